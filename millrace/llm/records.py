"""Length-delimited binary records of token ids as a Spark data source.

A data file holds frames one after another: the payload's length (8 bytes), the masked
CRC-32C of these 8 bytes, the payload, and its masked CRC-32C; numbers are little-endian.
A payload is one byte of flags (bytes of an id; with 128, the key is missing), the
key (8 bytes), and the ids. Beside each data file an index file holds, for each record
and once more for the end, the byte offset of the frame and the number of ids before it
in the file (8 bytes each), so any record can be read alone.

``in_order`` range-sorts rows by key, and ``write_records`` writes a file for each partition;
a task's files get a name of their own, and the listing written at the commit names those
that count, so attempts that were lost leave nothing behind that is read. Files are reached
through Arrow's file systems (local, object stores, HDFS where its library is installed).

``format("framed_records").load(path)`` gives (file, at, key, start, ids), ids as unsigned
32-bit numbers and ``start`` the ids before the record over all files; with the option
``only=index`` (file, at, name, offset, length, start). Every checksum is verified; a
wrong one fails the task with the file and the place. ``shuffled_records`` reads
through the index in a seeded order.

Defined cases: rows without key come first; missing ids are an empty sequence; equal keys stand in
the order of their values' hash; no rows give a listing without files; other columns aren't written.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)

from millrace.llm.common import seeded_order
from millrace.llm.crc32c import crc32c, masked

FORMAT = "framed_records"
LISTING = "_files.json"
READ_BYTES = 4_000_000
WRITE_ROWS = 512
HEAD, TAIL, NAMED = 12, 4, 9
NO_KEY = 128
RECORDS = "file int, at bigint, key bigint, start bigint, ids binary"
INDEX = "file int, at bigint, name string, offset bigint, length bigint, start bigint"


def _place(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1)) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def frames(payloads: list[bytes]) -> list[bytes]:
    """Each payload with its length and checksums."""
    lengths = np.array([len(p) for p in payloads], "<u8")
    heads = masked(crc32c(lengths.view(np.uint8), np.full(len(payloads), 8)))
    data = np.frombuffer(b"".join(payloads), np.uint8)
    tails = masked(crc32c(data, lengths.astype(np.int64)))
    raw, head, tail = lengths.tobytes(), heads.astype("<u4").tobytes(), tails.astype("<u4").tobytes()
    return [raw[8 * i : 8 * i + 8] + head[4 * i : 4 * i + 4] + p + tail[4 * i : 4 * i + 4] for i, p in enumerate(payloads)]


def payloads(data: bytes, offsets: np.ndarray, name: str) -> list[bytes]:
    """The verified payloads of the frames of ``data`` that begin at the offsets; the last is the end."""
    flat = np.frombuffer(data, np.uint8)
    begin, end = offsets[:-1], offsets[1:]
    at = lambda start, size: flat[start[:, None] + np.arange(size)]
    heads = np.ascontiguousarray(at(begin, HEAD))
    lengths = np.ascontiguousarray(heads[:, :8]).view("<u8")[:, 0].astype(np.int64)
    wrong = masked(crc32c(heads[:, :8].ravel(), np.full(len(begin), 8))) != np.ascontiguousarray(heads[:, 8:]).view("<u4")[:, 0]
    wrong |= lengths != end - begin - HEAD - TAIL
    if not wrong.any():
        out = [data[b + HEAD : e - TAIL] for b, e in zip(begin.tolist(), end.tolist())]
        tails = np.ascontiguousarray(at(end - TAIL, TAIL)).view("<u4")[:, 0]
        wrong = masked(crc32c(np.frombuffer(b"".join(out), np.uint8), lengths)) != tails
    if wrong.any():
        raise ValueError(f"{name}: the record at byte {begin[wrong.argmax()]} of the part read doesn't match its checksum or length")
    return out


def serialized(key: int | None, ids: bytes, width: int) -> bytes:
    flags = width if key is not None else width | NO_KEY
    return bytes([flags]) + (key or 0).to_bytes(8, "little", signed=True) + ids


def parsed(payload: bytes) -> tuple[int | None, bytes]:
    """Key, and the ids as unsigned 32-bit numbers."""
    key = None if payload[0] & NO_KEY else int.from_bytes(payload[1:NAMED], "little", signed=True)
    ids = payload[NAMED:]
    return key, ids if payload[0] & 127 == 4 else np.frombuffer(ids, "<u2").astype("<u4").tobytes()


@dataclass
class Written(WriterCommitMessage):
    part: int
    name: str
    records: int
    ids: int


class Writer(DataSourceArrowWriter):
    def __init__(self, path: str, width: int):
        self.path, self.width = path, width

    def sequences(self, batch: pa.RecordBatch) -> Iterator[tuple[list, list]]:
        """Keys and ids of a few rows at a time."""
        for lo in range(0, batch.num_rows, WRITE_ROWS):
            part = batch.slice(lo, WRITE_ROWS)
            yield part.column("key").to_pylist(), part.column("ids").to_pylist()

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}"
        places, size, total = [], 0, 0
        files, folder = _place(self.path)
        out = None
        for keys, ids in (few for batch in iterator for few in self.sequences(batch)):
            if out is None:
                files.create_dir(folder, recursive=True)
                out = files.open_output_stream(f"{folder}/{name}.rec")
            found = [serialized(key, v or b"", self.width) for key, v in zip(keys, ids)]
            for frame, payload in zip(frames(found), found):
                places.append((size, total))
                size += len(frame)
                total += (len(payload) - NAMED) // self.width
                out.write(frame)
        if out is None:
            return Written(part, "", 0, 0)
        out.close()
        with files.open_output_stream(f"{folder}/{name}.idx") as index:
            index.write(np.array([*places, (size, total)], "<u8").tobytes())
        return Written(part, name, len(places), total)

    def commit(self, messages: list[Written | None]) -> None:
        named = sorted((m.part, m.name, m.records, m.ids) for m in messages if m and m.name)
        files, folder = _place(self.path)
        files.create_dir(folder, recursive=True)
        with files.open_output_stream(f"{folder}/{LISTING}") as out:
            out.write(json.dumps([{"name": n, "records": r, "ids": i} for _, n, r, i in named]).encode())

    def abort(self, messages: list[Written | None]) -> None:
        """Without a listing nothing is read."""


@dataclass
class File(InputPartition):
    number: int
    name: str
    start: int

    def __post_init__(self):
        super().__init__(self.number)


def _index(files: fs.FileSystem, folder: str, name: str) -> np.ndarray:
    with files.open_input_stream(f"{folder}/{name}.idx") as f:
        return np.frombuffer(f.read(), "<u8").reshape(-1, 2).astype(np.int64)


class Reader(DataSourceReader):
    def __init__(self, path: str, index_only: bool):
        self.path, self.index_only = path, index_only

    def partitions(self) -> list[File]:
        files, folder = _place(self.path)
        with files.open_input_stream(f"{folder}/{LISTING}") as f:
            named = json.loads(f.read())
        out, start = [], 0
        for number, entry in enumerate(named):
            out.append(File(number, entry["name"], start))
            start += entry["ids"]
        return out

    def read(self, partition: File) -> Iterator[pa.RecordBatch]:
        if partition is None or not hasattr(partition, "name"):
            return
        files, folder = _place(self.path)
        index = _index(files, folder, partition.name)
        offsets, before = index[:, 0], index[:, 1] + partition.start
        if self.index_only:
            n = len(offsets) - 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, partition.number, np.int32)), pa.array(np.arange(n)), pa.array([partition.name] * n, pa.string()),
                 pa.array(offsets[:-1]), pa.array(np.diff(offsets)), pa.array(before[:-1])],
                ["file", "at", "name", "offset", "length", "start"],
            )
            return
        with files.open_input_file(f"{folder}/{partition.name}.rec") as f:
            lo = 0
            while lo < len(offsets) - 1:
                hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + READ_BYTES, "right")) - 1)
                f.seek(int(offsets[lo]))
                data = f.read(int(offsets[hi] - offsets[lo]))
                rows = [parsed(p) for p in payloads(data, offsets[lo : hi + 1] - offsets[lo], partition.name)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(hi - lo, partition.number, np.int32)), pa.array(np.arange(lo, hi)), pa.array([k for k, _ in rows], pa.int64()),
                     pa.array(before[lo:hi]), pa.array([ids for _, ids in rows], pa.binary())],
                    ["file", "at", "key", "start", "ids"],
                )
                lo = hi


class FramedRecords(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return INDEX if self.options.get("only") == "index" else RECORDS

    def reader(self, schema) -> Reader:
        return Reader(self.options["path"], self.options.get("only") == "index")

    def writer(self, schema, overwrite: bool) -> Writer:
        return Writer(self.options["path"], int(self.options.get("width", 4)))


def in_order(rows: DataFrame, key: str, value: str) -> DataFrame:
    """The rows range-sorted by key, rising from partition to partition.

    A key with many rows is dealt over ranges by the hash of its value and a number of the row.
    """
    dealt = rows.select(F.col(key).cast("bigint").alias("key"), F.col(value).alias("value"))
    dealt = dealt.withColumns({"tie": F.xxhash64("value"), "row": F.monotonically_increasing_id()})
    order = ("key", "tie", "row")
    return dealt.repartitionByRange(*order).sortWithinPartitions(*order).select("key", "value")


def write_records(rows: DataFrame, path: str, width: int = 4) -> None:
    """Write (key, ids) to a new folder, a file for each partition; ``ids`` holds numbers of ``width`` bytes, little-endian."""
    rows.sparkSession.dataSource.register(FramedRecords)
    rows.select("key", "ids").write.format(FORMAT).option("width", width).mode("append").save(path)


def read_records(spark: SparkSession, path: str, index_only: bool = False) -> DataFrame:
    spark.dataSource.register(FramedRecords)
    reader = spark.read.format(FORMAT)
    return (reader.option("only", "index") if index_only else reader).load(path)


def shuffled_records(spark: SparkSession, path: str, seed: int) -> DataFrame:
    """(turn, file, at, key, ids) of all records in an order drawn from the seed: ``turn`` rises from partition to partition.

    Only the index is shuffled; each task then reads its records by their offsets.
    """
    index = read_records(spark, path, index_only=True)
    order = ("turn", "file", "at")
    drawn = index.withColumn("turn", seeded_order(seed, F.concat_ws(":", "file", "at")))
    dealt = drawn.repartitionByRange(*order).sortWithinPartitions(*order)

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, folder = _place(path)
        for batch in batches:
            rows, got = batch.to_pydict(), [b""] * batch.num_rows
            by_file: dict[str, list[int]] = {}
            for i, name in enumerate(rows["name"]):
                by_file.setdefault(name, []).append(i)
            for name, wanted in by_file.items():
                with files.open_input_file(f"{folder}/{name}.rec") as f:
                    for i in sorted(wanted, key=rows["offset"].__getitem__):
                        f.seek(rows["offset"][i])
                        got[i] = payloads(f.read(rows["length"][i]), np.array([0, rows["length"][i]]), name)[0]
            pairs = [parsed(p) for p in got]
            yield pa.RecordBatch.from_pydict(
                {"turn": rows["turn"], "file": pa.array(rows["file"], pa.int32()), "at": rows["at"],
                 "key": pa.array([k for k, _ in pairs], pa.int64()), "ids": pa.array([v for _, v in pairs], pa.binary())}
            )

    return dealt.mapInArrow(fetch, "turn bigint, file int, at bigint, key bigint, ids binary")
