"""Suffix-array deduplication: remove bytes of long strings that occur earlier.

A byte goes if a string of ``length`` bytes that covers it also starts earlier, in a
document with a smaller id or further left in the same one. The suffix array is
sparse and bounded in depth:

1. Every window of ``length`` bytes has an anchor: its leftmost ``ANCHOR``-byte substring
   of least hash. Neighbouring windows mostly share theirs, so a text falls into
   stretches of windows, and equal windows have equal anchors. Only hashes of anchors
   and stretches are shuffled, about one record for thirty bytes of text.
2. A stretch that occurred before as a whole is covered. Stretches of one anchor that
   differ (where repeats begin or end) need their bytes: the strings to the right and, in
   reverse, to the left of the anchor are suffix-sorted by deep-shallow sorting
   (``suffix_sort``), and neighbours' common prefixes tell which windows are equal.
3. Covered stretches return to their documents, which are cut.

A stretch repeated inside a batch is settled there, so a passage that most documents share
sends one record per batch. Stretches of an anchor with more than ``HOT`` variants
are dealt by the content of their windows instead of the anchor.

Anchors and whole stretches are compared by hashes of 57 and 64 bits together, all else by bytes.

Defined cases: a missing text is empty; a text shorter than ``length`` loses nothing; a
missing id comes after all others; occurrences with equal id and start count as one, in
rows of other texts too, so repeated rows are treated alike and do not remove each other; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import mix64
from millrace.llm.suffix_sort import deep_shallow_order
from millrace.session import written

U = np.uint64
ANCHOR = 32
SHALLOW = 16  # bytes beyond the anchor that the sort by levels looks at
HOT = 20_000
BLOCK_BYTES = 1 << 20
BUCKET_BYTES = 64 << 20
LAST_ID = np.iinfo(np.int64).max

_BYTES = mix64(np.arange(1, 257, dtype=np.uint64) * U(0x9E3779B97F4A7C15))
_STEPS = [U(0x9FB21C651E98DF25), U(0xD1342543DE82EF95), U(0xAF251AF3B0F025B5), U(0xB564EF22EC7AECE5), U(0xF7C2EBC08F67F2B5)]
_BASE = 0xB5297A4D3F84D5B5

STRETCH = np.dtype([("anchor", "<u8"), ("whole", "<u8"), ("id", "<i8"), ("row", "<u4"), ("lo", "<u4"), ("span", "u1"), ("rel", "u1")])
COVERED = np.dtype([("id", "<i8"), ("row", "<u4"), ("start", "<u4"), ("end", "<u4")])
VARIANT = np.dtype([("anchor", "<u8"), ("lo", "<u4"), ("span", "u1"), ("rel", "u1"), ("hot", "u1")])
PART = np.dtype([("start", "<u4"), ("end", "<u4")])


def _powers(base: int, n: int) -> np.ndarray:
    out, filled = np.ones(n, np.uint64), 1
    while filled < n:
        more = min(filled, n - filled)
        out[filled : filled + more] = out[:more] * U(pow(base, filled, 1 << 64))
        filled += more
    return out


class _Stretches:
    """Cuts concatenated texts into stretches of windows that share an anchor."""

    def __init__(self, length: int):
        self.length = length
        self.up, self.down = _powers(_BASE, 1), _powers(1, 1)

    def of(self, texts: list[bytes]) -> tuple[np.ndarray, ...]:
        """(text, lo, span, rel, anchor hash, hash of the stretch) of every stretch; ``lo`` counts from the text's start."""
        sizes = np.array([len(t) for t in texts], np.int64)
        data = np.frombuffer(b"".join(texts), np.uint8)
        n = len(data) - self.length + 1
        if n <= 0 or int(sizes.max()) < self.length:
            return tuple(np.zeros(0, np.int64) for _ in range(6))
        values = _BYTES[data]
        runs = values
        for step, gap in zip(_STEPS, (1, 2, 4, 8, 16), strict=True):
            runs = runs[:-gap] * step + runs[gap:]
        # The low bits hold the distance to the least hash, so ties go to the left.
        least = mix64(runs) & U(0xFFFFFFFFFFFFFF80)
        reach, wide = 1, self.length - ANCHOR + 1
        while reach < wide:
            gap = min(reach, wide - reach)
            least = np.minimum(least[:-gap], least[gap:] + U(gap))
            reach += gap
        starts = np.cumsum(sizes) - sizes
        enough = sizes >= self.length
        edge = np.zeros(n + 1, np.int8)
        np.add.at(edge, starts[enough], 1)
        np.add.at(edge, (starts + sizes - self.length + 1)[enough], -1)
        valid = np.cumsum(edge[:n]).astype(bool)
        at = np.where(valid, np.arange(n) + (least & U(127)).astype(np.int64), -1)
        cut = np.concatenate([[0], np.flatnonzero(at[1:] != at[:-1]) + 1, [n]])
        lo, hi = cut[:-1], cut[1:] - 1
        real = at[lo] >= 0
        lo, hi = lo[real], hi[real]
        if len(self.up) <= len(data):
            self.up = _powers(_BASE, len(data) + 1)
            self.down = _powers(pow(_BASE, -1, 1 << 64), len(data) + 1)
        sums = np.concatenate([[U(0)], np.cumsum(values * self.up[: len(data)], dtype=np.uint64)])
        span, rel = hi - lo, at[lo] - lo
        whole = (sums[hi + self.length] - sums[lo]) * self.down[lo]
        whole = mix64(whole + (span * 128 + rel).astype(np.uint64) * _STEPS[0])
        text = np.searchsorted(starts, lo, side="right") - 1
        # Empty texts share a start with the next one; the last of them owns it.
        return text, lo - starts[text], span, rel, least[lo] >> U(7), whole


def _blocks(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= BLOCK_BYTES):
            size += len(texts[end])
            end += 1
        yield at, end
        at = end


def _same_as_before(*keys: np.ndarray) -> np.ndarray:
    same = np.ones(len(keys[0]), bool)
    same[:1] = False
    for k in keys:
        same[1:] &= k[1:] == k[:-1]
    return same


def _firsts(order: np.ndarray, same: np.ndarray) -> np.ndarray:
    """For each sorted place the first place of its run of equal keys."""
    place = np.arange(len(order))
    return np.maximum.accumulate(np.where(same, 0, place))


def _dealt(kind: int, records: np.ndarray, bucket: np.ndarray) -> list[tuple[int, int, bytes]]:
    order = np.argsort(bucket, kind="stable")
    records, bucket = records[order], bucket[order]
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    return [(int(b[0]), kind, r.tobytes()) for b, r in zip(np.split(bucket, cuts), np.split(records, cuts), strict=True) if len(r)]


def _find(batches: Iterator[pa.RecordBatch], length: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Stretches by anchor (kind 0) and what is covered inside the batch (kind 1), as packed records."""
    cutter = _Stretches(length)
    for batch in batches:
        ids = np.array([LAST_ID if i is None else i for i in batch.column("id").to_pylist()], np.int64)
        rows = np.array(batch.column("row").to_pylist(), np.uint32)
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        order = np.argsort(ids, kind="stable")
        texts = [texts[i] or b"" for i in order]
        ids, rows = ids[order], rows[order]
        found = []
        for a, b in _blocks(texts):
            text, lo, span, rel, anchor, whole = cutter.of(texts[a:b])
            part = np.zeros(len(lo), STRETCH)
            part["anchor"], part["whole"], part["id"], part["row"] = anchor, whole, ids[a + text], rows[a + text]
            part["lo"], part["span"], part["rel"] = lo, span, rel
            found.append(part)
        s = np.concatenate(found) if found else np.zeros(0, STRETCH)
        if not len(s):
            continue
        by = np.lexsort((s["row"], s["lo"], s["id"], s["whole"]))
        same = _same_as_before(s["whole"][by], s["anchor"][by])
        first = by[_firsts(by, same)]
        later = by[same & ((s["id"][by] != s["id"][first]) | (s["lo"][by] != s["lo"][first]))]
        # Another row of the first one's id and start stays: an earlier document may cover both.
        again = np.zeros(len(s), bool)
        again[later] = True
        again[by[same & _same_as_before(s["row"][by], s["id"][by], s["lo"][by])]] = True
        out = _dealt(0, s[~again], (s["anchor"][~again] % U(buckets)).astype(np.int64))
        later.sort()
        c = _covered(s["id"][later], s["row"][later], s["lo"][later], s["lo"][later].astype(np.int64) + s["span"][later] + length)
        out += _dealt(1, c, np.mod(c["id"], buckets))
        yield pa.RecordBatch.from_arrays(
            [pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.int32()), pa.array([o[2] for o in out], pa.binary())],
            ["bucket", "kind", "packed"],
        )


def _covered(ids, rows, starts, ends) -> np.ndarray:
    """Covered byte ranges, sorted by document and start, with those that touch joined."""
    out = np.zeros(len(ids), COVERED)
    out["id"], out["row"], out["start"], out["end"] = ids, rows, starts, ends
    if not len(out):
        return out
    out = out[np.lexsort((out["start"], out["row"], out["id"]))]
    new = ~_same_as_before(out["id"], out["row"])
    document = np.cumsum(new).astype(np.int64) << 33
    reach = np.maximum.accumulate(document + out["end"])
    new[1:] |= document[1:] + out["start"][1:] > reach[:-1]
    firsts = np.flatnonzero(new)
    joined = out[firsts]
    joined["end"] = (reach[np.append(firsts[1:], len(out)) - 1] & ((1 << 33) - 1)).astype(np.uint32)
    return joined


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """The rows of each bucket; they come sorted by bucket."""
    held: list[tuple] = []
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for row in zip(*columns, strict=True):
            if held and held[0][0] != row[0]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _documents(covered: np.ndarray, variants: np.ndarray, v_ids: np.ndarray, v_rows: np.ndarray) -> pa.RecordBatch:
    """One row per document: packed covered ranges, packed variants."""
    out: dict[tuple[int, int], list[bytes | None]] = {}
    for records, ids, rows, slot in ((covered[list(PART.names)], covered["id"], covered["row"], 0), (variants, v_ids, v_rows, 1)):
        if not len(records):
            continue
        order = np.lexsort((rows, ids))
        records, ids, rows = records[order], ids[order], rows[order]
        packed = np.zeros(len(records), PART if slot == 0 else VARIANT)
        for name in packed.dtype.names:
            packed[name] = records[name]
        starts = np.flatnonzero(~_same_as_before(ids, rows))
        ends = np.append(starts[1:], len(ids))
        size, raw = packed.dtype.itemsize, packed.tobytes()
        for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
            out.setdefault((int(ids[a]), int(rows[a])), [None, None])[slot] = raw[a * size : b * size]
    keys = list(out)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([k[0] for k in keys], pa.int64()),
            pa.array([k[1] for k in keys], pa.int64()),
            pa.array([out[k][0] for k in keys], pa.binary()),
            pa.array([out[k][1] for k in keys], pa.binary()),
        ],
        ["id", "row", "covered", "variants"],
    )


DOCUMENT_SCHEMA = "id bigint, row bigint, covered binary, variants binary"


def _settle(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Per bucket: whole stretches that occurred before are covered; anchors with differing ones give variants."""
    for rows in _by_bucket(batches):
        s = np.frombuffer(b"".join(r[2] for r in rows if r[1] == 0), STRETCH)
        covered = [np.frombuffer(b"".join(r[2] for r in rows if r[1] == 1), COVERED)]
        by = np.argsort(s["anchor"], kind="stable")
        same = _same_as_before(s["anchor"][by])
        shared = same | np.append(same[1:], False)
        s = s[by[shared]]
        by = np.lexsort((s["row"], s["lo"], s["id"], s["whole"], s["anchor"]))
        s = s[by]
        same = _same_as_before(s["anchor"], s["whole"])
        first = _firsts(by, same)
        later = same & ((s["id"] != s["id"][first]) | (s["lo"] != s["lo"][first]))
        covered.append(_covered(s["id"][later], s["row"][later], s["lo"][later], s["lo"][later].astype(np.int64) + s["span"][later] + length))
        anchor = np.cumsum(~_same_as_before(s["anchor"])) - 1
        differing = (np.bincount(anchor, ~same) > 1)[anchor]
        s = s[differing & ~later & ~(same & _same_as_before(s["row"], s["id"], s["lo"]))]
        v = np.zeros(len(s), VARIANT)
        for name in ("anchor", "lo", "span", "rel"):
            v[name] = s[name]
        if len(v):
            starts = np.flatnonzero(~_same_as_before(v["anchor"]))
            sizes = np.diff(np.append(starts, len(v)))
            v["hot"] = np.repeat(sizes > HOT, sizes)
        yield _documents(np.concatenate(covered), v, s["id"], s["row"])


def _extract(batches: Iterator[pa.RecordBatch], length: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """The bytes of the variants, dealt by anchor; those of hot anchors window by window, dealt by content."""
    for batch in batches:
        out: dict[int, list[tuple[int, int, int, int, int, int, bytes]]] = {}
        ids, rows, texts, lists = (batch.column(n).to_pylist() for n in ("id", "row", "text", "variants"))
        for i, row, text, packed in zip(ids, rows, texts, lists, strict=True):
            raw = text.encode("utf-8", "surrogatepass")
            i = LAST_ID if i is None else i
            for anchor, lo, span, rel, hot in np.frombuffer(b"".join(packed), VARIANT).tolist():
                if hot:
                    for s in range(lo, lo + span + 1):
                        window = raw[s : s + length]
                        out.setdefault(zlib.crc32(window) % buckets, []).append((anchor, i, row, s, 0, rel - (s - lo), window))
                else:
                    out.setdefault(anchor % buckets, []).append((anchor, i, row, lo, span, rel, raw[lo : lo + span + length]))
        names = list(out)
        packed = []
        for b in names:
            head = np.zeros(len(out[b]), STRETCH)
            for name, column in zip(("anchor", "id", "row", "lo", "span", "rel"), list(zip(*out[b], strict=True))[:6], strict=True):
                head[name] = column
            packed.append((head.tobytes(), b"".join(v[6] for v in out[b])))
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.int32()), *(pa.array([p[k] for p in packed], pa.binary()) for k in (0, 1))], ["bucket", "heads", "bytes"]
        )


def _equal_windows(s: np.ndarray, strings: list[bytes], length: int) -> np.ndarray:
    """For each stretch and distance from window start to anchor: does the window start earlier elsewhere?"""
    anchors = np.unique(s["anchor"], return_inverse=True)[1]
    rel, span = s["rel"].astype(np.int64), s["span"].astype(np.int64)
    right = [x[r:] for x, r in zip(strings, rel.tolist(), strict=True)]
    left = [x[:r][::-1] for x, r in zip(strings, rel.tolist(), strict=True)]
    sides = [deep_shallow_order(right, anchors, ANCHOR + SHALLOW), deep_shallow_order(left, anchors, SHALLOW)]
    anchor_at = s["lo"].astype(np.int64) + rel
    by = np.lexsort((anchor_at, s["id"]))
    rank = np.zeros(len(s), np.int64)
    rank[by] = np.cumsum(~_same_as_before(s["id"][by], anchor_at[by]))
    wide = length - ANCHOR + 1
    again = np.zeros((len(s), wide), bool)

    def classes(side: int, depth: int) -> np.ndarray:
        """Equal numbers for equal anchors and equal first ``depth`` bytes beside them."""
        order, prefix = sides[side]
        out = np.zeros(len(s), np.int64)
        fresh = prefix < depth
        if depth == 0:
            fresh = np.diff(anchors[order], prepend=-1) != 0
        out[order] = np.cumsum(fresh)
        return out

    for a in range(wide):
        mine = np.flatnonzero((rel - span <= a) & (a <= rel))
        if not len(mine):
            continue
        key = classes(0, length - a)[mine] * (len(s) + 1) + classes(1, a)[mine]
        by = np.lexsort((rank[mine], key))
        first = _firsts(by, _same_as_before(key[by]))
        ranks = rank[mine][by]
        again[mine[by], a] = ranks > ranks[first]
    return again


def _compare(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for rows in _by_bucket(batches):
        s = np.frombuffer(b"".join(r[1] for r in rows), STRETCH)
        raw = b"".join(r[2] for r in rows)
        ends = np.cumsum(s["span"].astype(np.int64) + length)
        starts = ends - s["span"] - length
        again = _equal_windows(s, [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], length)
        which, a = np.nonzero(again)
        at = s["lo"][which].astype(np.int64) + s["rel"][which] - a
        covered = _covered(s["id"][which], s["row"][which], at, at + length)
        yield _documents(covered, np.zeros(0, VARIANT), s["id"][:0], s["row"][:0])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        texts, lists = batch.column("text").cast(pa.binary()).to_pylist(), batch.column("covered").to_pylist()
        n_bytes, n_removed, spans, kept = [], [], [], []
        for text, packed in zip(texts, lists, strict=True):
            text = text or b""
            parts = np.frombuffer(b"".join(packed or []), PART)
            zeros = np.zeros(len(parts), np.int64)
            runs = _covered(zeros, zeros, parts["start"], parts["end"])
            out, at = [], 0
            for start, end in zip(runs["start"].tolist(), runs["end"].tolist(), strict=True):
                out.append(text[at:start])
                at = end
            out.append(text[at:])
            n_bytes.append(len(text))
            n_removed.append(int((runs["end"].astype(np.int64) - runs["start"]).sum()))
            spans.append([{"start": a, "end": b} for a, b in zip(runs["start"].tolist(), runs["end"].tolist(), strict=True)])
            kept.append(b"".join(out))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(spans, spans_type), pa.array(kept, pa.binary())],
            ["id", "n_bytes", "n_removed", "spans", "kept"],
        )


def remove_repeats(docs: DataFrame, length: int = 100, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, n_removed, spans, kept): removed byte ranges and the bytes that stay, for every row."""
    if not ANCHOR < length <= ANCHOR + 127:
        raise ValueError(f"length must lie between {ANCHOR + 1} and {ANCHOR + 127}")
    spark = docs.sparkSession
    plain = docs.select(
        F.col(key).cast("bigint").alias("id"),
        F.col(text).alias("text"),
        F.coalesce(F.crc32(F.col(text).cast("binary")), F.lit(0)).alias("row"),
    )
    total = plain.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET_BYTES))

    found = plain.mapInArrow(lambda it: _find(it, length, buckets), "bucket int, kind int, packed binary")
    met = found.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    settled = written(met.mapInArrow(lambda it: _settle(it, length), DOCUMENT_SCHEMA), "repeats")

    document = F.struct(F.coalesce("id", F.lit(LAST_ID)).alias("id"), "row")
    keyed = plain.select(document.alias("document"), "id", "row", "text")
    listed = lambda rows, name: rows.where(F.col(name).isNotNull()).groupBy(F.struct("id", "row").alias("document")).agg(F.collect_list(name).alias(name))
    wanted = keyed.join(listed(settled, "variants"), "document").dropDuplicates(["document"]).select("id", "row", "text", "variants")
    extracted = wanted.mapInArrow(lambda it: _extract(it, length, buckets), "bucket int, heads binary, bytes binary")
    beside = extracted.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    compared = beside.mapInArrow(lambda it: _compare(it, length), DOCUMENT_SCHEMA)

    covered = listed(settled.select("id", "row", "covered").unionByName(compared.select("id", "row", "covered")), "covered")
    cut = keyed.join(covered, "document", "left").select("id", "text", "covered")
    schema = "id bigint, n_bytes bigint, n_removed bigint, spans array<struct<start: bigint, end: bigint>>, kept binary"
    return cut.mapInArrow(_cut, schema).withColumnRenamed("id", key)


def repeats_sql(length: int = 100) -> str:
    """The digest of ``op3`` in SQL, with every window as a row."""
    return f"""
with d as (select doc_id, hex(encode(coalesce(text, ''))) as x, strlen(coalesce(text, '')) as n from documents),
w as (select doc_id, s, md5(x[2 * s + 1 : 2 * (s + {length})]) as h
  from (select doc_id, x, unnest(range(n - {length} + 1)) as s from d where n >= {length})),
l as (select doc_id, s, row_number() over (partition by h order by doc_id, s) > 1 as again from w),
g as (select doc_id, s, s - coalesce(max(s) over (partition by doc_id order by s rows between unbounded preceding and 1 preceding), -1000) > {length} as fresh
  from l where again),
r as (select doc_id, min(s) as a, max(s) + {length} as b
  from (select *, sum(fresh::int) over (partition by doc_id order by s) as run from g) group by doc_id, run),
k as (select doc_id, a, b, lag(b, 1, 0) over (partition by doc_id order by a) as was from r),
o as (select doc_id, sum(b - a) as n_removed, count(*) as n_spans, max(b) as last,
    string_agg(x[2 * was + 1 : 2 * a], '' order by a) as head from k join d using (doc_id) group by doc_id)
select doc_id, n::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0) as n_spans,
  sha256(unhex(coalesce(head, '') || x[2 * coalesce(last, 0) + 1 :])) as kept_sha256
from d left join o using (doc_id)
"""
