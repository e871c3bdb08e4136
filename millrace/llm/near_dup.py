"""MinHash near-duplicates: fast similarity sketches, banding, exact verification.

1. Every text becomes its set of word shingles, a digest of the set, and a fast
   similarity sketch (``shingles.sketches``). Equal sets collapse into one node.
2. Bands of sketch coordinates are hashed; nodes that share a band are candidates.
   Inside a bucket only a forest of the pairs whose sketches agree on at least
   ``screen`` of the coordinates is emitted, never all pairs.
3. Components of these forests are clusters: no link leads out of one. The texts of a
   cluster meet once, and links are confirmed on full sets; pairs that are connected
   already are not compared. Components of the links are the groups.

Buckets and clusters larger than a block are cut into blocks by hash, and each pair
of blocks is a unit of work, so a task holds two blocks at most and no pair is left out.

With the defaults a pair at the threshold is missed with a probability below 1e-6: no
band in common (0.6 to 0.8 in a million), or an estimate more than five deviations low.

Defined cases: texts without words (or missing) have an empty set and are linked with
nothing; a text with fewer words than a shingle is one shingle; rows with a missing
id have a missing group; rows that share an id are one document if their texts
agree and else are judged by each text; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import mix64
from millrace.llm.graph import connected
from millrace.llm.shingles import jaccard_at_least, shingle_sets, sketches
from millrace.session import written


@dataclass(frozen=True)
class Near:
    percent: int = 85
    width: int = 5
    rows: int = 6  # coordinates of a band
    bands: int = 30
    screen: float = 0.70  # least share of equal coordinates of a candidate
    bucket_block: int = 1024
    cluster_block: int = 512

    @property
    def size(self) -> int:
        return self.rows * self.bands


AT_85 = Near()
# 0.8 needs more and shorter bands for the same certainty.
AT_80 = Near(percent=80, rows=5, bands=36, screen=0.64)


def _digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _sketched(sets: list[np.ndarray], near: Near) -> tuple[np.ndarray, np.ndarray]:
    """Band hashes and one byte of each coordinate."""
    full = sketches(sets, near.size)
    bands = np.zeros((len(sets), near.bands), np.uint64)
    for j in range(near.rows):
        bands = mix64(bands * np.uint64(31) + full[:, j :: near.rows] + np.arange(near.bands, dtype=np.uint64))
    return bands, (full >> np.uint64(40)).astype(np.uint8)


def _facts(batches: Iterator[pa.RecordBatch], near: Near) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), 2000):
            part = batch.slice(at, 2000)
            sets = shingle_sets(part.column(1).cast(pa.binary()).to_pylist(), near.width)
            bands, small = _sketched(sets, near)
            full = [len(s) > 0 for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_digest(s) if f else None for s, f in zip(sets, full, strict=True)], pa.binary()),
                    pa.array([b.view(np.int64) if f else None for b, f in zip(bands, full, strict=True)], pa.list_(pa.int64())),
                    pa.array([k.tobytes() if f else None for k, f in zip(small, full, strict=True)], pa.binary()),
                ],
                ["id", "n_shingles", "node", "bands", "sketch"],
            )


class _Union:
    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)
        return a != b


def _forest(nodes: list[bytes], sides: list[int], marks: np.ndarray, near: Near, linked) -> list[tuple[bytes, bytes]]:
    """Edges that connect what ``linked`` connects; across sides if there are two."""
    union, out = _Union(len(nodes)), []
    side = np.array(sides)
    two = bool((side != side[0]).any())
    for i in range(len(nodes) - 1):
        like = (marks[i + 1 :] == marks[i]).mean(axis=1) >= near.screen
        if two:
            like &= side[i + 1 :] != side[i]
        for j in (np.flatnonzero(like) + i + 1).tolist():
            if union.find(i) != union.find(j) and linked(i, j):
                union.join(i, j)
                out.append((nodes[i], nodes[j]))
    return out


def _edges(batches: Iterator[pa.RecordBatch], near: Near, confirm: bool) -> Iterator[pa.RecordBatch]:
    """Forests of the units of work, which come sorted by ``unit``."""
    unit, held = None, []

    def done() -> pa.RecordBatch | None:
        if len(held) < 2:
            return None
        sets = [r["set"] for r in held] if confirm else None
        exact = (lambda i, j: jaccard_at_least(sets[i], sets[j], near.percent)) if confirm else (lambda i, j: True)
        marks = np.frombuffer(b"".join(r["sketch"] for r in held), np.uint8).reshape(len(held), -1)
        found = _forest([r["node"] for r in held], [r["side"] for r in held], marks, near, exact)
        return pa.RecordBatch.from_arrays([pa.array([e[k] for e in found], pa.binary()) for k in (0, 1)], ["a", "b"]) if found else None

    for batch in batches:
        rows = batch.to_pylist()
        if confirm:
            for r, s in zip(rows, shingle_sets([r.pop("text").encode("utf-8", "surrogatepass") for r in rows], near.width), strict=True):
                r["set"] = s
        for r in rows:
            if r["unit"] != unit:
                if (out := done()) is not None:
                    yield out
                unit, held = r["unit"], []
            # A text that shares the id but not the set of the node is another document.
            if confirm and _digest(r["set"]) != r["node"] or held and held[-1]["node"] == r["node"]:
                continue
            held.append(r)
    if (out := done()) is not None:
        yield out


def _units(members: DataFrame, counts: DataFrame, group: str, block: int) -> DataFrame:
    """Members dealt to units of work: the group, or each pair of its blocks."""
    blocks = F.ceil(F.col("n") / F.lit(float(block))).cast("int")
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = members.join(counts, group).withColumn("blocks", blocks).withColumn("mine", mine)
    pairs = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    unit = F.struct(F.col(group), F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"))
    # Within a block's own unit all pairs count; in a pair of blocks only those across.
    return pairs.withColumns({"unit": unit, "side": F.col("mine")}).drop("n", "blocks", "mine", "other", group)


def near_groups(docs: DataFrame, near: Near = AT_85, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id, kept) of every row."""
    plain = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    id_type = plain.schema["id"].dataType.simpleString()
    facts = written(
        plain.mapInArrow(
            lambda batches: _facts(batches, near),
            f"id {id_type}, n_shingles bigint, node binary, bands array<bigint>, sketch binary",
        ),
        "near-facts",
    )
    some = facts.where("node is not null")
    nodes = written(some.groupBy("node").agg(F.min("id").alias("id"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")), "near-nodes")

    banded = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = banded.join(shared.select("bucket"), "bucket").join(nodes.select("node", "sketch"), "node")
    units = _units(members, shared, "bucket", near.bucket_block)
    schema = "a binary, b binary"
    dealt = units.select("unit", "side", "node", "sketch").repartition("unit").sortWithinPartitions("unit", "node")
    candidates = dealt.mapInArrow(lambda batches: _edges(batches, near, False), schema).distinct()
    clusters = written(connected(candidates), "near-clusters")

    sizes = clusters.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
    wanted = clusters.join(nodes.select("node", "id", "sketch"), "node")
    texts = _units(wanted, sizes, "root", near.cluster_block)
    with_text = texts.join(plain.where("text is not null"), "id").select("unit", "side", "node", "sketch", "text")
    met = with_text.repartition("unit").sortWithinPartitions("unit", "node")
    links = met.mapInArrow(lambda batches: _edges(batches, near, True), schema)
    groups = written(connected(links), "near-groups")

    first = groups.join(nodes.select("node", "id"), "node").groupBy("root").agg(F.min("id").alias("first"))
    named = nodes.select("node", F.col("id").alias("own")).join(groups, "node", "left").join(first, "root", "left")
    named = named.select("node", F.coalesce("first", "own").alias("first"))
    group = F.when(F.col("id").isNotNull(), F.coalesce("first", "id"))
    return facts.select("id", "n_shingles", "node").join(named, "node", "left").select(
        F.col("id").alias(key), "n_shingles", group.alias("component_id"), group.eqNullSafe(F.col("id")).alias("kept")
    )


def drop_near_duplicates(docs: DataFrame, near: Near = AT_80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are the first of their group; exact repeats of a row with its id stay with it."""
    kept = near_groups(docs, near, key, text).where("kept").select(F.col(key).alias("_key")).distinct()
    return docs.join(kept, docs[key].eqNullSafe(kept["_key"]), "left_semi")


def near_sql(near: Near = AT_85) -> str:
    """Groups by comparing every pair of texts that share a shingle, in SQL."""
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    w = near.width
    return f"""
with recursive d as (select doc_id, regexp_extract_all(coalesce({lower}, ''), '[^\\x20\\x09-\\x0D]+') as w from documents),
s as (select distinct doc_id, array_to_string(w[i : i + {w - 1}], ' ') as g
  from (select doc_id, w, unnest(range(1, greatest(len(w) - {w - 1}, 1) + 1)) as i from d where len(w) > 0)),
n as (select doc_id, count(*) as n from s group by doc_id),
p as (select x.doc_id as a, y.doc_id as b, count(*) as both from s x join s y on x.g = y.g and x.doc_id < y.doc_id group by all),
e as (select a, b from p join n na on na.doc_id = a join n nb on nb.doc_id = b
  where 100 * p.both >= {near.percent} * (na.n + nb.n - p.both)),
u as (select a, b from e union all select b, a from e),
r as (select doc_id as a, doc_id as b from d union select r.a, u.b from r join u on r.b = u.a)
select doc_id, coalesce(any_value(n.n), 0)::bigint as n_shingles, min(r.b) as component_id, doc_id = min(r.b) as kept
from d join r on r.a = doc_id left join n using (doc_id) group by doc_id
"""
