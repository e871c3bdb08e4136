import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.llm.common import positions
from millrace.llm.sharding import assign_shards, shard_documents


def table_rows(n=1000):
    rows = [(i, f"text {i % 37} é", "en", "hot" if i % 3 else f"s{i % 5}") for i in range(n)]
    return rows + [(2, "text", "en", None), (2, "text", "en", None), (None, None, None, None), (4, "", "en", "hot")]


@pytest.mark.parametrize("shards", [1, 7, 40])
def test_shards_are_even_gapless_and_mixed(docs, shards):
    rows = table_rows()
    got = assign_shards(docs(rows, 5, ["size", "_rank", "shard"]), shards).collect()
    facts = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, _, _ in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == facts
    counts = Counter(r["shard"] for r in got)
    assert len(counts) == shards and max(counts.values()) - min(counts.values()) <= 1
    for shard, n in counts.items():
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(range(n))
    source = {i: s for i, _, _, s in rows}
    for name in ("hot", "s0"):
        each = Counter(r["shard"] for r in got if source[r["doc_id"]] == name)
        # Proportional strata: each shard holds its part of the source, give or take a few.
        assert max(each.values()) - min(each[s] for s in range(shards)) <= 3


def test_seed_and_layout(docs):
    rows = table_rows(300)
    as_set = lambda frame: Counter(tuple(r) for r in frame.collect())
    assert as_set(assign_shards(docs(rows, 2), 10)) == as_set(assign_shards(docs(rows[::-1], 6), 10))
    assert as_set(assign_shards(docs(rows, 2), 10)) != as_set(assign_shards(docs(rows, 2), 10, seed=1))


def test_documents_with_repeated_rows(docs):
    rows = table_rows(60)
    frame = docs(rows, 3, ["shard", "_crc"])
    got = shard_documents(frame, 4)
    assert got.columns == [*(c for c in frame.columns if c != "shard"), "shard", "slot"]
    assert Counter((r["doc_id"], r["text"]) for r in got.collect()) == Counter((r[0], r[1]) for r in rows)
    assert len({(r["shard"], r["slot"]) for r in got.collect()}) == len(rows)


def test_fewer_rows_than_shards_and_empty(docs):
    assert sorted(r["slot"] for r in assign_shards(docs([(1, "a"), (2, "b")]), 40).collect()) == [0, 0]
    assert assign_shards(docs([], 1)).collect() == []


def test_positions_number_groups_over_buckets(spark):
    frame = spark.range(5000).select((F.col("id") % 3).alias("g"), (F.xxhash64("id") % 100 / 200 + 0.5).alias("x"), "id")
    frame = frame.withColumn("x", F.greatest(F.lit(0.0), F.least(F.lit(0.999), F.col("x"))))
    sized = frame.join(frame.groupBy("g").count(), "g")
    rows = positions(sized, ["g"], "x", ["id"], "count", "at", per_bucket=50).collect()
    for g in range(3):
        mine = sorted((r for r in rows if r["g"] == g), key=lambda r: (r["x"], r["id"]))
        assert [r["at"] for r in mine] == list(range(len(mine)))


def brute(rows, shards, seed):
    """(id, size, crc, shard, slot) by plain sorting; Spark's xxhash64 chains the columns' hashes as seeds and leaves out missing ones."""
    import struct
    import zlib

    import xxhash

    def xx(*values):
        h = 42
        for kind, v in values:
            if v is not None:
                data = v.encode() if kind == "s" else struct.pack("<i" if kind == "i" else "<q", v)
                h = xxhash.xxh64_intdigest(data, h)
        return h

    facts = []
    for key, text, source in rows:
        data = (text or "").encode()
        crc = zlib.crc32(data)
        draw = (xx(("i", seed), ("l", key), ("l", crc)) >> 11) / 2**53
        facts.append((source, draw, key, crc, len(data) + 16))
    order = lambda f: (f[1], f[2] is not None, f[2] or 0, f[3], f[4])
    placed = []
    for source in {f[0] for f in facts}:
        mine = sorted((f for f in facts if f[0] == source), key=order)
        start = (xx(("i", seed), ("s", source)) >> 11) / 2**53
        placed += [((at + start) / len(mine), source is not None, source or "", order(f), f) for at, f in enumerate(mine)]
    out = []
    for at, (*_, f) in enumerate(sorted(placed)):
        shard = at * shards // len(placed)
        out.append((f[2], f[4], f[3], shard, at - -(-shard * len(placed) // shards)))
    return sorted(out, key=repr)


def test_registered_assignment_equals_plain_sorting(spark, small):
    import random

    from millrace.llm import queries
    from millrace.llm.sharding import assign_shards

    given = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    found = sorted(((r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in queries.op10_stratified_shards(spark, small).collect()), key=repr)
    assert found == brute(given, 40, 17)
    rng = random.Random(8)
    rows = [(rng.choice([None, 3, i]), rng.choice(["copy", None, f"text {i}"]), rng.choice([None, "a", "b", "b", "b"])) for i in range(500)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(5)
    found = sorted((tuple(r) for r in assign_shards(frame, 7, 99).collect()), key=repr)
    assert found == brute(rows, 7, 99)
