"""Callbacks over groups, mergeable distinct counts, key checks on arrival, set functions, nested documents."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from millrace.functions.tables import register_table_function
from millrace.operators import callbacks, distinct_bitmaps, quality
from millrace.operators.known_keys import KnownKeys
from millrace.sources import readers


# ---------------------------------------------------------------- callbacks
def mean_below(limit):
    return callbacks.GroupRule(
        start=lambda: [0.0, 0],
        fold=lambda s, rows: [s[0] + float(rows["v"].sum()), s[1] + len(rows)],
        merge=lambda a, b: [a[0] + b[0], a[1] + b[1]],
        keep=lambda s: s[0] < limit * s[1],
    )


def test_callback_equals_a_built_in_rule_on_a_hot_group(spark, rows):
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(F.concat(F.lit("g"), (F.col("id") % 40).cast("string")))
    df = spark.range(20_000).repartition(7).select("id", key.alias("g"), (F.col("id") % 2).alias("h"), (F.col("id") * 7919 % 101).cast("double").alias("v"))
    got = callbacks.keep_groups_by(df, ["g", "h"], ["v"], mean_below(50))
    means = df.groupBy("g", "h").agg(F.avg("v").alias("m")).where("m < 50 and g is not null")
    wanted = df.join(means.drop("m"), ["g", "h"], "left_semi")
    assert 0 < wanted.count() < df.count()
    assert rows(got.select("id")) == rows(wanted.select("id"))


def test_callback_sends_states_not_rows(spark):
    df = spark.range(30_000).repartition(6).select((F.col("id") % 2).alias("g"), F.col("id").cast("double").alias("v"))
    kept = callbacks.kept_groups(df, ["g"], ["v"], mean_below(1e9))
    assert sorted(r["g"] for r in kept.collect()) == [0, 1]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    # The first function stands below the exchange: tasks fold what they read.
    final = plan.split("Initial Plan")[0]
    assert final.index("MapInArrow") < final.index("Exchange") < final.rindex("MapInArrow")


def test_callback_with_many_groups_and_none(spark, monkeypatch):
    monkeypatch.setattr(callbacks, "HELD_STATES", 3)
    df = spark.range(500).repartition(3).select((F.col("id") % 97).alias("g"), F.col("id").cast("double").alias("v"))
    assert callbacks.kept_groups(df, ["g"], ["v"], mean_below(1e9)).count() == 97
    assert callbacks.kept_groups(df.limit(0), ["g"], ["v"], mean_below(1)).collect() == []


# ---------------------------------------------------------------- distinct counts
def test_bitmaps_merge_exactly(spark, tmp_path):
    path, rng = str(tmp_path / "b"), random.Random(2)
    batches = [[(rng.choice("abc"), rng.randrange(1, 200_000)) for _ in range(3000)] for _ in range(3)]
    batches[1] += [(None, 5), ("a", None)]
    seen = {}
    for batch in [*batches, batches[0]]:
        df = spark.createDataFrame(batch, "g string, id bigint")
        distinct_bitmaps.add_bitmaps(distinct_bitmaps.bitmaps(df, ["g"], "id"), path, ["g"])
        for g, i in batch:
            seen.setdefault(g, set()).update(() if i is None else (i,))
        counts = distinct_bitmaps.distinct_counts(distinct_bitmaps.stored_bitmaps(spark, path), ["g"], "n")
        assert {r["g"]: r["n"] for r in counts.collect()} == {g: len(s) for g, s in seen.items()}


def test_a_batch_rewrites_its_chunks_only(spark, tmp_path):
    path = str(tmp_path / "b")
    put = lambda ids: distinct_bitmaps.add_bitmaps(distinct_bitmaps.bitmaps(ids.withColumn("g", F.lit("x")), ["g"], "id"), path, ["g"])
    put(spark.range(1, 400_000))
    before = {f: os.path.getmtime(f) for f in glob.glob(f"{path}/*/part-*")}
    put(spark.range(40_000, 40_010))
    after = {f: os.path.getmtime(f) for f in glob.glob(f"{path}/*/part-*")}
    assert len(before) > 8 and len({os.path.dirname(f) for f in set(before) ^ set(after)}) == 1
    # One row for each chunk of 32,768 ids.
    assert distinct_bitmaps.stored_bitmaps(spark, path).count() == 13


# ---------------------------------------------------------------- key checks
@pytest.mark.parametrize("bits", [16, 24])
def test_arrivals_equal_the_full_checks(spark, tmp_path, rows, bits):
    known, rng = KnownKeys(str(tmp_path / "k"), buckets=4, bits=bits), random.Random(bits)
    everything = []
    for _ in range(3):
        batch = [(rng.choice([None, rng.randrange(3000), rng.randrange(10**9)]), i) for i in range(400)]
        df = spark.createDataFrame(batch, "k bigint, v int")
        old = spark.createDataFrame([(k,) for k in everything] or [(None,)], "k bigint")
        wanted = sorted(
            (k, sum(x == k for x, _ in batch)) for k in {x for x, _ in batch if x is not None} if k in set(everything) or sum(x == k for x, _ in batch) > 1
        )
        assert rows(known.repeated(df, "k")) == sorted(wanted, key=repr)
        lost = df.where("k is not null").join(old.dropna(), "k", "left_anti").select("k", "v")
        assert rows(known.missing(df, "k")) == rows(lost)
        known.add(df, "k")
        everything += [k for k, _ in batch if k is not None]


def test_arrivals_read_the_buckets_they_hit(spark, tmp_path):
    known = KnownKeys(str(tmp_path / "k"), buckets=64, bits=26)
    known.add(spark.range(5000).withColumnRenamed("id", "k"), "k")
    plan = known.missing(spark.createDataFrame([(7,), (8,)], "k bigint"), "k")._jdf.queryExecution().executedPlan().toString()
    import re

    buckets = re.findall(r"PartitionFilters: \[[^]]*_bucket#\d+ IN \(([\d,]+)\)", plan)
    assert buckets and all(len(b.split(",")) <= 2 for b in buckets)


def test_text_keys(spark, tmp_path, rows):
    known = KnownKeys(str(tmp_path / "k"), buckets=2, bits=18)
    known.add(spark.createDataFrame([("a",), ("é",), ("",), (None,)], "k string"), "k")
    batch = spark.createDataFrame([("a",), ("b",), ("",), ("b",), (None,)], "k string")
    assert rows(known.repeated(batch, "k")) == [("", 1), ("a", 1), ("b", 2)]
    assert rows(known.missing(batch, "k")) == [("b",), ("b",)]


# ---------------------------------------------------------------- set functions
def test_table_function_is_a_join_with_pushed_filters(spark, tmp_path):
    spark.range(1000).select("id", (F.col("id") % 10).alias("g")).write.parquet(str(tmp_path / "t"))
    items = spark.read.parquet(str(tmp_path / "t"))
    register_table_function(spark, "ids_of", "wanted BIGINT", "id BIGINT", "SELECT id FROM {items} WHERE g = wanted", items=items)
    called = spark.sql("SELECT a.id AS g, x.id FROM range(3) a, LATERAL ids_of(a.id) x WHERE x.id > 500")
    assert called.count() == 149
    plan = called._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "GreaterThan(id,500)" in plan
    assert sorted(r[0] for r in spark.sql("SELECT * FROM ids_of(4) WHERE id < 30").collect()) == [4, 14, 24]
    assert "EqualTo(g,4)" in spark.sql("SELECT * FROM ids_of(4)")._jdf.queryExecution().executedPlan().toString()


# ---------------------------------------------------------------- nested documents
def test_entries_of_mixed_documents(spark, tmp_path):
    texts = ['{"a": [1, "x", null, {"b": 2}], "c": 3}', '{"a": {"k": true, "z": [0]}}', '{"a": 5}', '{"a": []}', "{}", "broken{", None, '[{"a": 1}]']
    df = spark.createDataFrame(list(enumerate(texts)), "id int, j string").repartition(2)
    readers.variant_documents(df, "j").write.parquet(str(tmp_path / "v"))
    stored = spark.read.parquet(str(tmp_path / "v"))
    assert dict(stored.dtypes)["document"] == "variant"
    shown = lambda at, **kw: sorted(
        ((r["id"], r["pos"], r["key"], r["v"]) for r in readers.variant_entries(stored, "document", at, **kw).select("id", "pos", "key", F.to_json("value").alias("v")).collect()),
        key=repr,
    )
    assert shown("$.a") == sorted(
        [(0, 0, None, "1"), (0, 1, None, '"x"'), (0, 2, None, "null"), (0, 3, None, '{"b":2}'), (1, 0, "k", "true"), (1, 1, "z", "[0]")], key=repr
    )
    assert {r[0] for r in shown("$.a", keep_empty=True)} == set(range(8))
    assert (7, 0, None, '{"a":1}') in shown("$") and (0, 1, "c", "3") in shown("$")
    numbers = spark.createDataFrame([('{"a": 1, "b": [1.5]}',), ('{"a": 2, "c": "t"}',), ('{"b": [2]}',)], "j string")
    found = readers.merged_schema(readers.variant_documents(numbers, "j"), "document")
    assert found.startswith("OBJECT<a: BIGINT, b: ARRAY<") and "c: STRING" in found
