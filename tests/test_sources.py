import datetime
import glob
import json
import os
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import scratch_dir
from millrace.sources import readers, tables, writers

NAMED = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])


def put(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_json_array_reads_named_fields_only(spark, tmp_path):
    path = put(tmp_path, "a.json", json.dumps([{"id": 1, "name": "a, b", "x": 1}, {"id": 2, "name": ""}]))
    assert [tuple(r) for r in readers.json_arrays(spark, path, NAMED).collect()] == [(1, "a, b"), (2, "")]


def test_written_arrays_are_valid_json_files(spark, tmp_path, rows):
    df = spark.range(25).select("id", F.concat(F.lit("n"), F.col("id").cast("string")).alias("name"))
    out = str(tmp_path / "arrays")
    writers.write_json_arrays(df, "id", 10, out)
    files = glob.glob(f"{out}/part=*/part-*")
    assert len(files) == 3 and sum(len(json.load(open(f))) for f in files) == 25
    assert rows(readers.json_arrays(spark, out, NAMED)) == rows(df)


def test_csv_missing_texts_match_the_whole_cell(spark, tmp_path):
    schema = T.StructType(
        [T.StructField("id", T.LongType()), T.StructField("t", T.StringType()), T.StructField("n", T.DoubleType())]
    )
    body = 'id,t,n\n1,NA,1.5\n2, NA,NaN\n3,"a ""q""\nb",\n4,none,null\n'
    got = [tuple(r) for r in readers.csv_with_header(spark, put(tmp_path, "a.csv", body), schema).collect()]
    assert got == [(1, None, 1.5), (2, " NA", None), (3, 'a "q"\nb', None), (4, "none", None)]


def test_csv_round_trip_keeps_blanks_and_breaks(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, " a \n\"b\", c"), (2, None), (3, "ü\u2003")], "id bigint, name string")
    out = str(tmp_path / "csv")
    writers.write_csv(df, out)
    assert rows(readers.csv_with_header(spark, out, NAMED)) == rows(df)


def test_csv_with_another_header_fails(spark, tmp_path):
    with pytest.raises(Exception, match="(?i)header"):
        readers.csv_with_header(spark, put(tmp_path, "a.csv", "name,id\na,1\n"), NAMED).collect()


def test_csv_without_line_breaks_is_split(spark, tmp_path, rows):
    df = spark.range(3000).select("id", F.concat(F.lit('a "b", '), F.col("id").cast("string")).alias("name"))
    out = str(tmp_path / "csv")
    writers.write_csv(df.coalesce(1), out)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    try:
        whole, split = (readers.csv_with_header(spark, out, NAMED, line_breaks=b) for b in (True, False))
        assert whole.rdd.getNumPartitions() == 1 and split.rdd.getNumPartitions() > 3
        assert rows(split) == rows(whole) == rows(df)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_written_arrays_of_a_repeated_key(spark, tmp_path, rows):
    df = spark.range(500).select(F.lit(7).cast("bigint").alias("id"), F.col("id").cast("string").alias("name"))
    out = str(tmp_path / "arrays")
    writers.write_json_arrays(df, "id", 10, out)
    assert rows(readers.json_arrays(spark, out, NAMED)) == rows(df)


def test_written_arrays_of_missing_keys_are_dealt_over_files(spark, tmp_path, rows):
    key = F.when(F.col("id") % 3 > 0, F.col("id"))
    df = spark.range(300).repartition(4).select(key.alias("id"), F.col("id").cast("string").alias("name"))
    out = str(tmp_path / "arrays")
    writers.write_json_arrays(df, "id", 10, out)
    sizes = [len(json.load(open(f))) for f in glob.glob(f"{out}/part=none*/part-*")]
    assert len(sizes) == 5 and sum(sizes) == 100 and max(sizes) < 40
    assert rows(readers.json_arrays(spark, out, NAMED)) == rows(df)


def test_numeric_vector(spark, tmp_path):
    path = put(tmp_path, "v.csv", "70, 120, 70, 50 , 110\n")
    got = readers.numeric_vectors(spark, path).orderBy("pos").collect()
    assert [tuple(r) for r in got] == [(0, 70.0), (1, 120.0), (2, 70.0), (3, 50.0), (4, 110.0)]


def test_variant_parameters_and_nan(spark):
    df = spark.createDataFrame([('{"k": 5, "a": {"b": "x"}}', float("nan")), ("{}", 1.0)], "j string, x double")
    got = readers.variant_fields(df, "j", k="$.k:int", b="$.a.b:string").select("k", "b").collect()
    assert [tuple(r) for r in got] == [(5, "x"), (None, None)]
    assert [r["x"] for r in readers.without_nan(df).collect()] == [None, 1.0]
    hits = readers.select_with_parameters(spark, "SELECT x FROM {d} WHERE x = :v", {"v": 1.0}, d=df)
    assert hits.count() == 1


def test_bundle_guards(spark, tmp_path):
    df = spark.range(1)
    with pytest.raises(ValueError):
        writers.export_bundle({}, "json", str(tmp_path / "a"))
    with pytest.raises(ValueError):
        writers.export_bundle({"a": df}, "yaml", str(tmp_path / "b"))
    dated = df.select(F.current_date().alias("d"))
    with pytest.raises(TypeError):
        writers.export_bundle({"a": dated}, "json", str(tmp_path / "c"))
    writers.export_bundle({"a": dated}, "XML", str(tmp_path / "d"))


def test_bundle_contents(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", None)], "name string, n int").withColumn(
        "m", F.lit("1.50").cast("decimal(5,2)")
    )
    folders = writers.export_bundle({"r": df.coalesce(1)}, "json", str(tmp_path / "j"))
    lines = [json.loads(x) for f in glob.glob(folders["r"] + "/part-*") for x in open(f)]
    assert lines == [{"name": "a", "n": 1, "m": 1.5}, {"name": "b", "n": None, "m": 1.5}]
    folders = writers.export_bundle({"r": df.coalesce(1)}, "xml", str(tmp_path / "x"))
    text = "".join(open(f).read() for f in glob.glob(folders["r"] + "/part-*"))
    assert "<r>" in text and "<n>None</n>" in text and len(re.findall("<row>", text)) == 2
    back = writers.read_xml_rows(spark, folders["r"], ["name", "n"]).orderBy("name").collect()
    assert [tuple(r) for r in back] == [("a", "1"), ("b", None)]


def test_month_partitions_prune_and_refuse(spark, tmp_path):
    data = [("2022-01-01 00:00:00",), ("2022-01-31 23:59:59",), ("2022-02-01 00:00:00",), ("2021-12-31 23:59:59",), (None,)]
    df = spark.createDataFrame(data, "t string").select(F.col("t").cast("timestamp_ntz").alias("ts"))
    out = str(tmp_path / "months")
    with pytest.raises(Exception, match="no partition for ts"):
        writers.write_by_month(df, "ts", "2022-01", "2022-07", str(tmp_path / "strict"))
    writers.write_by_month(df, "ts", "2022-01", "2022-07", out, str(tmp_path / "rejects"))
    assert spark.read.parquet(str(tmp_path / "rejects")).count() == 2
    assert sorted(os.path.basename(p) for p in glob.glob(out + "/month=*")) == ["month=2022-01", "month=2022-02"]
    january = writers.read_months(spark, out, "2022-01", "2022-01")
    assert january.count() == 2
    plan = january._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan


def test_full_refresh_is_repeatable_and_checks_columns(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.LongType(), False)])
    for _ in range(2):
        tables.full_refresh(spark, {"refresh_parent": (spark.range(3), schema)}, str(tmp_path / "w"))
        assert spark.table("refresh_parent").count() == 3
    gap = spark.createDataFrame([(None,)], "id bigint")
    with pytest.raises(Exception, match="id is missing"):
        tables.full_refresh(spark, {"refresh_gap": (gap, schema)}, str(tmp_path / "w"))
    spark.sql("DROP TABLE IF EXISTS refresh_parent")


def test_upsert_rules(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.read_keyed(spark, path) is None
    tables.upsert_by_key(spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "id int, t string, kept int"), path, "id", F.lit(0))
    batch = spark.createDataFrame(
        [(2, "x", 1, "n"), (2, None, 2, "n"), (3, "c", 1, "n"), (None, "z", 1, "n")], "id int, t string, seq int, extra string"
    )
    tables.upsert_by_key(batch, path, "id", F.col("seq"), columns=["id", "t", "extra"])
    got = {r["id"]: (r["t"], r["kept"], r["extra"]) for r in tables.read_keyed(spark, path).collect()}
    assert got == {1: ("a", 5, None), 2: (None, 6, "n"), 3: ("c", None, "n")}


def test_repeated_batch_of_a_writer_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    put_one = lambda v, **by: tables.upsert_by_key(spark.createDataFrame([(1, v)], "id int, v int"), path, "id", F.lit(0), **by)
    value = lambda: tables.read_keyed(spark, path).first()["v"]
    for n in range(3):
        assert put_one(n, writer="a", number=n)
    assert not put_one(99, writer="a", number=2) and not put_one(98, writer="a", number=0)
    assert value() == 2
    assert put_one(50, writer="b", number=0) and value() == 50
    assert put_one(51) and value() == 51
    assert sorted(map(str, (tuple(r) for r in tables.applied_batches(spark, path).collect()))) == sorted(
        map(str, [("a", 0, 16), ("a", 1, 16), ("a", 2, 16), ("b", 0, 16), (None, 0, 16)])
    )


def test_only_touched_buckets_are_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.upsert_by_key(spark.range(200).withColumn("v", F.lit(0)), path, "id", F.lit(0), buckets=8)
    parts = lambda: {f: os.path.getmtime(f) for f in glob.glob(f"{path}/*/part-*.parquet")}
    before = parts()
    change = spark.createDataFrame([(7, 1)], "id bigint, v int")
    tables.upsert_by_key(change, path, "id", F.lit(0), buckets=8)
    after = parts()
    assert len({os.path.dirname(f) for f in set(before) - set(after)}) == len({os.path.dirname(f) for f in set(after) - set(before)}) == 1
    assert all(after[f] == m for f, m in before.items() if f in after)
    assert {r["id"]: r["v"] for r in tables.read_keyed(spark, path).collect()} == {i: int(i == 7) for i in range(200)}
    with pytest.raises(ValueError, match="8 buckets"):
        tables.upsert_by_key(change, path, "id", F.lit(0), buckets=16)


def test_batch_that_failed_before_its_log_is_repeated(spark, tmp_path):
    """The same records set twice, as a query does that stops between the table and the log."""
    path, day = str(tmp_path / "t"), lambda d: F.lit(d).cast("timestamp_ntz")
    rows = spark.range(50).withColumn("v", F.lit(0))
    tables.upsert_by_key(rows, path, "id", F.lit(0), writer="q", number=0, stamp="at", now=day("2024-01-01"))
    change = spark.range(20, 70).withColumn("v", F.lit(1))
    again = dict(writer="q", number=1, stamp="at")
    assert tables.upsert_by_key(change, path, "id", F.lit(0), **again, now=day("2024-02-01"))
    done = sorted(tuple(r) for r in tables.read_keyed(spark, path).collect())
    log = str(tmp_path / "t_batches")
    kept = tables.applied_batches(spark, path).where("number = 0").collect()
    spark.createDataFrame(kept, "writer string, number bigint, buckets int").write.mode("overwrite").parquet(log)
    assert tables.upsert_by_key(change, path, "id", F.lit(0), **again, now=day("2024-03-01"))
    assert sorted(tuple(r) for r in tables.read_keyed(spark, path).collect()) == done


def test_empty_batch_and_empty_table(spark, tmp_path):
    path = str(tmp_path / "t")
    none = spark.createDataFrame([], "id int, v int")
    tables.upsert_by_key(none, path, "id", F.lit(0))
    assert tables.read_keyed(spark, path) is None
    tables.upsert_by_key(spark.createDataFrame([(1, 1)], "id int, v int"), path, "id", F.lit(0))
    tables.upsert_by_key(none, path, "id", F.lit(0))
    assert [tuple(r) for r in tables.read_keyed(spark, path).collect()] == [(1, 1)]


def test_merge_rules_without_hints(spark, rows):
    stored = spark.createDataFrame([(1, "a", 5), (2, "b", 6), (3, None, 7)], "id int, t string, kept int")
    batch = spark.createDataFrame([(2, None, "n"), (3, "c", None), (4, "d", "m")], "id int, t string, extra string")
    merged = tables.merge_by_key(stored, batch, "id")
    assert rows(merged) == [(1, "a", 5, None), (2, None, 6, "n"), (3, "c", 7, None), (4, "d", None, "m")]
    assert "ResolvedHint" not in merged._jdf.queryExecution().analyzed().toString()


def test_stamp_only_on_changed_rows(spark):
    day = lambda d: F.lit(d).cast("timestamp_ntz")
    stored = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, t string").withColumn("at", day("2024-01-01"))
    batch = spark.createDataFrame([(1, "a"), (2, "c"), (3, None), (4, "d")], "id int, t string")
    merged = tables.merge_by_key(stored, batch, "id", "at", day("2024-02-01"))
    got = {r["id"]: r["at"].month for r in merged.collect()}
    assert got == {1: 1, 2: 2, 3: 1, 4: 2}


def test_merge_text():
    text = tables.merge_statement("t", "b", "id", ["id", "v"])
    assert text.startswith("MERGE INTO t t USING b s ON t.`id` = s.`id`") and "INSERT (`id`, `v`)" in text


def test_scratch_folder_comes_from_the_session(spark):
    before = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch_dir(spark, "x")
    assert "/x-" in path and path != scratch_dir(spark, "x")
    if before:
        assert path.startswith(before)
