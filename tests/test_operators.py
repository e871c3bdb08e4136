import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.operators import aggregates as agg
from millrace.operators import joins, quality, ranking
from millrace.operators import rows as rw
from millrace.operators import text_index as ti
from millrace.operators.distance import distance_matrix, distance_pairs
from millrace.operators.keys import assign_keys, next_key
from millrace.operators.quantiles import (
    describe_groups,
    distribution_summary,
    exact_quantiles,
    first_percentile_above,
)
from millrace.operators.sequences import max_after, run_lengths

CHECKED = settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)

# The 77 calorie counts of the golden distribution.
CALORIES = [
    70, 120, 70, 50, 110, 110, 110, 130, 90, 90, 120, 110, 120, 110, 110, 110, 100, 110, 110, 110,
    100, 110, 100, 100, 110, 110, 100, 120, 120, 110, 100, 110, 100, 110, 120, 120, 110, 110, 110,
    140, 110, 100, 110, 100, 150, 150, 160, 100, 120, 140, 90, 130, 120, 100, 50, 50, 100, 100, 120,
    100, 90, 110, 110, 80, 90, 90, 110, 110, 90, 110, 140, 100, 110, 110, 100, 100, 110,
]


# ---------------------------------------------------------------- distributions
def test_golden_distribution(spark):
    df = spark.createDataFrame([(float(c),) for c in CALORIES], "x double")
    s = distribution_summary(df, "x", 60).first()
    assert round(s["mean"], 3) == 106.883 and round(s["gap"], 3) == 46.883
    assert s["median"] == 110 and round(s["std"], 3) == 19.357
    assert round(s["percent_above"], 3) == 96.104
    assert first_percentile_above(df, "x", 60).first()[0] == 4


@CHECKED
@given(st.lists(st.integers(-20, 20), min_size=1, max_size=60), st.integers(-25, 25))
def test_first_percentile_matches_numpy(spark, values, threshold):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    want = next((p for p in range(1, 101) if np.percentile(values, p) > threshold + 1e-9), None)
    assert first_percentile_above(df, "x", threshold).first()[0] == want


@CHECKED
@given(st.lists(st.tuples(st.sampled_from("ab"), st.floats(-1e3, 1e3)), min_size=1, max_size=80))
def test_exact_quantiles_match_numpy(spark, data):
    df = spark.createDataFrame(data, "g string, x double").repartition(3)
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {(r["g"], r["prob"]): r["quantile"] for r in exact_quantiles(df, ["g"], "x", probs).collect()}
    frame = pd.DataFrame(data, columns=["g", "x"])
    for g, part in frame.groupby("g"):
        for p in probs:
            assert math.isclose(got[(g, p)], np.quantile(part["x"], p), rel_tol=1e-9, abs_tol=1e-9)
    assert len(got) == frame["g"].nunique() * len(probs)


def test_exact_quantiles_with_a_hot_group_and_few_values(spark):
    rng = np.random.default_rng(5)
    hot, cold = rng.normal(size=4000), rng.integers(0, 3, size=50).astype(float)
    data = [("hot", float(v)) for v in hot] + [("cold", float(v)) for v in cold]
    df = spark.createDataFrame(data, "g string, x double").repartition(5)
    got = {(r["g"], r["prob"]): r["quantile"] for r in exact_quantiles(df, ["g"], "x", [0.1, 0.5]).collect()}
    for g, vals in (("hot", hot), ("cold", cold)):
        for p in (0.1, 0.5):
            assert math.isclose(got[(g, p)], np.quantile(vals, p), rel_tol=1e-9)


def test_quantile_plans_sort_no_whole_group(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("g"), F.col("id").cast("double").alias("x"))
    plan = exact_quantiles(df, ["g"], "x", [0.5])._jdf.queryExecution().executedPlan().toString()
    running = [line for line in plan.splitlines() if "Window [sum(_m" in line]
    assert running and all("_part" in line for line in running)
    assert "percentile" not in plan


def test_describe_both_forms_agree_with_pandas(spark):
    frame = pd.DataFrame({"g": ["a"] * 5 + ["b"] + [None], "x": [1.0, 2, 2, 9, 4, 7, 100]})
    df = spark.createDataFrame(
        [(g, x) for g, x in zip(frame["g"], frame["x"])], "g string, x double"
    )
    want = frame.groupby("g")["x"].describe()
    for few in (True, False):
        got = {r["g"]: r for r in describe_groups(df, ["g"], "x", few_values=few).collect()}
        assert set(got) == {"a", "b"}
        assert got["b"]["std"] is None
        for name, col in (("count", "count"), ("mean", "mean"), ("q25", "25%"), ("q50", "50%"), ("q75", "75%"), ("max", "max")):
            assert math.isclose(got["a"][name], want.loc["a", col])
        assert math.isclose(got["a"]["std"], want.loc["a", "std"])


# ---------------------------------------------------------------- sequences
def brute_runs(values):
    out = []
    for pos, v in enumerate(values):
        if out and out[-1][1] == v:
            out[-1][2] += 1
        else:
            out.append([pos, v, 1])
    return [tuple(r) for r in out]


def brute_after(values):
    found = [b for a, b in zip(values, values[1:]) if a == 0]
    return max(found) if found else None


def series(spark, data):
    rows = [(s, i, v) for s, values in data.items() for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "s string, pos bigint, x int").repartition(4)


def test_golden_sequences(spark):
    df = series(spark, {"a": [6, 2, 0, 3, 0, 0, 5, 7, 0], "b": [1, 2], "c": [0]})
    for chunk in (1, 2, 4, 100):
        got = {r["s"]: r["max_after"] for r in max_after(df, "s", "pos", "x", chunk=chunk).collect()}
        assert got == {"a": 5, "b": None, "c": None}
    runs = run_lengths(series(spark, {"a": [2, 2, 2, 3, 3, 3, 5]}), "s", "pos", "x").orderBy("start_pos")
    assert [(r["x"], r["run_length"]) for r in runs.collect()] == [(2, 3), (3, 3), (5, 1)]


@CHECKED
@given(
    st.dictionaries(st.sampled_from("abc"), st.lists(st.integers(0, 2), min_size=1, max_size=25), min_size=1),
    st.integers(1, 6),
)
def test_sequences_match_brute_force_over_chunk_borders(spark, data, chunk):
    df = series(spark, data)
    after = {r["s"]: r["max_after"] for r in max_after(df, "s", "pos", "x", chunk=chunk).collect()}
    assert after == {s: brute_after(v) for s, v in data.items()}
    got = {}
    for r in run_lengths(df, "s", "pos", "x", chunk=chunk).collect():
        got.setdefault(r["s"], []).append((r["start_pos"], r["x"], r["run_length"]))
    assert {s: sorted(v) for s, v in got.items()} == {s: brute_runs(v) for s, v in data.items()}


def test_runs_keep_missing_values(spark):
    runs = run_lengths(series(spark, {"a": [1, None, None, 1]}), "s", "pos", "x", chunk=2)
    assert sorted((r["start_pos"], r["x"], r["run_length"]) for r in runs.collect()) == [(0, 1, 1), (1, None, 2), (3, 1, 1)]


# ---------------------------------------------------------------- distances, products, keys
def test_distance_matrix_matches_the_row_form_in_any_tiling(spark):
    rng = np.random.default_rng(1)
    vecs = rng.random((23, 6)).tolist()
    vecs[4] = vecs[3]
    x = spark.createDataFrame([(i, v) for i, v in enumerate(vecs)], "x_id bigint, vec array<double>")
    y = spark.createDataFrame([(i, v) for i, v in enumerate(vecs[:11])], "y_id bigint, vec array<double>")
    want = np.sqrt(((np.array(vecs)[:, None] - np.array(vecs[:11])[None]) ** 2).sum(-1))
    for tile in (3, 8, 100):
        got = {(r["x_id"], r["y_id"]): r["distance"] for r in distance_matrix(x, y, tile=tile).collect()}
        assert len(got) == 23 * 11
        assert all(abs(got[i, j] - want[i, j]) < 1e-6 for i in range(23) for j in range(11))
    pairs = spark.createDataFrame([([0.0, 0.0], [3.0, 4.0])], "a array<double>, b array<double>")
    assert distance_pairs(pairs, "a", "b").first()["distance"] == 5.0


def test_distances_of_missing_and_uneven_vectors(spark):
    x = spark.createDataFrame([(1, [1.0, 0.0, 0.0]), (2, None), (3, [0.0, 0.0, 5.0]), (4, [float("nan"), 0.0, 0.0])], "x_id bigint, vec array<double>")
    y = spark.createDataFrame([(1, [0.0, 0.0, 0.0]), (2, None)], "y_id bigint, vec array<double>")
    got = {(r["x_id"], r["y_id"]): r["distance"] for r in distance_matrix(x, y).collect()}
    assert len(got) == 8 and got[1, 1] == 1.0 and got[3, 1] == 5.0 and math.isnan(got[4, 1])
    assert [got[k] for k in ((2, 1), (1, 2), (2, 2), (3, 2))] == [None] * 4
    short = spark.createDataFrame([(1, [0.0, 0.0])], "y_id bigint, vec array<double>")
    with pytest.raises(Exception, match="vectors of 3 and 2 elements"):
        distance_matrix(x, short).collect()
    ragged = spark.createDataFrame([(1, [0.0]), (2, [0.0, 1.0])], "x_id bigint, vec array<double>")
    with pytest.raises(Exception, match="vectors of 1 and 2 elements"):
        distance_matrix(ragged, short).collect()
    gap = spark.createDataFrame([(1, [0.0, None])], "x_id bigint, vec array<double>")
    with pytest.raises(Exception, match="missing element"):
        distance_matrix(gap, short).collect()
    empty = spark.createDataFrame([(1, [])], "x_id bigint, vec array<double>")
    assert distance_matrix(empty, empty.withColumnRenamed("x_id", "y_id")).first()["distance"] == 0.0


def test_distance_matrix_of_nothing(spark):
    empty = spark.createDataFrame([], "x_id bigint, vec array<double>")
    other = spark.createDataFrame([(1, [1.0])], "y_id bigint, vec array<double>")
    assert distance_matrix(empty, other).count() == 0


def test_all_combinations_in_row_major_order(spark):
    a = spark.createDataFrame([(0,), (2,), (4,), (2,)], "a int")
    b = spark.createDataFrame([(1,), (3,), (5,)], "b int")
    got = joins.all_combinations([(a, "a"), (b, "b")]).orderBy("position").collect()
    assert [(r["a"], r["b"]) for r in got] == [(i, j) for i in (0, 2, 4) for j in (1, 3, 5)]
    assert [r["position"] for r in got] == list(range(9))
    none = joins.all_combinations([(a, "a"), (b.where("false"), "b")])
    assert none.count() == 0


def test_dense_keys(spark):
    df = spark.range(500).select((F.col("id") * 7 % 500).alias("k")).repartition(6)
    got = sorted((r["id"], r["k"]) for r in assign_keys(df, ["k"], "id", start=10).collect())
    assert got == [(i + 10, i) for i in range(500)]
    assert next_key(df, "k") == 500 and next_key(df.where("false"), "k") == 1


def test_dense_keys_with_a_frequent_first_column(spark):
    df = spark.range(900).select((F.col("id") % 3 == 0).cast("int").alias("hot"), "id").repartition(5)
    got = [r["n"] for r in assign_keys(df, ["hot", "id"], "n").orderBy("hot", "id").collect()]
    assert got == list(range(1, 901))


def test_diagonal_product(spark):
    rows = [("m", 0, [1, 0, 1]), ("m", 1, [2, 0, 2]), ("m", 2, [3, 0, 3]), ("m", 3, [4, 4, 4]), ("z", 0, [0])]
    df = spark.createDataFrame(rows, "m string, i int, r array<int>")
    got = {r["m"]: r["product"] for r in agg.diagonal_product(df, "i", "r", ["m"]).collect()}
    assert got == {"m": 3.0, "z": 0.0}
    assert agg.diagonal_product(df.where("m = 'm'"), "i", "r").first()["product"] == 3.0


def test_first_index_of_rows(spark):
    rows = [(1, 2, 3), (4, 5, 6), (1, 2, 3), (0, 0, 0), (7, 8, 9), (0, 0, 0), (1, 2, 3)]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "a int, b int, c int, i int")
    got = agg.first_index_of_rows(df, ["a", "b", "c"], "i").collect()
    assert [tuple(r) for r in got] == [(0, 0, 0, 3), (1, 2, 3, 0), (4, 5, 6, 1), (7, 8, 9, 4)]


@pytest.mark.parametrize(
    "left, right, same",
    [
        ([1, 2, 2, 4], [4, 2, 1, 2], True),
        ([1, 2, 2], [1, 1, 2], False),
        ([None, 1], [1, None], True),
        ([None], [], False),
        ([], [], True),
    ],
)
def test_same_multiset(spark, left, right, same):
    a = spark.createDataFrame([(v,) for v in left], "a int")
    b = spark.createDataFrame([(v,) for v in right], "b int")
    assert agg.same_multiset(a, b).first()["same"] is same


# ---------------------------------------------------------------- ranking
def test_ties_at_the_edge(spark, rows):
    df = spark.createDataFrame([("a", 5), ("b", 4), ("c", 4), ("d", 4), ("e", 1)], "n string, m int")
    assert [r[0] for r in rows(ranking.top_with_ties(df, "m", 2))] == ["a", "b", "c", "d"]
    assert [r[0] for r in rows(ranking.top_with_ties(df, "m", 1))] == ["a"]
    assert [r[0] for r in rows(ranking.top_distinct(df, "m", 2))] == ["a", "b", "c", "d"]
    assert ranking.top_distinct(df, "m", 3).count() == 5
    assert ranking.top_with_ties(df.where("false"), "m", 3).count() == 0


def test_group_lead_puts_missing_first(spark, rows):
    data = [("x", "a", 5.0), ("x", "b", None), ("y", "a", 2.0), ("y", "c", 2.0), ("y", "d", 1.0), (None, "q", 3.0)]
    df = spark.createDataFrame(data, "city string, cat string, hours double")
    got = rows(ranking.group_top_with_ties(df, ["city"], "hours").select("city", "cat"))
    assert got == sorted([("x", "b"), ("y", "a"), ("y", "c"), (None, "q")], key=repr)


def test_most_frequent_texts(spark):
    texts = ["a"] * 3 + ["b"] * 2 + [None] * 2 + ["", "d", "c"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [tuple(r) for r in agg.most_frequent_texts(df, "t", 4).collect()]
    assert got == [("a", 3), (None, 2), ("b", 2), ("", 1)]


def test_missing_and_empty_texts_are_different_groups(spark):
    df = spark.createDataFrame([(None,), (None,), ("",)], "t string")
    assert {tuple(r) for r in agg.most_frequent_texts(df, "t", 5).collect()} == {(None, 2), ("", 1)}


# ---------------------------------------------------------------- grouped statistics
def people(spark):
    data = [
        ("m", "x", 10, 40.0), ("m", "y", 20, 6.0), ("m", "x", 30, 50.0),
        ("f", "x", 40, 5.0), ("f", "y", 50, 50.0), (None, "x", 60, None),
    ]
    return spark.createDataFrame(data, "sex string, pay string, age int, hours double")


def test_missing_keys_form_no_group(spark, rows):
    df = people(spark)
    assert rows(agg.value_counts(df, "sex")) == [("f", 2), ("m", 3)]
    assert rows(agg.value_shares(df, "sex")) == [("f", 0.4), ("m", 0.6)]
    assert rows(agg.group_sizes(df, "sex")) == [("f", 2), ("m", 3)]
    shares = {(r[0], r[1]): r[2] for r in agg.group_value_shares(df, "sex", "pay").collect()}
    assert math.isclose(shares["m", "x"], 2 / 3) and shares["f", "y"] == 0.5


def test_compare_argmax_and_declared(spark, rows):
    df = people(spark)
    assert agg.larger_share(df, "sex", "pay", "x", "m", "f").first()[0] == "m"
    tie = df.where("age in (20, 30, 40, 50)")
    assert agg.larger_share(tie, "sex", "pay", "x", "m", "f").first()[0] == "f"
    assert agg.group_with_top_share(tie, "sex", "pay", "x", ["m", "f"]).first()[0] == "m"
    assert [tuple(r) for r in agg.group_sizes_declared(df, "sex", ["f", "none", "m"]).collect()] == [
        ("f", 2), ("none", 0), ("m", 3)
    ]


def test_keep_groups_and_mean(spark, rows):
    df = people(spark)
    rule = (F.avg("age") <= 40) & agg.all_rows(F.col("hours") > 5)
    assert rows(agg.keep_groups(df, "sex", rule).select("age")) == [(10,), (20,), (30,)]
    assert agg.mean_where(df, F.col("sex") == "m", "age").first()[0] == 20
    assert agg.stat_of_group(df, F.max("age").alias("m"), sex="f", pay="y").first()[0] == 50
    stats = {r["sex"]: r for r in agg.mean_std(df.where("age <> 50"), "sex", "age").collect()}
    assert stats["f"]["std"] is None and stats["m"]["std"] == 10
    assert [r[0] for r in agg.distinct_in_order(df, "pay", "age").collect()] == ["x", "y"]


def test_concat_skips_missing(spark):
    df = spark.createDataFrame([("a", "y"), ("a", None), ("a", "x"), ("a", "x"), ("b", None)], "k string, t string")
    assert {tuple(r) for r in agg.concat_texts(df, ["k"], "t", "s").collect()} == {("a", "x, x, y"), ("b", None)}
    assert ("a", "x, y") in {tuple(r) for r in agg.concat_texts(df, ["k"], "t", "s", distinct=True).collect()}


# ---------------------------------------------------------------- rows
def test_row_rewrites(spark, rows):
    df = spark.createDataFrame([("a", 0, 3), ("a", 1, 9), ("a", 2, 9), ("b", 0, 1)], "s string, i int, x int")
    assert rows(rw.zero_at_max(df, "s", "x", "y").select("s", "i", "y")) == [("a", 0, 3), ("a", 1, 0), ("a", 2, 0), ("b", 0, 0)]
    assert rw.filter_at_max(df, "x").count() == 2
    assert [r["x"] for r in rw.preview(df, ["x", "i"], 2).collect()] == [1, 3]


@pytest.mark.parametrize("values, inside", [(["a", "b"], True), (["a", None], False), (["c"], False), ([], True)])
def test_all_in_list(spark, values, inside):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    assert rw.all_in_list(df, "v", ["a", "b"], "ok").first()["ok"] is inside


def test_patterns_match_once(spark, rows):
    df = spark.createDataFrame([("Apple", "x-y"), ("apple", "z"), ("pear", "x-y"), ("pear", "z")], "n string, c string")
    assert rw.filter_prefix_or_infix(df, "n", "a", "c", "-").count() == 3


def test_defaults_and_sorting(spark):
    df = spark.createDataFrame([(1, None), (2, 5)], "id int, d int")
    filled = rw.fill_defaults(df, {"d": 3, "extra": "G"})
    assert [tuple(r) for r in filled.orderBy("id").collect()] == [(1, 3, "G"), (2, 5, "G")]
    ts = spark.createDataFrame([(1, None), (2, "2024-01-02 00:00:00"), (3, "2024-01-01 00:00:00")], "id int, at string")
    assert [r["id"] for r in rw.sort_by_ts_nulls_last(ts, "at", "id").collect()] == [3, 2, 1]
    assert rw.sort_by_ts_nulls_last(df, "at", "id") is df


# ---------------------------------------------------------------- joins, quality, text
def rentals(spark):
    inventory = spark.createDataFrame([(1, 10, 1), (2, 10, 2), (3, 11, 1)], "inventory_id int, film_id int, store_id int")
    rental = spark.createDataFrame(
        [(1, 1, 7, "2024-01-01"), (2, 1, 9, None), (3, 1, 8, None), (4, 2, 7, "2024-01-02")],
        "rental_id int, inventory_id int, customer_id int, return_date string",
    )
    return inventory, rental


def test_stock(spark, rows):
    inventory, rental = rentals(spark)
    assert [r["inventory_id"] for r in joins.in_stock(inventory, rental).collect()] == [2, 3]
    assert joins.in_stock(inventory, rental, film_id=10, store_id=1).count() == 0
    assert [r["inventory_id"] for r in joins.not_in_stock(inventory, rental, film_id=10).collect()] == [1]
    flags = {r["inventory_id"]: r["in_stock"] for r in joins.stock_flags(inventory, rental).collect()}
    assert flags == {1: False, 2: True, 3: True}
    held = {r["inventory_id"]: r["customer_id"] for r in joins.holders(inventory, rental).collect()}
    assert held == {1: 8, 2: None, 3: None}


def test_child_counts(spark, rows):
    parents = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id int, name string")
    children = spark.createDataFrame([(1,), (1,), (2,)], "room int")
    assert rows(joins.child_counts(parents, "id", children, "room", "n")) == [(1, "a", 2), (2, "a", 1), (3, "b", 0)]


def test_checks(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "bbb"), (2, None)], "k int, t string")
    assert rows(quality.duplicate_keys(df, ["k"])) == [(1, 2)]
    assert rows(quality.missing_counts(df, ["k", "t"])) == [("k", 0), ("t", 1)]
    assert quality.too_long(df, {"t": 2}).count() == 1
    assert quality.outside_range(df, "k", 1, 1).count() == 1
    assert quality.not_in_enum(df, "t", ["a"]).count() == 1
    parents = spark.createDataFrame([(1,), (None,)], "id int")
    assert rows(quality.orphans(df, "k", parents, "id")) == [(2, None)]
    assert rows(quality.violation_summary({"dup": quality.duplicate_keys(df, ["k"])})) == [("dup", 1)]
    with pytest.raises(quality.QualityError):
        quality.require_none(quality.duplicate_keys(df, ["k"]), "unique")


def test_text_index(spark, rows, tmp_path):
    texts = [(1, "The cat, the CATS sat."), (2, "a cat; élan 42"), (3, ""), (4, None), (5, "go to the churches of 1999")]
    df = spark.createDataFrame(texts, "d int, t string")
    stop = ("the", "of")
    assert rows(ti.document_frequency(df, "d", "t", stop)) == sorted(
        [("cat", 2), ("sat", 1), ("élan", 1), ("a", 1), ("42", 1), ("go", 1), ("to", 1), ("church", 1), ("1999", 1)], key=repr
    )
    index = ti.postings(df, "d", "t", stop)
    assert ("cat", 1, 2, 0) in rows(index)
    path = str(tmp_path / "index")
    ti.write_index(index, path)
    for held in (index, spark.read.parquet(path)):
        find = lambda q: rows(ti.documents_with_all(held, "d", q, stop))  # noqa: B023
        assert find("cat SAT") == [(1, 3)] and find("the cats, cat") == [(1, 2), (2, 1)]
        assert find("go") == [(5, 1)] and find("1999") == [(5, 1)] and find("church") == [(5, 1)]
        assert find("cat dog") == [] and find("the") == [] and find("") == []
    plan = ti.documents_with_all(spark.read.parquet(path), "d", "cat", stop)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan


def test_stems(spark):
    pairs = {"films": "film", "cities": "city", "glass": "glass", "boxes": "box", "bus": "bus", "this": "this", "running": "runn", "red": "red",
             "wanted": "want", "sing": "sing", "is": "is", "éclairs": "éclairs"}
    from millrace.functions.text import stem

    got = spark.createDataFrame([(w,) for w in pairs], "w string").select("w", stem(F.col("w")).alias("s")).collect()
    assert {r["w"]: r["s"] for r in got} == pairs


def test_zero_at_max_keeps_rows_without_a_series(spark, rows):
    from millrace.operators.rows import zero_at_max

    df = spark.createDataFrame([(1, 5), (1, 2), (None, 3), (None, 1)], "s int, x int")
    assert rows(zero_at_max(df, "s", "x", "y")) == sorted([(1, 5, 0), (1, 2, 2), (None, 3, 0), (None, 1, 1)], key=repr)


def test_plain_mean_of_scores_in_text_form(spark):
    from millrace.operators.aggregates import mean_per_day

    df = spark.createDataFrame([("a", "1.005"), ("a", "2.004"), ("a", "n/a"), ("b", None)], "d string, s string")
    got = {r["day"]: r["avg_score"] for r in mean_per_day(df, F.col("d"), F.col("s")).collect()}
    assert math.isclose(got["a"], 1.5045) and got["b"] is None


def test_listed_texts_number_each_group(spark, rows):
    from millrace.operators.aggregates import listed_texts

    df = spark.createDataFrame([("a", "y"), ("a", "x"), ("b", "z"), ("a", "y"), (None, "q")], "g string, t string")
    assert rows(listed_texts(df, ["g"], "t")) == [("a", 1, "x"), ("a", 2, "y"), ("a", 3, "y"), ("b", 1, "z")]


def test_number_within_groups(spark):
    from pyspark.sql import Window

    from millrace.operators.keys import number_within

    data = [(i % 7 if i % 3 else 5, None if i % 11 == 0 else i % 4, i * 37 % 101) for i in range(600)] + [(99, 1, 1), (5, 0, 3), (5, 0, 3)]
    df = spark.createDataFrame(data, "g int, h int, v int").repartition(5)
    got = number_within(df, ["g", "h"], ["v"], "n")
    wanted = df.withColumn("n", F.row_number().over(Window.partitionBy("g", "h").orderBy("v")).cast("bigint"))
    assert sorted(map(repr, got.collect())) == sorted(map(repr, wanted.collect()))
    assert number_within(df.limit(0), ["g"], ["v"], "n").collect() == []
    alone = number_within(spark.range(5), ["id"], [], "n")
    assert {r["n"] for r in alone.collect()} == {1}


def test_numbered_rows_are_shuffled_once_and_large_groups_by_ranges(spark):
    from functools import reduce

    from pyspark.sql import Window

    from millrace.operators.keys import numbered_parts

    data = [(i % 7 if i % 3 else 5, None if i % 11 == 0 else i % 4, i * 37 % 101) for i in range(600)] + [(5, 0, 3), (5, 0, 3)]
    df = spark.createDataFrame(data, "g int, h int, v int").repartition(5)
    wanted = df.withColumn("n", F.row_number().over(Window.partitionBy("g", "h").orderBy("v")).cast("bigint")).collect()
    for most, frames in ((1000, 1), (30, 2)):
        parts = numbered_parts(df, ["g", "h"], ["v"], "n", by=["g"], most=most)
        assert len(parts) == frames
        assert sorted(map(repr, reduce(lambda a, b: a.unionAll(b), parts).collect())) == sorted(map(repr, wanted))
    # The small groups are dealt by the columns of the next join: neither the window nor the join deals them again.
    (part,) = numbered_parts(spark.range(100).select("id", F.col("id").alias("g")), ["g", "id"], [], "n", by=["g"])
    joined = part.join(spark.range(50).withColumnRenamed("id", "g").hint("merge"), "g")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "Window" in plan


def test_large_distance_matrices_copy_a_vector_once_for_many_tiles(spark):
    from millrace.operators.distance import LEAST, TILES, _parts

    assert _parts(3000, 1000) == 3 and _parts(300_000, 1000) == 300 // TILES + 1 > LEAST
    vecs = np.random.default_rng(2).random((150, 3)).tolist()
    rows = [(i, None if i % 11 == 0 else v) for i, v in enumerate(vecs)]
    x = spark.createDataFrame(rows, "x_id bigint, vec array<double>")
    got = distance_matrix(x, x.withColumnRenamed("x_id", "y_id"), tile=3).collect()
    assert len(got) == len({(r["x_id"], r["y_id"]) for r in got}) == 150 * 150
    for r in got:
        a, b = rows[r["x_id"]][1], rows[r["y_id"]][1]
        assert r["distance"] is None if a is None or b is None else abs(r["distance"] - math.dist(a, b)) < 1e-6


def test_every_group_of_a_distance_matrix_is_a_task_of_its_own(spark):
    vecs = np.random.default_rng(3).random((150, 3)).tolist()
    x = spark.createDataFrame(list(enumerate(vecs)), "x_id bigint, vec array<double>")
    y = x.withColumnRenamed("x_id", "y_id")
    parts = distance_matrix(x, y, tile=30).groupBy(F.spark_partition_id().alias("part"))
    got = parts.agg(F.count_distinct("x_id").alias("x"), F.count_distinct("y_id").alias("y"), F.count(F.lit(1)).alias("n")).collect()
    assert len(got) == 25 and sum(r["n"] for r in got) == 150 * 150  # five stripes a side
    assert all(r["n"] == r["x"] * r["y"] for r in got)


def test_distances_where_a_side_or_a_tile_has_no_vectors(spark):
    x = spark.createDataFrame([(i, [float(i), 0.0] if i % 2 else None) for i in range(40)] + [(None, [3.0, 4.0])], "x_id bigint, vec array<double>")
    none = spark.createDataFrame([("a", None), ("b", None)], "y_id string, vec array<double>")
    for tile in (1, 4, 100):
        got = distance_matrix(x, none, tile=tile).collect()
        assert len(got) == 82 and all(r["distance"] is None for r in got) and {r["y_id"] for r in got} == {"a", "b"}
        got = distance_matrix(x, spark.createDataFrame([("o", [0.0, 0.0])], none.schema), tile=tile).collect()
        assert {r["x_id"]: r["distance"] for r in got} == {i: float(i) if i % 2 else None for i in range(40)} | {None: 5.0}
