import datetime

import pytest
from pyspark.sql import functions as F

from millrace.functions import dates, numeric, text
from millrace.functions.arrays import diagonal_element, meets_every_set, not_constant


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "as_of, birthday, years",
    [
        ("2001-02-28", "2000-02-29", 0),
        ("2001-03-01", "2000-02-29", 1),
        ("2020-06-15", "2000-06-15", 20),
        ("2020-06-14", "2000-06-15", 19),
        ("2000-01-01", "2000-12-31", 0),
        ("2000-01-01", "2002-06-01", -2),
    ],
)
def test_whole_years(spark, as_of, birthday, years):
    got = one(spark, dates.whole_years(F.lit(as_of).cast("date"), F.lit(birthday).cast("date")))
    assert got == years


def test_month_end_and_day(spark):
    ts = F.lit("2023-12-05 10:00:00").cast("timestamp_ntz")
    assert one(spark, dates.month_end(ts)) == datetime.date(2023, 12, 31)
    assert one(spark, dates.month_end(F.lit("2024-02-01").cast("date"))) == datetime.date(2024, 2, 29)
    assert one(spark, dates.day_start(ts)) == datetime.datetime(2023, 12, 5)


def test_coerce_ts_never_fails(spark):
    assert one(spark, dates.coerce_ts(F.lit("2024-01-02 03:04:05"))) == datetime.datetime(2024, 1, 2, 3, 4, 5)
    assert one(spark, dates.coerce_ts(F.lit("2024-1-5 3:04:05"))) == datetime.datetime(2024, 1, 5, 3, 4, 5)
    for bad in ("bad", "-", "", "2024-13-02 03:04:05", "2024-01-02"):
        assert one(spark, dates.coerce_ts(F.lit(bad))) is None


def test_seconds_between_open_end(spark):
    a = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    b = F.lit("2024-01-01 01:00:00.5").cast("timestamp_ntz")
    assert one(spark, dates.seconds_between(a, b)) == 3600.5
    assert one(spark, dates.seconds_between(a, F.lit(None).cast("timestamp_ntz"))) is None


@pytest.mark.parametrize(
    "cell, cleaned",
    [
        ("null", "-"),
        ("NULL", "-"),
        ("None", "-"),
        ("none", "-"),
        ("NA", "-"),
        (None, "-"),
        ("", "-"),
        ("   ", ""),
        (" NA ", "NA"),
        ("\u00a0\u2003x\u2003\n", "x"),
        ("a b", "a b"),
    ],
)
def test_clean_cell(spark, cell, cleaned):
    assert one(spark, text.clean_cell(F.lit(cell).cast("string"))) == cleaned


@pytest.mark.parametrize(
    "cell, cleaned",
    [
        (None, "-"),
        ("", "-"),
        ("😀😀", "-"),
        (" ok! ", "ok!"),
        ("it's \"fine\" - a.b,c;d:e?", "it's \"fine\" - a.b,c;d:e?"),
        ("a\u2003b\u00a0c", "a\u2003b\u00a0c"),
        ("é a@b#c", "abc"),
        ("\u2003é\u2003", "-"),
        ("x\ny", "x\ny"),
    ],
)
def test_clean_text(spark, cell, cleaned):
    assert one(spark, text.clean_text(F.lit(cell).cast("string"))) == cleaned


def test_short_text_counts_code_points(spark):
    assert one(spark, text.shorter_than(F.lit("😀😀😀😀"), 5)) is True
    assert one(spark, text.shorter_than(F.lit("abcde"), 5)) is False
    assert one(spark, text.shorter_than(F.lit(None).cast("string"), 5)) is False


def test_names_and_labels(spark):
    assert one(spark, text.joined_title_names(F.lit("PENELOPE"), F.lit("de VRIES"))) == "PenelopeDe vries"
    assert one(spark, text.full_name(F.lit("A"), F.lit(None).cast("string"))) is None
    assert one(spark, text.prefix_label(F.lit("Married-x"), "Married", "m", "s")) == "m"


def test_right_closed_bins(spark):
    ages = [15, 16, 34, 35, 70, 71, 100, 101, None]
    df = spark.createDataFrame([(a,) for a in ages], "age int")
    binned = numeric.right_closed_bin(F.col("age"), (16, 34, 70, 100), ("young", "adult", "retiree"))
    got = {r["age"]: r["b"] for r in df.select("age", binned.alias("b")).collect()}
    assert got == {
        15: None, 16: "young", 34: "young", 35: "adult", 70: "adult",
        71: "retiree", 100: "retiree", 101: None, None: None,
    }
    with pytest.raises(ValueError):
        numeric.right_closed_bin(F.col("age"), (1, 2), ("a", "b"))


def test_negate_between_is_strict(spark):
    df = spark.createDataFrame([(x,) for x in (3, 4, 7, 8)], "x int")
    got = [r[0] for r in df.select(numeric.negate_between(F.col("x"), 3, 8)).collect()]
    assert got == [3, -4, -7, 8]


def test_nan_to_null(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    assert [r[0] for r in df.select(numeric.nan_to_null(F.col("x"))).collect()] == [1.0, None, None]


def test_seeded_draws_ignore_partitioning(spark):
    keys = spark.range(2000)
    draw = keys.select("id", numeric.seeded_int(21, 0, 11, F.col("id")).alias("n"),
                       numeric.seeded_fraction(21, F.col("id")).alias("f"))
    again = keys.repartition(7).select(*[c for c in ("id",)], numeric.seeded_int(21, 0, 11, F.col("id")).alias("n"),
                                       numeric.seeded_fraction(21, F.col("id")).alias("f"))
    a, b = sorted(draw.collect()), sorted(again.collect())
    assert a == b
    assert {r["n"] for r in a} == set(range(11))
    assert all(0 <= r["f"] < 1 for r in a)
    assert abs(sum(r["f"] for r in a) / 2000 - 0.5) < 0.03


def test_array_conditions(spark):
    df = spark.createDataFrame([([1, 3, 9],), ([1, 2, 9],), ([3, 3, 3],), ([2, 2, 3],)], "r array<int>")
    covers = [r[0] for r in df.select(meets_every_set(F.col("r"), [[1, 2], [3, 4]])).collect()]
    assert covers == [True, False, False, True]
    assert [r[0] for r in df.select(not_constant(F.col("r"))).collect()] == [True, True, False, True]
    assert [r[0] for r in df.select(diagonal_element(F.col("r"), F.lit(3))).collect()] == [None] * 4


def test_rounded_equals_round(spark):
    values = [k / 200000 for k in range(-601, 602)] + [0.1 * k for k in range(50)]
    values += [v + d for v in (0.000005, 1.000015, 70000.123455) for d in (-1e-12, 1e-12)]
    values += [0.0, -0.0, -1e-9, 1e9, 123456789.123455, -1e15, 1e300, float("inf"), float("-inf"), float("nan"), None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for digits in (0, 2, 5):
        got = df.select(numeric.rounded(F.col("v"), digits).alias("got"), F.round("v", digits).alias("want")).collect()
        assert [repr(r["got"]) for r in got] == [repr(r["want"]) for r in got]
