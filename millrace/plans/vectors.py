"""Vectors, matrices and series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import numeric
from millrace.functions.arrays import meets_every_set, not_constant
from millrace.operators import aggregates as agg
from millrace.operators import rows
from millrace.operators.distance import distance_matrix, distance_pairs
from millrace.operators.joins import all_combinations
from millrace.operators.quantiles import describe_groups, distribution_summary, first_percentile_above
from millrace.operators.sequences import max_after, run_lengths
from millrace.plans.registry import job
from millrace.plans.roles import Roles


def line_rows(t: Roles) -> DataFrame:
    """Matrix of small whole numbers: one row of three per order line."""
    row = F.array(
        F.col("l_linenumber"),
        (F.col("l_quantity").cast("int") % 8),
        F.round(F.col("l_tax") * 100).cast("int"),
    )
    return t.table("lineitem").select("l_orderkey", "l_partkey", row.alias("row"))


_ROWS_SQL = """m as (select l_orderkey, l_partkey, l_linenumber as a, cast(l_quantity as int) % 8 as b,
    cast(round(l_tax * 100) as int) as c from lineitem)"""


@job("""select l_orderkey, l_linenumber, case when l_linenumber > 3 and l_linenumber < 8
    then -l_linenumber else l_linenumber end as x from lineitem""")
def cond_negate(t: Roles) -> DataFrame:
    x = numeric.negate_between(F.col("l_linenumber"), 3, 8)
    return t.table("lineitem").select("l_orderkey", "l_linenumber", x.alias("x"))


@job("""select series_id, pos, case when x = max(x) over (partition by series_id) then 0 else x end as y
    from v_series""")
def replace_max_with_zero(t: Roles) -> DataFrame:
    return rows.zero_at_max(t.series, "series_id", "x", "y").select("series_id", "pos", "y")


@job(f"""with {_ROWS_SQL} select l_orderkey, l_partkey, a, b, c from m
    where list_has_any([a, b, c], [1, 2]) and list_has_any([a, b, c], [3, 4])""")
def rows_cover_sets(t: Roles) -> DataFrame:
    kept = line_rows(t).where(meets_every_set(F.col("row"), [[1, 2], [3, 4]]))
    return _unpacked(kept)


@job(f"with {_ROWS_SQL} select l_orderkey, l_partkey, a, b, c from m where greatest(a, b, c) > least(a, b, c)")
def rows_not_constant(t: Roles) -> DataFrame:
    return _unpacked(line_rows(t).where(not_constant(F.col("row"))))


def _unpacked(df: DataFrame) -> DataFrame:
    parts = [F.col("row")[i].alias(name) for i, name in enumerate("abc")]
    return df.select("l_orderkey", "l_partkey", *parts)


@job("""with v as (select p_type, c_mktsegment, r_name from (select distinct p_type from part)
    cross join (select distinct c_mktsegment from customer) cross join (select distinct r_name from region))
    select row_number() over (order by p_type nulls first, c_mktsegment nulls first,
    r_name nulls first) - 1 as position, p_type, c_mktsegment, r_name
    from v""")
def cartesian_product(t: Roles) -> DataFrame:
    return all_combinations(
        [(t.table("part"), "p_type"), (t.table("customer"), "c_mktsegment"), (t.table("region"), "r_name")]
    )


@job("""select a.vec_id as x_id, b.vec_id as y_id, round(list_distance(
    cast(a.embedding as double[]), cast(b.embedding as double[])), 5) as distance
    from embeddings a cross join embeddings b""")
def pairwise_euclidean(t: Roles) -> DataFrame:
    vectors = t.table("embeddings")
    x = vectors.select(F.col("vec_id").alias("x_id"), F.col("embedding").alias("vec"))
    y = vectors.select(F.col("vec_id").alias("y_id"), F.col("embedding").alias("vec"))
    return distance_matrix(x, y).withColumn("distance", numeric.rounded(F.col("distance"), 5))


@job("""select a.vec_id as x_id, b.vec_id as y_id, round(list_distance(
    cast(a.embedding as double[]), cast(b.embedding as double[])), 5) as distance
    from embeddings a join embeddings b on b.label = a.label and b.vec_id = a.vec_id + 10""")
def distance_of_pairs(t: Roles) -> DataFrame:
    """The form that scales: distances for a table of wanted pairs, here neighbours of one label."""
    vectors = t.table("embeddings")
    x = vectors.select(F.col("vec_id").alias("x_id"), "label", F.col("embedding").alias("x"), (F.col("vec_id") + 10).alias("y_id"))
    y = vectors.select(F.col("vec_id").alias("y_id"), "label", F.col("embedding").alias("y"))
    pairs = distance_pairs(x.join(y, ["y_id", "label"]), "x", "y")
    return pairs.select("x_id", "y_id", F.round("distance", 5).alias("distance"))


@job("""select p_type, c_mktsegment, count(*) as n from lineitem join part on l_partkey = p_partkey
    join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey group by p_type, c_mktsegment""")
def occurring_combinations(t: Roles) -> DataFrame:
    """The form that scales: only the combinations that occur, with their rows."""
    parts = t.table("part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    orders = t.table("orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey"))
    segments = t.table("customer").select("c_custkey", "c_mktsegment")
    lines = t.table("lineitem").select("l_partkey", "l_orderkey").join(orders, "l_orderkey")
    per_customer = lines.join(parts, "l_partkey").groupBy("p_type", "c_custkey").agg(F.count(F.lit(1)).alias("n"))
    return per_customer.join(segments, "c_custkey").groupBy("p_type", "c_mktsegment").agg(F.sum("n").alias("n"))


@job("""with m as (select l_orderkey, l_linenumber - 1 as i, cast(min(l_quantity) as int) as q,
    l_linenumber as n, cast(round(min(l_discount) * 100) as int) as d, cast(round(min(l_tax) * 100) as int) as x
    from lineitem group by l_orderkey, l_linenumber),
    e as (select l_orderkey, case i when 0 then q when 1 then n when 2 then d when 3 then x end as v from m)
    select l_orderkey, coalesce(product(v) filter (where v <> 0), 0.0) as product from e group by l_orderkey""")
def diagonal_nonzero_product(t: Roles) -> DataFrame:
    """One matrix per order: row i comes from line i + 1, with four columns.

    Lines of equal number are one row, with the smallest value in each column: a matrix has one element at (i, i).
    """
    lines = t.table("lineitem").groupBy("l_orderkey", "l_linenumber").agg(
        F.min("l_quantity").cast("int").alias("q"),
        F.round(F.min("l_discount") * 100).cast("int").alias("d"),
        F.round(F.min("l_tax") * 100).cast("int").alias("x"),
    )
    matrix = lines.select(
        "l_orderkey", (F.col("l_linenumber") - 1).alias("i"), F.array("q", "l_linenumber", "d", "x").alias("row")
    )
    return agg.diagonal_product(matrix, "i", "row", ["l_orderkey"])


@job("""with s as (select cast(sum(cast(l_extendedprice as decimal(18,2))) as double) / count(*) as mean,
    quantile_cont(l_extendedprice, 0.5) as median, stddev_pop(l_extendedprice) as std,
    avg(case when l_extendedprice > 6000 then 1 else 0 end) * 100 as percent_above from lineitem)
    select round(mean, 4) as mean, round(mean - 6000, 4) as gap, round(median, 4) as median,
    round(std, 4) as std, percent_above from s""", name="distribution_summary")
def distribution_summary_of_prices(t: Roles) -> DataFrame:
    s = distribution_summary(t.table("lineitem"), "l_extendedprice", 6000)
    rounded = [F.round(c, 4).alias(c) for c in ("mean", "gap", "median", "std")]
    return s.select(*rounded, "percent_above")


@job("""with q as (select quantile_cont(l_extendedprice, [x / 100.0 for x in range(1, 101)]) as v from lineitem),
    p as (select unnest(v) as v, unnest(range(1, 101)) as p from q)
    select cast(min(p) as int) as percentile from p where v > 6000""", name="first_percentile_above")
def first_percentile_above_price(t: Roles) -> DataFrame:
    return first_percentile_above(t.table("lineitem"), "l_extendedprice", 6000)


@job("""select l_returnflag, count(*) as count, round(avg(l_extendedprice), 4) as mean,
    round(stddev_samp(l_extendedprice), 4) as std, min(l_extendedprice) as min,
    round(quantile_cont(l_extendedprice, 0.25), 4) as q25, round(quantile_cont(l_extendedprice, 0.5), 4) as q50,
    round(quantile_cont(l_extendedprice, 0.75), 4) as q75, max(l_extendedprice) as max
    from lineitem group by l_returnflag""")
def group_describe_prices(t: Roles) -> DataFrame:
    """The same statistics for a column of many values, by narrowed quantiles."""
    s = describe_groups(t.table("lineitem"), ["l_returnflag"], "l_extendedprice")
    return s.withColumns({c: F.round(c, 4) for c in ("mean", "std", "q25", "q50", "q75")})


@job("""select l_returnflag, l_linestatus, l_linenumber, min(l_orderkey) as first_index
    from lineitem group by all""")
def dedup_rows_first_index(t: Roles) -> DataFrame:
    return agg.first_index_of_rows(
        t.table("lineitem"), ["l_returnflag", "l_linestatus", "l_linenumber"], "l_orderkey"
    )


@job("select event_id, value from events order by value, event_id")
def sort_vector(t: Roles) -> DataFrame:
    return t.table("events").select("event_id", "value").orderBy("value", "event_id")


@job("""select (select count(*) from ((select l_linenumber from lineitem) except all
    (select l_linenumber from lineitem join orders on l_orderkey = o_orderkey))) = 0
    and (select count(*) from ((select l_linenumber from lineitem join orders on l_orderkey = o_orderkey)
    except all (select l_linenumber from lineitem))) = 0 as same""")
def multiset_equal(t: Roles) -> DataFrame:
    """The line numbers before and after joining the orders: the join loses no line."""
    lines = t.table("lineitem")
    joined = lines.join(t.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return agg.same_multiset(lines.select("l_linenumber"), joined.select("l_linenumber"))


@job("""select (select count(*) from ((select o_custkey from orders) except all (select c_custkey from customer))) = 0
    and (select count(*) from ((select c_custkey from customer) except all (select o_custkey from orders))) = 0
    as same""")
def multiset_differs(t: Roles) -> DataFrame:
    """Customers as they order against customers as listed: not the same multiset."""
    return agg.same_multiset(t.table("orders").select("o_custkey"), t.table("customer").select("c_custkey"))


@job("""with p as (select series_id, x, lag(x) over (partition by series_id order by pos) as prev from v_series)
    select series_id, max(x) filter (where prev = 0) as max_after from p group by series_id""")
def max_after_zero(t: Roles) -> DataFrame:
    return max_after(t.series, "series_id", "pos", "x")


@job("""with f as (select series_id, pos, x, case when x = lag(x) over w then 0 else 1 end as f
    from v_series window w as (partition by series_id order by pos)),
    r as (select series_id, pos, x, sum(f) over (partition by series_id order by pos) as run from f)
    select series_id, min(pos) as start_pos, any_value(x) as x, count(*) as run_length
    from r group by series_id, run""")
def run_length_encode(t: Roles) -> DataFrame:
    return run_lengths(t.series, "series_id", "pos", "x")


@job("""select vec_id, cast(('0x' || substr(md5('21:' || vec_id), 1, 13)) as bigint) % 11 as whole,
    cast(('0x' || substr(md5('22:' || vec_id), 1, 13)) as bigint) / 4503599627370496.0 as fraction
    from embeddings""")
def src_seeded_random(t: Roles) -> DataFrame:
    """A seeded draw per row: the same under any partitioning."""
    return t.table("embeddings").select(
        "vec_id",
        numeric.seeded_int(21, 0, 11, F.col("vec_id")).alias("whole"),
        numeric.seeded_fraction(22, F.col("vec_id")).alias("fraction"),
    )
