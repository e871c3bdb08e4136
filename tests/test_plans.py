"""Shape of the physical plans: what would hurt at scale must not be in them."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from millrace.plans import all_jobs
from millrace.operators.joins import join_chain
from millrace.operators.sequences import max_after
from millrace.plans.roles import Roles


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# Jobs whose data is written and read back show only the last read.
LAZY = [n for n in all_jobs() if not n.startswith(("sink_", "src_", "stream_", "mv_", "report_bundle"))]


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_single_partition_window(spark, small, name):
    plan = plan_of(contract.queries()[name](spark, small))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    for match in re.finditer(r"Window \[.*?\], \[(.*?)\]", plan):
        assert match.group(1) or "_rows" in match.group(0) or "_part" in match.group(0), match.group(0)
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_scan_reads_only_what_is_used(spark, small):
    plan = plan_of(contract.queries()["mean_filtered"](spark, small))
    assert "l_extendedprice" not in plan and "p_retailprice" not in plan
    plan = plan_of(contract.queries()["param_sql"](spark, small))
    assert "PushedFilters: [IsNotNull(o_orderstatus), IsNotNull(o_totalprice), EqualTo(o_orderstatus,F)" in plan


def test_facts_are_reduced_before_dimension_joins(spark, small):
    plan = plan_of(contract.queries()["sales_by_category"](spark, small))
    assert plan.count("partial_sum") >= 4


ROLE_QUERIES = ["sales_by_category", "sales_by_store", "top1_with_ties", "join_inner_chain", "filter_like_or", "check_not_null"]


@pytest.mark.parametrize("name", ROLE_QUERIES)
def test_lines_are_numbered_without_a_window_and_read_once(spark, small, name):
    """Both line roles read one written table; lineitem itself isn't in the plan any more, and no window is over lines."""
    plan = plan_of(contract.queries()[name](spark, small))
    assert "lineitem" not in plan and "Window" not in plan
    assert "/lines-" in plan and "l_suppkey" not in plan


def test_roles_without_ids_prune_columns(spark, small):
    plan = plan_of(contract.queries()["top10_with_ties"](spark, small))
    assert "Window" not in plan and "l_extendedprice" not in plan


def test_series_are_windowed_in_chunks(spark, small):
    t = Roles(spark, small)
    plan = plan_of(max_after(t.series, "series_id", "pos", "x"))
    assert re.search(r"hashpartitioning\(series_id#?\w*, _chunk", plan)


@pytest.fixture
def no_broadcast(spark):
    """Plans as they are for tables beyond every broadcast limit, with low skew limits."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield spark
    for name in settings:
        spark.conf.unset(name)


def test_a_hot_key_is_split_in_a_join(no_broadcast):
    spark = no_broadcast
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 1000)
    facts = spark.range(200_000).repartition(16).select(key.alias("k"), "id")
    names = spark.range(1000).select(F.col("id").alias("k"), F.col("id").cast("string").alias("name"))
    joined = join_chain(facts, (names, "k")).groupBy("k", "name").agg(F.sum("id").alias("total"))
    assert joined.agg(F.sum("total")).first()[0] == sum(range(200_000))
    joined.collect()
    assert "skew=true" in plan_of(joined).split("Initial Plan")[0]


@pytest.mark.parametrize(
    "name",
    ["top10_with_ties", "max_rental_hours_by_city", "customer_balance", "filter_at_max", "value_share", "top5_frequent",
     "distribution_summary", "replace_max_with_zero", "group_filter"],
)
def test_plans_beyond_broadcast_limits(no_broadcast, small, name):
    plan = plan_of(contract.queries()[name](no_broadcast, small))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "BroadcastHashJoin" not in plan


def test_stock_functions_collect_no_held_items(no_broadcast, small):
    """A NOT IN would broadcast all held items, whatever the limits say."""
    plan = plan_of(contract.queries()["sql_stock_functions"](no_broadcast, small))
    assert "BroadcastExchange" not in plan and "NestedLoop" not in plan


def test_records_across_blocks_shuffle_no_piece_again(no_broadcast, tmp_path):
    """What crosses a block's end is joined by block, as the pieces lie."""
    from millrace.sources.pieces import read_csv_records, read_json_elements

    (tmp_path / "a").write_text('a,b\n1,"x\ny"\n')
    for records in (read_csv_records(no_broadcast, str(tmp_path)), read_json_elements(no_broadcast, str(tmp_path))):
        dealt = re.findall(r"hashpartitioning\(([^)]*)\)", plan_of(records))
        assert dealt and not any("_record" in d for d in dealt)


def test_postings_shuffle_texts_not_words(spark):
    from millrace.operators.text_index import positions

    plan = plan_of(positions(spark.range(3).selectExpr("id as d", "'mill race' as text"), "d", "text"))
    dealt = re.findall(r"hashpartitioning\(([^)]*)\)", plan)
    assert dealt and not any("term" in d for d in dealt)


def test_distances_are_rounded_without_decimals(spark, small):
    assert "rint" in plan_of(contract.queries()["pairwise_euclidean"](spark, small)).lower()
