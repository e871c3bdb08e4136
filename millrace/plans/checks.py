"""Data-quality jobs and dense keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.dates import month_key
from millrace.operators import quality
from millrace.operators.keys import assign_keys
from millrace.operators.known_keys import KnownKeys
from millrace.plans.registry import job
from millrace.plans.roles import Roles
from millrace.session import scratch_dir


@job("""select l_orderkey, l_linenumber, count(*) as copies from lineitem
    group by l_orderkey, l_linenumber having count(*) > 1""")
def check_unique(t: Roles) -> DataFrame:
    return quality.duplicate_keys(t.table("lineitem"), ["l_orderkey", "l_linenumber"])


@job("""select event_id from events where event_id is not null
    and not exists (select 1 from documents where documents.doc_id = events.event_id)""")
def check_foreign_key(t: Roles) -> DataFrame:
    """Events that refer to no document."""
    return quality.orphans(t.table("events"), "event_id", t.table("documents"), "doc_id").select("event_id")


_RENTAL_COLUMNS = ["rental_id", "rental_date", "inventory_id", "customer_id", "return_date"]


@job(" union all ".join(
    f"select '{c}' as column_name, count(*) filter (where {c} is null) as missing from v_rental"
    for c in _RENTAL_COLUMNS
))
def check_not_null(t: Roles) -> DataFrame:
    return quality.missing_counts(t.rental, _RENTAL_COLUMNS)


@job("select o_orderkey, year(o_orderdate) as year from orders where year(o_orderdate) not between 1996 and 2000")
def check_range(t: Roles) -> DataFrame:
    years = t.table("orders").select("o_orderkey", F.year("o_orderdate").cast("bigint").alias("year"))
    return quality.outside_range(years, "year", 1996, 2000)


@job("""select payment_id, strftime(payment_date, '%Y-%m') as month from v_payment
    where strftime(payment_date, '%Y-%m') not between '1995-01' and '2001-06'""")
def check_range_months(t: Roles) -> DataFrame:
    """Payments outside the declared months, which the month-partitioned sink refuses."""
    months = t.payment.select("payment_id", month_key(F.col("payment_date")).alias("month"))
    return quality.outside_range(months, "month", "1995-01", "2001-06")


@job("select p_partkey, p_name from part where length(p_name) > 10")
def check_length(t: Roles) -> DataFrame:
    return quality.too_long(t.table("part"), {"p_name": 10}).select("p_partkey", "p_name")


_TYPES = ["STANDARD", "ECONOMY", "MEDIUM", "SMALL", "LARGE"]


@job("""select p_partkey, p_type from part
    where p_type not in ('STANDARD', 'ECONOMY', 'MEDIUM', 'SMALL', 'LARGE')""")
def check_enum(t: Roles) -> DataFrame:
    return quality.not_in_enum(t.table("part"), "p_type", _TYPES).select("p_partkey", "p_type")


@job("""select 'unique' as rule, (select count(*) from (select 1 from lineitem
    group by l_orderkey, l_linenumber having count(*) > 1)) as violations
    union all select 'enum', (select count(*) from part
    where p_type not in ('STANDARD', 'ECONOMY', 'MEDIUM', 'SMALL', 'LARGE'))""")
def check_summary(t: Roles) -> DataFrame:
    lines, part = t.table("lineitem"), t.table("part")
    return quality.violation_summary(
        {
            "unique": quality.duplicate_keys(lines, ["l_orderkey", "l_linenumber"]),
            "enum": quality.not_in_enum(part, "p_type", _TYPES),
        }
    )


@job("select row_number() over (order by p_partkey) as id, p_partkey, p_name from part")
def assign_surrogate_key(t: Roles) -> DataFrame:
    return assign_keys(t.table("part").select("p_partkey", "p_name"), ["p_partkey"], "id")


@job("""select o_orderkey, count(*) as n from orders group by o_orderkey having count(*) > 1
    union all select o_orderkey, 1 from orders where o_orderpriority = '1-URGENT'
    and o_orderkey in (select o_orderkey from orders group by o_orderkey having count(*) = 1)""")
def check_unique_on_arrival(t: Roles) -> DataFrame:
    """The urgent orders are known; then all orders arrive."""
    known = KnownKeys(scratch_dir(t.spark, "known-keys"), bits=22)
    orders = t.table("orders").select("o_orderkey", "o_orderpriority")
    urgent = orders.where(F.col("o_orderpriority") == "1-URGENT")
    known.add(urgent, "o_orderkey")
    return known.repeated(orders, "o_orderkey").select("o_orderkey", F.col("rows").alias("n"))


@job("select l_orderkey, l_linenumber from lineitem where l_partkey is not null and l_partkey not in (select p_partkey from part where p_type <> 'PROMO')")
def check_foreign_key_on_arrival(t: Roles) -> DataFrame:
    """Lines that arrive against the parts known so far: those of one type are missing."""
    known = KnownKeys(scratch_dir(t.spark, "known-parts"), bits=20)
    parts = t.table("part").where(F.col("p_type") != "PROMO")
    for half in (0, 1):  # two batches
        known.add(parts.where(F.col("p_partkey") % 2 == half), "p_partkey")
    lines = t.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return known.missing(lines, "l_partkey").select("l_orderkey", "l_linenumber")
