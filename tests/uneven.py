"""Writes an uneven copy of the given tables: hot keys and missing values.

A third of the lines share one order, part and supplier, a third of the events
one user, a third of the documents one text, and some values are missing.
Nothing is left out and no key column of a dimension becomes ambiguous.
"""

from __future__ import annotations

import duckdb

# Fixed texts: how each changed table is derived from the given one.
CHANGES = {
    "lineitem": """select case when rn % 3 = 0 then 7 else l_orderkey end as l_orderkey,
        case when rn % 3 = 0 then 11 when rn % 101 = 0 then null else l_partkey end as l_partkey,
        case when rn % 3 = 0 then 3 else l_suppkey end as l_suppkey, l_linenumber, l_quantity, l_extendedprice,
        l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
        from (select *, row_number() over () as rn from {lineitem})""",
    "orders": """select o_orderkey, case when o_orderkey % 3 = 1 then 5 else o_custkey end as o_custkey,
        o_orderstatus, o_totalprice, o_orderdate,
        case when o_orderkey % 53 = 0 then null else o_orderpriority end as o_orderpriority from {orders}""",
    "customer": """select c_custkey, c_name, case when c_custkey % 31 = 0 then null else c_nationkey end as c_nationkey,
        c_acctbal, case when c_custkey % 37 = 0 then null else c_mktsegment end as c_mktsegment from {customer}""",
    "part": """select p_partkey, p_name, case when p_partkey % 41 = 0 then null else p_brand end as p_brand, p_type,
        p_size, p_retailprice from {part}""",
    "events": """select event_id, ts, case when event_id % 3 = 0 then 4 else user_id end as user_id, event_type,
        value, props from {events}""",
    "documents": """select doc_id, case when doc_id % 3 = 0 then (select text from {documents} where doc_id = 1)
        when doc_id % 43 = 0 then null when doc_id % 47 = 0 then '' else text end as text, lang, source, n_chars
        from {documents}""",
}
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def write(source: str, target: str) -> str:
    con = duckdb.connect()
    files = {t: f"read_parquet('{source}/{t}.parquet')" for t in TABLES}
    for name in TABLES:
        text = CHANGES.get(name, "select * from {%s}" % name).format(**files)
        con.execute(f"copy ({text}) to '{target}/{name}.parquet' (format parquet)")
    con.close()
    return target
