"""Every registered job against its SQL text on the smallest tables."""

import datetime
import decimal
import math

import duckdb
import pytest
from tables import TABLES

import __spark_entry__ as contract
from millrace.plans import all_jobs

CHECKED = [name for name, job in all_jobs().items() if job.sql]


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{small}/{name}.parquet')")
    yield con
    con.close()


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, decimal.Decimal):
        return f"decimal {value}"
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def table(columns, rows):
    names = sorted(columns)
    picks = [columns.index(n) for n in names]
    return names, sorted((tuple(plain(r[i]) for i in picks) for r in rows), key=repr)


@pytest.mark.parametrize("name", CHECKED)
def test_job_equals_sql(spark, duck, small, name):
    df = contract.queries()[name](spark, small)
    cursor = duck.execute(contract.oracle_sql()[name])
    want = table([c[0] for c in cursor.description], cursor.fetchall())
    got = table(df.columns, df.collect())
    assert got == want


def test_contract_is_complete():
    assert len(contract.queries()) >= 102
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["category", "city", "max_rent_hours"] and df.count() > 0


@pytest.fixture(scope="module")
def uneven_tables(tmp_path_factory):
    import uneven

    return uneven.write("/root/testdata/sf0.001", str(tmp_path_factory.mktemp("uneven")))


# Jobs whose rows depend on hot keys or missing values.
UNEVEN = [
    n
    for n in CHECKED
    if not n.startswith(("stream_", "src_", "check_", "sink_")) or n in ("sink_range_partitioned", "check_unique")
]


@pytest.mark.parametrize("name", UNEVEN)
def test_job_equals_sql_on_uneven_tables(spark, uneven_tables, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{uneven_tables}/{t}.parquet')")
    df = contract.queries()[name](spark, uneven_tables)
    cursor = con.execute(contract.oracle_sql()[name])
    want = table([c[0] for c in cursor.description], cursor.fetchall())
    con.close()
    assert table(df.columns, df.collect()) == want


def test_lines_of_equal_number_are_one_row_of_the_diagonal(spark, tmp_path):
    """However many lines an order has, its matrix has one element at (i, i), so four at most."""
    folder = str(tmp_path)
    lines = [(1, 1, 9.0, 0.02, 0.03), (1, 1, 4.0, 0.05, 0.01), (1, 2, 7.0, 0.0, 0.0), (1, 3, 1.0, 0.06, 0.08), (1, 3, 1.0, 0.0, 0.0)]
    lines += [(1, 3, 1.0, None, None), (2, 4, 1.0, 0.01, 0.05), (2, 4, 1.0, 0.02, 0.04), (2, 7, 5.0, 0.1, 0.1), (3, 5, 1.0, 0.1, 0.1)]
    lines += [(4, 2, float(k), 0.01, 0.01) for k in range(2000)] + [(None, 1, 3.0, 0.1, 0.1), (None, 1, 2.0, 0.1, 0.1), (5, None, 1.0, 0.1, 0.1)]
    schema = "l_orderkey bigint, l_linenumber int, l_quantity double, l_discount double, l_tax double"
    spark.createDataFrame(lines, schema).write.parquet(f"{folder}/lineitem.parquet")
    df = contract.queries()["diagonal_nonzero_product"](spark, folder)
    got = {r["l_orderkey"]: r["product"] for r in df.collect()}
    assert got == {1: 4.0 * 2.0, 2: 4.0, 3: 0.0, 4: 2.0, None: 2.0, 5: 0.0}
    with duckdb.connect() as con:
        con.execute(f"create view lineitem as select * from read_parquet('{folder}/lineitem.parquet/*.parquet')")
        assert dict(con.execute(contract.oracle_sql()["diagonal_nonzero_product"]).fetchall()) == got
