"""Large CSV and JSON files read in pieces: equal to Spark's whole-file readers, in many tasks."""

import csv
import io
import json
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from millrace.session import session_setting
from millrace.sources import pieces, readers

ROWS = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType()), T.StructField("n", T.LongType())])
NAMES = ["a", "b", "n"]


@pytest.fixture
def small_blocks(spark):
    """Files are split into blocks of so many bytes."""

    class Blocks:
        def __call__(self, size):
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
            spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield Blocks()
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def put(tmp_path, name, text):
    path = tmp_path / name
    path.write_bytes(text.encode() if isinstance(text, str) else text)
    return str(path)


def as_csv(rows, end="\n", header=NAMES):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=end)
    writer.writerow(header)
    writer.writerows(rows)
    return out.getvalue()


def whole_file(spark, path):
    cells = spark.read.schema("a string, b string, n string").options(**readers.csv_options(True)).csv(path)
    return sorted((tuple(r) for r in cells.collect()), key=repr)


def in_pieces(spark, path):
    return sorted((tuple(r) for r in readers.csv_cells(spark, path, NAMES).collect()), key=repr)


def odd_rows(n, seed=3):
    rng = random.Random(seed)
    bits = ["x", "y z", '"', '""', "\n", "\n\n", ",", "é", "日", "NA", " ", "'", "\\", "{", "word" * 9]
    cell = lambda: "".join(rng.choice(bits) for _ in range(rng.randrange(6)))
    return [(cell(), "k" + cell(), str(i)) for i in range(n)]


@pytest.mark.parametrize("size", [40, 257, 5000, 10**7])
def test_csv_equals_the_whole_file_reader(spark, tmp_path, small_blocks, size):
    path = put(tmp_path, "a.csv", as_csv(odd_rows(600)))
    small_blocks(size)
    assert in_pieces(spark, path) == whole_file(spark, path)


def test_one_csv_file_is_read_by_many_tasks(spark, tmp_path, small_blocks):
    path = put(tmp_path, "a.csv", as_csv([(f"line one\nline {i}", 'a "b",', str(i)) for i in range(5000)]))
    small_blocks(10_000)
    lines = pieces.text_pieces(spark.read, path, "\n")
    assert lines.rdd.getNumPartitions() > 8
    found = readers.csv_with_header(spark, path, ROWS)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "FileScan text" in plan and "FileScan csv" not in plan and "BroadcastNestedLoop" not in plan
    # Only the records that cross a line are grouped; all lines are dealt by block, never by file.
    assert sorted(r["n"] for r in found.collect()) == list(range(5000))


def test_a_cell_across_many_blocks(spark, tmp_path, small_blocks):
    long = "\n".join(f"row {i}, \"quoted\"" for i in range(400))
    path = put(tmp_path, "a.csv", as_csv([("x", long, "1"), (long, "y", "2"), ("z", "", "3")]))
    small_blocks(200)
    assert in_pieces(spark, path) == whole_file(spark, path) == sorted([("x", long, "1"), (long, "y", "2"), ("z", None, "3")], key=repr)


def test_several_files_blank_lines_and_no_last_line_end(spark, tmp_path, small_blocks):
    folder = tmp_path / "many"
    folder.mkdir()
    put(folder, "a.csv", as_csv(odd_rows(50, 1)).rstrip("\n"))
    put(folder, "b.csv", "\n\n" + as_csv(odd_rows(30, 2)) + "\n\n")
    put(folder, "c.csv", "a,b,n\n")
    put(folder, "d.csv", "")
    put(folder, "e.csv", "\ufeffa,b,n\n1,2,3\n")
    small_blocks(120)
    assert len(in_pieces(spark, str(folder))) == 50 + 30 + 1
    put(folder, "b.csv", as_csv(odd_rows(30, 2)) + "\n\n")
    assert in_pieces(spark, str(folder)) == whole_file(spark, str(folder))


def test_carriage_returns_end_lines_where_the_first_line_has_one(spark, tmp_path, small_blocks):
    small_blocks(60)
    rows = [("one\r\ntwo", "k", "1"), ("x", 'q "r"', "2"), ("\r\n\r\n", "", "3")]
    path = put(tmp_path, "a.csv", as_csv(rows, end="\r\n"))
    assert in_pieces(spark, path) == sorted([("one\ntwo", "k", "1"), ("x", 'q "r"', "2"), ("\n\n", None, "3")], key=repr)


def test_header_and_stray_quotes(spark, tmp_path):
    for header in ("b,a,n", "a,b", "a,b,n,m"):
        with pytest.raises(Exception, match="header"):
            in_pieces(spark, put(tmp_path, "h.csv", header + "\n1,2,3\n"))
    assert in_pieces(spark, put(tmp_path, "h.csv", '"A",b,"N"\n1,2,3\n')) == [("1", "2", "3")]
    for row in ('5" pipe,x,1"', 'x,"a"b,1', '"a""b" ,c,1', 'a,b""c,1'):
        with pytest.raises(Exception, match="quote stands outside"):
            in_pieces(spark, put(tmp_path, "q.csv", f"a,b,n\n{row}\n"))


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    rows=st.lists(st.tuples(*[st.text(alphabet='ab,"\n {}\\é', max_size=12)] * 2), min_size=1, max_size=30),
    size=st.integers(8, 200),
)
def test_csv_cells_come_back(spark, tmp_path, small_blocks, rows, size):
    path = put(tmp_path, "p.csv", as_csv([(a, b, str(i)) for i, (a, b) in enumerate(rows)]))
    small_blocks(size)
    wanted = sorted(((a or None, b or None, str(i)) for i, (a, b) in enumerate(rows)), key=repr)
    assert in_pieces(spark, path) == wanted


NESTED = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("t", T.StringType()), T.StructField("o", T.StructType([T.StructField("x", T.StringType())]))]
)


def whole_array(spark, path):
    rows = spark.read.schema(NESTED).option("multiLine", "true").json(path).select(*NESTED.names)
    return sorted((tuple(r) for r in rows.collect()), key=repr)


def elements(spark, path):
    return sorted((tuple(r) for r in readers.json_arrays(spark, path, NESTED).collect()), key=repr)


def odd_objects(n, seed=5):
    rng = random.Random(seed)
    bits = ["{", "}", '"', "\\", "[", "]", ",", "},{", "é", "\n", "text", '\\"}', "\u2028"]
    text = lambda: "".join(rng.choice(bits) for _ in range(rng.randrange(8)))
    return [{"id": i, "t": text(), "o": {"x": text(), "y": [{"z": text()}, {}]}, text(): text()} for i in range(n)]


@pytest.mark.parametrize("size", [30, 333, 10**7])
@pytest.mark.parametrize("indent", [None, 1])
def test_array_equals_the_whole_file_reader(spark, tmp_path, small_blocks, size, indent):
    path = put(tmp_path, "a.json", json.dumps(odd_objects(200), indent=indent, ensure_ascii=indent is None))
    small_blocks(size)
    assert elements(spark, path) == whole_array(spark, path)


def test_one_array_is_read_by_many_tasks(spark, tmp_path, small_blocks):
    path = put(tmp_path, "a.json", json.dumps([{"id": i, "t": "}{"} for i in range(20_000)]))
    small_blocks(20_000)
    assert pieces.text_pieces(spark.read, path, "}").rdd.getNumPartitions() > 8
    found = readers.json_arrays(spark, path, NESTED)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "FileScan text" in plan and "FileScan json" not in plan
    assert found.selectExpr("count(*)", "sum(id)", "count_if(t = '}{')").first()[:] == (20_000, sum(range(20_000)), 20_000)


def test_empty_arrays_and_several_files(spark, tmp_path):
    for name, text in {"a": "[]", "b": "", "c": " [ ] \n", "d": '[{"id": 1}]', "e": '{"id": 2}\n', "f": '\ufeff[\n{"id": 3, "o": null},\n{}]'}.items():
        put(tmp_path, f"{name}.json", text)
    assert elements(spark, str(tmp_path)) == [(1, None, None), (2, None, None), (3, None, None), (None, None, None)]


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(st.text(alphabet='ab{}"\\[],\n', max_size=15), min_size=1, max_size=20), size=st.integers(8, 200))
def test_array_texts_come_back(spark, tmp_path, small_blocks, texts, size):
    path = put(tmp_path, "p.json", json.dumps([{"id": i, "t": t, "o": {"x": t}} for i, t in enumerate(texts)]))
    small_blocks(size)
    assert elements(spark, path) == sorted([(i, t, (t,)) for i, t in enumerate(texts)], key=repr)
