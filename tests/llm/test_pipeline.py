import sys
from collections import Counter

import pytest

import corpus_pipeline
from millrace.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def stages(spark, small):
    """Input and output of every stage at sf0.001, with some odd rows in front."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    out = []
    for name, stage in corpus_pipeline.STAGES:
        rows = stage(spark, docs, small).persist()
        out.append((name, docs, rows))
        docs = rows
    yield out
    for _, _, rows in out:
        rows.unpersist()


def ids(frame):
    return [r["doc_id"] for r in frame.select("doc_id").collect()]


def test_stages_narrow_down_and_keep_the_columns(stages, spark, small):
    columns = spark.read.parquet(f"{small}/documents.parquet").columns
    assert [s[0] for s in stages] == ["language", "near duplicates", "decontaminate", "mix", "shard"]
    for name, before, after in stages:
        given, kept = Counter(ids(before)), Counter(ids(after))
        assert kept and all(given[i] >= n for i, n in kept.items())
        if name in ("near duplicates", "decontaminate", "mix"):
            assert sum(kept.values()) < sum(given.values())
        assert after.columns == (columns if name != "shard" else [*columns, "shard", "slot"])


def test_language_rejects_only_texts_like_no_language(stages):
    before, after = set(ids(stages[0][1])), set(ids(stages[0][2]))
    gone = {r["doc_id"]: r["text"] for r in stages[0][1].collect() if r["doc_id"] in before - after}
    for text in gone.values():
        words = (text or "").split()
        assert not any(c.isalpha() for c in text or "") or len(set(words)) < 0.3 * len(words)


def test_no_near_copies_and_no_benchmark_left(stages, spark, small):
    sys.path.insert(0, __file__.rsplit("/", 1)[0])
    from test_decontaminate import brute as hits
    from test_near_dup import brute as groups

    rows = [(r["doc_id"], r["text"]) for r in stages[1][1].collect()]
    assert set(ids(stages[1][2])) == {g[0] for g in groups(rows, 80) if g[3]}
    items = [tuple(r) for r in spark.read.parquet(f"{small}/benchmark.parquet").select("item_id", "text").collect()]
    rows = [(r["doc_id"], r["text"]) for r in stages[2][1].collect()]
    assert set(ids(stages[2][2])) == {h[0] for h in hits(rows, items, 10) if not h[4]}


def test_shards_hold_all_rows_once(stages):
    rows = stages[-1][2].select("doc_id", "shard", "slot").collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(ids(stages[-1][1]))
    assert len({(r["shard"], r["slot"]) for r in rows}) == len(rows)


def test_odd_rows_pass_the_stages(spark, small, docs):
    odd = docs([(1, None), (2, ""), (3, "..."), (4, "the stone and the mill " * 30, None, None), (None, "a word"), (1, None)])
    for _, stage in corpus_pipeline.STAGES:
        odd = spark.createDataFrame(stage(spark, odd, small).collect(), stage(spark, odd, small).schema)
    assert set(ids(odd)) <= {4, None}


def test_stages_return_unknown_columns_unchanged(spark, small, docs):
    """Columns named like the operators' own, of odd types, come through every stage as they were."""
    clash = {
        "_found": "named_struct('runs', array(doc_id), 'items', 'x')",
        "_text": "cast(null as string)",
        "score": "date '2020-01-01'",
        "lang_pred": "map('a', doc_id)",
        "_key": "cast(doc_id as decimal(20,3))",
        "_crc": "array('x', text)",
        "_copy": "doc_id % 3 = 0",
        "row": "concat('r', doc_id)",
        "found": "cast(text as binary)",
        "a.b": "doc_id",
    }
    base = docs([(i, f"{w} the stone and the mill of words number {i} " * 12) for i, w in enumerate(["one", "two", "three", "four", "five", "six"])])
    frame = base.selectExpr("*", *(f"{v} as `{k}`" for k, v in clash.items()))
    wanted = {r["doc_id"]: r for r in frame.collect()}
    for name, stage in corpus_pipeline.STAGES:
        rows = stage(spark, frame, small)
        kept = rows.collect()
        assert rows.columns[: len(frame.columns)] == frame.columns, name
        assert kept and all(tuple(r)[: len(frame.columns)] == tuple(wanted[r["doc_id"]]) for r in kept), name


def test_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert {f"op{n}_" for n in range(1, 14)} == {q[: q.index("_") + 1] for q in QUERIES}
    assert "pipeline" in names and set(QUERIES) <= set(names) and set(ORACLES) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_match_sql(spark, small, name):
    import duckdb

    con = duckdb.connect()
    for table in ("documents", "benchmark", "conversations", "embeddings"):
        con.sql(f"create view {table} as select * from '{small}/{table}.parquet'")
    expected = con.sql(ORACLES[name])
    frame = QUERIES[name](spark, small)
    columns = sorted(frame.columns)
    assert columns == sorted(expected.columns)
    place = [expected.columns.index(c) for c in columns]
    assert sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=repr) == sorted((tuple(r[i] for i in place) for r in expected.fetchall()), key=repr)
