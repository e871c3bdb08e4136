import re

import pytest

from millrace.llm.decontaminate import contamination, drop_contaminated, find_benchmark

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, items, window):
    out = []
    for key, text in rows:
        w = words(text)
        hit, names = set(), set()
        for name, item in items:
            iw = words(item)
            for i in range(max(len(iw) - window + 1, 1) if iw else 0):
                p = iw[i : i + window]
                for at in range(len(w) - len(p) + 1):
                    if w[at : at + len(p)] == p:
                        hit |= set(range(at, at + len(p)))
                        names.add("" if name is None else str(name))
        out.append((key, len(w), len(hit), tuple(sorted(names)), bool(hit)))
    return sorted(out, key=repr)


@pytest.fixture
def benchmark(spark, texts):
    rows = [(1, texts[3]), (2, texts[5][: len(texts[5]) // 2]), (3, "one TWO, three"), (10, "word"), (4, None), (5, "..."), (2, texts[7]), (None, texts[9])]
    return rows, spark.createDataFrame(rows, "item_id bigint, text string")


@pytest.mark.parametrize("block_bytes", [4_000_000, 300])
def test_hits_match_all_windows(docs, texts, benchmark, block_bytes):
    items, frame = benchmark
    rows = [*enumerate(texts), (0, texts[0]), (None, texts[3]), (500, "x " + texts[3].upper() + "\n" + texts[9])]
    found = find_benchmark(docs(rows).select("doc_id", "text"), frame, 10, keep=["doc_id", "text"], block_bytes=block_bytes).collect()
    got = []
    for r in found:
        runs = r["_found"]["runs"]
        got.append(
            (r["doc_id"], r["_found"]["words"], sum(s["end_word"] - s["first_word"] for s in runs), tuple(sorted(r["_found"]["items"])), bool(runs))
        )
        for s in runs:
            assert words(r["text"][s["start"] : s["end"]]) == words(r["text"])[s["first_word"] : s["end_word"]]
    assert sorted(got, key=repr) == brute(rows, items, 10)


def test_drop_keeps_clean_rows_and_columns(docs, texts, benchmark):
    items, frame = benchmark
    rows = list(enumerate(texts))
    data = docs(rows, 3, ["_runs", "n_hit"])
    kept = drop_contaminated(data, frame)
    assert kept.columns == data.columns
    assert {r["doc_id"] for r in kept.collect()} == {r[0] for r in brute(rows, items, 10) if not r[4]}


def test_empty_tables(docs, spark, benchmark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert contamination(docs([], 1), benchmark[1]).collect() == []
    assert [r["contaminated"] for r in contamination(docs([(1, "a b c")]), none).collect()] == [False]
