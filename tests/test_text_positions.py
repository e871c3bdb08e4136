"""The stored text index: positions, phrases, and changes that touch their documents' buckets only."""

import glob
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from millrace.operators import text_index as ti

STOP = ti.ENGLISH_STOP_WORDS
SCHEMA = "id bigint, text string"


def texts(n=60, seed=3):
    rng = random.Random(seed)
    words = ["mill", "race", "Races", "the", "stone", "and", "wheels", "of", "x1", "Größe", "日本"]
    return [(i, " ".join(rng.choice(words) + rng.choice(["", "", ",", "\n"]) for _ in range(rng.randrange(0, 60)))) for i in range(n)]


def brute_phrase(rows, phrase):
    stem = lambda w: {"races": "race", "wheels": "wheel"}.get(w, w)
    cut = lambda s: [None if w in STOP else stem(w) for w in re.findall(r"[^\W_]+", (s or "").lower())]
    line = cut(phrase)
    while line and line[0] is None:
        line.pop(0)
    while line and line[-1] is None:
        line.pop()
    out = {}
    for key, text in rows:
        w = cut(text)
        n = sum(all(p is None or w[i + k] == p for k, p in enumerate(line)) for i in range(len(w) - len(line) + 1)) if line else 0
        if n:
            out[key] = n
    return out


@pytest.fixture
def stored(spark, tmp_path):
    folders = ti.IndexFolders(str(tmp_path / "index"), "id", STOP, doc_buckets=5, term_buckets=3)
    rows = texts() + [(900, "mill " * 9000 + "race mill race"), (901, None), (902, ""), (903, "the and")]
    ti.store_positions(folders, spark.createDataFrame(rows, SCHEMA).repartition(3), "text")
    return folders, rows


PHRASES = ["mill race", "MILL, the race", "race", "races mill mill", "stone and of", "the", "", "of of", "größe 日本", "mill nowhere", "the mill the"]


@pytest.mark.parametrize("phrase", PHRASES)
def test_phrases_equal_a_scan(spark, stored, phrase):
    folders, rows = stored
    got = {r["id"]: r["occurrences"] for r in ti.documents_with_phrase(folders, spark, phrase).collect()}
    assert got == brute_phrase(rows, phrase)


def test_lists_are_bounded(spark, stored):
    folders, _ = stored
    blocks = ti.stored_positions(folders, spark).where("id = 900 and term = 'mill'").select(F.size("offsets").alias("n"), "start").collect()
    assert len(blocks) == 3 and max(r["n"] for r in blocks) <= ti.BLOCK and sum(r["n"] for r in blocks) == 9001


def rows_of(spark, folders):
    return sorted((r["term"], r["id"], r["start"], tuple(r["offsets"])) for r in ti.stored_positions(folders, spark).collect())


def test_a_change_equals_a_new_index_and_touches_its_buckets_only(spark, stored, tmp_path):
    folders, rows = stored
    files = lambda: {f: os.path.getmtime(f) for f in glob.glob(f"{folders.path}/*/*/part-*")}
    before = files()
    # The documents of one bucket: changed, taken out, and a new one.
    bucket = {r["id"]: r["b"] for r in spark.range(2000).select("id", folders.doc_bucket().alias("b")).collect()}
    old = [k for k, _ in rows if bucket[k] == 2]
    new = next(k for k in range(1000, 2000) if bucket[k] == 2)
    change = [(old[0], "stone wheel"), (old[1], None), (old[2], ""), (new, "entirely fresh mill")]
    ti.change_positions(folders, spark.createDataFrame(change, SCHEMA), "text")
    after = files()
    touched = {f.split("/doc_bucket=")[1][0] for f in set(before) ^ set(after)}
    assert touched == {"2"}
    again = ti.IndexFolders(str(tmp_path / "again"), "id", STOP, doc_buckets=5, term_buckets=3)
    now = dict(rows) | dict(change)
    ti.store_positions(again, spark.createDataFrame(list(now.items()), SCHEMA), "text")
    assert rows_of(spark, folders) == rows_of(spark, again)


def test_a_bucket_can_become_empty(spark, tmp_path):
    folders = ti.IndexFolders(str(tmp_path / "index"), "id", STOP, doc_buckets=1, term_buckets=4)
    ti.store_positions(folders, spark.createDataFrame([(1, "mill race stone wheel one two three")], SCHEMA), "text")
    ti.change_positions(folders, spark.createDataFrame([(1, None)], SCHEMA), "text")
    assert rows_of(spark, folders) == []
    ti.change_positions(folders, spark.createDataFrame([], SCHEMA), "text")
    ti.change_positions(folders, spark.createDataFrame([(2, "mill")], SCHEMA), "text")
    assert rows_of(spark, folders) == [("mill", 2, 0, (0,))]


def test_a_query_reads_the_folders_of_its_terms(spark, stored):
    folders, _ = stored
    plan = ti.documents_with_phrase(folders, spark, "mill race")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*term_bucket#\d+ (IN|=|INSET) ", plan)
