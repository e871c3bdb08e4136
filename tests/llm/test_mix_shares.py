import re
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm.mixing import mix_sources

README = Path(__file__).parents[2] / "README.md"


def test_readme_states_the_reached_and_wanted_shares(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    mix = corpus_pipeline.MIX

    def shares(m):
        got = mix_sources(docs, m)
        out = {}
        for level in mix.weights:
            sums = dict(got.groupBy(level).agg(F.sum("tokens")).collect())
            out |= {(level, name): 100 * n / sum(sums.values()) for name, n in sums.items()}
        return out

    # All tokens in one epoch are the table itself.
    table, reached = shares(replace(mix, share_percent=100)), shares(mix)
    wanted = {(level, name): 100 * w / sum(ws.values()) for level, ws in mix.weights.items() for name, w in ws.items()}
    stated = {(m[1], m[2]): [float(x) for x in m[3].split("|")] for m in re.finditer(r"^\| (domain|lang) (\w+) \| (.*) \|$", README.read_text(), re.M)}
    assert stated.keys() == wanted.keys() == reached.keys()
    for key, figures in stated.items():
        assert figures == pytest.approx([table[key], reached[key], wanted[key]], abs=0.01)
