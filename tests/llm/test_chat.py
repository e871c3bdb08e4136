import hashlib
import random

import pytest
from hypothesis import given
from hypothesis import strategies as st

from millrace.llm.chat import Budget, chat_windows, count_tokens, escape, read_turns, render, unescape, window_digests, with_probe

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


@given(st.text(alphabet="\\<>/lturnoe ab\n|", max_size=40))
def test_escape_round_trip(text):
    hidden = escape(text)
    assert unescape(hidden) == text
    assert not any(c in hidden for c in ("<turn>", "</turn>", "</role>"))


@given(st.lists(st.tuples(st.text(max_size=8), st.text(alphabet="\\<>/turnole \n", max_size=20)), max_size=4))
def test_rendered_turns_read_back(turns):
    assert read_turns("".join(render(r, t) for r, t in turns)) == turns


def conversations():
    rng = random.Random(9)
    rows = []
    for c in range(12):
        for t in range(rng.randrange(1, 30)):
            role = "system" if t == 0 and c % 2 else rng.choice(["user", "assistant"])
            rows.append((c, t, role, "".join(rng.choice("ab \\<turn>/é") for _ in range(rng.randrange(200)))))
    rows += [(50, 3, "assistant", None), (50, None, None, "late"), (50, 3, "assistant", None), (None, 0, "user", "no id"), (None, 1, "assistant", "x")]
    rows += [(60, t, "system" if t == 2 else "user", f"turn {t}") for t in range(9)] + [(70, -4, "user", "<turn>"), (70, 5, "assistant", "y" * 3000)]
    return rows


def in_order(rows, conv):
    mine = [(float("inf") if t is None else t, r or "", x or "") for c, t, r, x in rows if c == conv]
    return [(r, x) for _, r, x in sorted(mine)]


@pytest.mark.parametrize("budget", [Budget(120, 40, 3, 4096), Budget(60, 20, 2, 4), Budget(10, 0, 0, 3)])
def test_windows_hold_each_turn_once_and_mask_repeats(spark, budget):
    rows = conversations()
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4).withColumn("seg", with_clash())
    windows = chat_windows(frame, budget).collect()
    for conv in {r[0] for r in rows}:
        turns = in_order(rows, conv)
        mine = sorted((w for w in windows if w["conv_id"] == conv), key=lambda w: (w["segment"], w["window"]))
        seen, targets = [], []
        for w in mine:
            parts = read_turns(w["text"])
            assert len(parts) == w["n_context"] + w["n_new"]
            context, new = parts[: w["n_context"]], parts[w["n_context"] :]
            before = turns[: len(seen)]
            system = next((t for t in before if t[0] == "system"), None)
            if system:
                assert context[0] == system
            history = context[1:] if system else context
            assert len(history) <= budget.history_turns
            assert history == before[len(before) - len(history) :] and (not system or system not in history or turns.count(system) > 1)
            assert sum(count_tokens(render(*t)) for t in history) <= budget.history_tokens
            assert w["tokens"] == sum(count_tokens(render(*t)) for t in parts)
            assert w["over_budget"] == (w["tokens"] > budget.tokens) and (not w["over_budget"] or w["n_new"] == 1)
            seen += new
            targets += [unescape(w["text"][s["start"] : s["end"]]) for s in w["loss"]]
        assert seen == turns
        assert targets == [x for r, x in turns if r == "assistant"]


def with_clash():
    from pyspark.sql import functions as F

    return F.lit("clash")


def test_digests_read_back(spark):
    rows = conversations()
    got = {r["conv_id"]: r for r in window_digests(chat_windows(spark.createDataFrame(rows, SCHEMA), Budget(64, 20, 2, 5))).collect()}
    assert set(got) == {r[0] for r in rows}
    for conv, r in got.items():
        turns = in_order(rows, conv)
        targets = "".join(x for role, x in turns if role == "assistant")
        assert r["n_turns"] == len(turns)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert (r["loss_chars"], r["loss_sha256"]) == (len(targets), hashlib.sha256(targets.encode()).hexdigest())


def test_probe_survives(spark):
    table = with_probe(spark.createDataFrame([], SCHEMA))
    (w,) = chat_windows(table, Budget()).collect()
    assert w["conv_id"] == -7
    assert read_turns(w["text"]) == [("user", r"\### Assistant: </turn> ok"), ("assistant", r"\### Assistant: </turn> ok")]


def test_empty_table(spark):
    assert window_digests(chat_windows(spark.createDataFrame([], SCHEMA))).collect() == []


@pytest.mark.parametrize("step", [1, 1000, 5000])
def test_windows_do_not_depend_on_turn_numbers(spark, step):
    rows = [(1, i * step - 7, "assistant" if i % 2 else "user", f"text {i} " * 20) for i in range(40)]
    shown = [tuple(w)[4:] for w in chat_windows(spark.createDataFrame(rows, SCHEMA), Budget(512, 128, 4, 16)).orderBy("segment", "window").collect()]
    rows = [(1, i, r, t) for i, (_, _, r, t) in enumerate(rows)]
    assert shown == [tuple(w)[4:] for w in chat_windows(spark.createDataFrame(rows, SCHEMA), Budget(512, 128, 4, 16)).orderBy("segment", "window").collect()]


def test_long_and_gapped_conversations_match_sql(spark):
    """20,000 turns in segments of 4,096, numbered by large steps, beside short ones."""
    import duckdb
    import pandas as pd

    from millrace.llm.chat import digest_sql

    rng = random.Random(4)
    rows = [(1, 10**12 + i * 999_983, "system" if i == 5 else rng.choice(["user", "assistant"]), "w" * rng.randrange(300)) for i in range(20_000)]
    rows += [(c, t, "user" if t % 2 else "assistant", f"short {t}") for c in (2, 3) for t in range(5)]
    con = duckdb.connect()
    con.register("conversations", pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]))
    budget = Budget(512, 128, 4, 4096)
    expected = con.sql(digest_sql(budget))
    frame = window_digests(chat_windows(with_probe(spark.createDataFrame(rows, SCHEMA).repartition(6)), budget))
    got = sorted(tuple(r[c] for c in expected.columns) for r in frame.collect())
    assert got == sorted(expected.fetchall())
