import random

import pytest

from millrace.llm import line_dedup
from millrace.llm.line_dedup import Similar, _candidates, dedup_lines

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def tokens(line, width):
    low = line.translate(str.maketrans(UPPER, UPPER.lower()))
    for b in "\t\x0b\x0c\r":
        low = low.replace(b, " ")
    w = [x for x in low.split(" ") if x]
    return frozenset(tuple(w[i : i + width]) for i in range(max(len(w) - width + 1, 1))) if w else frozenset()


def brute(rows, similar):
    lines = []
    for key, text in rows:
        for i, line in enumerate((text if text is not None else "").split("\n") if text is not None else []):
            lines.append(((float("inf") if key is None else key, i), tokens(line, similar.width), line))
    first = {}
    for place, t, _ in lines:
        if t:
            first[t] = min(first.get(t, place), place)
    out = []
    for key, text in rows:
        kept, links = [], 0
        parts = text.split("\n") if text is not None else []
        for i, line in enumerate(parts):
            place, t = (float("inf") if key is None else key, i), tokens(line, similar.width)
            if not t:
                kept.append(line)
            elif first[t] == place:
                mine = sum(1 for o, p in first.items() if p < place and 100 * len(o & t) >= similar.percent * len(o | t))
                links += mine
                if not mine:
                    kept.append(line)
        out.append((key, len(parts), len(parts) - len(kept), links, "\n".join(kept)))
    return sorted(out, key=repr)


def found(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def near_lines():
    base = [f"w{i}" for i in range(50)]
    out = []
    for k in range(30):
        line = list(base)
        for j in range(k % 4):
            line[(k * 7 + j * 13) % 50] = f"n{k}{j}"
        out.append(" ".join(line))
    return out


@pytest.mark.parametrize("similar", [Similar(), Similar(percent=60, width=2), Similar(percent=95, width=1)])
def test_matches_all_pairs_of_lines(docs, texts, similar):
    near = near_lines()
    rows = list(enumerate(texts + ["\n".join(near[i : i + 3]) for i in range(0, 30, 3)]))
    rows += [(900, "\n\nOne two\nthree\n" + near[0].upper()), (None, near[3] + "\nunseen words here"), (-1, near[5] + "\n" + near[5])]
    assert found(dedup_lines(docs(rows, 4, ["line", "class", "token"]), similar)) == brute(rows, similar)


def test_repeated_rows_stay_alike(docs):
    rows = [(5, "a b c d e f\nx y"), (5, "a b c d e f\nx y"), (7, "x y\nnew")]
    got = found(dedup_lines(docs(rows)))
    assert [r[:3] for r in got] == [(5, 2, 0), (5, 2, 0), (7, 2, 1)]


def test_missing_empty_and_blank(docs):
    got = {r[0]: r[1:] for r in found(dedup_lines(docs([(1, None), (2, ""), (3, " \n\t"), (4, "a")])))}
    assert got == {1: (0, 0, 0, ""), 2: (1, 0, 0, ""), 3: (2, 0, 0, " \n\t"), 4: (1, 0, 0, "a")}
    assert dedup_lines(docs([], 1)).collect() == []


def test_random_lines_near_the_threshold(docs):
    rng = random.Random(8)
    line = lambda: " ".join(rng.sample("abcdefghijkl", rng.randrange(2, 10)))
    rows = [(i, "\n".join(line() for _ in range(3))) for i in range(60)]
    for similar in (Similar(percent=50, width=1), Similar(percent=75, width=1)):
        assert found(dedup_lines(docs(rows), similar)) == brute(rows, similar)


def test_meetings_without_room_end_in_the_join(spark):
    """Two sets of 20 tokens must share 18 for 80 %, so the first one they share is among the first three of both."""
    rows = [(i, 0, 20, [i * 10, i * 10 + 1, -1 if i < 3 else i * 10 + 2, -2, -3]) for i in range(40)]
    classes = spark.createDataFrame(rows, "id bigint, line int, n int, prefix array<bigint>")
    got = _candidates(classes, Similar())
    assert sorted((r["c_id"], r["d_id"]) for r in got.collect()) == [(1, 0), (2, 0), (2, 1)]
    (join,) = [x for x in got._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Join Inner" in x]
    assert "* 180" in join


def edited_copies(n):
    """Copies of a line of 100 words, every tenth with one word changed, the others with four."""
    rng = random.Random(4)
    base = [f"w{i}" for i in range(100)]
    out = []
    for k in range(n):
        line = list(base)
        for j in rng.sample(range(100), 1 if k % 10 == 0 else 4):
            line[j] = f"n{k}x{j}"
        out.append(" ".join(line))
    return out


def test_copies_with_many_edits_make_no_pairs(docs, monkeypatch):
    """Two copies of 96 tokens are alike with two edits in both together, so those with four are like none."""
    made, write = {}, line_dedup.written

    def written(df, label):
        made[label] = write(df, label)
        return made[label]

    monkeypatch.setattr(line_dedup, "written", written)
    rows = list(enumerate(edited_copies(80)))
    got = found(dedup_lines(docs(rows)))
    assert got == brute(rows, Similar())
    assert sum(r[3] for r in got) == made["line-pairs"].count() == 8 * 7 // 2


@pytest.mark.parametrize("hot", [0, 1, 4])
def test_lines_of_hot_tokens_match_all_pairs(docs, monkeypatch, hot):
    """With a null id and lines of other lengths among the copies."""
    monkeypatch.setattr(line_dedup, "HOT", hot)
    copies = edited_copies(40)
    rng = random.Random(6)
    cut = [" ".join(c.split(" ")[: rng.randrange(70, 100)]) for c in copies]
    rows = [(i, f"{a}\n{b}\n{a}") for i, (a, b) in enumerate(zip(copies, cut, strict=True))] + [(None, copies[3] + " end")]
    assert found(dedup_lines(docs(rows))) == brute(rows, Similar())
    rows = [(i, "\n".join(" ".join(rng.sample("abcdefghijkl", rng.randrange(2, 10))) for _ in range(3))) for i in range(60)]
    for similar in (Similar(percent=50, width=1), Similar(percent=75, width=1)):
        assert found(dedup_lines(docs(rows), similar)) == brute(rows, similar)
