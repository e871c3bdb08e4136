import hashlib
import random
import re

from pyspark.sql import functions as F

from millrace.llm.fingerprints import END, FINE, K, RUN, S, SHARE, WINDOW, anchors, anchors_with_places, edited_fingerprints, kept, likeness, marks, matched_places, parts, whole


def brute(spark, text):
    """Closed syncmers run by run, on Spark's hashes of the tokens."""
    tokens = re.findall(r"[^ \t\n\x0b\f\r]{1,16}", text or "")
    if not tokens:
        return []
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(tokens)], "i int, t string").select("i", F.xxhash64("t").alias("h")).collect()
    h = [r["h"] for r in sorted(rows)]
    inner = [(i, h[i : i + S]) for i in range(len(h) - S + 1)]
    g = {}
    if inner:
        got = spark.createDataFrame([(i, *x) for i, x in inner], "i int, a bigint, b bigint, c bigint").select("i", F.xxhash64("a", "b", "c").alias("g"))
        g = {r["i"]: r["g"] for r in got.collect()}
    out = []
    for i in range(len(h) - K + 1):
        part = [g[i + j] for j in range(WINDOW)]
        if min(part) in (part[0], part[-1]):
            out.append((i, (part[0], part[S], part[-1])))
    if not out:
        return [(0, spark.createDataFrame([(h,)], "h array<bigint>").select(F.xxhash64("h")).first()[0] & 0x7FFFFFFF)]
    got = spark.createDataFrame([(i, *x) for i, x in out], "i int, a bigint, b bigint, c bigint").select("i", F.xxhash64("a", "b", "c").alias("x"))
    return sorted((r["i"], r["x"] & 0x7FFFFFFF) for r in got.collect())


def test_anchors_are_closed_syncmers(spark, docs, texts):
    picked = [texts[i] for i in (0, 1, 5, -1, -4, -12, -10, -9, -7)] + ["a b c d e f g h", "日本語日本語日本語日本語日本語日本語 x"]
    got = docs(list(enumerate(picked))).select("doc_id", anchors_with_places(F.col("text")).alias("a")).collect()
    for r in got:
        assert [(x["at"], x["hash"]) for x in r["a"]] == brute(spark, picked[r["doc_id"]])


def plain_edit(rows):
    """Edits by position in the order of ids."""
    out = {}
    ids = sorted({i for i, _ in rows}, key=lambda i: (i is not None, i))
    text = {i: [t or "" for j, t in rows if j == i] for i in ids}
    for at, i in enumerate(ids):
        follower = min(text[ids[(at + 1) % len(ids)]])
        for t in text[i]:
            q = len(t) // 4
            out.setdefault(i, []).append(t[: len(t) - q] + follower[:q])
    return out


def test_edits_take_the_next_beginning(docs, texts):
    rows = [(i * 3 - 20, t) for i, t in enumerate(texts)]
    got = edited_fingerprints(docs(rows, 4, ["next", "head", "found"])).collect()
    expected = plain_edit(rows)
    assert len(got) == len(rows)
    for r in got:
        assert r["edited_sha256"] == hashlib.sha256(expected[r["doc_id"]][0].encode()).hexdigest()
        assert r["n_chars"] == len(dict(rows)[r["doc_id"]] or "")
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    by_text = {}
    for r in got:
        by_text.setdefault(dict(rows)[r["doc_id"]] or "", set()).add(r["fingerprint"])
    assert all(len(f) == 1 for f in by_text.values())


def test_likeness_follows_shared_passages(spark):
    long = " ".join(f"w{i * i % 977}" for i in range(400))
    frame = spark.createDataFrame([(long, long[: len(long) * 3 // 4] + " " + "z ".join("abc" * 40)), (long, long), (long, "q r s t u v w x y"), ("", " "), ("a", "")], "a string, b string")
    got = [r[0] for r in frame.select(likeness(anchors(F.col("a")), anchors(F.col("b")))).collect()]
    assert 0.7 < got[0] < 1 and got[1] == 1 and got[2] == 0 and got[3] == 1 and got[4] == 0


def test_places_match_across_a_shift(spark):
    passage = " ".join(f"w{i * i % 977}" for i in range(100))
    frame = spark.createDataFrame([(passage, "one two three " + passage)], "a string, b string")
    pairs = frame.select(matched_places(anchors_with_places(F.col("a")), anchors_with_places(F.col("b")))).first()[0]
    assert len(pairs) > 10 and all(p["right"] - p["left"] == 3 for p in pairs)


def test_repeated_missing_single_and_empty(docs):
    rows = [(4, "abcd efgh"), (4, "abcd efgh"), (None, "zz yy xx ww"), (9, None)]
    got = edited_fingerprints(docs(rows)).collect()
    expected = plain_edit(rows)
    assert sorted(r["edited_sha256"] for r in got) == sorted(hashlib.sha256(t.encode()).hexdigest() for ts in expected.values() for t in ts)
    one = edited_fingerprints(docs([(1, "abcdefgh")])).collect()
    assert one[0]["edited_sha256"] == hashlib.sha256(b"abcdefab").hexdigest()
    assert edited_fingerprints(docs([], 1)).collect() == []


def test_short_texts_are_like_their_edits(docs):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.randrange(4, 10)))
    rows = [(i, " ".join(word() for _ in range(i % 15 + 1))) for i in range(90)]
    got = edited_fingerprints(docs(rows)).collect()
    assert len(got) == 90
    assert min(r["near_edited"] for r in got) >= 0.25
    assert all(r["near_edited"] > r["near_next"] + 0.1 for r in got)


def test_unspaced_texts_are_like_when_shifted(spark):
    rng = random.Random(4)
    run = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    base64 = run("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", 600)
    han = run([chr(0x4E00 + i) for i in range(2000)], 300)
    rows = [(x, y + x, run(letters, len(x))) for x, y, letters in ((base64, "Q", base64), (han, "\u6587", han), ("ht" + "/b-c_d" * 40 + base64[:200], "s", base64), (run("ACGT", 400), "G", "ACGT"))]
    frame = spark.createDataFrame(rows, "a string, b string, c string")
    a, b, c = (marks(F.col(x)) for x in "abc")
    for r in frame.select(likeness(a, b).alias("shifted"), likeness(a, c).alias("other")).collect():
        assert r["shifted"] > 0.85 and r["other"] < 0.3


def test_any_four_tokens_hold_a_fine_anchor(docs, texts):
    got = docs(list(enumerate(texts))).select("text", F.regexp_count(F.coalesce("text", F.lit("")), F.lit(FINE.token)).alias("n"), anchors_with_places(F.col("text"), FINE)["at"].alias("at")).collect()
    for r in got:
        places = [-1, *r["at"], max(r["n"] - FINE.k + 1, 0)]
        assert all(b - a <= 2 for a, b in zip(places, places[1:]))


def test_ends_are_all_runs_of_short_texts(docs, texts, spark):
    picked = [t for t in texts if t and t.strip()] + ["a", "ab", " abc\n", *("x" * 3 + "abcdefghijklmnopqrstuvwxyzABCDEFGHI"[:n] for n in range(36))]
    got = docs(list(enumerate(picked))).select("doc_id", marks(F.col("text")).alias("m"), anchors(F.col("text"), FINE).alias("a")).collect()
    runs = sorted({t.strip()[i : i + RUN] for t in picked for i in range(len(t.strip()))})
    h = {r["x"]: r["h"] & 0x7FFFFFFF for r in spark.createDataFrame([(x,) for x in runs], "x string").select("x", F.xxhash64("x").alias("h")).collect()}
    for r in got:
        t = picked[r["doc_id"]].strip()
        starts = range(max(len(t) - RUN + 1, 1))
        first = [i for i in starts if i <= max(END - RUN, 0)]
        last = [i for i in starts if i > END - RUN and i >= len(t) - END]
        kept = [x for x in r["a"] if x < (1 << 31) // SHARE]
        assert r["m"] == [h[t[i : i + RUN]] for i in first] + kept + [h[t[i : i + RUN]] for i in last]


def fine_brute(spark, texts):
    """The fine anchors of each text run by run: tokens cut by a plain scan, on Spark's hashes."""
    unspaced = [(0x0E00, 0x109F), (0x1780, 0x17FF), (0x2E80, 0xA4CF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x20000, 0x3FFFF)]
    own = lambda c: any(a <= ord(c) <= b for a, b in unspaced)
    cuts, blanks = set("aeiouyAEIOUY0369"), set(" \t\n\x0b\f\r")

    def tokens(text):
        out = []
        for run in re.split("[ \t\n\x0b\f\r]+", text or ""):
            if 0 < len(run) <= 16 and not any(own(c) for c in run):
                out.append(run)
                continue
            at = 0
            while at < len(run):
                end = at
                while end < len(run) and end - at < 7 and "!" <= run[end] <= "~" and run[end] not in cuts:
                    end += 1
                if end < len(run) and run[end] in cuts:
                    end += 1
                elif end < len(run) or end == at:
                    end = at + 1  # neither a cut nor the run's end behind it: one character
                out.append(run[at:end])
                at = end
        assert not any(c in blanks for t in out for c in t)
        return out

    cut = [tokens(t) for t in texts]
    words = sorted({w for c in cut for w in c})
    one = {r["w"]: r["h"] for r in spark.createDataFrame([(w,) for w in words], "w string").select("w", F.xxhash64("w").alias("h")).collect()}
    again = {r["h"]: r["g"] for r in spark.createDataFrame([(h,) for h in sorted(set(one.values()))], "h bigint").select("h", F.xxhash64("h").alias("g")).collect()}
    found = []
    for c in cut:
        g = [again[one[w]] for w in c]
        found.append([(i, tuple(g[i : i + 3])) for i in range(len(g) - 2) if min(g[i : i + 3]) in (g[i], g[i + 2])])
    runs = sorted({x for f in found for _, x in f})
    value = {}
    if runs:
        rows = spark.createDataFrame(runs, "a bigint, b bigint, c bigint")
        value = {(r["a"], r["b"], r["c"]): r["v"] & 0x7FFFFFFF for r in rows.select("a", "b", "c", F.xxhash64("a", "b", "c").alias("v")).collect()}
    return [[(i, value[x]) for i, x in f] for f in found]


def test_fine_anchors_equal_a_scan(spark, docs, texts):
    picked = [t for t in texts if len(t or "") < 3000] + ["日本語のテキスト and words", "http://example.org/a-b_c?d=1&e=bcdfghjklmnpqrstvwxz", "x" * 40, "ACGTACGTTGCA" * 3, "a b c d"]
    got = docs(list(enumerate(picked))).select("doc_id", anchors_with_places(F.col("text"), FINE).alias("a")).collect()
    wanted = fine_brute(spark, picked)
    for r in got:
        assert [(x["at"], x["hash"]) for x in r["a"]] == wanted[r["doc_id"]], picked[r["doc_id"]]


def test_registered_fingerprints_equal_brute_force(spark, small):
    """Fingerprints and likeness of the whole table, from the scan above."""
    from millrace.llm import queries

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    edits = plain_edit(rows)
    given = [t or "" for _, t in rows] + [edits[i][0] for i, _ in rows]
    strip = " \t\n\x0b\f\r"
    pieces = lambda t: [t[i : i + RUN] for i in range(max(len(t) - RUN + 1, min(len(t), 1)))]
    names = sorted({p for t in given for p in [*pieces(t.strip(strip)[:END]), *pieces(t.strip(strip)[-END - RUN :])]})
    h = {r["x"]: r["h"] & 0x7FFFFFFF for r in spark.createDataFrame([(x,) for x in names], "x string").select("x", F.xxhash64("x").alias("h")).collect()}
    prints = []
    for t, found in zip(given, fine_brute(spark, given)):
        t = t.strip(strip)
        starts = range(max(len(t) - RUN + 1, min(len(t), 1)))
        first = [h[t[i : i + RUN]] for i in starts if i <= max(END - RUN, 0)]
        last = [h[t[i : i + RUN]] for i in starts if i > END - RUN and i >= len(t) - END]
        prints.append(first + [v for _, v in found if v < (1 << 31) // SHARE] + last)
    dice = lambda a, b: 2 * len(set(a) & set(b)) / (len(set(a)) + len(set(b))) if a or b else 1.0
    ids = sorted(i for i, _ in rows)
    own = dict(zip((i for i, _ in rows), prints))
    size, chars = 0, 0
    for r in queries.op6_syncmer_fingerprints(spark, small).collect():
        at = [i for i, _ in rows].index(r["doc_id"])
        a, e, n = prints[at], prints[len(rows) + at], own[ids[(ids.index(r["doc_id"]) + 1) % len(ids)]]
        assert r["fingerprint"] == "".join(f"{x:08x}" for x in a) and r["edited_fingerprint"] == "".join(f"{x:08x}" for x in e)
        assert abs(r["near_edited"] - dice(a, e)) < 1e-12 and abs(r["near_next"] - dice(a, n)) < 1e-12
        if r["n_chars"] > 3000:  # shorter ones have mostly the runs at their ends
            size, chars = size + len(r["fingerprint"]), chars + r["n_chars"]
    assert 0 < size < 0.12 * chars


def test_all_anchors_count_beside_the_fingerprint(spark, docs, texts):
    """Likeness by all anchors equals brute force, where the fingerprint's rests on a part of them."""
    rows = list(enumerate(t for t in texts if t is None or len(t) < 3000))
    edits = plain_edit(rows)
    given = [t or "" for _, t in rows] + [edits[i][0] for i, _ in rows]
    found = fine_brute(spark, given)
    ends = [r for r in docs(list(enumerate(given))).select("doc_id", parts(F.col("text")).alias("p")).collect()]
    end = {r["doc_id"]: (r["p"]["first"], r["p"]["last"]) for r in ends}
    all_of = [set(end[i][0]) | {v for _, v in f} | set(end[i][1]) for i, f in enumerate(found)]
    dice = lambda a, b: 2 * len(a & b) / (len(a) + len(b)) if a or b else 1.0
    for r in edited_fingerprints(docs(rows)).collect():
        i = r["doc_id"]
        assert abs(r["near_edited_whole"] - dice(all_of[i], all_of[len(rows) + i])) < 1e-12
        assert abs(r["near_next_whole"] - dice(all_of[i], all_of[(i + 1) % len(rows)])) < 1e-12


def test_one_changed_word_shows_in_all_anchors(spark):
    words = [f"w{i * i % 977}x{i}" for i in range(300)]
    rows = [(" ".join(words), " ".join([*words[:k], "other", *words[k + 1 :]])) for k in range(20, 280, 5)]
    frame = spark.createDataFrame(rows, "a string, b string").select(parts(F.col("a")).alias("a"), parts(F.col("b")).alias("b"))
    got = frame.select(likeness(kept(F.col("a")), kept(F.col("b"))).alias("kept"), likeness(whole(F.col("a")), whole(F.col("b"))).alias("whole")).collect()
    assert any(r["kept"] == 1 for r in got) and all(0.97 < r["whole"] < 1 for r in got)
