import random

import numpy as np
import pytest

from millrace.llm.graph import connected
from millrace.llm.near_dup import AT_80, AT_85, Near, drop_near_duplicates, near_groups
from millrace.llm.shingles import jaccard_at_least, shingle_sets, sketches

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BLANK = " \t\n\x0b\x0c\r"


def shingles(text, width=5):
    lower = (text or "").translate(str.maketrans(UPPER, UPPER.lower()))
    for b in BLANK:
        lower = lower.replace(b, " ")
    words = [w for w in lower.split(" ") if w]
    return {tuple(words[i : i + width]) for i in range(max(len(words) - width + 1, 1))} if words else set()


def brute(rows, percent):
    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                group[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[root(i)] = min(least.get(root(i), key), key)
    return sorted(
        ((k, len(sets[i]), least.get(root(i)) if k is not None else None, k == (least.get(root(i)) if k is not None else None)) for i, (k, _) in enumerate(rows)),
        key=repr,
    )


def found(frame):
    return sorted((tuple(r) for r in frame.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=repr)


def copies(seed, groups=12, size=9, words=70):
    """Groups of texts with ever more words changed, so that links lie on both sides of the threshold."""
    rng = random.Random(seed)
    out = []
    for g in range(groups):
        base = [f"w{rng.randrange(5000)}" for _ in range(words)]
        for _ in range(size):
            out.append(" ".join(base))
            base = list(base)
            base[rng.randrange(words)] = f"n{rng.randrange(10**6)}"
    rng.shuffle(out)
    return out


@pytest.mark.parametrize(("near", "percent"), [(AT_85, 85), (AT_80, 80), (Near(bucket_block=2, cluster_block=2), 85)])
def test_groups_match_all_pairs(docs, texts, near, percent):
    rows = list(enumerate(copies(7) + texts))
    assert found(near_groups(docs(rows, 4, ["node", "component_id", "unit"]), near)) == brute(rows, percent)


def test_repeated_and_missing_ids(docs):
    a = " ".join(f"w{i}" for i in range(40))
    b = a.replace("w3 ", "v ")
    rows = [(5, a), (5, a), (None, b), (2, a + " x"), (7, None), (7, ""), (9, "lone words")]
    expected = brute(rows, 85)
    got = found(near_groups(docs(rows), AT_85))
    # A missing id has no group; it still links the others.
    assert [r for r in got if r[0] is not None] == [(k, n, c, k == c) for k, n, c, _ in expected if k is not None]
    assert all(r[2] is None for r in got if r[0] is None)


def test_one_id_with_two_texts(docs):
    a, b = " ".join(f"w{i}" for i in range(40)), " ".join(f"v{i}" for i in range(40))
    rows = [(4, a), (4, b), (6, b + " more")]
    got = {r[0]: r[2] for r in found(near_groups(docs(rows), AT_85))}
    assert got == {4: 4, 6: 4}


def test_drop_keeps_one_of_each_group(docs, texts):
    rows = list(enumerate(copies(8) + texts))
    kept = {r["doc_id"] for r in drop_near_duplicates(docs(rows)).collect()}
    assert kept == {r[0] for r in brute(rows, 80) if r[3]}


def test_empty_table(docs):
    assert near_groups(docs([], 1)).collect() == []


def test_shingle_sets_have_the_sizes_of_plain_sets(texts):
    sizes = [len(s) for s in shingle_sets([t.encode() if t is not None else None for t in texts])]
    assert sizes == [len(shingles(t)) for t in texts]


def test_sketches_fill_every_coordinate_and_estimate_similarity():
    rng = np.random.default_rng(1)
    pool = rng.integers(1, 2**63, 3000, dtype=np.int64).astype(np.uint64)
    sets = [np.sort(pool[:1000]), np.sort(pool[100:1100]), np.sort(pool[:1]), np.sort(pool[:3]), np.zeros(0, np.uint64)]
    found_rows = sketches(sets, 180)
    assert (found_rows[:4] != 0).all() and not found_rows[4].any()
    # Independent pairs that share 900 of 1,100 elements.
    draws = rng.integers(1, 2**63, (40, 1100), dtype=np.int64).astype(np.uint64)
    estimates = [sketches([np.sort(d[:1000]), np.sort(d[100:])], 180) for d in draws]
    assert abs(np.mean([(a == b).mean() for a, b in estimates]) - 9 / 11) < 0.02


def test_exact_threshold():
    a = np.arange(100, dtype=np.uint64)
    assert jaccard_at_least(a, a[:85], 85) and not jaccard_at_least(a, a[:84], 85)


def test_components_of_long_paths_stars_and_loops(spark):
    rng = random.Random(4)
    path = list(range(200))
    edges = [(path[i], path[i + 1]) for i in range(199)] + [(1000, 1000 + i) for i in range(300)] + [(5000, 5000)]
    edges += [(9000 + rng.randrange(60), 9000 + rng.randrange(60)) for _ in range(50)]
    names = lambda x: x.to_bytes(4, "big")
    frame = spark.createDataFrame([(bytearray(names(a)), bytearray(names(b))) for a, b in edges], "a binary, b binary")
    got = {int.from_bytes(r["node"], "big"): int.from_bytes(r["root"], "big") for r in connected(frame).collect()}
    root = {}
    for a, b in edges:
        if a != b:
            root.setdefault(a, a), root.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            if a != b and root[a] != root[b]:
                root[a] = root[b] = min(root[a], root[b])
                changed = True
    assert got == root
