import hashlib
from collections import defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from millrace.llm import mixing
from millrace.llm.mixing import Mix, leaf_budgets, mix_sources, mixed_documents


def divide(budget, children):
    """Water filling one saturated child after the other; children: name -> (capacity, weight)."""
    shares, open_ones = {}, {n: cw for n, cw in children.items() if cw[1] > 0}
    while open_ones:
        total = sum(w for _, w in open_ones.values())
        full = [n for n, (c, w) in open_ones.items() if c * total <= budget * w]
        if not full:
            return shares | {n: budget * w // total for n, (_, w) in open_ones.items()}
        name = min(full, key=lambda n: (Fraction(open_ones[n][0], open_ones[n][1]), n))
        shares[name] = open_ones.pop(name)[0]
        budget -= shares[name]
    return shares


def brute_budgets(leaves, mix):
    """Budgets by recursion; leaves: (domain, lang, source) -> tokens."""
    out = {}

    def down(path, budget):
        if len(path) == 3:
            out[path] = budget
            return
        caps = defaultdict(int)
        for leaf, tokens in leaves.items():
            if leaf[: len(path)] == path:
                caps[leaf[len(path)]] += tokens * mix.max_epochs
        weights = mix.weights.get(mixing.LEVELS[len(path)], {})
        for name, share in divide(budget, {n: (c, weights.get(n, 1)) for n, c in caps.items()}).items():
            down((*path, name), share)

    total = sum(leaves.values())
    down((), min(total * mix.share_percent // 100, total * mix.max_epochs))
    return out


def brute(rows, mix):
    """rows: (doc_id, domain, lang, source, tokens)."""
    leaves = defaultdict(int)
    for _, d, l, s, n in rows:
        leaves[d, l, s] += n
    out = []
    for leaf, quota in brute_budgets(leaves, mix).items():
        mine = [r for r in rows if r[1:4] == leaf]
        if not quota:
            continue
        whole, rest = divmod(quota, leaves[leaf])
        out += [(*r, e) for r in mine for e in range(whole)]
        key = lambda r: int(hashlib.md5(f"{mix.seed}:{whole}:{'' if r[0] is None else r[0]}".encode()).hexdigest()[:15], 16)  # noqa: B023, E731
        used = 0
        for r in sorted(mine, key=lambda r: (key(r), (r[0] is not None, r[0]), r[4])):
            used += r[4]
            if rest and used <= rest:
                out.append((*r, whole))
    return sorted(out, key=repr)


def rows_and_docs(docs, n=600):
    sources = ["src0"] * 5 + ["src1", "src2", "src3", None]
    langs = ["en"] * 4 + ["de", "fr", None]
    raw = [(i, " ".join("w" * (i * 7 % 50)), langs[i % 7], sources[i % 9]) for i in range(n)]
    raw += [(3, "a b", "en", "src1"), (None, "x y z", "en", "src1"), (1000, None, "de", "src0"), (1001, " \n", "de", "src0"), (1002, None, "xx", "src9")]
    label = lambda x: "(none)" if x is None else x
    domain = lambda s: "(none)" if s is None else "crawl" if s == "src0" else "curated"
    rows = [(i, domain(s), label(l), label(s), len((t or "").split())) for i, t, l, s in raw]
    return rows, docs(raw, 4, ["domain", "tokens", "epoch"])


MIXES = [
    Mix(),
    Mix({"domain": {"crawl": 1, "curated": 9}, "lang": {"en": 1, "fr": 5}}, 150, 4, 1),
    Mix({"lang": {"en": 0}, "source": {"src0": 3}}, 40, 1, 2),
    Mix({"domain": {"curated": 50}}, 100, 1, 3),
    Mix({}, 10_000, 2, 4),
]


@pytest.mark.parametrize("mix", MIXES)
def test_matches_plain_budgeting(docs, mix):
    rows, frame = rows_and_docs(docs)
    got = sorted((tuple(r) for r in mix_sources(frame, mix).collect()), key=repr)
    assert got == brute(rows, mix)


def test_repeats_epochs_and_redistributes_to_siblings_first(spark):
    mix = Mix({"domain": {"a": 1, "b": 1}}, 100, 2, 1)
    leaves = {("a", "en", "s1"): 10, ("a", "en", "s2"): 300, ("b", "en", "s3"): 400, ("b", "de", "s4"): 100}
    frame = spark.createDataFrame([(*k, v) for k, v in leaves.items()], "domain string, lang string, source string, tokens bigint")
    got = {(r["domain"], r["lang"], r["source"]): r["quota"] for r in leaf_budgets(frame, mix).collect()}
    # s1 can supply 20 of its 202, and its sibling s2 takes the rest of a's half.
    assert got[("a", "en", "s1")] == 20 and got[("a", "en", "s2")] == 385
    assert got == brute_budgets(leaves, mix)


def test_cut_inside_one_range(docs, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE_BITS", 1)
    rows, frame = rows_and_docs(docs, 200)
    got = sorted((tuple(r) for r in mix_sources(frame, MIXES[0]).collect()), key=repr)
    assert got == brute(rows, MIXES[0])


def test_documents_keep_their_columns(docs):
    frame = docs([(i, "a b c", "en", "src0" if i % 2 else "src1") for i in range(50)], 2, ["_key"])
    mix = Mix({"domain": {"crawl": 1, "curated": 3}}, 60, 1, 5)
    kept = mixed_documents(frame, mix)
    assert kept.columns == frame.columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in mix_sources(frame, mix).collect()}
    with pytest.raises(ValueError, match="max_epochs"):
        mixed_documents(frame, Mix(max_epochs=2))


def test_empty_table(docs):
    assert mix_sources(docs([], 1), Mix()).collect() == []


def test_other_domains(docs):
    got = mix_sources(docs([(1, "a b", "en", "x")]), Mix(share_percent=100), F.lit("web")).collect()
    assert [r["domain"] for r in got] == ["web"]
