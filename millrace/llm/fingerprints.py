"""Document fingerprints from closed syncmers, in column functions only.

A run of ``k`` tokens is an anchor if the least hash among its runs of ``s`` tokens is that of
the first or the last: a property of the run alone, so equal passages have equal anchors
whatever surrounds them, at places that match. There are two grains:

- ``COARSE``, for the alignment of long passages: tokens are runs of non-blank characters, cut
  every 16 characters; a text without any anchor has one, the hash of all its tokens.
- ``FINE``, for fingerprints: of any four tokens in a row at least one starts an anchor. A token is
  a word of at most 16 characters. Longer runs, and scripts without blanks, are cut by content:
  after a character of ``CUTS``, else after each character, so a shift moves the cuts along.

The fingerprint (``marks``) is the hashes of the first ``END`` characters' runs of ``RUN``
characters, of the fine anchors whose hash lies in the lowest of ``SHARE`` equal parts, and of the last ``END``
characters' runs, in order. The bound is the same for every text, so the kept anchors are as free of context as all
of them, and a fingerprint takes about a tenth of a long text. Of N anchors that two texts share or not, about N / ``SHARE``
decide: their likeness L has a standard error of about sqrt(L (1 - L) ``SHARE`` / N), 0.04 at L = 0.75 for 1,000 words. Every
text has the runs at its ends, so short texts, down to one word, are compared by them (by runs of characters, not
by syncmers) without a threshold at which the rule changes; in long ones they count little. The likeness of two
fingerprints is twice the shared distinct hashes over the sum of both. Beside it stands the likeness by all anchors (``whole``),
which no bound thins.

Defined cases: a missing text is empty; a text with blanks only has an empty fingerprint;
one of fewer than ``RUN`` characters has the hash of all of them; blanks at the ends of a text do
not count; two empty fingerprints are alike, an empty one is unlike any other. Rows that share an
id are followed by the same next document; of several rows of the next id the least
beginning counts; a missing id comes first. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.keys import assign_keys

K, S = 8, 3
WINDOW = K - S + 1  # runs of S tokens in a run of K
TOKEN = r"\S{1,16}"
MASK = (1 << 31) - 1
BLANKS = " \t\n\x0b\f\r"
# Thai to Tibetan, Myanmar, Khmer, Chinese and Japanese: written without blanks between words.
UNSPACED = r"\u0E00-\u109F\u1780-\u17FF\u2E80-\uA4CF\uF900-\uFAFF\uFF66-\uFF9F\x{20000}-\x{3FFFF}"
CUTS = "aeiouyAEIOUY0369"
_WORD = rf"(?<!\S)[^\s{UNSPACED}]{{1,16}}+(?!\S)"
# What precedes a cut is at most 7 characters, which depend on what follows them only.
_INNER = rf"[!-~&&[^{CUTS}]]"
PIECE = rf"{_WORD}|{_INNER}{{0,7}}+[{CUTS}]|{_INNER}{{1,7}}+(?!\S)|\S"
RUN, END = 3, 16
SHARE = 12


@dataclass(frozen=True)
class Grain:
    """Tokens by pattern, tokens in a run and in an inner run, and whether texts without anchors get one of all."""

    token: str
    k: int
    s: int
    whole: bool


COARSE = Grain(TOKEN, K, S, whole=True)
FINE = Grain(PIECE, 3, 1, whole=False)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of the value, which is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _upto(last: Column) -> Column:
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def _short(h: Column) -> Column:
    return h.bitwiseAND(F.lit(MASK)).cast("int")


def anchors_with_places(text: Column, grain: Grain = COARSE) -> Column:
    """array of (at, hash): the anchors of a text and the numbers of their first tokens."""
    s, window = grain.s, grain.k - grain.s + 1

    def runs(h: Column) -> Column:
        inner = F.transform(_upto(F.size(h) - s), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(s)]))
        if not grain.whole:
            return _let(inner, closed)
        return _let(inner, lambda g: _let(closed(g), lambda found: F.when((F.size(found) > 0) | (F.size(h) == 0), found).otherwise(F.array(whole(h)))))

    def whole(h: Column) -> Column:
        return F.struct(F.lit(0).alias("at"), _short(F.xxhash64(h)).alias("hash"))

    def closed(g: Column) -> Column:
        def test(i: Column) -> Column:
            first, last = F.get(g, i), F.get(g, i + (window - 1))
            least = F.least(*[F.get(g, i + j) for j in range(window)])
            # Three inner runs cover all tokens of the outer one.
            value = _short(F.xxhash64(first, F.get(g, i + s), last))
            return F.when((least == first) | (least == last), F.struct(i.alias("at"), value.alias("hash")))

        return F.filter(F.transform(_upto(F.size(g) - window), test), lambda x: x.isNotNull())

    tokens = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(grain.token), F.lit(0))
    return _let(F.transform(tokens, lambda t: F.xxhash64(t)), runs)


def anchors(text: Column, grain: Grain = COARSE) -> Column:
    """The anchors' hashes in order."""
    return F.transform(anchors_with_places(text, grain), lambda a: a["hash"])


def _runs(part: Column, last: Column) -> Column:
    """Hashes of the runs of ``RUN`` characters that start at places 0 to ``last``."""
    return F.transform(_upto(last), lambda i: _short(F.xxhash64(F.substring(part, i + 1, F.lit(RUN)))))


def parts(text: Column) -> Column:
    """struct of hashes (first, anchors, last): the first characters' runs, all fine anchors, the last characters' runs."""
    plain = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    n = F.length(plain)
    # The last runs begin behind the first ones, so a text of up to 2 * END - RUN + 1 characters has each run once.
    left = F.greatest(F.least(n - (END - RUN + 1), F.lit(END)), F.lit(0))
    first = _let(F.substring(plain, 1, END), lambda e: _runs(e, F.when(F.length(e) > 0, F.greatest(F.length(e) - RUN, F.lit(0))).otherwise(-1)))
    last = _let(F.right(plain, left), lambda e: _runs(e, F.length(e) - RUN))
    return F.struct(first.alias("first"), anchors(text, FINE).alias("anchors"), last.alias("last"))


def whole(found: Column) -> Column:
    """All hashes of the parts, in order."""
    return F.concat(found["first"], found["anchors"], found["last"])


def kept(found: Column) -> Column:
    """The hashes of the parts that a fingerprint keeps, in order."""
    return F.concat(found["first"], F.filter(found["anchors"], lambda h: h < F.lit((MASK + 1) // SHARE)), found["last"])


def marks(text: Column) -> Column:
    """The hashes of a text's fingerprint."""
    return kept(parts(text))


def fingerprint(found: Column) -> Column:
    """Eight hexadecimal digits per hash."""
    return F.array_join(F.transform(found, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Dice measure of the distinct hashes, 0 to 1."""
    total = F.size(F.array_distinct(a)) + F.size(F.array_distinct(b))
    return F.when(total > 0, F.lit(2.0) * F.size(F.array_intersect(a, b)) / total).otherwise(F.lit(1.0))


def matched_places(a: Column, b: Column) -> Column:
    """Pairs of places at which two texts' anchors (with places) match once each, for alignment."""
    shared = F.array_intersect(F.transform(a, lambda x: x["hash"]), F.transform(b, lambda x: x["hash"]))
    place = lambda found, h: F.get(F.filter(found, lambda x: x["hash"] == h), F.lit(0))["at"]
    return F.transform(shared, lambda h: F.struct(place(a, h).alias("left"), place(b, h).alias("right")))


def with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text, parts, head, next_found, next_whole): each row with its hashes, the beginning of the next document that
    an edit of its last quarter needs, and the next document's marks and all its hashes.

    Only ids are put in order. A text is shuffled once by id; of the next document only the beginning and the
    hashes travel. A text's own are computed again behind the shuffle, which costs less than shuffling them.
    """
    rows = docs.select(F.struct(F.col(key).alias("id")).alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    sizes = docs.groupBy(F.col(key).alias("id")).agg(F.max(F.coalesce(F.length(text), F.lit(0))).alias("n"))
    placed = assign_keys(sizes, ["id"], "place")
    last = placed.agg(F.max("place")).first()[0] or 0
    before = placed.select(
        F.struct("id").alias("previous"), F.floor(F.col("n") / 4).cast("int").alias("need"), (F.col("place") % F.lit(max(last, 1)) + 1).alias("place")
    )
    following = placed.select(F.struct("id").alias("doc"), "place").join(before, "place").drop("place")
    beginnings = rows.join(following, "doc").select(
        F.col("previous").alias("doc"), F.expr("substring(text, 1, need)").alias("head"), parts(F.col("text")).alias("parts")
    )
    nexts = F.struct("head", kept(F.col("parts")).alias("found"), whole(F.col("parts")).alias("whole"))
    firsts = beginnings.select("doc", nexts.alias("next")).groupBy("doc").agg(F.min("next").alias("next"))
    return rows.join(firsts, "doc").select(
        F.col("doc.id").alias(key), "text", parts(F.col("text")).alias("parts"),
        F.col("next.head").alias("head"), F.col("next.found").alias("next_found"), F.col("next.whole").alias("next_whole"),
    )


def edited_fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edit: the last quarter replaced by the beginning of the next text."""
    quarter = F.floor(F.length("text") / 4).cast("int")
    edited = F.concat(F.expr("substring(text, 1, length(text) - _quarter)"), F.expr("substring(head, 1, _quarter)"))
    rows = with_next(docs, key, text).withColumn("_quarter", quarter).withColumn("edited", edited)
    both = rows.withColumn("edited_parts", parts(F.col("edited")))
    of = {"found": kept(F.col("parts")), "whole": whole(F.col("parts"))}
    of |= {"edited_found": kept(F.col("edited_parts")), "edited_whole": whole(F.col("edited_parts"))}
    both = both.withColumns(of)
    return both.select(
        key,
        F.length("text").cast("bigint").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(F.col("found")).alias("fingerprint"),
        fingerprint(F.col("edited_found")).alias("edited_fingerprint"),
        likeness(F.col("found"), F.col("edited_found")).alias("near_edited"),
        likeness(F.col("found"), F.col("next_found")).alias("near_next"),
        likeness(F.col("whole"), F.col("edited_whole")).alias("near_edited_whole"),
        likeness(F.col("whole"), F.col("next_whole")).alias("near_next_whole"),
    )
