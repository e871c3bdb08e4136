"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point and a seed.
A trigram binds its letters' vectors, each rotated by its place in the trigram, by
multiplication; a document bundles (sums) its trigrams' vectors; a language's
prototype bundles the unit vectors of its documents. A document gets the language
whose prototype has the largest cosine.

Trigrams run over the letters of lower-cased words with a blank at either end and never
span two words. A document is its distinct trigrams times their counts, so bundling
is a matrix product over blocks of documents.

Prototypes are learned from at most ``train_docs`` documents per language, drawn by a
seeded hash; every document is predicted from its whole text. Prototypes are sums of
whole numbers, so they do not depend on partitioning.

Defined cases: a missing text or one without a letter is ``und`` with score 0, as is
everything where nothing can be learned; rows without a language, or that
``may_learn`` leaves out, are not learned from; equal cosines go to the
first language by name; texts are read in pieces of a million characters, and a word cut
there counts as two.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from millrace.llm.common import beside
from millrace.session import written

UNKNOWN = "und"
SCALE = 1 << 20  # unit vectors are bundled as whole numbers of this size
PIECE = 1_000_000
BLOCK_CHARS = 2_000_000
BLOCK_CELLS = 4_000_000


@dataclass(frozen=True)
class Profiles:
    dimensions: int = 1024
    seed: int = 11
    train_docs: int = 2000  # per language
    max_languages: int = 1000  # prototypes go to every task


@lru_cache(maxsize=1 << 16)
def _letter(code: int, profiles: Profiles) -> np.ndarray:
    bits = np.random.Generator(np.random.Philox(key=[profiles.seed, code])).integers(0, 2, profiles.dimensions, dtype=np.int8)
    return bits * 2 - 1


def _trigram_vectors(codes: np.ndarray, profiles: Profiles) -> np.ndarray:
    """Bound vectors of trigrams given as rows of three code points."""
    known, at = np.unique(codes, return_inverse=True)
    letters = np.stack([_letter(int(c), profiles) for c in known])
    at = at.reshape(codes.shape)
    bound = np.roll(letters, 2, axis=1)[at[:, 0]] * np.roll(letters, 1, axis=1)[at[:, 1]]
    return bound * letters[at[:, 2]]


def _pieces(texts: list[str | None]) -> Iterator[tuple[list[int], list[str]]]:
    """Blocks of (document, piece)."""
    owners, pieces, size = [], [], 0
    for doc, text in enumerate(texts):
        text = text or ""
        start, end = 0, 0
        while start < len(text):
            start, end = end, min(end + PIECE, len(text))
            while 0 < end < len(text) and text[end - 1].isalpha() and text[end].isalpha():
                end += 1  # a word is never cut
            piece = text[start:end].lower()
            if owners and (size + len(piece) > BLOCK_CHARS or len(owners) >= 512):
                yield owners, pieces
                owners, pieces, size = [], [], 0
            owners.append(doc)
            pieces.append(piece)
            size += len(piece)
    if owners:
        yield owners, pieces


def _trigrams(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(row, code points) of every trigram of the pieces."""
    # A line break ends each piece, as no letter does.
    codes = np.frombuffer(("\n" + "\n".join(pieces) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    row = np.repeat(np.arange(len(pieces)), [len(p) + 1 for p in pieces])
    known, at = np.unique(codes, return_inverse=True) if len(codes) < 4096 else _ranked(codes)
    letter = np.array([chr(c).isalpha() for c in known])[at]
    gap = np.where(letter, codes, 0x20)
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first blank behind a word
    keep[0] = True
    gap, row = gap[keep], np.concatenate([[0], row])[: len(keep)][keep]
    middle = np.flatnonzero(gap[1:-1] != 0x20) + 1
    return row[middle], np.stack([gap[middle - 1], gap[middle], gap[middle + 1]], axis=1)


def _ranked(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """np.unique with inverse by a table, as code points are few."""
    seen = np.zeros(0x110000, bool)
    seen[codes] = True
    known = np.flatnonzero(seen)
    place = np.zeros(0x110000, np.int32)
    place[known] = np.arange(len(known))
    return known, place[codes]


def document_vectors(texts: list[str | None], profiles: Profiles) -> np.ndarray:
    """The bundled vector of each text; zeros where it has no letter."""
    out = np.zeros((len(texts), profiles.dimensions), np.float32)
    for owners, pieces in _pieces(texts):
        row, grams = _trigrams(pieces)
        if not len(row):
            continue
        _, at = _ranked(grams.ravel())
        at = at.reshape(grams.shape).astype(np.int64)
        width = int(at.max()) + 1
        gram_code = (at[:, 0] * width + at[:, 1]) * width + at[:, 2]
        if width**3 <= 1 << 21:
            first = np.full(width**3, -1, np.int64)
            first[gram_code] = np.arange(len(gram_code))
            present = np.flatnonzero(first >= 0)
            place = np.zeros(width**3, np.int64)
            place[present] = np.arange(len(present))
            gram, example = place[gram_code], first[present]
        else:
            _, example, gram = np.unique(gram_code, return_index=True, return_inverse=True)
        n = len(example)
        rows = len(pieces)
        order = np.argsort(gram, kind="stable") if n > BLOCK_CELLS // rows else None
        for lo in range(0, n, max(1, BLOCK_CELLS // rows)):
            hi = min(n, lo + max(1, BLOCK_CELLS // rows))
            if order is None:
                mine = slice(None)
            else:
                mine = order[np.searchsorted(gram, lo, sorter=order) : np.searchsorted(gram, hi, sorter=order)]
            cell = row[mine] * (hi - lo) + (gram[mine] - lo)
            counts = np.bincount(cell, minlength=rows * (hi - lo)).reshape(rows, hi - lo).astype(np.float32)
            vectors = _trigram_vectors(grams[example[lo:hi]], profiles).astype(np.float32)
            np.add.at(out, owners, counts @ vectors)
    return out


def _units(vectors: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, norms, out=np.zeros_like(vectors), where=norms > 0)


def _bundles(batches: Iterator[pa.RecordBatch], profiles: Profiles) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs = np.array(batch.column("lang").to_pylist(), object)
        if not len(langs):
            continue
        units = np.rint(_units(document_vectors(batch.column("text").to_pylist(), profiles)) * SCALE).astype(np.int64)
        names = sorted(set(langs))
        sums = [units[langs == name].sum(axis=0) for name in names]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(sums, pa.list_(pa.int64()))], ["lang", "bundle"])


def _sample(labelled: DataFrame, profiles: Profiles) -> DataFrame:
    """At most ``train_docs`` keys per language, by a seeded hash."""
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(profiles.seed), "key"), 11) / F.lit(float(1 << 53))
    keys = labelled.select("key", "lang").withColumn("draw", draw)
    counts = keys.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(profiles.max_languages + 1).collect()
    if not counts or len(counts) > profiles.max_languages:
        if counts:
            raise ValueError(f"more than {profiles.max_languages} languages to learn")
        return labelled.select("key").limit(0)
    # The share of each language that is drawn: a few more than wanted, so the exact cut sorts a bounded number of rows.
    share = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], (1.3 * profiles.train_docs + 50) / r["n"])])
    near = keys.where(F.col("draw") < F.element_at(share, F.col("lang")))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "key"))
    return near.withColumn("rank", rank).where(F.col("rank") <= profiles.train_docs).select("key").distinct()


def learn_prototypes(docs: DataFrame, profiles: Profiles, may_learn: Column, key: str, text: str, lang: str) -> dict[str, np.ndarray]:
    """Unit prototype of each language."""
    labelled = docs.where(may_learn & F.col(lang).isNotNull()).select(
        F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")
    )
    # At most train_docs keys for each of max_languages: the texts are not shuffled for a few of them.
    sample = beside(written(_sample(labelled, profiles), "language-sample"))
    chosen = labelled.join(sample, "key", "left_semi").select("lang", "text")
    parts = chosen.mapInArrow(lambda batches: _bundles(batches, profiles), "lang string, bundle array<bigint>")
    sums = parts.select("lang", F.posexplode("bundle").alias("at", "x")).groupBy("lang", "at").agg(F.sum("x").alias("x"))
    vectors: dict[str, np.ndarray] = {}
    for r in sums.collect():  # at most max_languages times dimensions numbers
        vectors.setdefault(r["lang"], np.zeros(profiles.dimensions))[r["at"]] = r["x"]
    return {name: v / np.linalg.norm(v) for name, v in sorted(vectors.items()) if v.any()}


def predict(texts: list[str | None], prototypes: dict[str, np.ndarray], profiles: Profiles) -> tuple[list[str], list[float]]:
    vectors = document_vectors(texts, profiles)
    names = list(prototypes)
    if not names or not len(texts):
        return [UNKNOWN] * len(texts), [0.0] * len(texts)
    cosines = _units(vectors).astype(np.float64) @ np.stack([prototypes[n] for n in names]).T
    # Rounded, so that equal texts in different blocks get equal scores.
    cosines = np.round(np.clip(cosines, 0, 1), 5)
    best, known = cosines.argmax(axis=1), vectors.any(axis=1)
    langs = [names[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
    return langs, [float(c[b]) if k else 0.0 for c, b, k in zip(cosines, best, known, strict=True)]


def _identified(docs: DataFrame, profiles: Profiles, may_learn: Column, key: str, text: str, lang: str, keep: list[str]) -> DataFrame:
    """(row, lang_pred, score): the kept columns as one struct, so that no name can clash."""
    prototypes = learn_prototypes(docs, profiles, may_learn, key, text, lang)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(text).alias("text"))

    def guess(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = predict(batch.column(1).to_pylist(), prototypes, profiles)
            columns = [batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["row", "lang_pred", "score"])

    schema = T.StructType([rows.schema["row"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(guess, schema)


def identify(
    docs: DataFrame, profiles: Profiles, may_learn: Column, key: str = "doc_id", text: str = "text", lang: str = "lang", keep: list[str] | None = None
) -> DataFrame:
    """The kept columns (default: all) with ``lang_pred`` and ``score``; input columns of these names are replaced."""
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("lang_pred", "score")]
    return _identified(docs, profiles, may_learn, key, text, lang, keep).select("row.*", "lang_pred", "score")


def keep_identified(
    docs: DataFrame, profiles: Profiles, may_learn: Column, min_score: float, scored_bytes: int, key: str = "doc_id", text: str = "text", lang: str = "lang"
) -> DataFrame:
    """The rows of ``docs`` in a known language, all columns as they were.

    Texts without letters go, and texts of ``scored_bytes`` or more with a cosine below ``min_score``.
    """
    found = _identified(docs, profiles, may_learn, key, text, lang, docs.columns)
    junk = (F.col("score") < min_score) & (F.octet_length(F.col("row")[text]) >= scored_bytes)
    return found.where((F.col("lang_pred") != UNKNOWN) & ~junk).select("row.*")
