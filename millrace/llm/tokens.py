"""Token ids of whole texts by a public tokenizer, and their record files.

The tokenizers library is run once for each distinct piece, which for ``by_piece`` is what the
vocabulary itself encodes alone: it drops blanks, puts letters into lower case, and takes runs of letters, single
digits, and runs of other characters. So a text is cut at ASCII blanks, and plain Latin pieces further at
these bounds, of which runs of letters go straight to the library's merges; pieces with an apostrophe (``'s`` and
the like stand together) or beyond Latin go to the library as they are. Tests compare with whole texts, and each
worker a probe; ``by_piece=False`` runs whole texts, for vocabularies of another kind.
Parts met before come from a bounded table of the worker process.

Defined cases: a missing text is empty; an empty one has the end id alone; the strings of special tokens in a text
become their ids, as the library does; a missing key is kept; no rows give no records.
"""

from __future__ import annotations

import json
import os
from array import array
from collections.abc import Iterator
from dataclasses import asdict, dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.records import WRITE_ROWS, FramedRecords, Writer, in_order, read_records
from millrace.session import scratch_dir

KNOWN_PARTS = 500_000
BLOCK_CHARS = 4_000_000
AT_ONCE = 4096
PROBE = "A probe  of\nthe Kind: Größe 1984, naïve,don't"
# Latin letters, digits and signs up to U+024F, but for the apostrophe, blanks, and the letter that has two characters in lower case.
PLAIN = "[!-&(-;=-~\u00a1-\u012f\u0131-\u024f]+"
LATIN = regex.compile(PLAIN)


@dataclass(frozen=True)
class Vocabulary:
    """A file for the tokenizers library, the id that ends each document, and the bytes of an id."""

    path: str
    end_id: int = 1
    width: int = 2
    by_piece: bool = True


class Encoder:
    """Ids by piece, with those of pieces met before kept."""

    def __init__(self, vocabulary: Vocabulary):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a task for each core
        from tokenizers import Tokenizer

        self.vocabulary = vocabulary
        self.tokenizer = Tokenizer.from_file(vocabulary.path)
        if vocabulary.width not in (2, 4):
            raise ValueError("an id has 2 or 4 bytes")
        if max(self.tokenizer.get_vocab_size(with_added_tokens=True) - 1, vocabulary.end_id) >= 1 << 8 * vocabulary.width:
            raise ValueError(f"ids of {vocabulary.path} don't fit into {vocabulary.width} bytes")
        self.kind, self.code = f"<u{vocabulary.width}", "H" if vocabulary.width == 2 else "I"
        self.known: dict[str, bytes] = {}
        if vocabulary.by_piece:
            whole = np.frombuffer(next(self.encoded([PROBE])), self.kind).tolist()
            if np.frombuffer(self.ids(pa.array([PROBE], pa.large_string()))[0], self.kind).tolist() != [*whole, vocabulary.end_id]:
                raise ValueError(f"{vocabulary.path} is of another kind: run it with by_piece=False")

    def encoded(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text as the library gives them."""
        for lo in range(0, len(texts), AT_ONCE):
            for e in self.tokenizer.encode_batch_fast(texts[lo : lo + AT_ONCE], add_special_tokens=False):
                yield np.array(e.ids, self.kind).tobytes()

    def merged(self, words: list[str]) -> Iterator[bytes]:
        """Ids of runs of letters in lower case by the library's merges alone, without its rules for cutting."""
        model, letters, kind = self.tokenizer.model, _byte_letters(), self.code
        for w in words:
            yield array(kind, [t.id for t in model.tokenize(w if w.isascii() else w.translate(letters))]).tobytes()

    def parts(self, texts: list[str]) -> list[bytes]:
        """Ids of each part of a piece."""
        if len(self.known) > KNOWN_PARTS:
            self.known = {}
        known = self.known
        found = list(map(known.get, texts))
        missing = [t for t, ids in zip(texts, found) if ids is None]
        runs = [t for t in missing if t.isalpha() and (t.isascii() or LATIN.fullmatch(t))]
        known.update(zip(runs, self.merged(runs)))
        rest = [t for t in missing if t not in known]
        known.update(zip(rest, self.encoded(rest)))
        fresh = map(known.__getitem__, missing)
        return [next(fresh) if ids is None else ids for ids in found]

    def ids(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text and the end id, as bytes."""
        end = np.array([self.vocabulary.end_id], self.kind)
        if not self.vocabulary.by_piece:
            return [ids + end.tobytes() for ids in self.encoded(texts.to_pylist())]
        split = pc.ascii_split_whitespace(texts)
        words = split.flatten().dictionary_encode()
        plain = pc.match_substring_regex(words.dictionary, f"^{PLAIN}$")
        cut = pc.replace_substring_regex(pc.utf8_lower(words.dictionary), "([^\\p{L}\\p{N}]+|\\p{N})", " \\1 ")
        cut = pc.ascii_split_whitespace(pc.if_else(plain, cut, words.dictionary))
        parts = cut.flatten().dictionary_encode()
        ids = self.parts(parts.dictionary.to_numpy(zero_copy_only=False).tolist())
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // self.vocabulary.width
        flat = np.frombuffer(b"".join(ids), self.kind)
        flat, sizes = _strung(flat, sizes, parts.indices.to_numpy(), cut.offsets.to_numpy())
        flat, sizes = _strung(np.append(flat, end), np.append(sizes, 1), *_ended(words.indices.to_numpy(), split.offsets.to_numpy(), len(sizes)))
        data, out, lo = flat.tobytes(), [], 0
        for hi in (np.cumsum(sizes) * self.vocabulary.width).tolist():
            out.append(data[lo:hi])
            lo = hi
        return out


def _strung(flat: np.ndarray, sizes: np.ndarray, at: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ``flat`` with these sizes strung together as ``at`` names them; the sizes of the strings between the offsets."""
    begins, runs = (np.cumsum(sizes) - sizes)[at], sizes[at]
    stops = np.concatenate([[0], np.cumsum(runs)])
    whole = flat[np.repeat(begins - stops[:-1], runs) + np.arange(stops[-1])]
    return whole, np.diff(stops[offsets])


def _ended(at: np.ndarray, offsets: np.ndarray, last: int) -> tuple[np.ndarray, np.ndarray]:
    """The names with ``last`` after each list."""
    return np.insert(at, offsets[1:], last), offsets + np.arange(len(offsets))


@lru_cache
def _byte_letters() -> dict[int, str]:
    """The letters that stand for the UTF-8 bytes of a Latin letter, by the library's own table."""
    from tokenizers.pre_tokenizers import ByteLevel

    table = ByteLevel(add_prefix_space=False, use_regex=False)
    return {c: table.pre_tokenize_str(chr(c))[0][0] for c in range(0xA1, 0x250)}


@lru_cache(maxsize=2)
def encoder(vocabulary: Vocabulary) -> Encoder:
    """One for each worker process."""
    return Encoder(vocabulary)


def _blocks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Rows of at most about ``BLOCK_CHARS`` together, or one row."""
    sizes = np.cumsum(pc.utf8_length(texts).to_numpy(zero_copy_only=False))
    lo, passed = 0, 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(sizes, passed + BLOCK_CHARS, "right")))
        yield lo, hi
        lo, passed = hi, int(sizes[hi - 1])


class TokenWriter(Writer):
    """Encodes the texts on their way into the files."""

    def __init__(self, path: str, vocabulary: Vocabulary):
        super().__init__(path, vocabulary.width)
        self.vocabulary = vocabulary

    def sequences(self, batch: pa.RecordBatch) -> Iterator[tuple[list, list]]:
        texts = pc.fill_null(batch.column("text").cast(pa.large_string()), "")
        for lo, hi in _blocks(texts):
            ids = encoder(self.vocabulary).ids(texts.slice(lo, hi - lo))
            keys = batch.column("key").slice(lo, hi - lo).to_pylist()
            for at in range(0, len(ids), WRITE_ROWS):
                yield keys[at : at + WRITE_ROWS], ids[at : at + WRITE_ROWS]


class TokenRecords(FramedRecords):
    """The record files as a sink for texts; the vocabulary comes as JSON."""

    @classmethod
    def name(cls) -> str:
        return "token_records"

    def writer(self, schema, overwrite: bool) -> TokenWriter:
        return TokenWriter(self.options["path"], Vocabulary(**json.loads(self.options["vocabulary"])))


def token_records(docs: DataFrame, vocabulary: Vocabulary, path: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode the texts, write record files to ``path`` (the shared scratch folder, if None) and read them back.

    (file, at, key, start, ids): the ids of every whole text with the end id; see ``records``. Texts are sorted before they are
    encoded, as the sampling of the ranges would run the encoder a second time, and encoded by the task that writes them.
    """
    spark = docs.sparkSession
    path = path or scratch_dir(spark, "records")
    spark.dataSource.register(TokenRecords)
    rows = in_order(docs, key, text).select("key", F.col("value").cast("string").alias("text"))
    sink = rows.write.format(TokenRecords.name()).option("vocabulary", json.dumps(asdict(vocabulary)))
    sink.mode("append").save(path)
    return read_records(spark, path)
