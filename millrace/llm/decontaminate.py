"""Benchmark decontamination with one Aho-Corasick automaton over word symbols.

Every word of the normalised benchmark texts becomes one symbol (a code point), every
other word one common symbol. The automaton holds the windows of the items as symbol
strings; each document, mapped to symbols, is scanned once, and hits are word
positions, which are mapped to character offsets of the original text.

Only the benchmark goes to the tasks, in blocks of at most ``BLOCK_BYTES`` of text
(such a block has fewer distinct words than there are code points). A larger
benchmark takes one pass per block over the same rows; nothing is shuffled.

Defined cases: a missing or empty text has no words and no hits; items without words
match nothing; items with fewer words than a window are one window; equal ids are one
item, a missing id reads as an empty one; repeated documents are judged alike.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import ALNUM, words_of

BLOCK_BYTES = 4_000_000
OTHER = "\x00"
WORD = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")
FOUND = "struct<words: bigint, runs: array<struct<first_word: int, end_word: int, start: int, end: int>>, items: array<string>>"
_RUNS = pa.list_(pa.struct([(n, pa.int32()) for n in ("first_word", "end_word", "start", "end")]))
_FOUND = pa.struct([("words", pa.int64()), ("runs", _RUNS), ("items", pa.list_(pa.string()))])


class Windows:
    """The automaton over the windows of some items."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.symbols: dict[bytes, str] = {}
        owners: dict[str, set[str]] = {}
        for item, words in items:
            text = "".join([self._symbol(w) for w in words])
            for i in range(max(len(text) - window + 1, 1) if text else 0):
                owners.setdefault(text[i : i + window], set()).add(item)
        self.automaton = ahocorasick.Automaton()
        for text, of in owners.items():
            self.automaton.add_word(text, (len(text), of))
        if owners:
            self.automaton.make_automaton()

    def _symbol(self, word: bytes) -> str:
        n = len(self.symbols) + 1
        return self.symbols.setdefault(word, chr(n if n < 0xD800 else n + 0x800))

    def find(self, words: list[bytes]) -> tuple[list[list[int]], set[str]]:
        """Maximal word runs inside occurring windows, and the items that occur."""
        runs: list[list[int]] = []
        items: set[str] = set()
        if not len(self.automaton):
            return runs, items
        get = self.symbols.get
        for last, (n, of) in self.automaton.iter("".join([get(w, OTHER) for w in words])):
            items |= of
            _join(runs, last - n + 1, last + 1)
        return runs, items


def _join(runs: list[list[int]], start: int, end: int) -> None:
    """Add an interval that ends last; shorter windows may end together with longer ones."""
    while runs and runs[-1][1] >= start:
        start = min(start, runs.pop()[0])
    runs.append([start, end])


def _merged(a: list[list[int]], b: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for start, end in sorted(a + b):
        if out and out[-1][1] >= start:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def _scan(batches: Iterator[pa.RecordBatch], items, window: int) -> Iterator[pa.RecordBatch]:
    """Batches of (row, text, found) with what these items add to ``found``."""
    windows = Windows([(item, words_of(t)) for item, t in items], window)
    for batch in batches:
        earlier = batch.column(2).to_pylist()
        found = []
        for row, raw in enumerate(batch.column(1).cast(pa.binary()).to_pylist()):
            words = (raw or b"").translate(ALNUM).split()
            runs, names = windows.find(words)
            if earlier[row]:
                runs = _merged([[r["first_word"], r["end_word"]] for r in earlier[row]["runs"]], runs)
                names |= set(earlier[row]["items"])
            at = [m.span() for m in WORD.finditer(raw.decode("utf-8", "replace"))] if runs else []
            spans = [{"first_word": a, "end_word": b, "start": at[a][0], "end": at[b - 1][1]} for a, b in runs]
            found.append({"words": len(words), "runs": spans, "items": sorted(names)})
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, _FOUND)], ["row", "text", "found"])


def _found(
    docs: DataFrame, benchmark: DataFrame, window: int, text: str, keep: list[str], item: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """(row, text, found): the kept columns as one struct, so that no name can clash, and word count, runs of hit words, items."""
    named = benchmark.select(
        F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"), F.coalesce(F.col(item_text), F.lit("")).alias("text")
    )
    total = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // (block_bytes // 2 or 1))) if total > block_bytes else 1
    dealt = named.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(blocks)))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(text).alias("text"), F.lit(None).cast(FOUND).alias("found")
    )
    for block in range(blocks):
        items = [(r["item"], r["text"]) for r in dealt.where(F.col("block") == block).select("item", "text").collect()]
        rows = rows.mapInArrow(lambda batches, items=items: _scan(batches, items, window), rows.schema)
    return rows


def find_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    text: str = "text",
    keep: list[str] | None = None,
    item: str = "item_id",
    item_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The kept columns and ``_found``: word count, runs of hit words with their character offsets, items.

    An input column ``_found`` is replaced.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c != "_found"]
    return _found(docs, benchmark, window, text, keep, item, item_text, block_bytes).select("row.*", F.col("found").alias("_found"))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, n_hit, items, runs, contaminated) of every document."""
    found = _found(docs, benchmark, window, text, [key])
    runs = F.col("found.runs")
    n_hit = F.aggregate(runs, F.lit(0).cast("bigint"), lambda n, r: n + r["end_word"] - r["first_word"])
    return found.select(
        F.col("row")[key].alias(key),
        F.col("found.words").alias("n_words"),
        n_hit.alias("n_hit"),
        F.array_sort("found.items").alias("items"),
        runs.alias("runs"),
        (F.size(runs) > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10, text: str = "text") -> DataFrame:
    """The rows of ``docs`` without any benchmark window, all columns as they were."""
    return _found(docs, benchmark, window, text, docs.columns).where(F.size("found.runs") == 0).select("row.*")


def contamination_sql(window: int = 10) -> str:
    """The digest of ``op7`` in SQL."""
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    words = f"regexp_extract_all(coalesce({lower}, ''), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""
with d as (select doc_id, {words} as w from documents),
i as (select item_id, {words} as w from benchmark),
p as (select item_id, w[s : s + {window} - 1] as ws
  from (select item_id, w, unnest(range(1, greatest(len(w) - {window} + 1, 1) + 1)) as s from i where len(w) > 0)),
q as (select distinct item_id, len(ws) as n, array_to_string(ws, ' ') as phrase from p),
g as (select doc_id, n, s, array_to_string(w[s : s + n - 1], ' ') as phrase
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as s from d, (select distinct n from q) where len(w) >= n)),
h as (select doc_id, item_id, s, n from g join q using (n, phrase)),
c as (select doc_id, count(distinct pos) as n_hit from (select doc_id, unnest(range(s, s + n)) as pos from h) group by doc_id),
m as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct doc_id, item_id::varchar as item from h) group by doc_id)
select d.doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join c using (doc_id) left join m using (doc_id)
"""
