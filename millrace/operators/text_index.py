"""Inverted text index and matching.

Texts and queries go through one normaliser (``functions.text.terms``): runs of letters
and digits of any length, in lower case, without stop words, stemmed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import distinct_terms, stem, terms, words
from millrace.session import staged

# Common English words that carry no search meaning.
ENGLISH_STOP_WORDS = (
    "and",
    "are",
    "but",
    "for",
    "from",
    "had",
    "has",
    "have",
    "her",
    "his",
    "its",
    "not",
    "that",
    "the",
    "their",
    "they",
    "this",
    "was",
    "were",
    "which",
    "will",
    "with",
    "you",
)


BUCKETS = 64


def postings(df: DataFrame, doc: str, text: str, stop_words: tuple[str, ...] = ()) -> DataFrame:
    """Rows (term, document, occurrences, first position among the terms) over whole texts.

    The index stays in long form: a term of a third of all documents is many
    rows, never one list. The groups are keyed by term and document together,
    so a frequent term spreads over all tasks.
    """
    # The outer form keeps the optimizer from splitting every text a second time.
    placed = df.select(doc, F.posexplode_outer(terms(F.col(text), stop_words)).alias("_pos", "term"))
    return placed.where("term is not null").groupBy("term", doc).agg(
        F.count(F.lit(1)).alias("occurrences"), F.min("_pos").alias("first_pos")
    )


def _occurrences(df: DataFrame, doc: str, text: str, stop_words: tuple[str, ...]) -> DataFrame:
    """(document, position, term) of every word that is not a stop word; positions count all words."""
    placed = df.select(doc, F.posexplode_outer(words(F.col(text))).alias("_pos", "_word")).where("_word is not null")
    kept = placed.where(~F.col("_word").isin(*stop_words)) if stop_words else placed
    return kept.select(doc, "_pos", stem(F.col("_word")).alias("term"))


def document_frequency(df: DataFrame, doc: str, text: str, stop_words: tuple[str, ...] = ()) -> DataFrame:
    """Documents per term. Repeats are dropped within the row, before any shuffle."""
    once = df.select(F.explode_outer(distinct_terms(F.col(text), stop_words)).alias("term"))
    return once.where("term is not null").groupBy("term").agg(F.count(F.lit(1)).alias("documents"))


def _bucket(term):
    return F.pmod(F.xxhash64(term), F.lit(BUCKETS)).cast("int")


def write_index(index: DataFrame, path: str) -> None:
    """Store postings in folders by hash of the term, so a query reads the folders of its terms only.

    The rebalance hint splits the folder of a frequent term over several files.
    """
    dealt = index.withColumn("bucket", _bucket("term")).hint("rebalance", "bucket")
    dealt.sortWithinPartitions("term").write.partitionBy("bucket").parquet(path)


def query_terms(spark: SparkSession, query: str, stop_words: tuple[str, ...] = ()) -> list[str]:
    """The distinct terms of a query."""
    found = spark.range(1).select(F.array_distinct(terms(F.lit(query), stop_words))).first()[0]
    return sorted(found)


def documents_with_all(index: DataFrame, doc: str, query: str, stop_words: tuple[str, ...] = ()) -> DataFrame:
    """Documents that hold all terms of the query, with the occurrences of these terms.

    A query of stop words only finds nothing. On a stored index only the wanted folders are read.
    """
    wanted = query_terms(index.sparkSession, query, stop_words)
    if "bucket" in index.columns and wanted:
        buckets = index.sparkSession.createDataFrame([(w,) for w in wanted], "term string").select(_bucket("term")).distinct()
        index = index.where(F.col("bucket").isin(*[r[0] for r in buckets.collect()]))
    hits = index.where(F.col("term").isin(*wanted) if wanted else F.lit(False)).groupBy(doc)
    found = hits.agg(F.count(F.lit(1)).alias("_terms"), F.sum("occurrences").alias("occurrences"))
    return found.where(F.col("_terms") == len(wanted)).drop("_terms")


# ---------------------------------------------------------------- positions, kept on write
BLOCK = 4096  # words of a text whose positions may share a row


@dataclass(frozen=True)
class IndexFolders:
    """A stored index in plain Parquet folders by document bucket and term bucket.

    A change rewrites the folders of its documents' buckets, a query reads those of its terms' buckets. Choose both numbers
    for the final size.
    """

    path: str
    doc: str
    stop_words: tuple[str, ...] = ()
    doc_buckets: int = 16
    term_buckets: int = 16

    def doc_bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.doc), F.lit(self.doc_buckets)).cast("int")

    def term_bucket(self, term: Column) -> Column:
        return F.pmod(F.xxhash64(term), F.lit(self.term_buckets)).cast("int")


def positions(df: DataFrame, doc: str, text: str, stop_words: tuple[str, ...] = ()) -> DataFrame:
    """Rows (term, document, start, offsets): the positions of a term in ``BLOCK`` words of a text, as distances from the first.

    A term that is frequent in a document has a row for each block, one that is in many documents a row
    for each, so no list grows with the data. The texts are dealt by document, so that only they are shuffled, not their words.
    """
    found = _occurrences(df.select(doc, text).repartition(doc), doc, text, stop_words)
    blocks = found.groupBy("term", doc, F.expr(f"_pos div {BLOCK}").alias("_block")).agg(F.sort_array(F.collect_list("_pos")).alias("_at"))
    start = F.get("_at", F.lit(0))
    return blocks.select("term", doc, start.alias("start"), F.transform("_at", lambda p: (p - start).cast("smallint")).alias("offsets"))


def store_positions(folders: IndexFolders, df: DataFrame, text: str) -> None:
    """Write the index of all documents anew."""
    _write(folders, positions(df, folders.doc, text, folders.stop_words), "overwrite", "static")


def change_positions(folders: IndexFolders, changed: DataFrame, text: str) -> None:
    """Set the given documents' texts in a stored index; a missing text takes its document out.

    Only the buckets of these documents are read and replaced (dynamic partition overwrite). Ids are unique in
    a change; one change at a time.
    """
    spark = changed.sparkSession
    with staged(changed.select(folders.doc, F.col(text).alias("_text"), folders.doc_bucket().alias("doc_bucket")), "index-change") as batch:
        touched = sorted(r[0] for r in batch.select("doc_bucket").distinct().collect())
        if not touched:
            return
        stored = _stored(folders, spark).where(F.col("doc_bucket").isin(touched))
        known = stored.where("term is not null").join(batch.select(folders.doc), folders.doc, "left_anti")
        new = positions(batch, folders.doc, "_text", folders.stop_words)
        columns = ["term", folders.doc, "start", "offsets"]
        # A folder is only replaced where rows are written to it: each touched one gets a row without a term.
        pairs = spark.range(folders.term_buckets).select(F.explode(F.array(*map(F.lit, touched))).alias("doc_bucket"), F.col("id").cast("int").alias("term_bucket"))
        _write(folders, known.select(*columns).unionByName(new.select(*columns)), "overwrite", "dynamic", pairs)


def _write(folders: IndexFolders, rows: DataFrame, mode: str, overwrite: str, pairs: DataFrame | None = None) -> None:
    dealt = rows.withColumns({"doc_bucket": folders.doc_bucket(), "term_bucket": folders.term_bucket(F.col("term"))})
    if pairs is not None:
        dealt = dealt.unionByName(pairs, allowMissingColumns=True)
    dealt = dealt.hint("rebalance", "doc_bucket", "term_bucket").sortWithinPartitions("doc_bucket", "term_bucket", "term")
    dealt.write.mode(mode).option("partitionOverwriteMode", overwrite).partitionBy("doc_bucket", "term_bucket").parquet(folders.path)


def _stored(folders: IndexFolders, spark: SparkSession) -> DataFrame:
    return spark.read.parquet(folders.path)


def stored_positions(folders: IndexFolders, spark: SparkSession) -> DataFrame:
    """The stored rows (term, document, start, offsets, buckets)."""
    return _stored(folders, spark).where("term is not null")


def stored_frequency(folders: IndexFolders, spark: SparkSession) -> DataFrame:
    """Documents per term; a document's first block of a term stands for it."""
    rows = stored_positions(folders, spark).select("term", folders.doc).distinct()
    return rows.groupBy("term").agg(F.count(F.lit(1)).alias("documents"))


def documents_with_phrase(folders: IndexFolders, spark: SparkSession, phrase: str) -> DataFrame:
    """(document, occurrences): where the phrase's terms stand at the same distances as in the phrase.

    Stop words count as places but match any word. Folders of other terms aren't read. Documents that lack a term go before any
    position is looked at; then each place of a term votes for the place where the phrase would begin.
    """
    line = _occurrences(spark.range(1).select(F.lit(0).alias("q"), F.lit(phrase).alias("text")), "q", "text", folders.stop_words)
    wanted = [(r["term"], r["_pos"]) for r in line.collect()]
    if not wanted:
        return stored_positions(folders, spark).where("false").select(folders.doc, F.lit(0).cast("bigint").alias("occurrences"))
    first = min(at for _, at in wanted)
    places: dict[str, list[int]] = {}
    for term, at in wanted:
        places.setdefault(term, []).append(at - first)
    named = spark.createDataFrame([(t,) for t in places], "term string").select(folders.term_bucket(F.col("term")))
    buckets = sorted({r[0] for r in named.collect()})
    rows = stored_positions(folders, spark).where(F.col("term_bucket").isin(buckets) & F.col("term").isin(*places))
    full = rows.groupBy(folders.doc).agg(F.count_distinct("term").alias("_terms")).where(F.col("_terms") == len(places)).select(folders.doc)
    shifts = F.create_map(*[x for t, at in places.items() for x in (F.lit(t), F.array(*map(F.lit, at)))])
    at = rows.join(full, folders.doc, "left_semi").select(folders.doc, "term", "start", F.explode("offsets").alias("_offset"))
    begins = at.select(folders.doc, (F.col("start") + F.col("_offset")).alias("_at"), F.explode(F.element_at(shifts, F.col("term"))).alias("_shift"))
    votes = begins.groupBy(folders.doc, (F.col("_at") - F.col("_shift")).alias("_begin")).agg(F.count(F.lit(1)).alias("_votes"))
    return votes.where(F.col("_votes") == len(wanted)).groupBy(folders.doc).agg(F.count(F.lit(1)).alias("occurrences"))
