"""Text index over whole documents and over film titles with descriptions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import STEM_RULES
from millrace.operators import text_index as ti
from millrace.plans.registry import job
from millrace.plans.roles import Roles
from millrace.session import scratch_dir

_STOP = ti.ENGLISH_STOP_WORDS
_STOP_SQL = ", ".join(f"'{w}'" for w in _STOP)


def _stem_sql(word: str) -> str:
    for pattern, ending in STEM_RULES:
        word = f"regexp_replace({word}, '{pattern}', '\\1{ending}')"
    return word


def _terms_sql(key: str, text: str, table: str) -> str:
    """Every term of every text: all words and numbers, of any length, but for the stop words."""
    return rf"""words as (select {key}, unnest(regexp_extract_all(lower({text}), '[\p{{L}}\p{{N}}]+')) as w from {table}),
    t as (select {key}, {_stem_sql('w')} as term from words where w not in ({_STOP_SQL}))"""


_DOCUMENTS = _terms_sql("doc_id", "text", "documents")
_FILMS = _terms_sql("film_id", "title || ' ' || description", "v_film")


@job(f"with {_DOCUMENTS} select term, count(distinct doc_id) as documents from t group by term")
def text_index(t: Roles) -> DataFrame:
    return ti.document_frequency(t.table("documents"), "doc_id", "text", _STOP)


@job(f"with {_DOCUMENTS} select term, doc_id, count(*) as occurrences from t group by term, doc_id")
def text_postings(t: Roles) -> DataFrame:
    """The index itself in long form."""
    index = ti.postings(t.table("documents"), "doc_id", "text", _STOP)
    return index.select("term", "doc_id", "occurrences")


# "The" is a stop word, "re" is short, and "shing" loses its ending in texts and query alike.
@job(f"""with {_DOCUMENTS} select doc_id, count(*) as occurrences from t
    where term in ('re', 'be') group by doc_id having count(distinct term) = 2""")
def text_match(t: Roles) -> DataFrame:
    return ti.documents_with_all(ti.postings(t.table("documents"), "doc_id", "text", _STOP), "doc_id", "The re, be", _STOP)


def film_texts(t: Roles) -> DataFrame:
    """Title and description of each film as one text."""
    return t.film.select("film_id", F.concat_ws(" ", "title", "description").alias("text"))


@job(f"""with {_FILMS} select film_id, count(*) as occurrences from t
    where term in (select {_stem_sql("'blue'")} union all select '7') group by film_id having count(distinct term) = 2
    union all select film_id, count(*) from t where term = 'brand' group by film_id having count(distinct term) = 1""")
def film_match(t: Roles) -> DataFrame:
    """Two searches of a stored index: words and numbers of titles, and one of descriptions."""
    path = scratch_dir(t.spark, "film-index")
    ti.write_index(ti.postings(film_texts(t), "film_id", "text", _STOP), path)
    stored = t.spark.read.parquet(path)
    found = [ti.documents_with_all(stored, "film_id", query, _STOP) for query in ("the blue 7", "brands")]
    return found[0].unionAll(found[1])


# ---------------------------------------------------------------- positions, kept on write
def _folders(t: Roles) -> ti.IndexFolders:
    return ti.IndexFolders(scratch_dir(t.spark, "positions"), "doc_id", _STOP, doc_buckets=8, term_buckets=8)


_PLACES = rf"""words as (select doc_id, unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+')) as w,
    generate_subscripts(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+'), 1) as i from documents),
    t as (select doc_id, i, {_stem_sql('w')} as term from words where w not in ({_STOP_SQL}))"""


@job(f"""with {_PLACES} select a.doc_id, count(*) as occurrences from t a join t b on b.doc_id = a.doc_id and b.i = a.i + 2
    where a.term = 'thanedble' and b.term = 'anea' group by a.doc_id""")
def text_phrase(t: Roles) -> DataFrame:
    """Documents where two words stand around a third one: a stop word of the phrase holds its place only."""
    folders = _folders(t)
    ti.store_positions(folders, t.table("documents"), "text")
    return ti.documents_with_phrase(folders, t.spark, "Thanedble the anea")


@job(f"""with changed as (select d.doc_id, case when toxic = 1 then null else lang || ' ' || source || ' ' || lang end as text
    from documents d join labels using (doc_id)),
    now as (select doc_id, text from changed union all select doc_id, text from documents
    where doc_id not in (select doc_id from labels)),
    {_terms_sql("doc_id", "text", "now")} select term, count(distinct doc_id) as documents from t group by term""")
def text_index_update(t: Roles) -> DataFrame:
    """The stored index after a change: the labelled documents get other texts, the toxic ones go."""
    folders, docs = _folders(t), t.table("documents")
    ti.store_positions(folders, docs, "text")
    changed = docs.join(t.table("labels"), "doc_id").select(
        "doc_id", F.when(F.col("toxic") == 1, F.lit(None)).otherwise(F.concat_ws(" ", "lang", "source", "lang")).alias("text")
    )
    ti.change_positions(folders, changed, "text")
    return ti.stored_frequency(folders, t.spark)
