"""The registered queries: each operator on its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.chat import Budget, chat_windows, digest_sql, window_digests, with_probe
from millrace.llm.common import table
from millrace.llm.decontaminate import contamination, contamination_sql
from millrace.llm.fingerprints import edited_fingerprints
from millrace.llm.language import Profiles, identify
from millrace.llm.licenses import scan_licenses
from millrace.llm.line_dedup import Similar, dedup_lines, line_sql
from millrace.llm.mixing import Mix, mix_sources, mix_sql
from millrace.llm.near_dup import AT_85, near_groups, near_sql
from millrace.llm.repeats import remove_repeats, repeats_sql
from millrace.llm.sharding import assign_shards
from millrace.llm.tokens import Vocabulary, token_records
from millrace.llm.walsh import Clusters, cluster, cluster_sql
from millrace.llm.whitening import whiten
from millrace.session import configure

MIX = Mix(
    weights={"domain": {"crawl": 3, "curated": 7}, "lang": {"en": 6, "de": 2, "fr": 2, "es": 2}},
    share_percent=80,
    max_epochs=3,
    seed=23,
)


PROFILES = Profiles(dimensions=1024, seed=11, train_docs=2000)


def held_out(key: str = "doc_id"):
    """Documents that language profiles may not be learned from."""
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(3)) == 1


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(configure(spark), folder, "documents").select("doc_id", "text", "lang")
    found = identify(docs, PROFILES, ~held_out(), keep=["doc_id"])
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


CHAT = Budget(tokens=512, history_tokens=128, history_turns=4, segment_turns=4096)


def op2_chat_windows(spark: SparkSession, folder: str) -> DataFrame:
    return window_digests(chat_windows(with_probe(table(configure(spark), folder, "conversations")), CHAT))


def op3_repeated_bytes(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(table(configure(spark), folder, "documents"), length=100).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


def op4_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = scan_licenses(table(configure(spark), folder, "documents"))
    base = F.filter("detections", lambda d: d["base"])
    starts = F.transform(base, lambda d: d["first_word"])
    labels = lambda hits: F.array_join(F.array_sort(F.array_distinct(F.transform(hits, lambda d: d["label"]))), ",")
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("detections")).alias("labels"),
        F.coalesce(F.array_max(F.transform("detections", lambda d: d["confidence"])), F.lit(0.0)).alias("score"),
        F.size("detections").cast("bigint").alias("n_detections"),
    )


def op5_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_groups(table(configure(spark), folder, "documents"), AT_85)


def op6_syncmer_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return edited_fingerprints(table(configure(spark), folder, "documents"))


def op7_benchmark_contamination(spark: SparkSession, folder: str) -> DataFrame:
    docs, benchmark = (table(configure(spark), folder, name) for name in ("documents", "benchmark"))
    return contamination(docs, benchmark, window=10).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


LINES = Similar(percent=80, width=5)


def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = dedup_lines(table(configure(spark), folder, "documents"), LINES)
    return found.select("doc_id", "n_lines", "n_removed", "n_links", F.sha2("kept", 256).alias("kept_sha256"))


def op9_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mix_sources(table(configure(spark), folder, "documents"), MIX)


def op10_stratified_shards(spark: SparkSession, folder: str) -> DataFrame:
    shards = assign_shards(table(configure(spark), folder, "documents"), shards=40)
    return shards.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


# Ids below 49,408 fit into two bytes.
WORD_BPE = "word_bpe_49k.json"


def op11_token_records(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    vocabulary = Vocabulary(public_tokenizers.path(WORD_BPE), end_id=1, width=2)
    found = token_records(table(configure(spark), folder, "documents"), vocabulary)
    n_tokens = (F.octet_length("ids") / 4).cast("bigint")
    return found.select(F.col("key").alias("doc_id"), "start", n_tokens.alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


CLUSTERS = Clusters(count=8, rounds=10, scale=1024, seed="3", dims=64)


def op12_walsh_clusters(spark: SparkSession, folder: str) -> DataFrame:
    found = cluster(table(configure(spark), folder, "embeddings"), CLUSTERS)
    return found.select(*found.columns[:-1], F.sha2("centroid", 256).alias("centroid_sha256"))


def op13_exact_whitening(spark: SparkSession, folder: str) -> DataFrame:
    found = whiten(table(configure(spark), folder, "embeddings"), components=4, scale=256)
    return found.withColumn("deviation", F.col("deviation").cast("bigint"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_language_id,
        op2_chat_windows,
        op3_repeated_bytes,
        op4_license_scan,
        op5_near_duplicates,
        op6_syncmer_fingerprints,
        op7_benchmark_contamination,
        op8_line_dedup,
        op9_source_mix,
        op10_stratified_shards,
        op11_token_records,
        op12_walsh_clusters,
        op13_exact_whitening,
    )
}
ORACLES: dict[str, str] = {
    "op2_chat_windows": digest_sql(CHAT),
    "op3_repeated_bytes": repeats_sql(100),
    "op5_near_duplicates": near_sql(AT_85),
    "op7_benchmark_contamination": contamination_sql(10),
    "op8_line_dedup": line_sql(LINES),
    "op9_source_mix": mix_sql(MIX),
    "op12_walsh_clusters": cluster_sql(CLUSTERS),
}
