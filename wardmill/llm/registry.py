"""The registered queries of this subpackage, one for each operator, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from wardmill.llm import (
    byte_bpe,
    centroids,
    conversation_trie,
    decontamination,
    language_id,
    license_scan,
    line_dedup,
    mixing,
    near_duplicates,
    quality_rules,
    sharding,
    sql,
    substring_dedup,
    warc,
)
from wardmill.llm.common import digest, table
from wardmill.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def op1_line_dedup(spark: SparkSession, root: str) -> DataFrame:
    kept = line_dedup.without_repeats(table(spark, root, "documents"))
    return kept.select("row.doc_id", "n_lines", "n_removed", digest(F.col("kept_text")).alias("kept_sha256"))


def op2_quality_rules(spark: SparkSession, root: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, root, "documents"), table(spark, root, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule"
    )


def op3_substring_dedup(spark: SparkSession, root: str) -> DataFrame:
    kept = substring_dedup.without_repeats(table(spark, root, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", digest(F.col("kept_text")).alias("kept_sha256"))


SHARDS = 40


def op4_sharding(spark: SparkSession, root: str) -> DataFrame:
    placed = sharding.shard(table(spark, root, "documents"), SHARDS, scratch_path(spark, "shard-map"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "vslot",
        "map_version",
    )


def tokenizer_path() -> str:
    """The rank file of the public tokenizer that the queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def op5_digest(coded: DataFrame) -> DataFrame:
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        digest(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("ids_sha256"),
        digest(F.col("decoded")).alias("decoded_sha256"),
    )


def op5_byte_bpe(spark: SparkSession, root: str) -> DataFrame:
    return op5_digest(byte_bpe.encode(table(spark, root, "documents"), tokenizer_path(), decoded=True))


def op6_minhash_near_dedup(spark: SparkSession, root: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, root, "documents"))


def op7_license_scan(spark: SparkSession, root: str) -> DataFrame:
    found = license_scan.scan(table(spark, root, "documents"))
    places = F.col("base.word")
    labels = F.array_distinct(F.concat("base.label", "detections.label"))
    sure = F.greatest(F.array_max("detections.confidence"), F.when(F.size("base") > 0, F.lit(0.5)), F.lit(0.0))
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(places).alias("first_word"),
        F.array_max(places).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct("base.label")), ",").alias("base_labels"),
        F.array_join(F.array_sort(labels), ",").alias("labels"),
        sure.alias("score"),
    )


def op8_decontamination(spark: SparkSession, root: str) -> DataFrame:
    found = decontamination.contamination(table(spark, root, "documents"), table(spark, root, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        digest(F.array_join("items", ",")).alias("items_sha256"),
        "contaminated",
    )


def op9_warc(spark: SparkSession, root: str) -> DataFrame:
    archive = warc.write(table(spark, root, "pages"), scratch_path(spark, "warc"))
    return warc.read(spark, archive).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_language_id(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents")
    predicted = language_id.predict(docs, language_id.learn_from(docs))
    return predicted.select("row.doc_id", language_id.held_out("row.doc_id").alias("held_out"), "lang_pred", "score")


def op11_conversation_trie(spark: SparkSession, root: str) -> DataFrame:
    return conversation_trie.prefix_trie(table(spark, root, "conversations"))


def op12_centroid_clustering(spark: SparkSession, root: str) -> DataFrame:
    return centroids.with_inertia(*centroids.cluster(table(spark, root, "embeddings")))


def op13_source_mixing(spark: SparkSession, root: str) -> DataFrame:
    mixed = mixing.mix(table(spark, root, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


QUERIES: dict[str, Query] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_quality_rules": op2_quality_rules,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_sharding": op4_sharding,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_minhash_near_dedup": op6_minhash_near_dedup,
    "op7_license_scan": op7_license_scan,
    "op8_decontamination": op8_decontamination,
    "op9_warc": op9_warc,
    "op10_language_id": op10_language_id,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_centroid_clustering": op12_centroid_clustering,
    "op13_source_mixing": op13_source_mixing,
}

OP1_SQL = r"""
WITH line AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS no
  FROM documents
), full_line AS (
  SELECT doc_id, no, line, row_number() OVER (PARTITION BY doc_id ORDER BY no) AS k
  FROM line WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), run AS (
  SELECT doc_id, k, line AS a, lead(line) OVER d AS b, lead(line, 2) OVER d AS c
  FROM full_line WINDOW d AS (PARTITION BY doc_id ORDER BY k)
), later AS (
  SELECT doc_id, k FROM run WHERE c IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, k) > 1
), gone AS (
  SELECT DISTINCT doc_id, k + i AS k FROM later, (VALUES (0), (1), (2)) AS v(i)
), marked AS (
  SELECT l.doc_id, l.no, l.line, f.k, g.k AS gone
  FROM line l LEFT JOIN full_line f ON f.doc_id = l.doc_id AND f.no = l.no
  LEFT JOIN gone g ON g.doc_id = f.doc_id AND g.k = f.k
)
SELECT doc_id, count(k) AS n_lines, count(gone) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (gone IS NULL), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

ORACLES: dict[str, str] = {
    "op1_line_dedup": OP1_SQL,
    "op11_conversation_trie": sql.TRIE,
    "op12_centroid_clustering": sql.CLUSTER,
}
