"""The registered queries ``opN_<name>`` over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import docs_of, table_of


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .langid import identify
    return identify(docs_of(spark, sf_dir))


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .minhash import near_duplicates
    return near_duplicates(docs_of(spark, sf_dir))


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontam import contamination
    return contamination(docs_of(spark, sf_dir), table_of(spark, sf_dir, "benchmark"))


def op7_length_bucket_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack
    return pack(docs_of(spark, sf_dir))


def op8_pstable_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .embed_dedup import near_embeddings
    return near_embeddings(table_of(spark, sf_dir, "embeddings"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secret_scan import secret_spans
    return secret_spans(docs_of(spark, sf_dir))


def op4_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii_crf import personal_data
    return personal_data(docs_of(spark, sf_dir))


def op5_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import archive_round_trip
    return archive_round_trip(table_of(spark, sf_dir, "pages"))


def op9_paragraph_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substring_dedup import repeated_passages
    return repeated_passages(docs_of(spark, sf_dir))


def op10_co_trained_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import classify
    return classify(docs_of(spark, sf_dir), table_of(spark, sf_dir, "labels"))


def op11_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .prefix_trie import rebuilt_trie
    return rebuilt_trie(table_of(spark, sf_dir, "conversations")).drop("prefix")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of every seventh vec_id are moved on by one first."""
    from .hard_negatives import hard_negatives
    rows = table_of(spark, sf_dir, "embeddings").select("vec_id", F.col("label").try_cast("long").alias("label"), "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved))


def op13_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix
    size, copies = F.col("mix_size"), F.col("mix_copies")
    return mix(docs_of(spark, sf_dir)).select(
        "doc_id", size.alias("size"), F.col("mix_source_size").alias("source_size"), F.col("mix_target").alias("target"),
        (size * copies).alias("taken"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_minhash_near_dedup": op2_minhash_near_dedup,
    "op6_benchmark_decontamination": op6_benchmark_decontamination,
    "op3_secret_scan": op3_secret_scan,
    "op4_pii_crf": op4_pii_crf,
    "op5_warc_round_trip": op5_warc_round_trip,
    "op7_length_bucket_packing": op7_length_bucket_packing,
    "op8_pstable_embedding_dedup": op8_pstable_embedding_dedup,
    "op9_paragraph_substring_dedup": op9_paragraph_substring_dedup,
    "op10_co_trained_quality": op10_co_trained_quality,
    "op11_conversation_prefix_trie": op11_conversation_prefix_trie,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_source_mixing": op13_source_mixing,
}
