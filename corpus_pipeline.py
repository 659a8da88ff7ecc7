"""Corpus pipeline: language ID, near-dedup, decontamination, secrets, packing.

Every stage takes (spark, docs, sf_dir) and all rows that the stage before kept.
All but the last return the columns of ``documents``; the last returns the packed
sequences. ``run`` applies them to ``documents``, writing each result as Parquet
under ``spark.checkpoint.dir`` and reading it again.

* language_id drops documents without a letter, or that no language fits;
* minhash_near_dedup keeps one document of each group (5-word shingles, 0.8);
* benchmark_decontamination cuts passages of the benchmark from the text and
  drops a document that consists of them for more than half;
* secret_scan replaces every secret in the text by ``<SECRET>``;
* packing deals the texts' token sequences into length buckets and batches.

``n_chars`` follows the text where a stage changes it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import Scratch, docs_of, importable, table_of
from ledgerloom.llm.decontam import decontaminate
from ledgerloom.llm.langid import accept
from ledgerloom.llm.minhash import keep_one
from ledgerloom.llm.packing import pack
from ledgerloom.llm.secret_scan import redact


def _with_size(docs: DataFrame) -> DataFrame:
    """``n_chars``, where the table has it, as the length of the text."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    size = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast(kind))
    return docs.withColumn("n_chars", size)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return accept(docs)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return keep_one(docs, shingle_words=5, percent=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _with_size(decontaminate(docs, table_of(spark, sf_dir, "benchmark")))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _with_size(redact(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("minhash_near_dedup", minhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scan", secret_scan),
    ("packing", packing),
]

#: Language scores, sketches and the packing programme are no SQL; tests/llm
#: holds the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = docs_of(spark, sf_dir)
    scratch = Scratch(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = scratch.table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
