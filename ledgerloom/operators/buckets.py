"""Tables that are stored by the hash of their join key.

Two tables bucketed alike by one key are joined, and grouped by it, where they lie:
no row is shuffled. A bucket is one task's work, though, and a key that holds a
large part of the rows can't be split as in a shuffled join; ``even`` tells from the
written files whether a table's buckets are of like size, so that a skewed one can be
read as plain files instead.

Buckets are a property of the table, not of its files, so they are used through the
session's catalog: ``write_bucketed`` creates an external table over the given folder,
and ``register_bucketed`` names the folder in a later session without touching it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import STORED, shuffles_freed


def table_name(purpose: str) -> str:
    return f"ledgerloom_{purpose}_{uuid.uuid4().hex}"


def by_bucket(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """Rows dealt as the buckets will be, so that each task writes one file."""
    return df.repartition(buckets, key)


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int, purpose: str) -> DataFrame:
    """Write ``df``, dealt by ``by_bucket``, as a bucketed table at ``path``, sorted by
    the key inside buckets; the table as read back."""
    name = table_name(purpose)
    with shuffles_freed(df.sparkSession):
        df.write.mode("overwrite").format("parquet").options(**STORED).bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def register_bucketed(spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int, purpose: str) -> DataFrame:
    """The bucketed table that an earlier session wrote at ``path``."""
    name = table_name(purpose)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
              f"INTO {int(buckets)} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def even(table: DataFrame, buckets: int, most: float = 4.0) -> bool:
    """Whether no bucket of ``table`` has more than ``most`` times its share of the rows
    (a table of few rows a bucket always is). Rows are counted by the bucket in their
    file's name; no column is read."""
    bucket = F.regexp_extract("_metadata.file_name", r"_(\d+)\.c\d+", 1)
    sizes = table.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    row = sizes.agg(F.max("n").alias("most"), F.sum("n").alias("all")).first()
    return not row["all"] or row["most"] <= max(most * row["all"] / buckets, 1_000_000)
