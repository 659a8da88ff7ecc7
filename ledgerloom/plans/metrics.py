"""Figures of a table gathered by the job that writes it.

``observed_write`` attaches aggregates to the rows on their way into the files
(``DataFrame.observe``): row count, bytes, NULLs per foreign key and the exact sum of
every decimal column. They cost no further scan, and the observation is the last
step before the write, in its result stage, where Spark counts each task once,
however often it was tried.

A ``Journal`` keeps them beside the tables: a record per table, made after its write
has committed. A run that is built anew on the same folder takes up the tables that
have a record, and the figures with them.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import asdict, dataclass, field
from decimal import Decimal

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import list_names, read_text, write_stored, write_text
from ..operators.buckets import by_bucket, write_bucketed
from ..operators.lookups import row_bytes
from ..schemas import FOREIGN_KEYS

JOURNAL = "_journal"


@dataclass(frozen=True)
class TableMetrics:
    """Rows, bytes, NULLs by foreign key column and sums by decimal column."""
    rows: int
    bytes: int
    nulls: dict[str, int] = field(default_factory=dict)
    sums: dict[str, str | None] = field(default_factory=dict)

    def total(self, column: str) -> Decimal | None:
        value = self.sums[column]
        return None if value is None else Decimal(value)


def observed_write(df: DataFrame, path: str, name: str, bucket: tuple[str, int] | None = None) -> tuple[DataFrame, TableMetrics]:
    """Write table ``name`` as Parquet; the written table and its figures. ``bucket``
    (key, number) stores it by the hash of the key."""
    keys = [fk.column for fk in FOREIGN_KEYS if fk.child == name]
    money = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)]
    seen = Observation(name)
    if bucket is not None:
        df = by_bucket(df, *bucket)
    out = df.observe(
        seen, F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("bytes"),
        *[F.count_if(F.col(k).isNull()).alias(f"null {k}") for k in keys],
        *[F.sum(F.col(c).cast("decimal(38,4)")).cast("string").alias(f"sum {c}") for c in money])
    if bucket is None:
        write_stored(out, path)
        written = df.sparkSession.read.parquet(path)
    else:
        written = write_bucketed(out, path, *bucket, name)
    got = seen.get
    return written, TableMetrics(
        got["rows"], got["bytes"], {k: got[f"null {k}"] for k in keys}, {c: got[f"sum {c}"] for c in money})


class Journal:
    """Records of the tables that are complete in a run folder."""

    def __init__(self, spark: SparkSession, run_dir: str):
        self.spark = spark
        self.folder = f"{run_dir.rstrip('/')}/{JOURNAL}"

    def done(self) -> dict[str, TableMetrics]:
        out = {}
        for file in list_names(self.spark, self.folder):
            text = read_text(self.spark, f"{self.folder}/{file}")
            if text.endswith("\n"):  # else its writer was lost while writing it
                record = json.loads(text)
                name = record.pop("table")
                out[name] = TableMetrics(**record)
        return out

    def record(self, name: str, metrics: TableMetrics) -> None:
        write_text(self.spark, f"{self.folder}/{name}.json", json.dumps({"table": name, **asdict(metrics)}) + "\n", overwrite=True)

    def frame(self) -> DataFrame:
        """(table_name, metric, value): the recorded figures as rows."""
        records = self.spark.read.schema("table string, rows bigint, nulls map<string,bigint>, sums map<string,string>").json(self.folder)
        value = "decimal(38,4)"
        figures = F.concat(
            F.array(F.struct(F.lit("rows").alias("metric"), F.col("rows").cast(value).alias("value"))),
            F.transform(F.map_entries("nulls"), lambda e: F.struct(F.concat(F.lit("null "), e["key"]).alias("metric"), e["value"].cast(value).alias("value"))),
            F.transform(F.map_entries("sums"), lambda e: F.struct(F.concat(F.lit("sum "), e["key"]).alias("metric"), e["value"].cast(value).alias("value"))))
        return records.filter("table is not null").select(F.col("table").alias("table_name"), F.inline(figures))


def metrics_frame(spark: SparkSession, metrics: Mapping[str, TableMetrics]) -> DataFrame:
    """(table_name, metric, value): the figures as rows (a few dozen)."""
    rows = []
    for name, m in metrics.items():
        rows += [(name, "rows", Decimal(m.rows)), *[(name, f"null {k}", Decimal(n)) for k, n in m.nulls.items()],
                 *[(name, f"sum {c}", m.total(c)) for c in m.sums]]
    return spark.createDataFrame(rows, "table_name string, metric string, value decimal(38,4)")
