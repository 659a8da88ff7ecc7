"""Surrogate keys that stay the same from load to load.

A ``KeyMap`` keeps every natural key that was ever numbered with its surrogate key,
a folder of Parquet files for each load. A later load looks its rows up there, and
only the rows it has not seen are numbered, from the largest key on. Keys are never
reused, also when a row is gone and comes back.

A load claims its number by a file created only if absent, so two loads cannot
number the same keys; the new keys are written, and read back, before a table uses them.
A load that was lost between its claim and its write leaves an open claim, which
``release`` gives up.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import list_names, path_exists, remove_path, stage_path, write_stored, write_text
from .keys import dense_key


class OpenClaim(RuntimeError):
    """Another load is numbering, or was lost while it did."""


class KeyMap:
    """The keys of one table under ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _loads(self) -> list[str]:
        return [n.removesuffix(".claim") for n in list_names(self.spark, f"{self.path}/_claims")]

    def _complete(self, load: str) -> bool:
        return path_exists(self.spark, f"{self.path}/{load}/_SUCCESS")

    def known(self, schema) -> DataFrame | None:
        """All keys so far, with columns and types of ``schema``."""
        paths = [f"{self.path}/{n}" for n in self._loads() if self._complete(n)]
        return self.spark.read.schema(schema).parquet(*paths) if paths else None

    def release(self) -> list[str]:
        """Give up the claims of loads that were lost; call it only when none is at
        work. Returns them."""
        lost = [n for n in self._loads() if not self._complete(n)]
        for n in lost:
            remove_path(self.spark, f"{self.path}/{n}")
            remove_path(self.spark, f"{self.path}/_claims/{n}.claim")
        return lost

    def number(self, df: DataFrame, order_by: Sequence[str], key_col: str,
               num_partitions: int | None = None, stage_dir: str | None = None,
               repeated: Sequence[str] = ()) -> DataFrame:
        """The distinct rows ``df`` with ``key_col``. NULLs in a natural key are equal,
        as in DISTINCT. Rows and keys are stacked and grouped by all columns in one
        shuffle, which makes the rows distinct as well; no row of a dimension or fact is
        ever sent to all tasks. They meet the keys once: the asked rows are staged with
        what was found, and only those without a key are numbered and written to the
        map. ``repeated`` is handed to ``dense_key``."""
        natural = list(df.columns)
        loads = self._loads()
        if loads and not self._complete(loads[-1]):
            raise OpenClaim(f"{self.path}: load {loads[-1]} has not finished")
        load = f"load-{len(loads) + 1:08d}"
        schema = f"{key_col} bigint, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
        known = self.known(schema)
        if not write_text(self.spark, f"{self.path}/_claims/{load}.claim", load + "\n"):
            raise OpenClaim(f"{self.path}: load {load} was claimed by another one")
        fresh, start, met = df, 1, None
        if known is not None:
            path = f"{stage_dir.rstrip('/')}/met-{uuid.uuid4().hex}" if stage_dir else stage_path(self.spark, "met")
            asked = df.select(F.lit(None).cast("bigint").alias("_ll_key"), *natural, F.lit(True).alias("_ll_asked"))
            both = asked.unionByName(known.select(F.col(key_col).alias("_ll_key"), *natural, F.lit(False).alias("_ll_asked")))
            found = both.groupBy(*natural).agg(F.max("_ll_key").alias(key_col), F.max("_ll_asked").alias("_ll_asked"))
            write_stored(found.filter("_ll_asked").select(key_col, *natural), path)
            met = self.spark.read.schema(schema).parquet(path)
            fresh, repeated = met.filter(F.col(key_col).isNull()).select(*natural), ()
            start = (known.agg(F.max(key_col)).first()[0] or 0) + 1
        numbered = dense_key(fresh, order_by, key_col, num_partitions, start=start, stage_dir=stage_dir, repeated=repeated)
        write_stored(numbered.select(key_col, *natural), f"{self.path}/{load}")
        new = self.spark.read.schema(schema).parquet(f"{self.path}/{load}")
        return new if met is None else met.filter(F.col(key_col).isNotNull()).unionByName(new)
