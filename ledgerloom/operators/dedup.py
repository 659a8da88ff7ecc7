"""Duplicate removal.

``distinct_rows`` is a plain hash aggregate (partial aggregation on the map
side, so a value repeated in a third of all rows collapses before the shuffle).
``keep_first`` keeps one row per key by a sequence column with a ``min`` over a
struct — also a partial aggregate, so a hot key never lands whole in one task,
unlike a ``row_number`` window that sorts each group in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """SELECT DISTINCT over ``cols`` (all columns by default)."""
    return (df.select(*cols) if cols else df).distinct()


def keep_first(df: DataFrame, key: Sequence[str], seq: str,
               cols: Sequence[str] | None = None) -> DataFrame:
    """One row per ``key``: the one with the smallest ``seq``.

    Ties on ``seq`` fall back to the remaining columns, so the choice is
    deterministic. NULL keys form one group, as pandas ``drop_duplicates`` does.
    Output: ``cols`` (default: all columns but ``seq``) in that order.
    """
    key = list(key)
    out = list(cols) if cols else [c for c in df.columns if c != seq]
    rest = [c for c in out if c not in key]
    best = F.min(F.struct(F.col(seq).alias("_ll_seq"), *[F.col(c) for c in rest])).alias("_ll_best")
    picked = df.groupBy(*key).agg(best)
    return picked.select(*[F.col(c) if c in key else F.col(f"_ll_best.{c}").alias(c) for c in out])
