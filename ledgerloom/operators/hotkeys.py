"""Lookups whose keys are skewed: hot keys found by a sketch are joined apart.

A key that a third of all rows share would bring them into one task of a shuffled
join. A frequent-items sketch over the key's hash (``approx_top_k``, mergeable,
one small row a task) names every key above a share of the rows; the few dimension
rows of these keys are broadcast, and only the other rows are shuffled. Rows with a
NULL key match nothing, so they are neither shuffled nor joined.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Keys the sketch reports and counters it holds; a key above 1 / (TRACKED * 0.75) of
#: the rows is always among them.
REPORTED, TRACKED = 256, 4096


def key_hash(cols: Sequence[str | Column]) -> Column:
    return F.xxhash64(*cols)


def _no_null(cols: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])


def hot_hashes(df: DataFrame, keys: Sequence[str], share: float) -> list[int]:
    """Hashes of the keys that at least ``share`` of the rows have, and perhaps some a
    little below it (the sketch never counts too low by more than its error). At most
    1 / share of them matter, and ``REPORTED`` reach the driver."""
    if share * REPORTED < 1:
        raise ValueError(f"a share of {share} may have more than {REPORTED} hot keys")
    rows = df.filter(_no_null(keys)).select(key_hash(keys).alias("_ll_h"))
    row = rows.agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(_ll_h, {REPORTED}, {TRACKED})").alias("top")).first()
    return [t["item"] for t in row["top"] or () if t["count"] >= share * row["n"]]


def mostly_distinct(df: DataFrame, cols: Sequence[str | Column], share: float, least: float = 0.5) -> bool:
    """Whether the rows have about ``least`` times as many different values of ``cols`` as
    there are rows, or more, and no value has ``share`` of them: a DISTINCT before a shuffle
    then saves less than the shuffle it costs. Told from sketches over the values' hash."""
    rows = df.select(key_hash(cols).alias("_ll_h"))
    row = rows.agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("_ll_h").alias("different"),
                   F.expr(f"approx_top_k(_ll_h, {REPORTED}, {TRACKED})").alias("top")).first()
    return row["different"] >= least * row["n"] and not any(t["count"] >= share * row["n"] for t in row["top"] or ())


def split_by_heat(df: DataFrame, keys: Sequence[str], hot: Sequence[int]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows with a NULL key, rows with a hot key, all others)."""
    known, heat = _no_null(keys), key_hash(keys).isin(list(hot))
    return df.filter(~known), df.filter(known & heat), df.filter(known & ~heat)
