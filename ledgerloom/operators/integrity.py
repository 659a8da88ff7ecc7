"""Key-integrity operators: duplicate keys and foreign-key orphans.

All aggregate per key value first (partial aggregation before the shuffle),
so a key that holds a third of all rows costs one row per map task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their row count."""
    return (df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows"))
            .filter(F.col("rows") > 1))


def duplicate_key_count(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: number of key values that occur more than once."""
    return duplicate_keys(df, key).agg(F.count(F.lit(1)).cast("bigint").alias("duplicate_keys"))


def orphan_rows(child: DataFrame, fk: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose non-NULL ``fk`` has no parent (LEFT ANTI JOIN)."""
    keys = parent.select(F.col(parent_key).alias("_ll_pk"))
    return child.filter(F.col(fk).isNotNull()).join(keys, F.col(fk) == F.col("_ll_pk"), "left_anti")


def _total(value: Column, cond: Column) -> Column:
    return F.coalesce(F.sum(F.when(cond, value)), F.lit(0)).cast("bigint")


def key_pass(parent: DataFrame, key: Sequence[str], children: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """One row about a parent's key and all foreign keys that name it: ``rows`` and
    ``bad_keys`` (key values that are NULL or occur twice) of the parent, and per child
    ``orphans_<name>`` (rows whose key no parent has) and ``nulls_<name>``.

    A tagged union instead of joins: the parent's keys and every child's foreign
    keys are stacked with a number for their side and aggregated once by value.
    A value without a parent row is an orphan, a NULL one stands apart. The rows of a
    hot key meet in the partial aggregates; each table is read once, its key column
    only. Children need a parent with a single key column.
    """
    if children and len(key) != 1:
        raise ValueError(f"foreign keys name one column, the key is {tuple(key)}")
    names = [f"_ll_k{i}" for i in range(len(key))]
    stacked = parent.select(*[F.col(k).alias(n) for k, n in zip(key, names)], F.lit(0).alias("_ll_side"))
    for i, (child, fk) in enumerate(children.values(), 1):
        stacked = stacked.unionByName(child.select(F.col(fk).alias(names[0]), F.lit(i).alias("_ll_side")))
    per_key = stacked.groupBy(*names).agg(
        *[F.count_if(F.col("_ll_side") == i).alias(f"_ll_n{i}") for i in range(len(children) + 1)])
    null = reduce(lambda a, b: a | b, [F.col(n).isNull() for n in names])
    own = F.col("_ll_n0")
    sums = [F.coalesce(F.sum(own), F.lit(0)).cast("bigint").alias("rows"),
            F.count_if((own > 1) | (null & (own > 0))).cast("bigint").alias("bad_keys")]
    for i, name in enumerate(children, 1):
        sums += [_total(F.col(f"_ll_n{i}"), ~null & (own == 0)).alias(f"orphans_{name}"),
                 _total(F.col(f"_ll_n{i}"), null).alias(f"nulls_{name}")]
    return per_key.agg(*sums)


def orphan_count(child: DataFrame, fk: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """One row: ``orphan_rows`` (non-NULL FK without parent), ``null_fk_rows``."""
    return key_pass(parent, [parent_key], {"fk": (child, fk)}).select(
        F.col("orphans_fk").alias("orphan_rows"), F.col("nulls_fk").alias("null_fk_rows"))
