"""Sets of dense ids as bucketed bitmaps.

A set of surrogate keys is stored as one 4 KB bitmap for each run of 32 768 ids
(``bitmap_construct_agg``), so membership of a fact row is a join on its bucket
number and a bit test, and repeated ids need no DISTINCT. Partial bitmaps are
built on the map side: a task sends one row a bucket it has seen, however many ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lookups import broadcast_byte_limit

BUCKET = 32_768                     # ids in a bitmap, fixed by Spark's functions
BITMAP_BYTES = BUCKET // 8 + 64     # with the row around it


def bitmaps(ids: DataFrame, id_col: str) -> DataFrame:
    """(_ll_bucket, _ll_bitmap): the non-NULL values of ``id_col``."""
    x = F.col(id_col)
    return (ids.filter(x.isNotNull()).groupBy(F.bitmap_bucket_number(x).alias("_ll_bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(x)).alias("_ll_bitmap")))


def has_bit(bitmap: Column, position: Column) -> Column:
    """Whether the bit at ``position`` is set; False for a NULL bitmap."""
    byte = F.conv(F.hex(F.substring(bitmap, (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("long")
    return F.coalesce(F.getbit(byte, (position % 8).cast("int")) == 1, F.lit(False))


def bitmap_bound(ids: DataFrame, id_col: str) -> int:
    """Bytes that the bitmaps of ``id_col`` can take at most: one for each id, or
    one for each bucket between the smallest and the largest, whichever is less.
    One pass over one column."""
    bucket = F.bitmap_bucket_number(F.col(id_col))
    row = ids.agg(F.count(id_col).alias("n"), F.min(bucket).alias("lo"), F.max(bucket).alias("hi")).first()
    return min(row["n"], row["hi"] - row["lo"] + 1) * BITMAP_BYTES if row["n"] else 0


def with_membership(df: DataFrame, id_col: str, ids: DataFrame, ids_col: str, flag: str) -> DataFrame:
    """``df`` with boolean ``flag``: whether ``df[id_col]`` occurs in ``ids[ids_col]``.
    A NULL id is in no set. The bitmaps are broadcast if their bound is within the
    byte limit, else joined by bucket; a bucket of ``df`` has ``BUCKET`` ids at most."""
    right = bitmaps(ids, ids_col)
    if bitmap_bound(ids, ids_col) <= broadcast_byte_limit(df):
        right = F.broadcast(right)
    x = F.col(id_col)
    return (df.join(right, F.bitmap_bucket_number(x) == F.col("_ll_bucket"), "left")
            .withColumn(flag, has_bit(F.col("_ll_bitmap"), F.bitmap_bit_position(x))).drop("_ll_bucket", "_ll_bitmap"))
