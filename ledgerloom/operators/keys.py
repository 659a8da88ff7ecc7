"""Dense, ordered surrogate keys without a single-partition window.

``row_number() over (order by ...)`` with no PARTITION BY plans an
``Exchange SinglePartition``: every row of the table goes through one task. The
key builder here gives the same numbers in two distributed passes:

1. range-partition on the ordering, sort inside each partition, and record for
   every row its partition id and its position in that partition; the result is
   written to the shared checkpoint folder, which cuts the lineage, so the
   recorded positions never change on a retry;
2. count rows per partition (reads one column), turn the counts into running
   offsets over a table with one row per partition, broadcast that table — its
   size is bounded by the partition count — and add offset + position.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import stage_path, write_stored

#: Ranges of a key build. Spark samples about a hundred rows per range, one million
#: at most, so more ranges get uneven and the sample heavy on the driver.
MAX_RANGES = 10_000

_PART = "_ll_part"
_POS = "_ll_pos"
_CNT = "_ll_cnt"
_OFF = "_ll_off"

# monotonically_increasing_id puts the partition index above bit 33 and the
# row position in the low 33 bits.
_POS_MASK = (1 << 33) - 1


def _ordering(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in cols]


def dense_key(df: DataFrame, order_by: Sequence[str | Column], key_col: str,
              num_partitions: int | None = None, start: int = 1,
              stage_dir: str | None = None, repeated: Sequence[str] = ()) -> DataFrame:
    """Add ``key_col`` = start, start+1, ... following ``order_by`` (ASC NULLS FIRST).

    Equal to ``row_number() over (order by ...)``; ties (if the ordering is not
    total) are numbered in an arbitrary but fixed order. ``num_partitions``
    fixes the range-partition count; by default the session's shuffle
    partitions are used and adaptive execution may coalesce neighbouring ranges,
    which keeps them contiguous and in order. The positioned rows are written
    under ``stage_dir`` (default: a fresh folder under the checkpoint root).

    Rows of ``df`` that may be repeated are made distinct on the way if ``repeated`` names
    the first columns of the order, none of them a float: the ranges are then of these,
    and equal rows meet in one range, so that DISTINCT needs no shuffle of its own. Rows
    alike in these columns stay together; they should be few, and copies rare.
    """
    spark = df.sparkSession
    ordering = _ordering(order_by)
    if num_partitions is None and int(spark.conf.get("spark.sql.shuffle.partitions")) > MAX_RANGES:
        num_partitions = MAX_RANGES
    bounds = ordering[:len(repeated)] if repeated else ordering
    if num_partitions is None:
        ranged = df.repartitionByRange(*bounds)
    else:
        ranged = df.repartitionByRange(min(num_partitions, MAX_RANGES), *bounds)
    if repeated:
        ranged = ranged.distinct()
    positioned = (ranged.sortWithinPartitions(*ordering)
                  .withColumn(_PART, F.spark_partition_id())
                  .withColumn(_POS, F.monotonically_increasing_id().bitwiseAND(F.lit(_POS_MASK))))
    path = (f"{stage_dir.rstrip('/')}/dense-key-{uuid.uuid4().hex}" if stage_dir
            else stage_path(spark, "dense-key"))
    write_stored(positioned, path)
    staged = spark.read.parquet(path)

    counts = staged.groupBy(_PART).agg(F.count(F.lit(1)).alias(_CNT))
    offsets = counts.select(
        _PART,
        (F.sum(_CNT).over(Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, 0))
         - F.col(_CNT)).alias(_OFF))
    keyed = staged.join(F.broadcast(offsets), _PART, "inner")
    key = (F.col(_OFF) + F.col(_POS) + F.lit(start)).cast("bigint").alias(key_col)
    return keyed.select(key, *[F.col(c) for c in df.columns if c != key_col])
