"""Natural-key → surrogate-key lookups (LEFT equi-joins).

A dimension is broadcast only after its row count and its byte size have
been measured against limits (``ledgerloom.broadcast.maxRows``,
``ledgerloom.broadcast.maxBytes``); above them the join stays a shuffled join,
and adaptive execution may still switch it to a broadcast from measured
shuffle sizes, or split a hot key's partition (skew join).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .hotkeys import hot_hashes, key_hash, split_by_heat

BROADCAST_ROWS_CONF = "ledgerloom.broadcast.maxRows"
BROADCAST_BYTES_CONF = "ledgerloom.broadcast.maxBytes"
DEFAULT_BROADCAST_ROWS = 1_000_000
DEFAULT_BROADCAST_BYTES = 256 * 1024 * 1024
ROW_OVERHEAD_BYTES = 32   # per-row cost of a row in the broadcast hash relation


def broadcast_limit(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(BROADCAST_ROWS_CONF, str(DEFAULT_BROADCAST_ROWS)))


def broadcast_byte_limit(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(BROADCAST_BYTES_CONF, str(DEFAULT_BROADCAST_BYTES)))


def _width(field: T.StructField) -> Column:
    """Bytes of one value: exact for text and binary, fixed width otherwise."""
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)).cast("long")
    return F.lit(16 if isinstance(field.dataType, T.DecimalType) else 8).cast("long")


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row of ``df`` in a broadcast relation (text measured exactly)."""
    width = F.lit(ROW_OVERHEAD_BYTES).cast("long")
    for f in df.schema.fields:
        width = width + _width(f)
    return width


def fits_broadcast(dim: DataFrame, max_rows: int | None = None,
                   max_bytes: int | None = None, known: tuple[int, int] | None = None) -> bool:
    """True when ``dim`` has at most ``max_rows`` rows and its rows add up to
    at most ``max_bytes`` (text measured exactly, plus a per-row overhead).

    The row count comes first: on Parquet it is answered from row-group
    metadata, so a huge table is rejected without reading its columns (a
    ``limit`` would funnel rows through one task instead). Only a table that
    passes is measured, and that pass reads at most ``max_rows`` rows. ``known``
    gives rows and bytes that were measured before, e.g. by the job that wrote the
    table (bytes of more columns are an upper bound); no job runs then.
    """
    limit = broadcast_limit(dim) if max_rows is None else max_rows
    byte_limit = broadcast_byte_limit(dim) if max_bytes is None else max_bytes
    if known is not None:
        return known[0] <= limit and known[1] <= byte_limit
    if dim.count() > limit:
        return False
    size = dim.agg(F.coalesce(F.sum(row_bytes(dim)), F.lit(0)).alias("b")).first()["b"]
    return size <= byte_limit


def sized_broadcast(dim: DataFrame, max_rows: int | None = None,
                    max_bytes: int | None = None, known: tuple[int, int] | None = None) -> DataFrame:
    """``broadcast(dim)`` when it passes ``fits_broadcast``, else ``dim`` (the
    planner and adaptive execution then choose the join)."""
    return F.broadcast(dim) if fits_broadcast(dim, max_rows, max_bytes, known) else dim


@dataclass(frozen=True)
class Lookup:
    """Look up ``take`` in ``dim`` where ``dim[keys] == left[left_keys]``."""
    dim: DataFrame
    keys: tuple[str, ...]
    take: tuple[str, ...]
    left_keys: tuple[str, ...] | None = None
    broadcast_rows: int | None = None
    hot_share: float | None = None      # keys of at least this share of the rows are joined apart


def _join(left: DataFrame, lk: Lookup, right: DataFrame) -> DataFrame:
    left_keys = lk.left_keys or lk.keys
    cond: Column | None = None
    for lkey, dkey in zip(left_keys, lk.keys):
        term = left[lkey] == right[f"_lk_{dkey}"]
        cond = term if cond is None else cond & term
    return left.join(right, cond, "left").drop(*[f"_lk_{k}" for k in lk.keys])


def _right(lk: Lookup) -> DataFrame:
    return lk.dim.select(*[F.col(k).alias(f"_lk_{k}") for k in lk.keys], *lk.take)


def lookup(left: DataFrame, lk: Lookup) -> DataFrame:
    """LEFT JOIN ``lk.dim`` on its keys; adds the ``take`` columns.

    Plain SQL equality: a NULL key matches nothing and yields NULL ids. A key
    present twice in the dimension fans out (see ``check_lookup_unique``). If the
    dimension is too large to broadcast and ``hot_share`` is set, hot keys and NULL
    keys are kept out of the shuffled join (``hotkeys``); ``left`` is then read
    for the sketch and once for each part, so it should be a stored table.
    """
    right = _right(lk)
    if lk.hot_share is None or fits_broadcast(right, lk.broadcast_rows):
        return _join(left, lk, sized_broadcast(right, lk.broadcast_rows))
    keys = list(lk.left_keys or lk.keys)
    hot = hot_hashes(left, keys, lk.hot_share)
    few = right.filter(key_hash([f"_lk_{k}" for k in lk.keys]).isin(hot))
    if not hot or not fits_broadcast(few):
        return _join(left, lk, right)
    unmatched, heated, rest = split_by_heat(left, keys, hot)
    none = [F.lit(None).cast(lk.dim.schema[c].dataType).alias(c) for c in lk.take]
    return (_join(rest, lk, right).unionByName(_join(heated, lk, F.broadcast(few)))
            .unionByName(unmatched.select("*", *none)))


def lookup_rows(raw: DataFrame, lookups: Sequence[Lookup], out: Sequence[str],
                pre: Sequence[str | Column] | None = None) -> DataFrame:
    """``lookup_distinct`` before its DISTINCT."""
    rights = [_right(lk) for lk in lookups]
    small = [fits_broadcast(r, lk.broadcast_rows) for r, lk in zip(rights, lookups)]
    joined = raw if all(small) or pre is None else raw.select(*pre).distinct()
    for lk, r, fits in zip(lookups, rights, small):
        joined = _join(joined, lk, F.broadcast(r) if fits else r)
    return joined.select(*out)


def lookup_distinct(raw: DataFrame, lookups: Sequence[Lookup], out: Sequence[str],
                    pre: Sequence[str | Column] | None = None) -> DataFrame:
    """SELECT DISTINCT ``out`` FROM ``raw`` LEFT JOIN each lookup.

    When every dimension passes the broadcast size check the joins run on the
    map side at raw grain and the only shuffle is the DISTINCT itself, whose
    partial aggregation collapses repeated rows before the exchange. When one
    does not, ``raw`` is first reduced to its distinct ``pre`` columns so the
    shuffled joins (split by adaptive execution on a hot key) move as few rows
    as possible; the DISTINCT after the joins keeps the result exact, since
    two raw rows with unmatched keys can meet in one output row.
    """
    return lookup_rows(raw, lookups, out, pre).distinct()
