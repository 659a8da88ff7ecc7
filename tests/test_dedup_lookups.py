"""Keep-first, lookups (fan-out, NULL keys), orphan and duplicate counting."""

from __future__ import annotations

from conftest import plan_text
from ledgerloom.operators import (Lookup, duplicate_key_count, keep_first, lookup,
                                  lookup_distinct, orphan_count, sized_broadcast)


def test_keep_first_by_sequence_with_ties_and_null_key(spark):
    df = spark.createDataFrame(
        [("r1", "Ann", 2), ("r1", "Bob", 1), ("r2", "Cy", 5), ("r2", "Al", 5), (None, "N1", 3),
         (None, "N2", 4)], "region string, person string, seq int")
    got = sorted(keep_first(df, ["region"], "seq", ["person", "region"]).collect(),
                 key=lambda r: str(r["region"]))
    assert [(r["person"], r["region"]) for r in got] == [("N1", None), ("Bob", "r1"), ("Al", "r2")]


def test_lookup_null_key_never_matches_and_fan_out(spark):
    dim = spark.createDataFrame([(1, "East"), (2, "West"), (3, "West")], "people_id long, region string")
    left = spark.createDataFrame([("o1", "East"), ("o2", "West"), ("o3", None), ("o4", "North")],
                                 "order_id string, region string")
    got = sorted((r["order_id"], r["people_id"]) for r in
                 lookup(left, Lookup(dim, ("region",), ("people_id",))).collect())
    assert got == [("o1", 1), ("o2", 2), ("o2", 3), ("o3", None), ("o4", None)]


def test_lookup_distinct_collapses_unmatched_keys(spark):
    """Two raw rows that differ only in unmatched lookup keys give one output
    row, with and without the broadcast path."""
    dim = spark.createDataFrame([(1, "East")], "people_id long, region string")
    raw = spark.createDataFrame([("o1", "North"), ("o1", "South"), ("o1", None), ("o2", "East"),
                                 ("o2", "East")], "order_id string, region string")
    for limit in (100, 0):
        lk = Lookup(dim, ("region",), ("people_id",), broadcast_rows=limit)
        got = sorted((r["order_id"], r["people_id"]) for r in
                     lookup_distinct(raw, [lk], ["order_id", "people_id"],
                                     pre=["order_id", "region"]).collect())
        assert got == [("o1", None), ("o2", 1)]


def test_sized_broadcast_respects_limit(spark):
    dim = spark.range(10)
    fact = spark.range(5_000_000).withColumnRenamed("id", "k")
    small = fact.join(sized_broadcast(dim, 10), fact["k"] == dim["id"])
    big = fact.join(sized_broadcast(dim, 5), fact["k"] == dim["id"])
    assert "ResolvedHint (strategy=broadcast)" in plan_text(small, "extended")
    assert "ResolvedHint (strategy=broadcast)" not in plan_text(big, "extended")


def test_broadcast_byte_limit(spark):
    from ledgerloom.operators.lookups import fits_broadcast
    wide = spark.range(100).selectExpr("id", "repeat('x', 1000) AS text")
    assert fits_broadcast(wide, 1000, 200_000)            # ~100 * (1000 + 8 + 32) bytes
    assert not fits_broadcast(wide, 1000, 50_000)
    assert fits_broadcast(spark.range(0), 10, 10)


def test_orphans_and_nulls(spark):
    parent = spark.createDataFrame([(1,), (2,), (None,)], "id long")
    child = spark.createDataFrame([(1,), (1,), (3,), (3,), (4,), (None,)], "fk long")
    row = orphan_count(child, "fk", parent, "id").first()
    assert (row["orphan_rows"], row["null_fk_rows"]) == (3, 1)


def test_duplicate_key_count(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (3,), (3,), (3,)], "k long")
    assert duplicate_key_count(df, ["k"]).first()[0] == 2
