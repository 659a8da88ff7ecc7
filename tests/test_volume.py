"""Steps that keep the volume of a load low: shipments are made distinct in the ranges of
their keys, rows meet the key map without a join, a resumed run takes up the raw rows it
staged."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conftest import SF_SMALL, spark_bag
from ledgerloom.config import remove_path, stage_path
from ledgerloom.operators.hotkeys import mostly_distinct
from ledgerloom.operators.keymap import KeyMap
from ledgerloom.plans import entities as E
from ledgerloom.plans import normalize as N
from ledgerloom.schemas import TABLE_ORDER
from ledgerloom.sources import fixtures


def _shipments(spark, rows):
    return spark.createDataFrame(rows, "ship_mode string, order_id string, ship_date date") \
                .withColumn("ship_date", F.col("ship_date").cast("timestamp_ntz"))


@pytest.mark.parametrize("copies, want", [(1, ("order_id", "ship_date", "ship_id")), (40, ())])
def test_shipments_become_distinct_in_their_ranges_unless_many_are_alike(spark, monkeypatch, copies, want):
    import datetime as dt
    seen = []
    plain = E.dense_key
    monkeypatch.setattr(E, "dense_key", lambda *a, **k: seen.append(tuple(k["repeated"])) or plain(*a, **k))
    days = [None if i == 7 else dt.date(2024, 1, 1 + i % 28) for i in range(300)]
    rows = [(("First", "Second", None, "Lost")[i % 4], f"O-{i // 2}", days[i]) for i in range(300)]
    raw = _shipments(spark, rows * copies + rows[:5])
    modes = spark.createDataFrame([(1, "First"), (2, "Second")], "ship_id bigint, ship_mode string")
    got = E.build_date_ship(raw, modes, num_partitions=5)
    assert seen == [want]
    ids = {"First": 1, "Second": 2}
    low = dt.date(1, 1, 1)
    order = sorted({(o, d, ids.get(m)) for m, o, d in rows}, key=lambda r: (r[0], r[1] or low, r[2] or 0))
    found = [(r["order_id"], r["ship_date"] and r["ship_date"].date(), r["ship_id"]) for r in got.orderBy("date_ship_id").collect()]
    assert found == order
    assert [r[0] for r in got.select("date_ship_id").orderBy("date_ship_id").collect()] == list(range(1, len(order) + 1))


def test_a_hot_value_is_not_mostly_distinct(spark):
    rows = spark.range(1000).select(F.when(F.col("id") < 100, None).otherwise(F.col("id")).alias("a"))
    assert not mostly_distinct(rows, ["a"], 0.05) and mostly_distinct(rows, ["a"], 0.2)
    assert not mostly_distinct(rows.select(F.col("a") % 20), ["(a % 20)"], 0.9)


def test_rows_meet_the_key_map_without_a_join(spark, monkeypatch):
    keys = KeyMap(spark, stage_path(spark, "map"))
    df = lambda *rows: spark.createDataFrame(list(rows), "a string, x double")
    first = keys.number(df(("b", 1.0), ("a", None), (None, 2.0)), ["a", "x"], "k")
    assert spark_bag(first) == spark_bag(spark.createDataFrame([(1, None, 2.0), (2, "a", None), (3, "b", 1.0)], "k bigint, a string, x double"))
    joins = []
    plain = DataFrame.join
    cls = type(first)
    monkeypatch.setattr(cls, "join", lambda self, *a, f=cls.__dict__.get("join", plain), **k: joins.append(1) or f(self, *a, **k))
    rows = [("a", None), ("c", 0.5), ("a", None), (None, 2.0), ("c", 0.5)]
    second = keys.number(df(*rows), ["a", "x"], "k", repeated=["a"])
    want = [(1, None, 2.0), (2, "a", None), (4, "c", 0.5)]
    assert spark_bag(second) == spark_bag(spark.createDataFrame(want, "k bigint, a string, x double"))
    assert len(joins) == 1  # the offsets of the key build


def test_resumed_run_takes_up_its_staged_rows(spark, monkeypatch):
    raw = fixtures.raw_inputs(spark, SF_SMALL)
    run_dir = stage_path(spark, "resume-staged")
    N.Normalizer(*raw, run_dir=run_dir).build(TABLE_ORDER[:2])
    staged = []
    plain = N.stage
    monkeypatch.setattr(N, "stage", lambda df, path: staged.append(os.path.basename(path)) or plain(df, path))
    second = N.Normalizer(*raw, run_dir=run_dir, resume=True)
    assert spark_bag(second.raw_orders.select("order_id", "sales")) == spark_bag(raw[0].select("order_id", "sales"))
    assert staged == []
    # an unfinished copy, or one of other columns, is staged again
    remove_path(spark, f"{run_dir}/_staging/raw_orders/_SUCCESS")
    third = N.Normalizer(*raw, run_dir=run_dir, resume=True)
    assert third.raw_orders.count() == raw[0].count() and staged == ["raw_orders"]
    fewer = N.Normalizer(raw[0].drop("row_id"), *raw[1:], run_dir=run_dir, resume=True)
    assert "row_id" not in fewer.raw_orders.columns and staged == ["raw_orders"] * 2
