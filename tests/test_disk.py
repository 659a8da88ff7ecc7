"""What a load leaves on disk: shuffles are given back when the write that needed them has
ended, steps go with their table, the view carries wide columns through no shuffle of lines."""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, plan_text, spark_bag
from ledgerloom.catalog import edge_built
from ledgerloom.config import SHUFFLE_CLEANUP_CONF, list_names, path_exists, shuffles_freed, stage_path
from ledgerloom.operators.keymap import KeyMap
from ledgerloom.operators.keys import dense_key
from ledgerloom.plans import publish as P
from ledgerloom.plans import validate as V
from ledgerloom.plans.metrics import TableMetrics, observed_write
from ledgerloom.plans.normalize import Normalizer, stage
from ledgerloom.plans.views import sales_view
from ledgerloom.schemas import TABLE_ORDER
from ledgerloom.sources import fixtures


def _shuffles(spark) -> set[str]:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}


def _left(spark, before: set[str]) -> set[str]:
    """Shuffle files that came since ``before``, once removals on their way are done."""
    end = time.time() + 10
    while (left := _shuffles(spark) - before) and time.time() < end:
        time.sleep(0.1)
    return left


@pytest.mark.parametrize("step", ["stage", "observed", "dense_key", "key_map", "settled"])
def test_a_step_gives_its_shuffles_back(spark, step):
    rows = spark.range(400).groupBy((F.col("id") % 97).alias("a")).agg(F.max(F.col("id").cast("string")).alias("b"))
    before = _shuffles(spark)
    {"stage": lambda: stage(rows, stage_path(spark, "t")),
     "observed": lambda: observed_write(rows, stage_path(spark, "t"), "customers"),
     "dense_key": lambda: dense_key(rows, ["a"], "k"),
     "key_map": lambda: KeyMap(spark, stage_path(spark, "keys")).number(rows, ["a"], "k"),
     "settled": lambda: V.settled(rows)}[step]()
    assert _left(spark, before) == set()


def test_overlapping_steps_restore_the_setting(spark):
    was = spark.conf.get(SHUFFLE_CLEANUP_CONF)

    def step(i):
        with shuffles_freed(spark):
            time.sleep(0.01 * (i % 3))
            return spark.conf.get(SHUFFLE_CLEANUP_CONF)
    with ThreadPoolExecutor(8) as pool:
        assert set(pool.map(step, range(24))) == {"true"}
    with pytest.raises(KeyError), shuffles_freed(spark):
        raise KeyError
    assert spark.conf.get(SHUFFLE_CLEANUP_CONF) == was


def test_steps_go_with_their_table(spark):
    t = Normalizer(*fixtures.raw_inputs(spark, SF_SMALL), key_dir=stage_path(spark, "keys"))
    tables = t.build()
    assert list_names(spark, f"{t.run_dir}/_staging") == ["dimensions", "raw_orders"]
    assert all(tables[n].count() == t.metrics[n].rows for n in TABLE_ORDER)


def test_staging_is_gone_before_the_report(spark, monkeypatch):
    seen = []
    plain = P.expected_from_raw
    base = stage_path(spark, "published")
    runs = lambda: [f"{base}/runs/{n}" for n in list_names(spark, f"{base}/runs")]
    monkeypatch.setattr(P, "expected_from_raw", lambda *a: seen.extend(path_exists(spark, f"{r}/_staging") for r in runs()) or plain(*a))
    assert P.run_and_publish(*fixtures.raw_inputs(spark, SF_SMALL), base).published
    assert seen == [False]


def test_expected_figures_step_by_step(spark):
    raw = fixtures.raw_inputs(spark, SF_SMALL)
    odd = raw[0].withColumn("sales", F.when(F.col("quantity") % 7 == 0, None).otherwise(F.col("sales"))) \
                .withColumn("order_id", F.when(F.col("quantity") == 3, None).otherwise(F.col("order_id")))
    for orders in (odd, odd.filter("false")):
        counts, totals = V.expected_from_raw(orders, *raw[1:])
        want = V.expected_counts_from_raw(orders, *raw[1:])
        assert counts.dtypes == want.dtypes and spark_bag(counts) == spark_bag(want)
        assert spark_bag(totals) == spark_bag(V.expected_totals_from_raw(orders))


def test_view_shuffles_lines_twice_and_narrow(spark):
    """Customers and products too large to broadcast: customers meet the orders, and no
    shuffle carries the columns of a broadcast dimension."""
    t = edge_built(spark, SF_SMALL)
    tables = t.build()
    whole = spark_bag(sales_view(tables, t.metrics))
    large = {**t.metrics, **{n: TableMetrics(10**9, 10**12) for n in ("customers", "product")}}
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        view = sales_view(tables, large)
        blocks = [b for b in plan_text(view).split("\n\n") if "hashpartitioning(" in b]
        assert sum("detail_id" in b for b in blocks) == 2
        assert not any("detail_id" in b and "country" in b for b in blocks)
        assert spark_bag(view) == whole
        assert spark_bag(sales_view(tables, {**large, "addresses": TableMetrics(10**9, 10**12)})) == whole
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
