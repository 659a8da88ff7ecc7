"""Figures gathered while writing, key passes without joins, resumed runs, numbered
publishes, dimensions from one scan, keys kept across loads, bucketed facts."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, plan_text, spark_bag
from ledgerloom import catalog
from ledgerloom.config import read_text, stage_path, write_text
from ledgerloom.operators import bitmaps as B
from ledgerloom.operators.buckets import even, register_bucketed, write_bucketed
from ledgerloom.operators.integrity import key_pass
from ledgerloom.operators.keymap import KeyMap, OpenClaim
from ledgerloom.plans import entities as E
from ledgerloom.plans import publish as P
from ledgerloom.plans import validate as V
from ledgerloom.plans.metrics import Journal, TableMetrics, observed_write
from ledgerloom.plans.normalize import Normalizer
from ledgerloom.plans.views import sales_view
from ledgerloom.schemas import TABLE_ORDER
from ledgerloom.sources import fixtures


@pytest.fixture(scope="module")
def edge(spark):
    t = catalog.edge_built(spark, SF_SMALL)
    t.build()
    return t


def test_report_from_write_time_figures(spark, edge):
    """Equal to the scanned report, without reading a table for counts or totals."""
    rows = V.expected_counts_from_raw(edge.raw_orders, edge.raw_people, edge.raw_returns)
    sums = V.expected_totals(spark, 1.0, 2.0)
    observed = V.validation_report(edge.tables, rows, sums, edge.metrics)
    assert spark_bag(observed) == spark_bag(V.validation_report(edge.tables, rows, sums))
    passes = V.key_figures(edge.tables, ("row_count", "pk_unique", "fk_orphans", "fk_nulls"), edge.metrics)
    totals = V.check_control_totals(edge.tables["order_details"], sums, metrics=edge.metrics)
    for plan in (plan_text(passes), plan_text(totals)):
        assert "sales" not in "".join(x for x in plan.splitlines() if "ReadSchema" in x)
    assert "Scan parquet" not in plan_text(totals)


def test_key_checks_run_without_joins(edge):
    plan = plan_text(V.check_fk_orphans(edge.tables), "simple")
    assert "Join" not in plan
    parents = {"people", "customers", "type_ship", "addresses", "orders", "product", "order_details"}
    assert plan.count("FileScan parquet") == len(parents) + 9  # each parent and each foreign key once


def test_key_pass_counts(spark):
    parent = spark.createDataFrame([(1,), (2,), (2,), (None,), (5,)], "id long")
    child = spark.createDataFrame([(1,), (1,), (9,), (9,), (8,), (None,), (None,)], "fk long")
    row = key_pass(parent, ["id"], {"a": (child, "fk"), "b": (parent, "id"), "none": (child.filter("false"), "fk")}).first()
    assert (row.rows, row.bad_keys) == (5, 2)
    assert (row.orphans_a, row.nulls_a, row.orphans_b, row.nulls_b, row.orphans_none, row.nulls_none) == (3, 2, 0, 1, 0, 0)
    empty = key_pass(parent.filter("false"), ["id"], {"a": (child, "fk")}).first()
    assert (empty.rows, empty.bad_keys, empty.orphans_a, empty.nulls_a) == (0, 0, 5, 2)
    with pytest.raises(ValueError):
        key_pass(parent.withColumn("x", F.lit(1)), ["id", "x"], {"a": (child, "fk")})


def test_observed_write_of_an_empty_table(spark, edge):
    written, figures = observed_write(edge.tables["order_details"].filter("false"), stage_path(spark, "t"), "order_details")
    assert written.count() == 0 and figures.rows == 0 and figures.bytes == 0
    assert figures.nulls == {"order_id": 0, "product_code": 0} and figures.total("sales") is None
    assert V.check_control_totals(written, V.expected_totals(spark, 0, 0), metrics={"order_details": figures}) \
        .filter("status = 'MISMATCH'").count() == 2


def test_resumed_build_takes_up_written_tables(spark, edge):
    raw = (edge.raw_orders, edge.raw_people, edge.raw_returns)
    run_dir = stage_path(spark, "resume")
    first = Normalizer(*raw, run_dir=run_dir)
    first.build(["product", "addresses", "type_ship", "people"])
    assert sorted(first.written) == ["addresses", "people", "product", "type_ship"]
    # a record that its writer didn't finish doesn't count
    write_text(spark, f"{run_dir}/_journal/customers.json", json.dumps({"table": "customers", "rows": 1, "bytes": 1}))
    second = Normalizer(*raw, run_dir=run_dir, resume=True)
    tables = second.build()
    assert sorted(second.resumed) == ["addresses", "people", "product", "type_ship"]
    assert sorted(second.written) == ["customers", "date_ship", "order_details", "orders", "returns"]
    assert second.metrics == edge.metrics
    for name in TABLE_ORDER:
        assert spark_bag(tables[name]) == spark_bag(edge.tables[name])


def test_journal_round_trip(spark):
    journal = Journal(spark, stage_path(spark, "journal"))
    assert journal.done() == {}
    m = TableMetrics(3, 99, {"fk": 1}, {"sales": "12.3400", "profit": None})
    journal.record("orders", m)
    assert journal.done() == {"orders": m}


def test_two_publishers_and_a_clock_set_back(spark, monkeypatch):
    base = stage_path(spark, "base")
    assert P.current_run(spark, base) is None and P.published_runs(spark, base) == []

    class Clock(P.dt.datetime):
        year_now = 2030

        @classmethod
        def now(cls, tz=None):
            return P.dt.datetime(cls.year_now, 1, 1, tzinfo=tz)
    monkeypatch.setattr(P.dt, "datetime", Clock)
    assert P.write_manifest(spark, base, "run-a") == 1
    Clock.year_now = 2020
    seen = P._records(spark, base)
    assert P.write_manifest(spark, base, "run-b") == 2
    assert P.current_run(spark, base) == "run-b"
    # a publisher that listed the folder before run-b was published
    monkeypatch.setattr(P, "_records", lambda *a: seen)
    assert P.write_manifest(spark, base, "run-c") == 3
    monkeypatch.undo()
    assert P.published_runs(spark, base) == ["run-a", "run-b", "run-c"] and P.current_run(spark, base) == "run-c"
    # a record half written by a lost publisher is passed over
    write_text(spark, f"{base}/_manifest/{4:020d}.json", '{"run_dir": "run-')
    assert P.current_run(spark, base) == "run-c" and P.write_manifest(spark, base, "run-e") == 5
    assert P.current_run(spark, base) == "run-e"


def test_write_text_creates_once(spark):
    path = f"{stage_path(spark, 'text')}/x.json"
    assert write_text(spark, path, "one") and not write_text(spark, path, "two")
    assert read_text(spark, path) == "one"
    assert write_text(spark, path, "three", overwrite=True) and read_text(spark, path) == "three"


def test_bitmap_membership(spark):
    ids = [1, 2, 8, 9, 32_768, 32_769, 65_536, 1_000_000, 1_000_000]
    have = spark.createDataFrame([(i,) for i in [*ids, None]], "id long")
    ask = spark.createDataFrame([(i,) for i in [*range(1, 20), 32_767, 32_768, 32_769, 65_535, 65_536, 65_537, 1_000_000, None]], "x long")
    for limit in (str(1 << 28), "0"):
        spark.conf.set("ledgerloom.broadcast.maxBytes", limit)
        got = {r.x: r.there for r in B.with_membership(ask, "x", have, "id", "there").collect()}
        assert got == {r.x: r.x in ids for r in ask.collect()}
    spark.conf.unset("ledgerloom.broadcast.maxBytes")
    assert B.bitmaps(have, "id").count() == 3
    assert B.bitmap_bound(have, "id") == 9 * B.BITMAP_BYTES
    assert B.bitmap_bound(have.filter("false"), "id") == 0
    none = B.with_membership(ask, "x", have.filter("false"), "id", "there")
    assert none.count() == ask.count() and none.filter("there").count() == 0


def test_sales_view_flags_without_distinct(edge):
    plan = plan_text(sales_view(edge.tables, edge.metrics))
    assert "bitmap_construct_agg" in plan and plan.count("HashAggregate") <= 2


def test_dimensions_from_one_scan(spark, edge):
    rows = E.dimension_rows(edge.raw_orders)
    plan = plan_text(rows, "simple")
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1
    builders = {"product": E.distinct_product, "addresses": E.distinct_addresses, "type_ship": E.distinct_ship_mode,
                "customers": lambda raw: raw.select("customer_id", "customer_name", "segment").distinct()}
    staged = E.stage_dimensions(edge.raw_orders, stage_path(spark, "dims"))
    empty = E.stage_dimensions(edge.raw_orders.filter("false"), stage_path(spark, "dims"))
    for name, plain in builders.items():
        assert spark_bag(staged[name]) == spark_bag(plain(edge.raw_orders))
        assert empty[name].collect() == []


def test_key_map_keeps_and_extends(spark):
    keys = KeyMap(spark, stage_path(spark, "keys"))
    schema = "a string, b int"
    first = keys.number(spark.createDataFrame([("x", 1), (None, 2), ("y", None)], schema), ["a", "b"], "k")
    got = {(r.a, r.b): r.k for r in first.collect()}
    assert got == {(None, 2): 1, ("x", 1): 2, ("y", None): 3}
    second = keys.number(spark.createDataFrame([("a", 0), (None, 2), ("b", 0)], schema), ["a", "b"], "k")
    assert {(r.a, r.b): r.k for r in second.collect()} == {(None, 2): 1, ("a", 0): 4, ("b", 0): 5}
    third = keys.number(spark.createDataFrame([("y", None), ("x", 1), ("c", 3)], schema), ["a", "b"], "k")
    assert {(r.a, r.b): r.k for r in third.collect()} == {("y", None): 3, ("x", 1): 2, ("c", 3): 6}
    empty = keys.number(spark.createDataFrame([], schema), ["a", "b"], "k")
    assert empty.collect() == []
    write_text(spark, f"{keys.path}/_claims/load-00000005.claim", "load-00000005\n")
    with pytest.raises(OpenClaim):
        keys.number(spark.createDataFrame([("z", 1)], schema), ["a", "b"], "k")
    assert keys.release() == ["load-00000005"]
    last = keys.number(spark.createDataFrame([("z", 1)], schema), ["a", "b"], "k")
    assert last.first().k == 7


def test_second_publish_keeps_keys(spark):
    base = stage_path(spark, "kept")
    clean = fixtures.raw_inputs(spark, SF_SMALL)
    first = P.run_and_publish(*clean, base, keep_keys=True)
    assert first.published
    # the same lines once more, without the products of one category and with a new one
    extra = clean[0].filter("order_id = 'O-1'").agg(*[F.min(c).alias(c) for c in clean[0].columns])
    named = {c: F.lit(f"{c} new") for c in ("order_id", "product_id", "product_name")}
    orders = clean[0].filter("category <> 'PROMO BURNISHED COPPER'").unionByName(extra.withColumns(named))
    second = P.run_and_publish(orders, *clean[1:], base, keep_keys=True)
    assert second.published
    old = {(r.product_id, r.product_name): r.product_code for r in first.tables["product"].collect()}
    new = {(r.product_id, r.product_name): r.product_code for r in second.tables["product"].collect()}
    assert all(old.get(k, max(old.values()) + 1) == v for k, v in new.items()) and len(new.keys() - old.keys()) == 1
    was, now = ({r.detail_id: (r.order_id, r.quantity, r.sales) for r in x.tables["order_details"].collect()} for x in (first, second))
    assert all(was.get(i, v) == v for i, v in now.items()) and len(now.keys() - was.keys()) == 1


def test_bucketed_facts_join_without_shuffle(spark):
    t = catalog.colocated(spark, SF_SMALL)
    tables = t.build()
    rows = E.return_rows(t.returned, tables["orders"], tables["order_details"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Exchange" not in plan_text(rows, "simple")
        lines = plan_text(sales_view(tables, t.metrics), "simple")
        assert "Exchange hashpartitioning(order_id" not in lines and "SortMergeJoin" in lines
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    again = register_bucketed(spark, t.path("orders"), tables["orders"].schema, "order_id", t.buckets, "orders")
    assert spark_bag(again) == spark_bag(tables["orders"])


def test_uneven_buckets_are_told(spark):
    rows = spark.range(40).select((F.col("id") * 7).alias("k"))
    table = write_bucketed(rows.repartition(4, "k"), stage_path(spark, "even"), "k", 4, "even")
    assert even(table, 4)
    hot = spark.range(3_000_000).select(F.lit(5).alias("k"))
    assert not even(write_bucketed(hot, stage_path(spark, "hot"), "k", 16, "hot"), 16)
    assert even(table.filter("false"), 4)
