"""Negative tests: corrupt one table, the report fails in exactly that check.
Publishing happens only when every check passes."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerloom.config import stage_path
from ledgerloom.plans import validate as V
from ledgerloom.plans.normalize import Normalizer
from ledgerloom.plans.publish import current_run, run_and_publish
from ledgerloom.sources import fixtures


@pytest.fixture(scope="module")
def built(spark):
    ro, rp, rr = fixtures.raw_inputs(spark, SF_SMALL)
    n = Normalizer(ro, rp, rr)
    tables = n.build()
    rows = V.expected_counts_from_raw(n.raw_orders, rp, rr)
    sums = V.expected_totals_from_raw(n.raw_orders)
    return n, tables, rows, sums


def failing(report):
    return sorted((r["check_group"], r["check_name"]) for r in
                  report.filter("status = 'MISMATCH'").collect())


def test_clean_build_passes(built):
    _, tables, rows, sums = built
    report = V.validation_report(tables, rows, sums)
    assert failing(report) == []
    assert V.passed(report)
    assert all(r["all_passed"] for r in report.select("all_passed").collect())


def test_missing_parent_fails_orphans_and_count(built):
    _, tables, rows, sums = built
    bad = dict(tables)
    bad["product"] = tables["product"].filter(F.col("product_code") != 1)
    assert failing(V.validation_report(bad, rows, sums)) == [
        ("fk_orphans", "order_details.product_code -> product"), ("row_count", "product")]


def test_profit_times_ten_fails_only_profit_total(built):
    _, tables, rows, sums = built
    bad = dict(tables)
    bad["order_details"] = tables["order_details"].withColumn(
        "profit", (F.col("profit") * 10).cast("decimal(12,4)"))
    assert failing(V.validation_report(bad, rows, sums)) == [("control_total", "sum_profit")]


def test_duplicate_key_fails_pk(built):
    _, tables, rows, sums = built
    bad = dict(tables)
    bad["people"] = tables["people"].unionByName(tables["people"].limit(1))
    assert ("pk_unique", "people.people_id") in failing(V.validation_report(bad, rows, sums))
    assert ("lookup_unique", "people.region") in failing(V.validation_report(bad, rows, sums))


def test_fixed_expectations(spark, built):
    _, tables, _, _ = built
    rows = V.expected_counts(spark, {"product": 1, "people": 5})
    sums = V.expected_totals(spark, 0.0, 0.0)
    fails = failing(V.validation_report(tables, rows, sums))
    assert ("row_count", "product") in fails and ("row_count", "people") not in fails
    assert ("control_total", "sum_sales") in fails


def test_publish_gate(spark):
    ro, rp, rr = fixtures.raw_inputs(spark, SF_SMALL)
    base = stage_path(spark, "warehouse-test")
    ok = run_and_publish(ro, rp, rr, base)
    assert ok.published and current_run(spark, base) == ok.run_dir
    assert not os.path.exists(ok.run_dir.replace("file:", "") + "/_staging")
    assert os.path.exists(ok.run_dir.replace("file:", "") + "/order_details")
    wrong = V.expected_counts(spark, {"product": 1})
    bad = run_and_publish(ro, rp, rr, base, expected_rows=wrong)
    assert not bad.published
    assert current_run(spark, base) == ok.run_dir    # previous good run stays current
    newer = run_and_publish(ro, rp, rr, base)
    assert newer.published and current_run(spark, base) == newer.run_dir


def test_workbook_expectations_shape(spark, built):
    """The fixed workbook figures plug into the same report; on the test tables
    they are (rightly) not met."""
    _, tables, _, _ = built
    rows, sums = V.workbook_expectations(spark)
    assert rows.count() == 9 and sums.count() == 2
    report = V.validation_report(tables, rows, sums)
    fails = failing(report)
    assert ("row_count", "product") in fails and ("control_total", "sum_sales") in fails
    assert not any(g == "fk_orphans" for g, _ in fails)
