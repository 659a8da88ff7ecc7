"""Expected figures come from the source, apart from the build; old runs go."""

from __future__ import annotations

from conftest import SF_SMALL
from ledgerloom.config import path_exists, stage_path
from ledgerloom.plans import normalize as N
from ledgerloom.plans.publish import current_run, remove_old_runs, run_and_publish
from ledgerloom.plans.validate import expected_counts_from_raw
from ledgerloom.sources import fixtures


def test_a_short_staging_write_is_found(spark, monkeypatch):
    whole = N.stage

    def short(df, path):
        return whole(df.filter("order_id not like '%7'") if path.endswith("raw_orders") else df, path)
    monkeypatch.setattr(N, "stage", short)
    ro, rp, rr = fixtures.raw_inputs(spark, SF_SMALL)
    run = run_and_publish(ro, rp, rr, stage_path(spark, "short"))
    bad = {(r.check_group, r.check_name) for r in run.report.filter("status = 'MISMATCH'").collect()}
    assert not run.published
    assert {g for g, _ in bad} == {"row_count", "control_total"}
    assert {n for _, n in bad} >= {"orders", "order_details", "date_ship", "returns", "sum_sales", "sum_profit"}


def test_incompletely_named_products_are_no_mismatch(spark):
    base = fixtures.raw_orders(spark, SF_SMALL)
    row = base.orderBy("order_id", "product_id", "quantity", "ship_date").first().asDict()
    rows = [{**row, "product_id": p, "product_name": None} for p in ("P-a", "P-b")] + [row]
    raw = spark.createDataFrame(rows, base.schema)
    people = fixtures.raw_people(spark, SF_SMALL)
    returns = spark.createDataFrame([("Yes", row["order_id"])], "returned string, order_id string")
    want = {r.table_name: r.expected_rows for r in expected_counts_from_raw(raw, people, returns).collect()}
    assert (want["product"], want["order_details"], want["returns"]) == (3, 2, 2)
    run = run_and_publish(raw, people, returns, stage_path(spark, "unnamed"))
    assert run.published


def test_old_runs_are_removed_but_never_the_current_one(spark):
    ro, rp, rr = fixtures.raw_inputs(spark, SF_SMALL)
    small = ro.filter("order_id in ('O-1', 'O-2', 'O-3')")
    base = stage_path(spark, "retention")
    runs = [run_and_publish(small, rp, rr.filter("false"), base).run_dir for _ in range(3)]
    assert remove_old_runs(spark, base, keep=1) == [runs[1], runs[0]]
    assert current_run(spark, base) == runs[2] and path_exists(spark, runs[2]) and not path_exists(spark, runs[0])
    assert remove_old_runs(spark, base, keep=1) == [] and remove_old_runs(spark, f"{base}-none") == []
