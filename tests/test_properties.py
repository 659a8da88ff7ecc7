
from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, spark_bag
from ledgerloom.plans import entities as E
from ledgerloom.plans.normalize import Normalizer
from ledgerloom.plans.views import sales_view
from ledgerloom.schemas import TABLE_ORDER, TABLES
from ledgerloom.sources import fixtures


@pytest.fixture(scope="module")
def base(spark):
    ro, rp, rr = fixtures.raw_inputs(spark, SF_SMALL)
    n = Normalizer(ro, rp, rr)
    return ro, rp, rr, n.build()


def test_keys_are_one_to_n(base):
    *_, tables = base
    for name in TABLE_ORDER:
        key = TABLES[name].surrogate
        if key is None:
            continue
        stats = tables[name].agg(F.min(key), F.max(key), F.count(F.lit(1)),
                                 F.count_distinct(key)).first()
        assert tuple(stats) == (1, stats[2], stats[2], stats[2]), name


def test_round_trip_sales_view_to_raw(base):
    """Projected back, the view equals the distinct raw rows (without row_id and
    ship_date) after postal normalization and the store cast."""
    ro, _, _, tables = base
    cols = ["order_id", "order_date", "customer_id", "customer_name", "segment", "country", "city",
            "state", "postal_code", "region", "product_id", "category", "sub_category",
            "product_name", "quantity", "sales", "discount", "profit"]
    view = sales_view(tables)
    back = (view.join(tables["order_details"].select("detail_id"), "detail_id")
            .select(*cols).distinct())
    raw = E.store_money(E.with_postal_key(ro)).select(*cols).distinct()
    assert spark_bag(back) == spark_bag(raw)


def test_duplicating_and_shuffling_raw_changes_nothing(spark, base):
    ro, rp, rr, tables = base
    noisy = ro.unionByName(ro).repartition(5).sortWithinPartitions(F.rand(7))
    again = Normalizer(noisy, rp.unionByName(rp), rr.unionByName(rr).repartition(3)).build()
    for name in TABLE_ORDER:
        assert spark_bag(again[name]) == spark_bag(tables[name]), name


def test_fixture_golden_counts_and_totals(base):
    """The figures FIXTURES.md records for sf0.001 (taken from DuckDB there)."""
    from decimal import Decimal
    ro, _, rr, tables = base
    assert ro.count() == 6057 and rr.count() == 1969
    expected = {"product": 200, "addresses": 143, "type_ship": 5, "people": 5, "customers": 150,
                "orders": 1473, "date_ship": 5994, "order_details": 6000, "returns": 4890}
    assert {n: tables[n].count() for n in expected} == expected
    sums = tables["order_details"].agg(F.sum("sales"), F.sum("profit")).first()
    assert (sums[0], sums[1]) == (Decimal("317364757.3100"), Decimal("-225679.2873"))


def test_normalize_function_cleans_staging(spark):
    import os

    from ledgerloom.config import stage_path
    from ledgerloom.plans.normalize import normalize
    ro, rp, rr = fixtures.raw_inputs(spark, SF_SMALL)
    run_dir = stage_path(spark, "normalize-fn")
    tables = normalize(ro, rp, rr, run_dir=run_dir)
    assert tables["order_details"].count() == 6000
    assert not os.path.exists(run_dir.replace("file:", "") + "/_staging")
