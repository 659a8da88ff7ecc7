"""File sources (header names, locale numbers, missing markers) and plan shape."""

from __future__ import annotations

import os
import tempfile

from conftest import SF_SMALL, plan_text
from ledgerloom.catalog import QUERIES, reset_built
from ledgerloom.operators.keys import dense_key
from ledgerloom.operators.lookups import lookup_distinct
from ledgerloom.plans import entities as E
from ledgerloom.plans.normalize import Normalizer, stage
from ledgerloom.sources import fixtures, read_sheet
from ledgerloom.sources.readers import conform, rename_headers
from ledgerloom.schemas import RAW_ORDERS_SCHEMA, RAW_RETURNS_SCHEMA

HEADER = ("Row ID,Order ID,Order Date,Ship Date,Ship Mode,Customer ID,Customer Name,Segment,"
          "Country/Region,City,State,Postal Code,Region,Product ID,Category,Sub-Category,"
          "Product Name,Sales,Quantity,Discount,Profit")


def test_read_csv_sheet_with_source_headers(spark):
    d = tempfile.mkdtemp(prefix="ll-csv-")
    path = os.path.join(d, "orders.csv")
    with open(path, "w") as f:
        f.write(HEADER + "\n")
        f.write('1,O-1,2020-01-02 00:00:00,2020-01-05 00:00:00,Std,C-1,Ann,Home,US,Town,ST,2101,'
                'East,P-1,Cat,Sub,Pen,"1 234,56",2,"0,2","-5,5"\n')
        f.write("2,O-2,2020-01-03 00:00:00,NA,Std,C-2,NA,Home,US,Town,ST,,East,P-1,Cat,Sub,Pen,"
                "7,1,0,0\n")
    df = read_sheet(spark, path, "orders", locale_numbers=True)
    assert df.schema == RAW_ORDERS_SCHEMA
    rows = sorted(df.collect(), key=lambda r: r["row_id"])
    assert (rows[0]["sales"], rows[0]["discount"], rows[0]["profit"]) == (1234.56, 0.2, -5.5)
    assert rows[0]["postal_code"] == 2101.0 and rows[0]["quantity"] == 2
    assert rows[1]["ship_date"] is None and rows[1]["customer_name"] is None
    assert rows[1]["postal_code"] is None and rows[1]["sales"] == 7.0


def test_conform_fills_optional_row_id(spark):
    raw = fixtures.raw_orders(spark, SF_SMALL).drop("row_id")
    assert conform(raw, RAW_ORDERS_SCHEMA).schema == RAW_ORDERS_SCHEMA


def test_fact_key_plan_has_no_single_partition_exchange(spark):
    ro, rp, rr = fixtures.raw_inputs(spark, SF_SMALL)
    n = Normalizer(ro, rp, rr)
    rows = E.line_grain(n.raw_orders)
    plan = plan_text(rows.repartitionByRange(4, "order_id").sortWithinPartitions("order_id"))
    assert "SinglePartition" not in plan
    keyed = dense_key(rows, ["order_id", "product_id"], "k", num_partitions=4)
    assert "SinglePartition" not in plan_text(keyed.filter("k > 0"), "formatted").split(
        "BroadcastExchange")[0]


def test_lookups_broadcast_and_scans_pruned(spark):
    """Ship-mode lookup: map-side broadcast join, pruned raw scan, and one
    shuffle only (the DISTINCT)."""
    ro, rp, rr = fixtures.raw_inputs(spark, SF_SMALL)
    n = Normalizer(ro, rp, rr)
    t = n.build(["type_ship"])
    rows = lookup_distinct(n.raw_orders, [E.ship_lookup(t["type_ship"])],
                           ["ship_id", "order_id", "ship_date"],
                           pre=["ship_mode", "order_id", "ship_date"])
    plan = plan_text(rows)
    assert "BroadcastHashJoin" in plan
    assert "ReadSchema: struct<order_id:string,ship_date:timestamp_ntz,ship_mode:string>" in plan
    assert plan.count("hashpartitioning(") == 1


def test_read_parquet_sheets_strict_and_lenient(spark):
    import pytest
    from pyspark.errors import PySparkException
    d = tempfile.mkdtemp(prefix="ll-pq-")
    people = spark.createDataFrame([("Ann", "East"), ("NA", "West")], "`Person` string, `Region` string")
    people.write.parquet(f"{d}/people")
    got = sorted(((r["person"], r["region"]) for r in read_sheet(spark, f"{d}/people", "people",
                                                                 fmt="parquet").collect()),
                 key=lambda t: t[1])
    assert got == [("Ann", "East"), (None, "West")]
    returns = spark.createDataFrame([("Yes", "O-1")], "`Returned` string, `Order ID` string")
    returns.write.parquet(f"{d}/returns")
    assert read_sheet(spark, f"{d}/returns", "returns", fmt="parquet").first().asDict() == \
        {"returned": "Yes", "order_id": "O-1"}
    from ledgerloom.schemas import RAW_ORDERS_SCHEMA, SOURCE_HEADERS
    own = {"order_id", "sales", "order_date"}
    names = {ours: theirs for theirs, ours in SOURCE_HEADERS.items()}
    orders = spark.createDataFrame([("O-1", "12.5", "2020-01-02 00:00:00"), ("O-2", "n/a", "junk")],
                                   "`Order ID` string, `Sales` string, `Order Date` string")
    with pytest.raises(ValueError, match="missing columns"):
        conform(rename_headers(orders), RAW_ORDERS_SCHEMA)
    orders = orders.selectExpr("*", *(f"cast(null as string) `{names[f.name]}`" for f in RAW_ORDERS_SCHEMA
                                      if f.name not in own | {"row_id"}))
    orders.write.parquet(f"{d}/orders")
    lenient = read_sheet(spark, f"{d}/orders", "orders", fmt="parquet", strict=False)
    rows = {r["order_id"]: (r["sales"], r["order_date"]) for r in lenient.collect()}
    assert rows["O-1"][0] == 12.5 and rows["O-2"] == (None, None)
    with pytest.raises(PySparkException):
        read_sheet(spark, f"{d}/orders", "orders", fmt="parquet").collect()


def test_csv_follows_rfc_4180(spark):
    from ledgerloom.sources.readers import CSV_OPTIONS
    d = tempfile.mkdtemp(prefix="ll-csv-")
    rows = [('Binder, 11" x 17", blue', "East"), ('ends 11"', "two\nlines"), ('"quoted"', "a,b"), ("NA", "x")]
    spark.createDataFrame(rows, "Person string, Region string").write.options(**CSV_OPTIONS).csv(f"{d}/people")
    got = {(r.person, r.region) for r in read_sheet(spark, f"{d}/people", "people").collect()}
    assert got == {*rows[:3], (None, "x")}


def test_misspelt_header_is_an_error(spark):
    import pytest
    bad = spark.createDataFrame([("Yes", "O-1")], "`Returned` string, `Order Id` string")
    for strict in (True, False):
        with pytest.raises(ValueError, match="order_id"):
            conform(rename_headers(bad), RAW_RETURNS_SCHEMA, strict=strict)


def test_dates_do_not_depend_on_the_session_zone(spark):
    import datetime as dt

    from ledgerloom.functions.columns import parse_timestamp
    from pyspark.sql import functions as F
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
        df = spark.createDataFrame([("10/15/2017",), ("2017-10-15 00:00:00",)], "d string")
        got = [r[0] for r in df.select(parse_timestamp(F.col("d"), ("M/d/yyyy",))).collect()]
        assert got == [dt.datetime(2017, 10, 15)] * 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_totals_beyond_fourteen_digits(spark):
    from decimal import Decimal

    from ledgerloom.plans.validate import _sums
    lines = spark.range(3_000_000).selectExpr("cast(99999999.9999 as decimal(12,4)) sales",
                                              "cast(-99999999.9999 as decimal(12,4)) profit")
    assert _sums(lines, "s", "p").first()[0] == Decimal("99999999.9999") * 3_000_000


def test_corrupt_manifest_is_an_error(spark):
    import os

    import pytest

    from ledgerloom.plans.publish import MANIFEST, current_run
    d = tempfile.mkdtemp(prefix="ll-man-")
    assert current_run(spark, d) is None
    os.makedirs(f"{d}/{MANIFEST}")
    with open(f"{d}/{MANIFEST}/part-0.json", "w") as f:
        f.write("{not json\n")
    with pytest.raises(Exception):
        current_run(spark, d)


def test_load_moves_few_and_narrow_rows(spark, tmp_path):
    """Joins of tables too large to broadcast: customers meet orders, not lines; lines are
    shuffled for the lookup and for one DISTINCT; what is stored is compressed well."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_text(fixtures.raw_orders(spark, SF_SMALL))
        by_customer = [b for b in plan.split("\n\n") if "hashpartitioning(o_custkey" in b]
        assert by_customer and not any("l_orderkey" in b for b in by_customer)
        lines = QUERIES["fact_order_details_shuffled"](spark, SF_SMALL)
        plan = plan_text(lines)
        assert plan.count("hashpartitioning(") == 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        reset_built()
    stored = stage(spark.range(10), str(tmp_path / "t")).inputFiles()
    assert stored and all(f.endswith(".zstd.parquet") for f in stored)
