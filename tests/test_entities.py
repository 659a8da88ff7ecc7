"""The nine tables on hand-made edge rows, against the plain SQL form in DuckDB.

The DuckDB side runs the reference semantics literally (DISTINCT after the
LEFT JOINs, row_number keys) over the same raw rows, so it is a brute-force
check of the Spark plans, including the shuffled-join path (broadcast off).
"""

from __future__ import annotations

import datetime as dt

import duckdb
import pytest

from conftest import duck_bag, spark_bag
from ledgerloom.operators.lookups import BROADCAST_ROWS_CONF
from ledgerloom.oracle import target_sql
from ledgerloom.plans.normalize import Normalizer
from ledgerloom.plans.entities import build_returns_unfiltered
from ledgerloom.schemas import (RAW_ORDERS_SCHEMA, RAW_PEOPLE_SCHEMA, RAW_RETURNS_SCHEMA,
                                TABLE_ORDER)

D1 = dt.datetime(2020, 1, 1)
D2 = dt.datetime(2020, 1, 2)
S1 = dt.datetime(2020, 1, 5)
S2 = dt.datetime(2020, 1, 6)


def line(order="O-1", od=D1, sd=S1, mode="Std", cust="C-1", name="Ann", seg="Home",
         country="US", city="Town", state="ST", postal=2101.0, region="East",
         pid="P-1", cat="Cat", sub="Sub", pname="Pen", sales=10.0, qty=1, disc=0.0, profit=1.0):
    return (None, order, od, sd, mode, cust, name, seg, country, city, state, postal, region,
            pid, cat, sub, pname, sales, qty, disc, profit)


EDGE_LINES = [
    line(),
    line(),                                                    # exact duplicate line: collapses
    line(qty=2),                                               # equal but for quantity: stays
    line(order="O-2", postal=None, cust="C-2"),                # NULL postal -> '00000'
    line(order="O-3", postal=90210.0, sd=S2),
    line(order="O-3", postal=90210.0, sd=S1, pid="P-2"),       # one order, two ship dates
    line(order="O-4", postal=123456.0),                        # long code kept whole
    line(order="O-5", postal=90210.9),                         # truncated -> '90210'
    line(order="O-6", region=None),                            # NULL region -> NULL people id
    line(order="O-7", city=None),                              # NULL city -> NULL address id
    line(order="O-8", sales=1.00001),                          # both survive, both store 1.0000
    line(order="O-8", sales=1.00002),
    line(order="O-9", od=D1), line(order="O-9", od=D2),        # PK violation on orders
    line(order="O-10", cust="C-9", seg="Home"),
    line(order="O-11", cust="C-9", seg="Corp"),                # PK violation on customers
    line(order="O-12", pid="P-5", pname="Cap"),
    line(order="O-12", pid="P-5", pname="Cup"),                # one product id, two names
    line(order="O-13", pid="P-7", pname="Mug", cat="A"),
    line(order="O-14", pid="P-7", pname="Mug", cat="B"),       # (id, name) with two categories
    line(order="O-15", region="West"),                         # region with two managers
    line(order="O-16", region="Nowhere"),                      # region nobody manages
    line(order="O-16", region="Elsewhere"),                    # -> both give NULL people id
    line(order="O-17", mode=None),
]
EDGE_PEOPLE = [("Mia", "East"), ("Mia", "East"), ("Ned", "West"), ("Ola", "West"), ("Pat", None)]
EDGE_RETURNS = [("Yes", "O-1"), ("Yes", "O-1"), ("Yes", "O-none"), ("Yes", "O-3"), ("No", "O-3"),
                (None, "O-4")]


def frames(spark, lines=EDGE_LINES, people=EDGE_PEOPLE, returns=EDGE_RETURNS):
    return (spark.createDataFrame(lines, RAW_ORDERS_SCHEMA),
            spark.createDataFrame(people, RAW_PEOPLE_SCHEMA),
            spark.createDataFrame(returns, RAW_RETURNS_SCHEMA))


def duck_with(ro, rp, rr):
    con = duckdb.connect()
    for name, df in (("raw_orders", ro), ("raw_people", rp), ("raw_returns", rr)):
        arrow = df.toArrow()
        con.register(f"{name}_arrow", arrow)
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM {name}_arrow")
    return con


@pytest.mark.parametrize("broadcast_rows", ["1000000", "0"])
def test_edge_tables_match_plain_sql(spark, broadcast_rows):
    spark.conf.set(BROADCAST_ROWS_CONF, broadcast_rows)
    try:
        ro, rp, rr = frames(spark)
        n = Normalizer(ro, rp, rr, num_partitions=3)
        tables = n.build()
        con = duck_with(ro, rp, rr)
        for name in TABLE_ORDER:
            assert spark_bag(tables[name]) == duck_bag(con, target_sql(name)), name
        unfiltered = build_returns_unfiltered(rr, tables["order_details"])
        assert spark_bag(unfiltered) == duck_bag(con, target_sql("returns_unfiltered"))
    finally:
        spark.conf.unset(BROADCAST_ROWS_CONF)


def test_edge_semantics(spark):
    ro, rp, rr = frames(spark)
    t = Normalizer(ro, rp, rr).build()
    addr = {r["postal_code"] for r in t["addresses"].collect()}
    assert {"02101", "00000", "90210", "123456"} <= addr
    details = t["order_details"].filter("order_id = 'O-8'").collect()
    assert len(details) == 2 and {str(r["sales"]) for r in details} == {"1.0000"}
    o1 = t["order_details"].filter("order_id = 'O-1'").count()
    assert o1 == 2                                   # duplicate collapsed, quantity variant kept
    assert t["orders"].filter("order_id = 'O-9'").count() == 2
    assert t["date_ship"].filter("order_id = 'O-3'").count() == 2
    o16 = t["orders"].filter("order_id = 'O-16'").collect()
    assert len(o16) == 1 and o16[0]["people_id"] is None
    assert t["orders"].filter("order_id = 'O-15'").count() == 2   # two managers fan out
    keys = sorted(r[0] for r in t["order_details"].select("detail_id").collect())
    assert keys == list(range(1, len(keys) + 1))


def test_all_inputs_empty(spark):
    from ledgerloom.plans import validate as V
    ro, rp, rr = frames(spark, [], [], [])
    n = Normalizer(ro, rp, rr)
    tables = n.build()
    assert all(tables[name].count() == 0 for name in TABLE_ORDER)
    report = V.validation_report(tables, V.expected_counts_from_raw(n.raw_orders, rp, rr),
                                 V.expected_totals_from_raw(n.raw_orders))
    rows = {(r["check_group"], r["check_name"]): r["status"] for r in report.collect()}
    assert rows[("control_total", "sum_sales")] == "MISMATCH"
    assert rows[("row_count", "orders")] == "OK"
    assert not V.passed(report)


def test_strict_mode_stops_on_key_violations(spark):
    from ledgerloom.plans.normalize import KeyViolation
    ro, rp, rr = frames(spark)
    with pytest.raises(KeyViolation, match="lookup key"):
        Normalizer(ro, rp, rr, strict=True).build()
    clean_people = spark.createDataFrame([("Mia", "East"), ("Ned", "West")], RAW_PEOPLE_SCHEMA)
    clean = [ln for ln in EDGE_LINES if ln[1] not in ("O-9", "O-11", "O-14")]
    ro2, _, _ = frames(spark, lines=clean)
    tables = Normalizer(ro2, clean_people, rr, strict=True).build()
    assert tables["orders"].count() > 0
    bad_orders, _, _ = frames(spark, lines=clean + [line(order="O-1", od=D2)])
    with pytest.raises(KeyViolation, match="orders: primary key"):
        Normalizer(bad_orders, clean_people, rr, strict=True).build()


def test_flat_load_writes_and_keeps_first(spark, tmp_path):
    from ledgerloom.plans.normalize import flat_load
    people = spark.createDataFrame([("Mia", "East", 2), ("Ann", "East", 1), ("Ned", "West", 3)],
                                   "person string, region string, seq int")
    returns = spark.createDataFrame([("Yes", "O-1", 1), ("No", "O-1", 0)],
                                    "returned string, order_id string, seq int")
    ro, _, _ = frames(spark)
    out = flat_load(ro, people, returns, out_dir=str(tmp_path / "flat"))
    assert sorted(tuple(r) for r in out["people"].collect()) == [("Ann", "East"), ("Ned", "West")]
    assert [tuple(r) for r in out["returns"].collect()] == [("No", "O-1")]
    assert out["orders"].count() == len(EDGE_LINES)
    again = flat_load(ro, people, returns, out_dir=str(tmp_path / "flat"))
    assert again["people"].count() == 2


def test_store_overflow_stops_the_build(spark):
    """sales 123456789.5 does not fit decimal(12,4): the load fails instead of
    storing a wrong or NULL amount (ANSI cast)."""
    from pyspark.errors import PySparkException
    ro, rp, rr = frames(spark, lines=[line(), line(order="O-big", sales=123456789.5)])
    with pytest.raises(PySparkException):
        Normalizer(ro, rp, rr).build(["order_details"])


def test_hot_keys_on_the_shuffled_path(spark):
    """One order, one product and one exact copy each hold a third of the rows;
    with broadcasts off every lookup is a shuffled join. All nine tables still
    equal the plain SQL."""
    hot = [line(order="O-hot", pid="P-hot", pname="Hot", sales=float(i)) for i in range(200)]
    copies = [line(order="O-copy", pid="P-c", pname="Copy")] * 200
    rest = [line(order=f"O-{i % 40}", pid=f"P-{i % 13}", pname=f"N{i % 13}", sales=float(i),
                 cust=f"C-{i % 7}", region=("East", "West")[i % 2]) for i in range(200)]
    ro, rp, rr = frames(spark, lines=hot + copies + rest,
                        returns=[("Yes", "O-hot"), ("Yes", "O-copy"), ("Yes", "O-3")])
    confs = {BROADCAST_ROWS_CONF: "0", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        tables = Normalizer(ro, rp, rr, num_partitions=4).build()
        con = duck_with(ro, rp, rr)
        for name in TABLE_ORDER:
            assert spark_bag(tables[name]) == duck_bag(con, target_sql(name)), name
    finally:
        for k in confs:
            spark.conf.unset(k)


def test_failed_run_is_not_published_and_leaves_no_staging(spark):
    import os

    from ledgerloom.config import stage_path
    from ledgerloom.plans.normalize import KeyViolation
    from ledgerloom.plans.publish import current_run, run_and_publish
    ro, rp, rr = frames(spark)
    base = stage_path(spark, "warehouse-fail")
    with pytest.raises(KeyViolation):
        run_and_publish(ro, rp, rr, base, strict=True)
    assert current_run(spark, base) is None
    runs = os.path.join(base.replace("file:", ""), "runs")
    assert all(not os.path.exists(os.path.join(runs, r, "_staging")) for r in os.listdir(runs))
