"""Registered queries: one per operator of the inventory, over the test tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame. Raw inputs are
derived from the whole star-schema tables (``sources.fixtures``). The nine
normalized tables are built at most once per application and scale factor and
shared by the queries that read them (``built``); ``keyed_*`` entries build
their table afresh to exercise the key operator itself.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import stage_path
from .functions import columns as C
from .operators.dedup import keep_first
from .operators.keys import dense_key
from .operators.lookups import Lookup, lookup, lookup_distinct
from .plans import entities as E
from .plans import validate as V
from .plans.normalize import Normalizer, flat_load
from .plans.publish import current_run, read_tables, run_and_publish, table_counts
from .plans.views import sales_by_region_category, sales_view
from .schemas import ORDER_GRAIN, SOURCE_HEADERS, TABLE_ORDER
from .sources import fixtures
from .sources.readers import CSV_OPTIONS, clean_raw_orders, read_sheet, read_sheet_with_rejects

Query = Callable[[SparkSession, str], DataFrame]

_BUILT: dict[tuple[str, str], Normalizer] = {}


def built(spark: SparkSession, sf_dir: str) -> Normalizer:
    """Normalizer over the fixture raw inputs, shared within one application."""
    key = (spark.conf.get("spark.app.id", None) or str(id(spark)), sf_dir)
    if key not in _BUILT:
        ro, rp, rr = fixtures.raw_inputs(spark, sf_dir)
        _BUILT[key] = Normalizer(ro, rp, rr)
    return _BUILT[key]


def edge_built(spark: SparkSession, sf_dir: str) -> Normalizer:
    """Normalizer over the awkward variant of the inputs."""
    key = (spark.conf.get("spark.app.id", None) or str(id(spark)), f"{sf_dir} edge")
    if key not in _BUILT:
        _BUILT[key] = Normalizer(clean_raw_orders(fixtures.edge_orders(spark, sf_dir)),
                                 fixtures.edge_people_seq(spark, sf_dir).drop("seq"),
                                 fixtures.edge_returns_seq(spark, sf_dir).drop("seq"))
    return _BUILT[key]


def reset_built() -> None:
    _BUILT.clear()


def _tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return built(spark, sf_dir).build()


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return built(spark, sf_dir).raw_orders


# -- sources and column functions ----------------------------------------------

def scan_raw_orders(spark, sf):
    """Raw order lines conformed to the raw schema (NA markers, types). The
    optional ``row_id`` is left out: the source mapping has none and it feeds
    no table."""
    return clean_raw_orders(fixtures.raw_orders(spark, sf)).drop("row_id")


def scan_csv_sheets(spark, sf):
    """The raw orders sheet written as CSV under its source header names, then
    read back through the sheet reader (header mapping, NA markers, declared
    types)."""
    raw = fixtures.raw_orders(spark, sf).drop("row_id")
    source_names = {ours: theirs for theirs, ours in SOURCE_HEADERS.items()}
    path = stage_path(spark, "csv-sheet")
    raw.select(*[F.col(c).alias(source_names[c]) for c in raw.columns]) \
       .write.options(**CSV_OPTIONS).csv(path)
    return read_sheet(spark, path, "orders").drop("row_id")


def csv_with_rejects(spark, sf):
    """Damaged order rows written as CSV and read with rejects: every row, the bad ones
    with the columns that failed."""
    source_names = {ours: theirs for theirs, ours in SOURCE_HEADERS.items()}
    rows = fixtures.damaged_orders(spark, sf)
    path = stage_path(spark, "csv-damaged")
    rows.select(*[F.col(c).alias(source_names[c]) for c in rows.columns]).write.options(**CSV_OPTIONS).csv(path)
    good, bad = read_sheet_with_rejects(spark, path, "orders")
    shown = ["order_id", "product_id", "customer_name", "quantity", "order_date", "sales"]
    text = [F.col(c).cast("string").alias(c) for c in shown]
    day = F.date_format("order_date", "yyyy-MM-dd").alias("order_date")
    return (good.select(*[day if c == "order_date" else t for c, t in zip(shown, text)], F.lit("").alias("failed"))
            .unionByName(bad.select(*text, F.array_join("failed", ",").alias("failed"))))


def raw_counts(spark, sf):
    ro, rp, rr = fixtures.raw_inputs(spark, sf)
    return table_counts({"raw_orders": ro, "raw_people": rp, "raw_returns": rr})


def parse_locale_number(spark, sf):
    li = fixtures.table(spark, sf, "lineitem")
    text = F.translate(F.format_number("l_extendedprice", 2), ",.", " ,")
    return li.select("l_orderkey", "l_linenumber", text.alias("price_text"),
                     C.parse_locale_number(text).alias("price_parsed"))


def postal_normalize(spark, sf):
    cust = fixtures.table(spark, sf, "customer")
    mod = F.col("c_custkey") % 50
    postal = F.when(mod == 7, F.lit(None).cast("double")).otherwise((mod * 1999).cast("double"))
    return cust.select(F.concat(F.lit("C-"), F.col("c_custkey").cast("string")).alias("customer_id"),
                       postal.alias("postal_code"), C.postal_normalize(postal).alias("postal_norm"))


def parse_dates(spark, sf):
    li = fixtures.table(spark, sf, "lineitem")
    text = C.format_timestamp("l_shipdate")
    return li.select("l_orderkey", "l_linenumber", text.alias("ship_date_text"),
                     C.parse_timestamp(text, "yyyy-MM-dd HH:mm:ss").alias("ship_date_parsed"))


def format_dates(spark, sf):
    o = fixtures.table(spark, sf, "orders")
    return o.select(F.concat(F.lit("O-"), F.col("o_orderkey").cast("string")).alias("order_id"),
                    C.format_timestamp("o_orderdate").alias("order_date_text"))


def null_sentinels(spark, sf):
    t = built(spark, sf)
    pre = t.raw_orders.select("order_id", "product_id", "product_name",
                              C.sentinel("region").alias("region_key")).distinct()
    joined = lookup(pre, E.product_lookup(t.table("product")))
    return joined.select("order_id", "product_id", "product_name", "region_key",
                         C.sentinel("product_code").alias("product_code_text"))


def decimal_cast(spark, sf):
    return E.store_money(E.line_grain(_raw(spark, sf)))


# -- dimensions (natural attributes) and keyed tables ----------------------------

def dim_product(spark, sf):
    return built(spark, sf).grains["product"]


def dim_addresses(spark, sf):
    return built(spark, sf).grains["addresses"]


def dim_ship_mode(spark, sf):
    return built(spark, sf).grains["type_ship"]


def dim_people(spark, sf):
    return E.distinct_people(fixtures.raw_people(spark, sf))


def dim_customers(spark, sf):
    return built(spark, sf).grains["customers"]


def keyed_product(spark, sf):
    return E.build_product(_raw(spark, sf))


def keyed_addresses(spark, sf):
    return E.build_addresses(_raw(spark, sf))


def keyed_ship_mode(spark, sf):
    return E.build_ship_mode(_raw(spark, sf))


def keyed_people(spark, sf):
    return E.build_people(fixtures.raw_people(spark, sf))


def keyed_order_details(spark, sf):
    t = built(spark, sf)
    return E.build_order_details(t.raw_orders, t.table("product"))


def keyed_date_ship(spark, sf):
    t = built(spark, sf)
    return E.build_date_ship(t.raw_orders, t.table("type_ship"))


def keyed_returns(spark, sf):
    t = built(spark, sf)
    return E.build_returns(t.raw_returns, t.table("orders"), t.table("order_details"))


# -- lookups ---------------------------------------------------------------------

def lookup_people(spark, sf):
    t = built(spark, sf)
    pre = t.raw_orders.select("order_id", "region").distinct()
    return lookup(pre, E.people_lookup(t.table("people")))


def lookup_ship_mode(spark, sf):
    t = built(spark, sf)
    pre = t.raw_orders.select("order_id", "ship_mode").distinct()
    return lookup(pre, E.ship_lookup(t.table("type_ship")))


def lookup_addresses(spark, sf):
    t = built(spark, sf)
    raw = t.raw_orders
    pre = raw.select("order_id", "country", "city", "state",
                     E.postal_key(raw).alias("postal_code")).distinct()
    return lookup(pre, E.address_lookup(t.table("addresses")))


def lookup_product(spark, sf):
    t = built(spark, sf)
    pre = t.raw_orders.select("product_id", "product_name").distinct()
    return lookup(pre, E.product_lookup(t.table("product")))


# -- facts -----------------------------------------------------------------------

def fact_orders(spark, sf):
    return _tables(spark, sf)["orders"]


def fact_date_ship(spark, sf):
    return _tables(spark, sf)["date_ship"]


def fact_order_details(spark, sf):
    return _tables(spark, sf)["order_details"]


def fact_returns(spark, sf):
    return _tables(spark, sf)["returns"]


def returns_unfiltered(spark, sf):
    t = built(spark, sf)
    return E.build_returns_unfiltered(t.raw_returns, t.table("order_details"))


def orders_sorted(spark, sf):
    """Orders in presentation order, with the place that order gives them."""
    return dense_key(_tables(spark, sf)["orders"], ["order_date", "customer_id", "order_id"], "place")


def flat_orders(spark, sf):
    """The flat orders table in its written form."""
    loaded = flat_load(fixtures.raw_orders(spark, sf), fixtures.raw_people_seq(spark, sf),
                       fixtures.raw_returns(spark, sf, with_seq=True), out_dir=stage_path(spark, "flat"))
    return loaded["orders"].drop("row_id")


def flat_people(spark, sf):
    people = fixtures.raw_people_seq(spark, sf)
    return keep_first(people, ["region"], "seq", ["person", "region"])


def flat_returns(spark, sf):
    loaded = flat_load(fixtures.raw_orders(spark, sf), fixtures.raw_people_seq(spark, sf),
                       fixtures.raw_returns(spark, sf, with_seq=True))
    return loaded["returns"]


def sink_roundtrip(spark, sf):
    """Build, write, validate and publish a run; then read the published tables
    back through the manifest: every row of every table as text."""
    ro, rp, rr = fixtures.raw_inputs(spark, sf)
    base = stage_path(spark, "warehouse")
    result = run_and_publish(ro, rp, rr, base)
    run_dir = current_run(spark, base)
    if not result.published or run_dir is None:
        raise RuntimeError(f"run {result.run_dir} failed validation and was not published")
    frames = [t.select(F.lit(name).alias("table_name"), F.concat_ws("|", *(F.col(c).cast("string") for c in t.columns))
                       .alias("row_text")) for name, t in read_tables(spark, run_dir).items()]
    return reduce(DataFrame.unionByName, frames)


# -- checks ------------------------------------------------------------------------

def _expected(spark, sf):
    t = built(spark, sf)
    return V.expected_from_raw(t.raw_orders, t.raw_people, t.raw_returns)


def check_pk_unique(spark, sf):
    return V.check_pk_unique(_tables(spark, sf))


def check_lookup_unique(spark, sf):
    return V.check_lookup_unique(_tables(spark, sf))


def check_fk_orphans(spark, sf):
    return V.check_fk_orphans(_tables(spark, sf))


def check_row_counts(spark, sf):
    t = built(spark, sf)
    return V.check_row_counts(_tables(spark, sf), V.expected_counts_from_raw(t.raw_orders, t.raw_people, t.raw_returns))


def check_control_totals(spark, sf):
    sums = V.expected_totals_from_raw(built(spark, sf).raw_orders)
    return V.check_control_totals(_tables(spark, sf)["order_details"], sums)


def validation_report(spark, sf):
    """The report of the built tables, with the figures gathered while writing them."""
    rows, sums = _expected(spark, sf)
    tables = _tables(spark, sf)
    return V.validation_report(tables, rows, sums, built(spark, sf).metrics)


def validation_report_scanned(spark, sf):
    """The same report with every figure taken from the tables again."""
    rows, sums = _expected(spark, sf)
    return V.validation_report(_tables(spark, sf), rows, sums)


def write_metrics(spark, sf):
    """Rows, NULL foreign keys and decimal sums of every table, observed by the jobs
    that write them, from the run's journal."""
    t = built(spark, sf)
    t.build()
    return t.journal.frame()


def edge_write_metrics(spark, sf):
    t = edge_built(spark, sf)
    t.build()
    return t.journal.frame()


def resumed_load(spark, sf):
    """A load that ended after four tables, finished by a second one on the same
    folder: rows by table, and how many tables the second wrote."""
    ro, rp, rr = fixtures.raw_inputs(spark, sf)
    run_dir = stage_path(spark, "resumed")
    first = Normalizer(ro, rp, rr, run_dir=run_dir)
    first.build(TABLE_ORDER[:4])
    second = Normalizer(ro, rp, rr, run_dir=run_dir, resume=True)
    counts = table_counts(second.build())
    second.cleanup_staging()
    return counts.withColumn("taken_up", F.col("table_name").isin(second.resumed)) \
                 .withColumn("tables_written", F.lit(len(second.written)))


# -- the operators over awkward rows -------------------------------------------------

def edge_table(name: str) -> Query:
    def query(spark, sf):
        return edge_built(spark, sf).table(name)
    return query


def edge_scan(spark, sf):
    return clean_raw_orders(fixtures.edge_orders(spark, sf)).drop("row_id")


def edge_null_sentinels(spark, sf):
    t = edge_built(spark, sf)
    pre = t.raw_orders.select("order_id", "product_id", "product_name",
                              C.sentinel("region").alias("region_key")).distinct()
    return (lookup(pre, E.product_lookup(t.table("product")))
            .select("order_id", "product_id", "product_name", "region_key",
                    C.sentinel("product_code").alias("product_code_text")))


def edge_postal(spark, sf):
    return fixtures.edge_orders(spark, sf).select(
        "customer_id", "postal_code", C.postal_normalize("postal_code").alias("postal_norm")).distinct()


def edge_returns_unfiltered(spark, sf):
    t = edge_built(spark, sf)
    return E.build_returns_unfiltered(t.raw_returns, t.table("order_details"))


def edge_flat_people(spark, sf):
    return keep_first(fixtures.edge_people_seq(spark, sf), ["region"], "seq", ["person", "region"])


def edge_flat_returns(spark, sf):
    return keep_first(fixtures.edge_returns_seq(spark, sf), ["order_id"], "seq", ["returned", "order_id"])


def _damaged(spark, sf) -> dict[str, DataFrame]:
    """The awkward tables with parents missing and keys repeated."""
    t = dict(edge_built(spark, sf).build())
    product, detail = t["product"], t["order_details"]
    t["product"] = product.filter("product_code % 7 <> 0")
    t["order_details"] = detail.unionByName(detail.filter("detail_id % 50 = 0"))
    return t


def edge_check_pk_unique(spark, sf):
    return V.check_pk_unique(_damaged(spark, sf))


def edge_check_lookup_unique(spark, sf):
    return V.check_lookup_unique(_damaged(spark, sf))


def edge_check_fk_orphans(spark, sf):
    return V.check_fk_orphans(_damaged(spark, sf))


def edge_check_row_counts(spark, sf):
    t = edge_built(spark, sf)
    return V.check_row_counts(_damaged(spark, sf),
                              V.expected_counts_from_raw(t.raw_orders, t.raw_people, t.raw_returns))


def edge_sales_view(spark, sf):
    t = edge_built(spark, sf)
    return sales_view(t.build(), t.metrics)


# -- facts stored by order_id ----------------------------------------------------------

def colocated(spark: SparkSession, sf: str) -> Normalizer:
    """Normalizer over the awkward rows with orders, lines and returned orders bucketed."""
    key = (spark.conf.get("spark.app.id", None) or str(id(spark)), f"{sf} bucketed")
    if key not in _BUILT:
        _BUILT[key] = Normalizer(clean_raw_orders(fixtures.edge_orders(spark, sf)),
                                 fixtures.edge_people_seq(spark, sf).drop("seq"),
                                 fixtures.edge_returns_seq(spark, sf).drop("seq"),
                                 buckets=int(spark.conf.get("spark.sql.shuffle.partitions")))
    return _BUILT[key]


def colocated_returns(spark, sf):
    return colocated(spark, sf).table("returns")


def colocated_sales_view(spark, sf):
    t = colocated(spark, sf)
    return sales_view(t.build(), t.metrics)


# -- a second load that keeps the keys of the first ------------------------------------

def second_load(table: str) -> Query:
    """``table`` of a load of the awkward rows after one of the clean rows, both on
    the same key maps."""
    def query(spark, sf):
        key = (spark.conf.get("spark.app.id", None) or str(id(spark)), f"{sf} second load")
        if key not in _BUILT:
            keys = stage_path(spark, "keys")
            first = Normalizer(*fixtures.raw_inputs(spark, sf), key_dir=keys)
            first.build(SECOND_LOAD)
            first.cleanup_staging()
            _BUILT[key] = Normalizer(clean_raw_orders(fixtures.edge_orders(spark, sf)),
                                     fixtures.edge_people_seq(spark, sf).drop("seq"),
                                     fixtures.edge_returns_seq(spark, sf).drop("seq"), key_dir=keys)
        return _BUILT[key].table(table)
    return query


SECOND_LOAD = ("product", "addresses", "type_ship", "people", "order_details")


# -- lookups with no dimension small enough to broadcast -------------------------------

def _shuffled(*lookups: Lookup) -> list[Lookup]:
    return [replace(lk, broadcast_rows=-1) for lk in lookups]


def lookup_product_shuffled(spark, sf):
    t = edge_built(spark, sf)
    pre = t.raw_orders.select("product_id", "product_name").distinct()
    return lookup(pre, *_shuffled(E.product_lookup(t.table("product"))))


def lookup_product_hot(spark, sf):
    """Lines of which a third name one product: the hot product is joined apart."""
    t = built(spark, sf)
    path = stage_path(spark, "hot-lines")
    fixtures.hot_lines(spark, sf).write.parquet(path)
    lk = replace(E.product_lookup(t.table("product")), broadcast_rows=-1, hot_share=0.05)
    return lookup(spark.read.parquet(path), lk)


def fact_orders_shuffled(spark, sf):
    t = edge_built(spark, sf)
    out = ["order_id", "order_date", "people_id", "customer_id", "ship_id", "addresses_id"]
    lookups = _shuffled(E.people_lookup(t.table("people")), E.ship_lookup(t.table("type_ship")),
                        E.address_lookup(t.table("addresses")))
    return lookup_distinct(E.with_postal_key(t.raw_orders), lookups, out, pre=ORDER_GRAIN)


def fact_order_details_shuffled(spark, sf):
    t = edge_built(spark, sf)
    out = ["order_id", "product_code", "quantity", "sales", "discount", "profit"]
    return lookup_distinct(t.raw_orders, _shuffled(E.product_lookup(t.table("product"))), out)


# -- views -------------------------------------------------------------------------

def sales_view_query(spark, sf):
    return sales_view(_tables(spark, sf), built(spark, sf).metrics)


def sales_by_region_category_query(spark, sf):
    return sales_by_region_category(_tables(spark, sf), built(spark, sf).metrics)


_BUILDERS: dict[str, Query] = {
    "scan_raw_orders": scan_raw_orders,
    "scan_csv_sheets": scan_csv_sheets,
    "csv_with_rejects": csv_with_rejects,
    "raw_counts": raw_counts,
    "parse_locale_number": parse_locale_number,
    "postal_normalize": postal_normalize,
    "parse_dates": parse_dates,
    "format_dates": format_dates,
    "null_sentinels": null_sentinels,
    "decimal_cast": decimal_cast,
    "dim_product": dim_product,
    "dim_addresses": dim_addresses,
    "dim_ship_mode": dim_ship_mode,
    "dim_people": dim_people,
    "dim_customers": dim_customers,
    "keyed_product": keyed_product,
    "keyed_addresses": keyed_addresses,
    "keyed_ship_mode": keyed_ship_mode,
    "keyed_people": keyed_people,
    "keyed_order_details": keyed_order_details,
    "keyed_date_ship": keyed_date_ship,
    "keyed_returns": keyed_returns,
    "lookup_people": lookup_people,
    "lookup_ship_mode": lookup_ship_mode,
    "lookup_addresses": lookup_addresses,
    "lookup_product": lookup_product,
    "fact_orders": fact_orders,
    "fact_date_ship": fact_date_ship,
    "fact_order_details": fact_order_details,
    "fact_returns": fact_returns,
    "returns_unfiltered": returns_unfiltered,
    "orders_sorted": orders_sorted,
    "flat_orders": flat_orders,
    "flat_people": flat_people,
    "flat_returns": flat_returns,
    "sink_roundtrip": sink_roundtrip,
    "check_pk_unique": check_pk_unique,
    "check_lookup_unique": check_lookup_unique,
    "check_fk_orphans": check_fk_orphans,
    "check_row_counts": check_row_counts,
    "check_control_totals": check_control_totals,
    "validation_report": validation_report,
    "validation_report_scanned": validation_report_scanned,
    "write_metrics": write_metrics,
    "edge_write_metrics": edge_write_metrics,
    "resumed_load": resumed_load,
    "edge_scan": edge_scan,
    "edge_null_sentinels": edge_null_sentinels,
    "edge_postal": edge_postal,
    **{f"edge_{name}": edge_table(name) for name in TABLE_ORDER},
    "edge_returns_unfiltered": edge_returns_unfiltered,
    "edge_flat_people": edge_flat_people,
    "edge_flat_returns": edge_flat_returns,
    "edge_check_pk_unique": edge_check_pk_unique,
    "edge_check_lookup_unique": edge_check_lookup_unique,
    "edge_check_fk_orphans": edge_check_fk_orphans,
    "edge_check_row_counts": edge_check_row_counts,
    "edge_sales_view": edge_sales_view,
    "colocated_returns": colocated_returns,
    "colocated_sales_view": colocated_sales_view,
    **{f"second_load_{name}": second_load(name) for name in SECOND_LOAD},
    "lookup_product_shuffled": lookup_product_shuffled,
    "lookup_product_hot": lookup_product_hot,
    "fact_orders_shuffled": fact_orders_shuffled,
    "fact_order_details_shuffled": fact_order_details_shuffled,
    "sales_view": sales_view_query,
    "sales_by_region_category": sales_by_region_category_query,
}


# Columns each query result hands out as DOUBLE. The stored tables keep their
# exact types; the cast happens after all arithmetic, in the Spark result and
# in its oracle SQL alike, so a comparison by value does not depend on how a
# client library converts them. Decimals come out as Decimal objects from one
# engine and floats from the other; an integer column holding NULLs comes out
# as float from one and as a nullable integer from the other. Doubles hold
# integers below 2**53 exactly, and four decimals up to about 9 * 10**11, which
# covers single prices; the exact totals are compared inside both engines
# (check_control_totals).
MONEY = ("sales", "discount", "profit")
REPORT = ("expected", "actual")
DECIMAL_OUTPUTS: dict[str, tuple[str, ...]] = {
    "decimal_cast": MONEY,
    "keyed_order_details": MONEY,
    "fact_order_details": MONEY,
    "sales_view": MONEY,
    "sales_by_region_category": ("total_sales", "total_profit"),
    "check_pk_unique": REPORT,
    "check_lookup_unique": REPORT,
    "check_fk_orphans": REPORT,
    "check_row_counts": REPORT,
    "check_control_totals": REPORT,
    "validation_report": REPORT,
    "validation_report_scanned": REPORT,
    "write_metrics": ("value",),
    "edge_write_metrics": ("value",),
    "returns_unfiltered": ("detail_id",),   # NULL for a return of an unknown order
    "edge_orders": ("people_id", "ship_id", "addresses_id"),
    "edge_date_ship": ("ship_id",),
    "edge_order_details": ("product_code", *MONEY),
    "edge_returns_unfiltered": ("detail_id",),
    "edge_check_pk_unique": REPORT,
    "edge_check_lookup_unique": REPORT,
    "edge_check_fk_orphans": REPORT,
    "edge_check_row_counts": REPORT,
    "edge_sales_view": ("product_code", *MONEY),
    "colocated_sales_view": ("product_code", *MONEY),
    "lookup_product_hot": ("product_code",),
    "second_load_order_details": ("product_code", *MONEY),
    "lookup_product_shuffled": ("product_code",),
    "fact_orders_shuffled": ("people_id", "ship_id", "addresses_id"),
    "fact_order_details_shuffled": ("product_code",),
}


def as_double(df: DataFrame, cols: tuple[str, ...]) -> DataFrame:
    return df.select(*[F.col(c).cast("double").alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def _registered(name: str, fn: Query) -> Query:
    cols = DECIMAL_OUTPUTS.get(name)
    if not cols:
        return fn

    def query(spark: SparkSession, sf: str) -> DataFrame:
        return as_double(fn(spark, sf), cols)

    query.__name__ = fn.__name__
    query.__doc__ = fn.__doc__
    return query


QUERIES: dict[str, Query] = {name: _registered(name, fn) for name, fn in _BUILDERS.items()}
