"""Builders of the nine normalized tables.

Each builder takes DataFrames and returns a DataFrame in the table's declared
column order and types (``schemas.TABLES``). Dimensions are SELECT DISTINCT
plus a dense key; facts look natural keys up in their (already built)
parents. Where it gives the same rows, duplicates are removed on the raw
columns before a join rather than after it — Catalyst does not move a
DISTINCT below a LEFT JOIN by itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import write_stored
from ..functions.columns import postal_normalize, postal_or_default, to_store_decimal
from ..operators.dedup import distinct_rows
from ..operators.hotkeys import hot_hashes, key_hash, mostly_distinct
from ..operators.keymap import KeyMap
from ..operators.keys import dense_key
from ..operators.lookups import Lookup, lookup, lookup_distinct, lookup_rows
from ..schemas import DISCOUNT_TYPE, LINE_GRAIN, ORDER_GRAIN, PROFIT_TYPE, SALES_TYPE, TABLES


def conform_table(df: DataFrame, name: str) -> DataFrame:
    """Select the table's columns in declared order and types."""
    return df.select(*[F.col(c).cast(t).alias(c) for c, t in TABLES[name].columns])


def postal_key(raw: DataFrame) -> F.Column:
    """Text postal code as stored in Addresses and used as its lookup key."""
    if isinstance(raw.schema["postal_code"].dataType, T.StringType):
        return postal_or_default("postal_code")
    return postal_or_default(postal_normalize("postal_code"))


def number(df: DataFrame, name: str, num_partitions: int | None = None, stage_dir: str | None = None,
           known: KeyMap | None = None, repeated: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with the table's surrogate key: 1, 2, … in the key order, or the keys of
    earlier loads (``known``) and new ones after them. ``repeated`` as in ``dense_key``."""
    spec = TABLES[name]
    if known is not None:
        return known.number(df, spec.key_order, spec.surrogate, num_partitions, stage_dir=stage_dir, repeated=repeated)
    return dense_key(df, spec.key_order, spec.surrogate, num_partitions, stage_dir=stage_dir, repeated=repeated)


def keyed(df: DataFrame, name: str, num_partitions: int | None = None, stage_dir: str | None = None,
          known: KeyMap | None = None, repeated: tuple[str, ...] = ()) -> DataFrame:
    """Distinct rows of table ``name`` as the table: numbered, in declared types."""
    return conform_table(number(df, name, num_partitions, stage_dir, known, repeated), name)


# -- dimensions --------------------------------------------------------------

# The dimensions that are distinct tuples of the order rows.
DIMENSION_GRAINS = {
    "product": ("product_id", "category", "sub_category", "product_name"),
    "addresses": ("country", "city", "state", "postal_code"),
    "type_ship": ("ship_mode",),
    "customers": ("customer_id", "customer_name", "segment"),
}


def dimension_rows(raw: DataFrame) -> DataFrame:
    """The distinct tuples of all four dimensions from one scan: GROUPING SETS with a
    set for each dimension, named by ``grain``; columns of the others are NULL. Every
    row is expanded to four, which the partial aggregation collapses before the one
    shuffle."""
    cols = [c for grain in DIMENSION_GRAINS.values() for c in grain]
    rows = with_postal_key(raw).select(*cols)
    # grouping_id has a bit for each column that a set leaves out, the first column's highest
    ids = {name: sum(1 << (len(cols) - 1 - i) for i, c in enumerate(cols) if c not in grain)
           for name, grain in DIMENSION_GRAINS.items()}
    names = F.create_map(*[x for name, i in ids.items() for x in (F.lit(i).cast("bigint"), F.lit(name))])
    grouped = rows.groupingSets([[F.col(c) for c in grain] for grain in DIMENSION_GRAINS.values()], *cols)
    return grouped.agg(F.grouping_id().alias("_ll_set")).select(names[F.col("_ll_set").cast("bigint")].alias("grain"), *cols)


def stage_dimensions(raw: DataFrame, path: str) -> dict[str, DataFrame]:
    """``dimension_rows`` written once, a folder for each dimension; the dimensions'
    distinct rows as read from there."""
    rows = dimension_rows(raw)
    write_stored(rows, path, "grain")
    staged = raw.sparkSession.read.schema(rows.schema).parquet(path)
    return {name: staged.filter(F.col("grain") == name).select(*grain) for name, grain in DIMENSION_GRAINS.items()}


def distinct_product(raw: DataFrame) -> DataFrame:
    return distinct_rows(raw, ["product_id", "category", "sub_category", "product_name"])


def build_product(raw: DataFrame, num_partitions: int | None = None, stage_dir: str | None = None,
                  known: KeyMap | None = None) -> DataFrame:
    return keyed(distinct_product(raw), "product", num_partitions, stage_dir, known)


def distinct_addresses(raw: DataFrame) -> DataFrame:
    return raw.select("country", "city", "state", postal_key(raw).alias("postal_code")).distinct()


def build_addresses(raw: DataFrame, num_partitions: int | None = None, stage_dir: str | None = None,
                  known: KeyMap | None = None) -> DataFrame:
    return keyed(distinct_addresses(raw), "addresses", num_partitions, stage_dir, known)


def distinct_ship_mode(raw: DataFrame) -> DataFrame:
    return distinct_rows(raw, ["ship_mode"])


def build_ship_mode(raw: DataFrame, num_partitions: int | None = None, stage_dir: str | None = None,
                  known: KeyMap | None = None) -> DataFrame:
    return keyed(distinct_ship_mode(raw), "type_ship", num_partitions, stage_dir, known)


def distinct_people(raw_people: DataFrame) -> DataFrame:
    return distinct_rows(raw_people, ["person", "region"])


def build_people(raw_people: DataFrame, num_partitions: int | None = None, stage_dir: str | None = None,
                 known: KeyMap | None = None) -> DataFrame:
    return keyed(distinct_people(raw_people), "people", num_partitions, stage_dir, known)


def build_customers(raw: DataFrame) -> DataFrame:
    return conform_table(distinct_rows(raw, ["customer_id", "customer_name", "segment"]), "customers")


# -- lookups (natural key → surrogate key) -------------------------------------

def people_lookup(people: DataFrame) -> Lookup:
    return Lookup(people, ("region",), ("people_id",))


def ship_lookup(type_ship: DataFrame) -> Lookup:
    return Lookup(type_ship, ("ship_mode",), ("ship_id",))


def address_lookup(addresses: DataFrame) -> Lookup:
    return Lookup(addresses, ("country", "city", "state", "postal_code"), ("addresses_id",))


def product_lookup(product: DataFrame) -> Lookup:
    return Lookup(product, ("product_id", "product_name"), ("product_code",))


# -- facts ---------------------------------------------------------------------

def with_postal_key(raw: DataFrame) -> DataFrame:
    """Raw rows with the postal code in its stored text form (the lookup key)."""
    return raw.withColumn("postal_code", postal_key(raw))


def order_grain(raw: DataFrame) -> DataFrame:
    """Distinct raw rows at order grain (postal code in its stored text form)."""
    return with_postal_key(raw).select(*ORDER_GRAIN).distinct()


def build_orders(raw: DataFrame, people: DataFrame, type_ship: DataFrame,
                 addresses: DataFrame) -> DataFrame:
    """DISTINCT (order, date, manager, customer, ship mode, address) rows."""
    out = ["order_id", "order_date", "people_id", "customer_id", "ship_id", "addresses_id"]
    lookups = [people_lookup(people), ship_lookup(type_ship), address_lookup(addresses)]
    rows = lookup_distinct(with_postal_key(raw), lookups, out, pre=ORDER_GRAIN)
    return conform_table(rows, "orders")


def sort_orders(orders: DataFrame) -> DataFrame:
    """Presentation order (date, customer, order): range partitions in order, each
    sorted, so that reading them one after another gives the whole order and a
    filter on the date skips files."""
    order = ["order_date", "customer_id", "order_id"]
    return orders.repartitionByRange(*order).sortWithinPartitions(*order)


#: Share of the order lines from which one order and quantity, or one shipment, counts as hot.
HOT_LINES = 0.01


def build_date_ship(raw: DataFrame, type_ship: DataFrame, num_partitions: int | None = None,
                    stage_dir: str | None = None, known: KeyMap | None = None) -> DataFrame:
    """One row per distinct (ship mode, order, ship date); split shipments give
    several rows per order. Where most raw rows differ they are made distinct in the
    ranges of the key build, in one shuffle, as the order lines are; where many are
    alike, or one is hot, they collapse before it."""
    grain = ["ship_mode", "order_id", "ship_date"]
    rows = lookup_rows(raw, [ship_lookup(type_ship)], ["ship_id", "order_id", "ship_date"], pre=grain)
    if mostly_distinct(raw, grain, HOT_LINES):
        return keyed(rows, "date_ship", num_partitions, stage_dir, known, repeated=TABLES["date_ship"].key_order)
    return keyed(rows.distinct(), "date_ship", num_partitions, stage_dir, known)


def line_grain(raw: DataFrame) -> DataFrame:
    """Distinct raw order lines (money still as read, before the store cast)."""
    return raw.select(*LINE_GRAIN).distinct()


def build_order_details(raw: DataFrame, product: DataFrame, num_partitions: int | None = None,
                        stage_dir: str | None = None, known: KeyMap | None = None) -> DataFrame:
    """Distinct lines with their product code, numbered, then cast to the exact
    store types. The cast comes after DISTINCT: lines that differ only beyond
    the fourth decimal both survive (and both store the same value). The raw rows are
    hardly more than the lines, so they meet the products as they are: a DISTINCT before
    the lookup would shuffle them all once more. For the same reason they are made
    distinct in the ranges of the key build, unless an order and quantity has so many of
    the rows (hot copies) that they must collapse before a shuffle."""
    out = ["order_id", "product_code", "quantity", "sales", "discount", "profit"]
    rows = lookup_rows(raw, [product_lookup(product)], out)
    if hot_hashes(raw.select(key_hash(["order_id", "quantity"]).alias("line")), ["line"], HOT_LINES):
        return keyed(rows.distinct(), "order_details", num_partitions, stage_dir, known)
    return keyed(rows, "order_details", num_partitions, stage_dir, known, repeated=("order_id", "product_code", "quantity"))


def returned_orders(raw_returns: DataFrame) -> DataFrame:
    return raw_returns.select("returned", "order_id").distinct()


def return_rows(raw_returns: DataFrame, orders: DataFrame, order_details: DataFrame) -> DataFrame:
    """Distinct (returned, detail_id): every line of a returned order.

    (returned, order) pairs are made distinct first; since a detail belongs to
    one order, the joined (returned, detail) pairs are then distinct as well.
    The Orders hop is a semi join: Orders has one row per order. Over tables bucketed
    by order_id nothing is shuffled.
    """
    listed = returned_orders(raw_returns).join(orders.select("order_id"), "order_id", "left_semi")
    return listed.join(order_details.select("order_id", "detail_id"), "order_id", "inner").select("returned", "detail_id")


def build_returns(raw_returns: DataFrame, orders: DataFrame, order_details: DataFrame,
                  num_partitions: int | None = None, stage_dir: str | None = None,
                  known: KeyMap | None = None) -> DataFrame:
    """Every line of a returned order is a return; returns of unknown orders
    (or of orders without lines) are dropped."""
    return keyed(return_rows(raw_returns, orders, order_details), "returns", num_partitions, stage_dir, known)


def build_returns_unfiltered(raw_returns: DataFrame, order_details: DataFrame,
                             num_partitions: int | None = None,
                             stage_dir: str | None = None) -> DataFrame:
    """Draft variant: returns joined to details directly with no NOT NULL
    filter, so a return of an unknown order keeps one row with a NULL detail."""
    joined = lookup(returned_orders(raw_returns),
                    Lookup(order_details.select("order_id", "detail_id"), ("order_id",), ("detail_id",)))
    rows = joined.select("returned", "detail_id").distinct()
    return keyed(rows, "returns", num_partitions, stage_dir)


MONEY_TYPES = {"sales": SALES_TYPE, "discount": DISCOUNT_TYPE, "profit": PROFIT_TYPE}


def store_money(df: DataFrame) -> DataFrame:
    """Rows with the money columns cast to their exact store types."""
    return df.select(*[to_store_decimal(c, MONEY_TYPES[c]).alias(c) if c in MONEY_TYPES else F.col(c)
                       for c in df.columns])
