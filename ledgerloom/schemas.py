"""Declarative spec of the raw inputs and the nine normalized tables.

One place holds column names and types, the surrogate-key orderings, primary
keys, foreign keys and the lookup keys; builders and checks read from here.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Raw (flat) inputs
# ---------------------------------------------------------------------------

RAW_ORDERS_SCHEMA = T.StructType([
    T.StructField("row_id", T.LongType()),
    T.StructField("order_id", T.StringType()),
    T.StructField("order_date", T.TimestampNTZType()),
    T.StructField("ship_date", T.TimestampNTZType()),
    T.StructField("ship_mode", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("customer_name", T.StringType()),
    T.StructField("segment", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("postal_code", T.DoubleType()),
    T.StructField("region", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("sub_category", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("sales", T.DoubleType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("discount", T.DoubleType()),
    T.StructField("profit", T.DoubleType()),
])

RAW_PEOPLE_SCHEMA = T.StructType([
    T.StructField("person", T.StringType()),
    T.StructField("region", T.StringType()),
])

RAW_RETURNS_SCHEMA = T.StructType([
    T.StructField("returned", T.StringType()),
    T.StructField("order_id", T.StringType()),
])

# Header names of the source sheets, mapped to our column names.
SOURCE_HEADERS = {
    "Row ID": "row_id",
    "Order ID": "order_id",
    "Order Date": "order_date",
    "Ship Date": "ship_date",
    "Ship Mode": "ship_mode",
    "Customer ID": "customer_id",
    "Customer Name": "customer_name",
    "Segment": "segment",
    "Country/Region": "country",
    "City": "city",
    "State": "state",
    "Postal Code": "postal_code",
    "Region": "region",
    "Product ID": "product_id",
    "Category": "category",
    "Sub-Category": "sub_category",
    "Product Name": "product_name",
    "Sales": "sales",
    "Quantity": "quantity",
    "Discount": "discount",
    "Profit": "profit",
    "Person": "person",
    "Returned": "returned",
}

# The text cells pandas reads as missing by default.
NA_MARKERS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
              "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
              "n/a", "nan", "null")

# Default for a missing postal code and its width.
POSTAL_DEFAULT = "00000"
POSTAL_WIDTH = 5

# Store types of the money columns.
SALES_TYPE = "decimal(12,4)"
DISCOUNT_TYPE = "decimal(6,4)"
PROFIT_TYPE = "decimal(12,4)"
TOTAL_TYPE = "decimal(38,4)"

# ---------------------------------------------------------------------------
# Normalized model
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: tuple[tuple[str, str], ...]          # (name, Spark SQL type), output order
    primary_key: tuple[str, ...]
    surrogate: str | None = None                  # generated key column, if any
    key_order: tuple[str, ...] = ()               # total order that numbers the key
    lookup_key: tuple[str, ...] = ()              # natural key used by lookups
    parents: tuple[str, ...] = field(default=())  # tables that must be built first

    @property
    def column_names(self) -> list[str]:
        return [c for c, _ in self.columns]


TABLES: dict[str, TableSpec] = {t.name: t for t in [
    TableSpec("product",
              (("product_code", "bigint"), ("product_id", "string"), ("category", "string"),
               ("sub_category", "string"), ("product_name", "string")),
              primary_key=("product_code",), surrogate="product_code",
              key_order=("product_id", "product_name", "category", "sub_category"),
              lookup_key=("product_id", "product_name")),
    TableSpec("addresses",
              (("addresses_id", "bigint"), ("country", "string"), ("city", "string"),
               ("state", "string"), ("postal_code", "string")),
              primary_key=("addresses_id",), surrogate="addresses_id",
              key_order=("country", "state", "city", "postal_code"),
              lookup_key=("country", "city", "state", "postal_code")),
    TableSpec("type_ship",
              (("ship_id", "bigint"), ("ship_mode", "string")),
              primary_key=("ship_id",), surrogate="ship_id",
              key_order=("ship_mode",), lookup_key=("ship_mode",)),
    TableSpec("people",
              (("people_id", "bigint"), ("person", "string"), ("region", "string")),
              primary_key=("people_id",), surrogate="people_id",
              key_order=("region", "person"), lookup_key=("region",)),
    TableSpec("customers",
              (("customer_id", "string"), ("customer_name", "string"), ("segment", "string")),
              primary_key=("customer_id",)),
    TableSpec("orders",
              (("order_id", "string"), ("order_date", "timestamp_ntz"), ("people_id", "bigint"),
               ("customer_id", "string"), ("ship_id", "bigint"), ("addresses_id", "bigint")),
              primary_key=("order_id",),
              parents=("people", "customers", "type_ship", "addresses")),
    TableSpec("date_ship",
              (("date_ship_id", "bigint"), ("ship_id", "bigint"), ("order_id", "string"),
               ("ship_date", "timestamp_ntz")),
              primary_key=("date_ship_id",), surrogate="date_ship_id",
              key_order=("order_id", "ship_date", "ship_id"),
              parents=("type_ship", "orders")),
    TableSpec("order_details",
              (("detail_id", "bigint"), ("order_id", "string"), ("product_code", "bigint"),
               ("quantity", "int"), ("sales", SALES_TYPE), ("discount", DISCOUNT_TYPE),
               ("profit", PROFIT_TYPE)),
              primary_key=("detail_id",), surrogate="detail_id",
              key_order=("order_id", "product_code", "quantity", "sales", "discount", "profit"),
              parents=("orders", "product")),
    TableSpec("returns",
              (("return_id", "bigint"), ("returned", "string"), ("detail_id", "bigint")),
              primary_key=("return_id",), surrogate="return_id",
              key_order=("detail_id", "returned"),
              parents=("order_details",)),
]}

# Build (and write) order: parents before children.
TABLE_ORDER = ("product", "addresses", "type_ship", "people", "customers",
               "orders", "date_ship", "order_details", "returns")


@dataclass(frozen=True)
class ForeignKey:
    child: str
    column: str
    parent: str
    parent_column: str

    @property
    def name(self) -> str:
        return f"{self.child}.{self.column} -> {self.parent}"


FOREIGN_KEYS = (
    ForeignKey("orders", "people_id", "people", "people_id"),
    ForeignKey("orders", "customer_id", "customers", "customer_id"),
    ForeignKey("orders", "ship_id", "type_ship", "ship_id"),
    ForeignKey("orders", "addresses_id", "addresses", "addresses_id"),
    ForeignKey("date_ship", "ship_id", "type_ship", "ship_id"),
    ForeignKey("date_ship", "order_id", "orders", "order_id"),
    ForeignKey("order_details", "order_id", "orders", "order_id"),
    ForeignKey("order_details", "product_code", "product", "product_code"),
    ForeignKey("returns", "detail_id", "order_details", "detail_id"),
)

# Dimensions looked up by natural key while building facts (fan-out guard).
LOOKUP_TABLES = ("people", "type_ship", "addresses", "product")

# Raw columns at order grain (one value per order when the data is clean).
ORDER_GRAIN = ("order_id", "order_date", "region", "customer_id", "ship_mode",
               "country", "city", "state", "postal_code")

# Raw columns that identify one order line (row_id and ship_date excluded).
LINE_GRAIN = ("order_id", "product_id", "product_name", "quantity", "sales", "discount", "profit")

# The reference's expectations for its source workbook (row
# counts of the nine tables, control totals of sales and profit, tolerance).
SOURCE_WORKBOOK_ROWS = {
    "product": 1894,
    "people": 4,
    "type_ship": 4,
    "addresses": 632,
    "customers": 793,
    "orders": 5009,
    "date_ship": 5009,
    "order_details": 9993,
    "returns": 800,
}
SOURCE_WORKBOOK_SALES = 2296919.49
SOURCE_WORKBOOK_PROFIT = 286409.08
CONTROL_TOLERANCE = 1.0
