"""Denormalized sales view for BI, and the flagship aggregate over it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.bitmaps import with_membership
from ..operators.lookups import fits_broadcast, sized_broadcast
from ..schemas import TOTAL_TYPE
from .metrics import TableMetrics

SALES_VIEW_COLUMNS = (
    "detail_id", "order_id", "order_date", "customer_id", "customer_name", "segment",
    "country", "city", "state", "postal_code", "region", "person", "ship_mode",
    "product_code", "product_id", "category", "sub_category", "product_name",
    "quantity", "sales", "discount", "profit", "is_returned")


Metrics = Mapping[str, TableMetrics]


def with_returned_flag(details: DataFrame, returns: DataFrame) -> DataFrame:
    """Detail rows plus ``is_returned``, by bitmaps over the dense detail ids: a line
    listed under two ``returned`` values appears once without a DISTINCT of the
    returns, and the joined side is one row for 32 768 lines."""
    return with_membership(details, "detail_id", returns, "detail_id", "is_returned")


def _size(name: str, metrics: Metrics | None) -> tuple[int, int] | None:
    """Rows and bytes of table ``name`` gathered when it was written, if it was told."""
    return (metrics[name].rows, metrics[name].bytes) if metrics and name in metrics else None


def _dimension(tables: Mapping[str, DataFrame], name: str, metrics: Metrics | None, df: DataFrame | None = None) -> DataFrame:
    """The table, or columns ``df`` of it, with a broadcast hint if its size allows; the
    size is that gathered when it was written, or else measured."""
    return sized_broadcast(tables[name] if df is None else df, known=_size(name, metrics))


def sales_view(tables: Mapping[str, DataFrame], metrics: Metrics | None = None) -> DataFrame:
    """One row per order line with its order, customer, address, manager, ship
    mode, product and a returned flag.

    Lines meet orders in a shuffled join on ``order_id`` (both sides grow with
    the data; adaptive execution splits a hot order). Each dimension is
    broadcast when its known size allows (``metrics``; without them it is measured).
    One that is too large meets the orders before these meet the lines, of which there
    are several an order; the broadcast ones come last, so that no shuffle carries their
    columns.
    The returned flag is a bit test, so a line listed under two ``returned`` values
    still appears once. Ship dates are left out: an order may have several.
    """
    d, o = tables["order_details"], tables["orders"]
    orders = o.select(F.col("order_id").alias("_o_id"), "order_date",
                      F.col("customer_id").alias("_o_cust"), "people_id", "ship_id", "addresses_id")
    last = []
    for name, key, fk in (("customers", "customer_id", "_o_cust"), ("addresses", "addresses_id", "addresses_id"),
                          ("people", "people_id", "people_id"), ("type_ship", "ship_id", "ship_id")):
        dim = tables[name].withColumnRenamed(key, f"_dim_{key}")
        if fits_broadcast(dim, known=_size(name, metrics)):
            last.append((F.broadcast(dim), F.col(fk) == F.col(f"_dim_{key}")))
        else:
            orders = orders.join(dim, F.col(fk) == F.col(f"_dim_{key}"), "left").drop(f"_dim_{key}")
    prod = _dimension(tables, "product", metrics, tables["product"].withColumnRenamed("product_code", "_prod_code"))
    v = (with_returned_flag(d, tables["returns"]).join(orders, F.col("order_id") == F.col("_o_id"), "left").drop("_o_id")
         .join(prod, F.col("product_code") == F.col("_prod_code"), "left"))
    for dim, cond in last:
        v = v.join(dim, cond, "left")
    return v.select(*[F.col("_o_cust" if c == "customer_id" else c).alias(c) for c in SALES_VIEW_COLUMNS])


def sales_by_region_category(tables: Mapping[str, DataFrame], metrics: Metrics | None = None) -> DataFrame:
    """Lines, returned lines, sales and profit per manager region and product
    category.

    Only the tables that feed these columns are joined: details (with the
    returned flag), orders for the manager, people, product. Customers,
    addresses and ship modes would not change a figure but could cost a
    shuffle of the whole fact if one is too large to broadcast.
    """
    d = tables["order_details"].select("detail_id", "order_id", "product_code", "sales", "profit")
    lines = with_returned_flag(d, tables["returns"])
    orders = tables["orders"].select(F.col("order_id").alias("_o_id"), "people_id")
    ppl = _dimension(tables, "people", metrics, tables["people"].select(F.col("people_id").alias("_ppl_id"), "region"))
    prod = _dimension(tables, "product", metrics,
                      tables["product"].select(F.col("product_code").alias("_prod_code"), "category"))
    v = (lines.join(orders, F.col("order_id") == F.col("_o_id"), "left")
         .join(ppl, F.col("people_id") == F.col("_ppl_id"), "left")
         .join(prod, F.col("product_code") == F.col("_prod_code"), "left"))
    return v.groupBy("region", "category").agg(
        F.count(F.lit(1)).cast("bigint").alias("lines"),
        F.count_if(F.col("is_returned")).cast("bigint").alias("returned_lines"),
        F.sum("sales").cast(TOTAL_TYPE).alias("total_sales"),
        F.sum("profit").cast(TOTAL_TYPE).alias("total_profit"))
