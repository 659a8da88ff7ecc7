"""Flat raw inputs derived from the star-schema test tables.

The given tables (lineitem, orders, customer, nation, region, part) are joined
into the flat shape of the raw sales rows; the mapping (see FIXTURES.md §2) is
fixed, so the DuckDB oracle builds the very same rows. Everything is a lazy
DataFrame over the whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import spread
from ..schemas import RAW_ORDERS_SCHEMA


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _text(c) -> F.Column:
    return c.cast("string")


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order line, with exact duplicates of the lines of every
    hundredth order injected (the flat source has such duplicates)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_shipdate")
    lines = spread(li.unionByName(li.filter(F.col("l_orderkey") % 100 == 0)))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate",
                                                   "o_orderpriority")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey",
                                                       "c_mktsegment")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")

    # customers meet the orders, not the lines, and the names of nations and regions come
    # last: where a table is too large to broadcast, few and narrow rows are shuffled
    headers = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
    flat = (lines.join(headers, F.col("l_orderkey") == F.col("o_orderkey"), "left")
            .join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left"))

    cust_mod = F.col("c_custkey") % 50
    out = flat.select(
        F.lit(None).cast("bigint").alias("row_id"),
        F.concat(F.lit("O-"), _text(F.col("l_orderkey"))).alias("order_id"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("order_date"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("ship_date"),
        F.col("o_orderpriority").alias("ship_mode"),
        F.concat(F.lit("C-"), _text(F.col("c_custkey"))).alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("segment"),
        F.col("n_name").alias("country"),
        F.concat(F.lit("City "), _text(cust_mod)).alias("city"),
        F.concat(F.lit("State "), _text(F.col("c_custkey") % 10)).alias("state"),
        F.when(cust_mod == 7, F.lit(None).cast("double"))
         .otherwise((cust_mod * 1999).cast("double")).alias("postal_code"),
        F.col("r_name").alias("region"),
        F.concat(F.lit("P-"), _text(F.col("p_partkey") - F.col("p_partkey") % 2)).alias("product_id"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("sub_category"),
        F.concat(F.col("p_name"), F.lit(" #"), _text(F.col("p_partkey"))).alias("product_name"),
        F.col("l_extendedprice").alias("sales"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_discount").alias("discount"),
        F.round(F.col("l_extendedprice") * (F.lit(0.05) - F.col("l_discount")), 4).alias("profit"),
    )
    return out.select(*[F.col(f.name).cast(f.dataType) for f in RAW_ORDERS_SCHEMA.fields])


def raw_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One manager per region."""
    return table(spark, sf_dir, "region").select(
        F.concat(F.lit("Manager "), _text(F.col("r_regionkey"))).alias("person"),
        F.col("r_name").alias("region"))


def raw_people_seq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """People rows with their sheet position (for keep-first)."""
    return table(spark, sf_dir, "region").select(
        F.concat(F.lit("Manager "), _text(F.col("r_regionkey"))).alias("person"),
        F.col("r_name").alias("region"),
        F.col("r_regionkey").cast("bigint").alias("seq"))


def raw_returns(spark: SparkSession, sf_dir: str, with_seq: bool = False) -> DataFrame:
    """One 'Yes' row per returned line (an order with several has duplicates)
    plus one return of an order that does not exist."""
    li = table(spark, sf_dir, "lineitem")
    rows = li.filter(F.col("l_returnflag") == "R").select(
        F.lit("Yes").alias("returned"),
        F.concat(F.lit("O-"), _text(F.col("l_orderkey"))).alias("order_id"),
        (F.col("l_orderkey") * 1000 + F.col("l_linenumber")).cast("bigint").alias("seq"))
    # read from a table, so that the plan keeps an equi-join on order_id
    region = table(spark, sf_dir, "region")
    orphan = region.filter(F.col("r_regionkey") == 0).select(
        F.lit("Yes").alias("returned"),
        F.concat(F.lit("O-none-"), _text(F.col("r_regionkey"))).alias("order_id"),
        F.lit(-1).cast("bigint").alias("seq"))
    out = rows.unionByName(orphan)
    return out if with_seq else out.drop("seq")


# -- awkward variant -------------------------------------------------------------
# The same whole tables with the cases that clean rows lack: NULL and unknown
# regions, missing-marker text, NULL names and cities, long, fractional and
# negative postal codes, prices beyond four decimals, several people per region
# and several values of ``returned``.

def _number(c: str) -> F.Column:
    return F.substring(F.col(c), 3, 18).cast("bigint")


def edge_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_orders(spark, sf_dir)
    order, customer, product = _number("order_id"), _number("customer_id"), _number("product_id")
    price = F.when(F.col("quantity") % 2 == 0, F.col("sales") + F.lit(0.00003)).otherwise(F.col("sales"))
    edits = {
        "region": F.when(customer % 11 == 0, None).when(customer % 13 == 0, "Nowhere").otherwise(F.col("region")),
        "city": F.when(customer % 17 == 0, None).otherwise(F.col("city")),
        "ship_mode": F.when(order % 23 == 0, "N/A").when(order % 29 == 0, "").otherwise(F.col("ship_mode")),
        "product_name": F.when(product % 20 == 0, None).otherwise(F.col("product_name")),
        "postal_code": F.when(customer % 50 == 9, 123456.0).when(customer % 50 == 11, F.col("postal_code") + F.lit(0.9))
                        .when(customer % 50 == 12, -42.0).otherwise(F.col("postal_code")),
        "sales": price,
    }
    return raw.select(*[edits.get(c, F.col(c)).alias(c) for c in raw.columns])


def edge_people_seq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second person for every other region, and one without a region."""
    first = raw_people_seq(spark, sf_dir)
    region = table(spark, sf_dir, "region")
    deputies = region.filter(F.col("r_regionkey") % 2 == 0).select(
        F.concat(F.lit("Deputy "), _text(F.col("r_regionkey"))).alias("person"), F.col("r_name").alias("region"),
        (F.col("r_regionkey") - 100).cast("bigint").alias("seq"))
    spare = region.filter(F.col("r_regionkey") == 0).select(
        F.lit("Floater").alias("person"), F.lit(None).cast("string").alias("region"),
        F.lit(500).cast("bigint").alias("seq"))
    return first.unionByName(deputies).unionByName(spare)


def edge_returns_seq(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = raw_returns(spark, sf_dir, with_seq=True)
    return rows.withColumn("returned", F.when(F.col("seq") % 5 == 1, "No").otherwise(F.col("returned")))


def damaged_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw orders as text, with cells that are no number or date, missing markers
    and names that hold a quote, a comma and a line end."""
    raw = raw_orders(spark, sf_dir).drop("row_id")
    order, customer = _number("order_id"), _number("customer_id")
    edits = {
        "quantity": F.when(order % 31 == 0, "many").when(order % 37 == 0, "NA").otherwise(_text(F.col("quantity"))),
        "order_date": F.when(customer % 41 == 0, "some day").otherwise(F.date_format("order_date", "yyyy-MM-dd")),
        "sales": F.when(order % 43 == 0, "").otherwise(_text(F.col("sales"))),
        "customer_name": F.when(customer % 19 == 0, F.concat(F.col("customer_name"), F.lit(', "the\nthird"')))
                         .otherwise(F.col("customer_name")),
    }
    return raw.select(*[edits[c].alias(c) if c in edits else _text(F.col(c)).alias(c) for c in raw.columns])


def hot_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines of which more than a third name one product and a ninth none."""
    raw = raw_orders(spark, sf_dir)
    order = _number("order_id")
    hot = F.min(F.struct("product_id", "product_name")).alias("hot")
    first = raw.agg(hot).select("hot.*").withColumnsRenamed({"product_id": "h_id", "product_name": "h_name"})
    lines = raw.select("order_id", "quantity", "product_id", "product_name").join(F.broadcast(first))
    return lines.select("order_id", "quantity", *[
        F.when(order % 3 == 0, F.col(h)).when(order % 9 == 1, None).otherwise(F.col(c)).alias(c)
        for c, h in (("product_id", "h_id"), ("product_name", "h_name"))])


def raw_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return raw_orders(spark, sf_dir), raw_people(spark, sf_dir), raw_returns(spark, sf_dir)
