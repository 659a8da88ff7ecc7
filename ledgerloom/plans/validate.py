"""Reconciliation of the normalized tables, reported as a DataFrame.

Report columns: ``check_group``, ``check_name``, ``expected``, ``actual``
(both ``decimal(22,4)``), ``status`` (``OK`` / ``MISMATCH``, or ``INFO`` for
figures that do not gate). Every check is an aggregation on the executors; the
driver sees only the report rows.

Keys are checked in one pass a table (``integrity.key_pass``): its primary key and
all foreign keys that name it are aggregated together, without joins. Row counts,
NULL foreign keys and sums come from the figures that the writing job gathered
(``metrics``), or from these passes where there are none.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import stage_path, write_stored
from ..operators.integrity import key_pass
from ..schemas import (CONTROL_TOLERANCE, FOREIGN_KEYS, LOOKUP_TABLES,
                       SOURCE_WORKBOOK_PROFIT, SOURCE_WORKBOOK_ROWS, SOURCE_WORKBOOK_SALES,
                       TABLE_ORDER, TABLES, TOTAL_TYPE)
from .metrics import TableMetrics, metrics_frame

VALUE_TYPE = "decimal(38,4)"
TOLERANCE = CONTROL_TOLERANCE

REPORT_COLUMNS = ("check_group", "check_name", "expected", "actual", "status")


def _row(group: str, name: str | F.Column, expected: F.Column, actual: F.Column,
         status: F.Column) -> list[F.Column]:
    name_col = F.lit(name) if isinstance(name, str) else name
    return [F.lit(group).alias("check_group"), name_col.alias("check_name"),
            expected.cast(VALUE_TYPE).alias("expected"), actual.cast(VALUE_TYPE).alias("actual"),
            status.alias("status")]


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _ok_if(cond) -> F.Column:
    return F.when(cond, F.lit("OK")).otherwise(F.lit("MISMATCH"))


def _count(df: DataFrame, name: str, alias: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).cast("bigint").alias(alias)).select(
        F.lit(name).alias("table_name"), alias)


# -- row counts ----------------------------------------------------------------

def actual_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _union([_count(tables[n], n, "actual_rows") for n in TABLE_ORDER if n in tables])


def expected_counts(spark: SparkSession, expected: Mapping[str, int]) -> DataFrame:
    """Fixed expectations, e.g. the figures of a known source file."""
    return spark.createDataFrame([(k, int(v)) for k, v in expected.items()],
                                 "table_name string, expected_rows bigint")


# Column sets whose distinct tuples give each raw-derived table's row count.
_RAW_GRAINS = {
    "product": ("product_id", "category", "sub_category", "product_name"),
    "addresses": ("country", "city", "state", "postal_code"),
    "type_ship": ("ship_mode",),
    "customers": ("customer_id", "customer_name", "segment"),
    "date_ship": ("order_id", "ship_date", "ship_mode"),
}


def _source_lines(raw_orders: DataFrame) -> DataFrame:
    """Distinct order lines as the store must hold them, stated apart from the
    build: a line whose product is named incompletely matches no product, so such
    lines of an order are told apart by their figures alone."""
    product = F.when(F.col("product_id").isNotNull() & F.col("product_name").isNotNull(),
                     F.struct("product_id", "product_name"))
    return raw_orders.select("order_id", product.alias("product"), "quantity", "sales", "discount", "profit").distinct()


def _source_postal(c: str) -> Column:
    """Five digits, zeros in front; NULL is all zeros; a sign stays in front."""
    n = F.coalesce(F.col(c).cast("double"), F.lit(0.0)).cast("bigint")
    digits = F.abs(n).cast("string")
    width = F.when(n < 0, 4).otherwise(5)
    zeros = F.repeat(F.lit("0"), F.greatest(width - F.length(digits), F.lit(0)))
    return F.concat(F.when(n < 0, "-").otherwise(""), zeros, digits)


def expected_counts_from_raw(raw_orders: DataFrame, raw_people: DataFrame,
                             raw_returns: DataFrame) -> DataFrame:
    """Row count each table must have, computed from the raw rows alone.

    Five raw-order grains are counted in one aggregation: one scan, and one
    shuffle in which partial aggregation collapses repeated tuples. Each tuple is
    counted as a struct so that tuples with NULL fields count, as in SELECT
    DISTINCT. Lines are made distinct once and give the counts of orders, of details and
    of returned details. No helper of the build is used.
    """
    return _union([_expected_grains(raw_orders), _expected_people(raw_people), _expected_lines(raw_orders, raw_returns)])


def expected_from_raw(raw_orders: DataFrame, raw_people: DataFrame, raw_returns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``expected_counts_from_raw`` and ``expected_totals_from_raw``, computed now and
    stored. Counts and totals of the lines share their DISTINCT, and its shuffles and those
    of the grains are never on the disks together."""
    lines = settled(_expected_lines(raw_orders, raw_returns).select("table_name", F.col("expected_rows").cast(TOTAL_TYPE).alias("value"))
                    .union(expected_totals_from_raw(raw_orders)))
    total = F.col("table_name").startswith("sum_")
    counts = lines.filter(~total).select("table_name", F.col("value").cast("bigint").alias("expected_rows"))
    return (_union([settled(_expected_grains(raw_orders)), settled(_expected_people(raw_people)), counts]),
            lines.filter(total).select(F.col("table_name").alias("metric"), F.col("value").alias("expected")))


def settled(rows: DataFrame) -> DataFrame:
    """The few ``rows`` of a report, computed now and stored; their shuffles are given back."""
    path = stage_path(rows.sparkSession, "report")
    write_stored(rows, path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _expected_grains(raw_orders: DataFrame) -> DataFrame:
    raw = raw_orders.withColumn("postal_code", _source_postal("postal_code"))
    counts = raw.agg(*[F.count_distinct(F.struct(*cols)).alias(name)
                       for name, cols in _RAW_GRAINS.items()])
    return counts.select(F.stack(F.lit(len(_RAW_GRAINS)), *[
        x for name in _RAW_GRAINS for x in (F.lit(name), F.col(name).cast("bigint"))
    ]).alias("table_name", "expected_rows"))


def _expected_people(raw_people: DataFrame) -> DataFrame:
    return _count(raw_people.select("person", "region").distinct(), "people", "expected_rows")


def _expected_lines(raw_orders: DataFrame, raw_returns: DataFrame) -> DataFrame:
    per_order = _source_lines(raw_orders).groupBy("order_id").agg(F.count(F.lit(1)).alias("n"))
    values = raw_returns.groupBy("order_id").agg(F.count_distinct(F.struct("returned")).alias("k"))
    return (per_order.join(values, "order_id", "left")
            .agg(F.count(F.lit(1)).cast("bigint").alias("orders"), F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("details"),
                 F.coalesce(F.sum(F.col("n") * F.col("k")), F.lit(0)).cast("bigint").alias("returns"))
            .select(F.stack(F.lit(3), F.lit("orders"), "orders", F.lit("order_details"), "details", F.lit("returns"), "returns")
                    .alias("table_name", "expected_rows")))


def check_row_counts(tables: Mapping[str, DataFrame], expected: DataFrame) -> DataFrame:
    """Actual vs expected rows per table (expected: table_name, expected_rows)."""
    actual = actual_counts(tables).select(F.lit("row_count").alias("check_group"), F.col("table_name").alias("check_name"),
                                          F.col("actual_rows").cast(VALUE_TYPE).alias("actual"))
    return _judged(actual, expected)


# -- keys ----------------------------------------------------------------------

def _dup_check(df: DataFrame, key: tuple[str, ...], group: str, name: str,
               skip_null_keys: bool) -> DataFrame:
    if skip_null_keys:
        for k in key:
            df = df.filter(F.col(k).isNotNull())
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_ll_n"))
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
    bad = F.count_if((F.col("_ll_n") > 1) | any_null)
    return per_key.agg(bad.alias("bad")).select(*_row(group, name, F.lit(0), F.col("bad"), _ok_if(F.col("bad") == 0)))


def key_figures(tables: Mapping[str, DataFrame], groups: tuple[str, ...],
                metrics: Mapping[str, TableMetrics] | None = None) -> DataFrame:
    """(check_group, check_name, actual) of the ``groups`` among ``row_count``,
    ``pk_unique``, ``fk_orphans`` and ``fk_nulls``: one pass for each table that has
    something to be told of. With ``metrics`` counts and NULLs come from there."""
    known = metrics or {}
    frames = []
    for n in TABLE_ORDER:
        if n not in tables:
            continue
        spec = TABLES[n]
        named = {f"{fk.child}_{fk.column}": fk for fk in FOREIGN_KEYS if fk.parent == n and fk.child in tables} \
            if "fk_orphans" in groups else {}
        children = {k: (tables[fk.child], fk.column) for k, fk in named.items()}
        for k, fk in named.items():
            if fk.child in known:  # the NULLs are counted already
                children[k] = (tables[fk.child].filter(F.col(fk.column).isNotNull()), fk.column)
        rows = []
        if "row_count" in groups and n not in known:
            rows.append(("row_count", n, "rows"))
        if "pk_unique" in groups:
            rows.append(("pk_unique", f"{n}.{','.join(spec.primary_key)}", "bad_keys"))
        for k, fk in named.items():
            rows.append(("fk_orphans", fk.name, f"orphans_{k}"))
            if "fk_nulls" in groups and fk.child not in known:
                rows.append(("fk_nulls", fk.name, f"nulls_{k}"))
        if rows:
            stacked = F.stack(F.lit(len(rows)), *[x for g, name, c in rows for x in (F.lit(g), F.lit(name), F.col(c).cast(VALUE_TYPE))])
            frames.append(key_pass(tables[n], spec.primary_key, children)
                          .select(stacked.alias("check_group", "check_name", "actual")))
    if known:
        label = F.create_map(*[x for fk in FOREIGN_KEYS for x in (F.lit(f"{fk.child} null {fk.column}"), F.lit(fk.name))])
        null = F.col("metric").startswith("null ")
        spark = next(iter(tables.values())).sparkSession
        frames.append(metrics_frame(spark, known).filter((F.col("metric") == "rows") | null).select(
            F.when(null, "fk_nulls").otherwise("row_count").alias("check_group"),
            F.when(null, label[F.concat_ws(" ", "table_name", "metric")]).otherwise(F.col("table_name")).alias("check_name"),
            F.col("value").alias("actual")).filter(F.col("check_group").isin(*groups)))
    return _union(frames)


def _judged(figures: DataFrame, expected_rows: DataFrame | None = None) -> DataFrame:
    """Report rows from (check_group, check_name, actual): row counts must equal the
    expected ones, NULL keys are INFO, all others must be 0."""
    group = F.col("check_group")
    expected = F.when(group.isin("pk_unique", "fk_orphans"), F.lit(0))
    if expected_rows is not None:
        rows = expected_rows.select(F.lit("row_count").alias("check_group"), F.col("table_name").alias("check_name"), "expected_rows")
        figures = figures.join(rows, ["check_group", "check_name"], "left")
        expected = F.when(group == "row_count", F.col("expected_rows")).otherwise(expected)
    expected = expected.cast(VALUE_TYPE)
    status = F.when(group == "fk_nulls", "INFO").otherwise(_ok_if(F.coalesce(F.col("actual") == expected, F.lit(False))))
    return figures.select(group, "check_name", expected.alias("expected"), F.col("actual").cast(VALUE_TYPE).alias("actual"),
                          status.alias("status"))


def check_pk_unique(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Primary keys: number of key values that are NULL or occur twice."""
    return _judged(key_figures(tables, ("pk_unique",)))


def check_lookup_unique(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Fan-out guard: each lookup key (non-NULL) names at most one dimension row."""
    return _union([_dup_check(tables[n], TABLES[n].lookup_key, "lookup_unique",
                              f"{n}.{','.join(TABLES[n].lookup_key)}", True)
                   for n in LOOKUP_TABLES if n in tables])


def check_fk_orphans(tables: Mapping[str, DataFrame]) -> DataFrame:
    """All nine foreign keys: orphans gate (expected 0); NULL keys are reported
    as INFO (a nullable FK may be NULL)."""
    return _judged(key_figures(tables, ("fk_orphans", "fk_nulls")))


# -- control totals ------------------------------------------------------------

def _sums(lines: DataFrame, alias_sales: str, alias_profit: str) -> DataFrame:
    return lines.agg(F.sum("sales").cast(TOTAL_TYPE).alias(alias_sales),
                     F.sum("profit").cast(TOTAL_TYPE).alias(alias_profit))


def expected_totals_from_raw(raw_orders: DataFrame) -> DataFrame:
    """SUM(sales), SUM(profit) over the distinct raw lines in store precision."""
    money = _source_lines(raw_orders).select(F.col("sales").cast("decimal(12,4)").alias("sales"),
                                            F.col("profit").cast("decimal(12,4)").alias("profit"))
    sums = _sums(money, "sum_sales", "sum_profit")
    return sums.select(F.stack(F.lit(2), F.lit("sum_sales"), "sum_sales", F.lit("sum_profit"),
                               "sum_profit").alias("metric", "expected"))


def workbook_expectations(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """The fixed expectations of the original source workbook (row counts and
    control totals), for validating a load of that workbook as is."""
    return (expected_counts(spark, SOURCE_WORKBOOK_ROWS),
            expected_totals(spark, SOURCE_WORKBOOK_SALES, SOURCE_WORKBOOK_PROFIT))


def expected_totals(spark: SparkSession, sales: float, profit: float) -> DataFrame:
    return spark.createDataFrame([("sum_sales", float(sales)), ("sum_profit", float(profit))],
                                 "metric string, expected double")


def check_control_totals(order_details: DataFrame, expected: DataFrame, tolerance: float = TOLERANCE,
                         metrics: Mapping[str, TableMetrics] | None = None) -> DataFrame:
    """|actual − expected| < tolerance for SUM(sales) and SUM(profit). An empty
    table gives NULL sums and fails instead of crashing. With ``metrics`` the sums
    are those gathered when the table was written."""
    if metrics and "order_details" in metrics:
        sums = metrics_frame(order_details.sparkSession, {"order_details": metrics["order_details"]})
        actual = sums.filter(F.col("metric").isin("sum sales", "sum profit")).select(
            F.translate("metric", " ", "_").alias("metric"), F.col("value").alias("actual"))
    else:
        actual = _sums(order_details, "sum_sales", "sum_profit").select(
            F.stack(F.lit(2), F.lit("sum_sales"), "sum_sales", F.lit("sum_profit"),
                    "sum_profit").alias("metric", "actual"))
    j = actual.join(expected, "metric", "left")
    diff = F.abs(F.col("actual").cast(VALUE_TYPE) - F.col("expected").cast(VALUE_TYPE))
    return j.select(F.lit("control_total").alias("check_group"), F.col("metric").alias("check_name"),
                    F.col("expected").cast(VALUE_TYPE).alias("expected"),
                    F.col("actual").cast(VALUE_TYPE).alias("actual"),
                    _ok_if(F.coalesce(diff < F.lit(tolerance), F.lit(False))).alias("status"))


# -- report --------------------------------------------------------------------

def validation_report(tables: Mapping[str, DataFrame], expected_rows: DataFrame, expected_sums: DataFrame,
                      metrics: Mapping[str, TableMetrics] | None = None) -> DataFrame:
    """All checks in one frame plus ``all_passed``: every gating status is OK.
    With ``metrics``, the figures gathered when the tables were written, no table is
    read for counts, NULLs or sums; one pass a table checks its keys. The parts of the
    report are computed now, one after the other, so that their shuffles are never on the
    disks together.

    The window that computes ``all_passed`` spans the report rows only (a few
    dozen, one per check), never table data.
    """
    figures = settled(key_figures(tables, ("row_count", "pk_unique", "fk_orphans", "fk_nulls"), metrics))
    report = _union([
        _judged(figures, settled(expected_rows)),
        settled(check_lookup_unique(tables)),
        settled(check_control_totals(tables["order_details"], expected_sums, metrics=metrics)),
    ])
    gating_ok = F.when(F.col("status") == "INFO", F.lit(True)).otherwise(F.col("status") == "OK")
    return report.withColumn("all_passed", F.min(gating_ok).over(Window.partitionBy()))


def passed(report: DataFrame) -> bool:
    """Driver-side verdict: one boolean from the report."""
    gating = report.filter(F.col("status") != "INFO")
    row = gating.agg(F.count_if(F.col("status") != "OK").alias("bad"),
                     F.count(F.lit(1)).alias("n")).first()
    return row is not None and row["n"] > 0 and row["bad"] == 0
