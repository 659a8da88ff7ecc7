"""The README's user path: sheets exported as CSV under their source header
names (US dates, locale numbers) → read_sheet → run_and_publish."""

from __future__ import annotations

import os
from decimal import Decimal

from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerloom.config import stage_path
from ledgerloom.plans.publish import current_run, run_and_publish
from ledgerloom.schemas import SOURCE_HEADERS
from ledgerloom.sources import fixtures, read_sheet


def _locale(c: str, digits: int) -> F.Column:
    # '1,234.56' -> '1 234,56'
    return F.translate(F.format_number(F.col(c), digits), ",.", " ,")


def test_csv_sheets_to_published_run(spark):
    ro = fixtures.raw_orders(spark, SF_SMALL).drop("row_id")
    names = {ours: theirs for theirs, ours in SOURCE_HEADERS.items()}
    exported = ro.select(*[
        F.date_format(c, "M/d/yyyy").alias(names[c]) if c in ("order_date", "ship_date")
        else _locale(c, 2 if c == "sales" else 4).alias(names[c]) if c in ("sales", "profit")
        else F.col(c).alias(names[c])
        for c in ro.columns])
    src = stage_path(spark, "sheets")
    exported.write.option("header", True).csv(f"{src}/orders")
    fixtures.raw_people(spark, SF_SMALL).select(F.col("person").alias("Person"),
                                                F.col("region").alias("Region")) \
        .write.option("header", True).csv(f"{src}/people")
    fixtures.raw_returns(spark, SF_SMALL).select(F.col("returned").alias("Returned"),
                                                 F.col("order_id").alias("Order ID")) \
        .write.option("header", True).csv(f"{src}/returns")

    orders = read_sheet(spark, f"{src}/orders", "orders", locale_numbers=True,
                        date_formats=("M/d/yyyy",))
    people = read_sheet(spark, f"{src}/people", "people")
    returns = read_sheet(spark, f"{src}/returns", "returns")
    base = stage_path(spark, "warehouse-e2e")
    run = run_and_publish(orders, people, returns, base)

    assert run.published and current_run(spark, base) == run.run_dir
    assert run.report.filter("status = 'MISMATCH'").count() == 0
    counts = {n: t.count() for n, t in run.tables.items()}
    assert counts == {"product": 200, "addresses": 143, "type_ship": 5, "people": 5,
                      "customers": 150, "orders": 1473, "date_ship": 5994,
                      "order_details": 6000, "returns": 4890}
    sums = run.tables["order_details"].agg(F.sum("sales"), F.sum("profit")).first()
    assert (sums[0], sums[1]) == (Decimal("317364757.3100"), Decimal("-225679.2873"))
    assert not os.path.exists(run.run_dir.replace("file:", "") + "/_staging")


def test_command_line_load(spark, capsys):
    from ledgerloom.__main__ import main
    src = stage_path(spark, "cli-sheets")
    fixtures.raw_orders(spark, SF_SMALL).drop("row_id").write.parquet(f"{src}/orders")
    fixtures.raw_people(spark, SF_SMALL).write.parquet(f"{src}/people")
    fixtures.raw_returns(spark, SF_SMALL).write.parquet(f"{src}/returns")
    base = stage_path(spark, "cli-warehouse")
    args = ["--orders", f"{src}/orders", "--people", f"{src}/people", "--returns",
            f"{src}/returns", "--base", base, "--format", "parquet"]
    assert main(args, spark) == 0
    assert "published" in capsys.readouterr().out
    assert current_run(spark, base) is not None
