"""Every registered query against its DuckDB oracle at sf0.001 (the driver's
check, on the smallest scale)."""

from __future__ import annotations

import duckdb
import pytest

from conftest import SF_SMALL, duck_bag, spark_bag

import __spark_entry__ as entry
from ledgerloom.catalog import QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_oracle():
    assert set(QUERIES) <= set(entry.queries()) and set(QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    assert df.inputFiles(), "a registered query reads the given tables or files derived from them"
    assert spark_bag(df) == duck_bag(con, entry.oracle_sql()[name])


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["region", "category", "lines", "returned_lines", "total_sales",
                          "total_profit"]
    assert df.count() > 0


def test_decimal_outputs_listed(spark):
    """Every decimal column of a registered result is in DECIMAL_OUTPUTS
    (which also lists nullable integer columns)."""
    from pyspark.sql.types import DecimalType

    from ledgerloom.catalog import _BUILDERS, DECIMAL_OUTPUTS
    for name in ("fact_order_details", "validation_report", "sales_by_region_category",
                 "dim_product", "check_fk_orphans"):
        df = _BUILDERS[name](spark, SF_SMALL)
        decimals = tuple(f.name for f in df.schema.fields if isinstance(f.dataType, DecimalType))
        assert set(decimals) == set(DECIMAL_OUTPUTS.get(name, ())), name
        assert not any(isinstance(f.dataType, DecimalType)
                       for f in entry.queries()[name](spark, SF_SMALL).schema.fields)
