"""The distributed dense key equals row_number() over the same total order."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerloom.config import stage_path
from ledgerloom.operators.keymap import KeyMap
from ledgerloom.operators.keys import dense_key

ORDER = ["a", "b", "c"]


def row_number_key(df, order_by, key_col):
    """The plain single-window form (one task numbers every row): the
    reference the distributed key must equal, on small inputs only."""
    w = Window.orderBy(*[F.col(c).asc_nulls_first() for c in order_by])
    return df.select(F.row_number().over(w).cast("bigint").alias(key_col), *df.columns)


def _keys(df):
    return sorted((r["k"], r["a"], r["b"], r["c"]) for r in df.collect())


def _check(spark, rows, n):
    df = spark.createDataFrame(rows, "a string, b bigint, c double").distinct()
    got = _keys(dense_key(df, ORDER, "k", num_partitions=n))
    want = _keys(row_number_key(df, ORDER, "k"))
    assert got == want
    assert [g[0] for g in got] == list(range(1, len(got) + 1))


def test_dense_key_matches_row_number_over_partition_counts(spark):
    rows = [(f"o{i % 37}", i % 5, float(i) / 7) for i in range(500)]
    rows += [(None, 1, 1.0), ("o1", None, 2.0), ("o1", 2, None)]
    for n in (1, 4, 37):
        _check(spark, rows, n)


def test_dense_key_more_partitions_than_rows(spark):
    _check(spark, [("x", 1, 1.0), ("y", 2, 2.0), (None, None, None)], 16)


def test_dense_key_empty_input(spark):
    df = spark.createDataFrame([], "a string, b bigint, c double")
    assert dense_key(df, ORDER, "k").count() == 0


def test_dense_key_default_partitioning(spark):
    rows = [(f"o{i}", i, 0.5) for i in range(200)]
    df = spark.createDataFrame(rows, "a string, b bigint, c double")
    got = _keys(dense_key(df, ORDER, "k"))
    assert got == _keys(row_number_key(df, ORDER, "k"))


def test_dense_key_start_offset(spark):
    df = spark.createDataFrame([("b", 1, 1.0), ("a", 1, 1.0)], "a string, b bigint, c double")
    got = sorted((r["k"], r["a"]) for r in dense_key(df, ORDER, "k", start=10).collect())
    assert got == [(10, "a"), (11, "b")]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.one_of(st.none(), st.sampled_from(["x", "y", "z", ""])),
                               st.one_of(st.none(), st.integers(-3, 3)),
                               st.one_of(st.none(), st.floats(-2, 2, allow_nan=False))),
                     max_size=40),
       n=st.integers(1, 9))
def test_dense_key_property(spark, rows, n):
    _check(spark, rows, n)


def test_hot_leading_value_spans_range_partitions(spark):
    """A third of the rows share the leading key column; range bounds over the
    whole tuple still spread them over several partitions (no single hot task),
    and the keys stay exact."""
    rows = [("hot", i, 0.0) for i in range(300)] + [(f"k{i}", i, 0.0) for i in range(600)]
    df = spark.createDataFrame(rows, "a string, b bigint, c double")
    ordering = [F.col(c).asc_nulls_first() for c in ORDER]
    parts = (df.repartitionByRange(6, *ordering).filter(F.col("a") == "hot")
             .select(F.spark_partition_id().alias("p")).distinct().count())
    assert parts >= 2
    assert _keys(dense_key(df, ORDER, "k", num_partitions=6)) == _keys(row_number_key(df, ORDER, "k"))


def test_input_behind_a_shuffle_runs_once(spark):
    """The range sample reads the shuffled rows; lookups below a DISTINCT aren't run
    again for it."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b
    rows = spark.range(1000).mapInPandas(count, "id long").distinct()
    assert dense_key(rows, ["id"], "k").count() == 1000 and seen.value == 1000


def test_repeated_rows_become_distinct_in_their_ranges(spark):
    rows = [(f"o{i % 29}", i % 4, float(i % 11) / 7) for i in range(900)] + [(None, 1, 1.0), (None, 1, 1.0), ("o1", None, -0.0), ("o1", None, 0.0)]
    df = spark.createDataFrame(rows, "a string, b bigint, c double")
    got = _keys(dense_key(df, ORDER, "k", num_partitions=6, repeated=["a", "b"]))
    assert got == _keys(row_number_key(df.distinct(), ORDER, "k"))


def test_rows_of_a_later_load_run_once(spark):
    """They meet the key map in one join, not in one for the new keys and one for all."""
    keys = KeyMap(spark, stage_path(spark, "keys"))
    schema = "a string, b bigint, c double"
    first = spark.createDataFrame([(f"o{i}", i, 0.5) for i in range(60)] + [(None, None, None)], schema)
    old = _keys(keys.number(first, ORDER, "k").select("k", *ORDER))
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b
    rows = spark.createDataFrame([(f"o{i}", i, 0.5) for i in range(50, 80)] + [(None, None, None)], schema).mapInPandas(count, schema)
    got = _keys(keys.number(rows, ORDER, "k"))
    assert seen.value == 31
    assert set(old) & set(got) == {r for r in old if r[1] is None or int(r[1][1:]) >= 50} and len(got) == 31
    assert [r[0] for r in got if r not in old] == list(range(62, 82))
