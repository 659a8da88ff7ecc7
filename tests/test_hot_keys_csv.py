"""Lookups with hot keys joined apart; CSV files read split; rejected rows."""

from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import plan_text, spark_bag
from ledgerloom.config import stage_path
from ledgerloom.operators.hotkeys import hot_hashes, key_hash, split_by_heat
from ledgerloom.operators.lookups import Lookup, lookup
from ledgerloom.sources import readers as R


@pytest.fixture(scope="module")
def lines(spark):
    """60 000 rows: a third on one key, a sixth NULL, the others on 5 000 keys."""
    n = F.col("id")
    key = F.when(n % 3 == 0, 7).when(n % 6 == 1, None).otherwise(n % 5000).cast("long")
    path = stage_path(spark, "lines")
    spark.range(60_000).select(n, key.alias("k"), F.concat(F.lit("n"), key % 11).alias("name")).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def dim(spark):
    k = F.col("id")
    rows = spark.range(0, 4000).select(k.alias("k"), F.concat(F.lit("n"), k % 11).alias("name"), (k * 10).alias("code"))
    return rows.unionByName(rows.filter("k in (7, 8)").withColumn("code", F.col("code") + 1))  # keys that fan out


def test_hot_lookup_equals_the_plain_join(lines, dim):
    lk = Lookup(dim, ("k", "name"), ("code",), broadcast_rows=-1)
    plain = lookup(lines, lk)
    apart = lookup(lines, replace(lk, hot_share=0.05))
    assert spark_bag(apart) == spark_bag(plain)
    assert "BroadcastHashJoin" in plan_text(apart) and apart.columns == plain.columns


def test_no_task_gets_more_than_its_share(spark, lines):
    """What is shuffled after the hot and the NULL keys are taken out is even."""
    hot = hot_hashes(lines, ["k", "name"], 0.05)
    assert len(hot) == 1
    none, heated, rest = split_by_heat(lines, ["k", "name"], hot)
    assert none.count() == lines.filter("k is null").count() and heated.count() == lines.filter("k = 7").count()
    assert none.count() + heated.count() + rest.count() == lines.count()

    def largest(df):
        parts = df.repartition(16, "k", "name").groupBy(F.spark_partition_id()).count()
        return parts.agg(F.max("count")).first()[0] / df.count()
    assert largest(lines) > 0.3 and largest(rest) < 0.1


def test_hot_keys_of_edge_tables(spark, lines, dim):
    assert hot_hashes(lines.filter("false"), ["k"], 0.1) == [] == hot_hashes(lines.filter("k is null"), ["k"], 0.1)
    h = lines.limit(1).select(key_hash([F.lit(7).cast("long")])).first()[0]
    assert hot_hashes(lines, ["k"], 0.3) == [h]
    with pytest.raises(ValueError):
        hot_hashes(lines, ["k"], 1e-6)
    lk = Lookup(dim.filter("false"), ("k", "name"), ("code",), broadcast_rows=-1, hot_share=0.05)
    assert lookup(lines, lk).filter("code is not null").count() == 0


def people(n: int, start: int = 0) -> str:
    return "Person,Region\n" + "".join(f'"Anna ""A"" {i}",Region {i % 7}\n' for i in range(start, start + n))


def test_large_csv_is_split_and_open_lines_are_not(spark, tmp_path):
    folder = tmp_path / "sheet"
    folder.mkdir()
    (folder / "a.csv").write_text(people(20_000))
    (folder / "b c.csv").write_text(people(20_000, 50_000))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        split, whole = R.files_with_open_lines(spark, str(folder))
        assert len(split) == 2 and whole == []
        df = R.read_sheet(spark, str(folder), "people")
        assert df.rdd.getNumPartitions() > 10
        want = spark_bag(R.read_sheet(spark, str(folder), "people", options={"multiLine": "true"}))
        assert spark_bag(df) == want and sum(want.values()) == 40_000
        (folder / "d.csv").write_text(people(10) + '"two\nlines, ""q""",Region 9\n' + people(10, 100).split("\n", 1)[1])
        split, whole = R.files_with_open_lines(spark, str(folder))
        assert len(split) == 2 and [w.rsplit("/", 1)[1] for w in whole] == ["d.csv"]
        mixed = R.read_sheet(spark, str(folder), "people")
        assert mixed.rdd.getNumPartitions() > 10
        assert spark_bag(mixed) == spark_bag(R.read_sheet(spark, str(folder), "people", options={"multiLine": "true"}))
        assert mixed.filter("person = 'two\nlines, \"q\"'").count() == 1 and mixed.count() == 40_021
        only = R.read_sheet(spark, str(folder / "d.csv"), "people")
        assert only.count() == 21
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_rejects_keep_every_row(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text('Returned,Order ID\nYes,O-1\nNo\nYes,"O\n2"\nNA,O-3\nYes,O-4,extra\n')
    good, bad = R.read_sheet_with_rejects(spark, str(path), "returns")
    assert sorted(map(tuple, good.collect()), key=str) == [("Yes", "O-1"), ("Yes", "O\n2"), (None, "O-3")]
    rows = bad.select("returned", "order_id", "failed", "record").collect()
    assert sorted((r.record, r.failed) for r in rows) == [("No", []), ("Yes,O-4,extra", [])]


def test_rejected_cells_are_named(spark):
    schema = T.StructType([T.StructField("d", T.TimestampNTZType()), T.StructField("n", T.IntegerType()), T.StructField("t", T.StringType())])
    df = spark.createDataFrame([("2020-01-02", "5", "x"), ("some day", "5", None), ("NA", "", "y"), ("nan", "five", "z"),
                                ("x", "y", "NULL"), (None, None, None), ("2020-01-02", "99999999999", "w")], "d string, n string, t string")
    good, bad = R.conform_with_rejects(df, schema)
    assert good.schema.simpleString() == "struct<d:timestamp_ntz,n:int,t:string>"
    assert good.count() == 3 and good.count() + bad.count() == df.count()
    assert sorted((tuple(r.failed), r.d, r.n, r.t) for r in bad.collect()) == [
        (("d",), "some day", "5", None), (("d", "n"), "x", "y", "NULL"), (("n",), "2020-01-02", "99999999999", "w"), (("n",), "nan", "five", "z")]
    none_good, none_bad = R.conform_with_rejects(df.filter("false"), schema)
    assert none_good.collect() == [] and none_bad.collect() == []
