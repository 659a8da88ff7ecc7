"""Mixing sources to target weights by hash-threshold histograms.

The corpus has a budget of ``share`` times its words, dealt to the sources by
weight; a source gets at most ``most`` times its own words and what it can't use
goes to the others by weight, until none is above its bound. A target of t over a
source of s words takes every document ``floor(t / s)`` times, and the documents
whose key, a hash of (doc_id, text), lies under a threshold once more.

The threshold is found without sorting: words are summed by (source, leading 12
bits of the key), the bucket in which the running sum crosses the budget is
refined by the next 12 bits, and so on until the bucket holds one key. Each
step reads only the rows of the boundary buckets. Since a larger budget only
raises a threshold, mixtures of one corpus are nested.

All of it is DataFrame code; what a task holds is a histogram of at most 4 096
rows a source. A hot source costs each map task one row a bucket.

Defined results: a NULL text has no words; a NULL source is a source, after all
others. doc_id may be NULL or repeated. Documents without words are drawn like
others and take nothing. Rows equal in doc_id and text have one key; where the
threshold falls among them, as many as the budget asks for are taken, whichever
they are (they differ in other columns at most). Very long texts are counted
whole; the document at the threshold is taken where that comes nearer to the
target, so a source misses it by half a document at most. An empty table gives an
empty result, a corpus without words targets of 0. Columns of the caller named
like an added one (``mix_size``, ``mix_source_size``, ``mix_target``,
``mix_copies``; ``mix_copy`` of :func:`mixture`) are replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.keys import dense_key
from ..operators.lookups import sized_broadcast
from .common import Scratch

WORD = r"[^\x20\x09-\x0D]+"
#: Bits of a key, and those that one histogram tells apart.
KEY_BITS, STEP = 60, 12
ADDED = ("mix_size", "mix_source_size", "mix_target", "mix_copies")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw_key(doc_id: Column, text: Column) -> Column:
    """60 bits of a hash of the row, the same on every run and engine."""
    whole = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("|"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(whole), 1, KEY_BITS // 4), 16, 10).cast("long")


def source_targets(scratch: Scratch, sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """(source, source_size, target) from rows (source, size).

    Every round shares what the bounded sources leave among the others by weight;
    the driver sees two sums a round, and a round bounds one source more at least.
    """
    totals = scratch.table(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "totals")
    ranked = dense_key(totals, [F.col("source").asc_nulls_last()], "rank", start=0, stage_dir=scratch.root)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    sources = scratch.table(ranked.select("source", "source_size", weight.alias("w"),
                                          (F.col("source_size") * float(most)).alias("bound")), "sources")
    words = sources.agg(F.sum("source_size")).first()[0] or 0
    part, seen = F.lit(0.0), -1
    while True:
        above = part > F.col("bound")
        row = sources.agg(F.count_if(above).alias("n"), F.coalesce(F.sum(F.when(above, F.col("bound"))), F.lit(0.0)).alias("given"),
                          F.coalesce(F.sum(F.when(~above, F.col("w"))), F.lit(0.0)).alias("weight")).first()
        if row["n"] == seen:
            break
        seen = row["n"]
        free = float(share) * words - row["given"]
        part = F.col("w") * F.lit(free) / F.lit(row["weight"]) if row["weight"] else F.col("bound")
    return sources.select("source", "source_size", F.least(part, "bound").alias("target"))


def thresholds(scratch: Scratch, sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, source_size, target, whole, cut, tied, ties): every document is taken
    ``whole`` times, once more if its key is below ``cut``, and so are ``ties`` of the
    ``tied`` rows with this key. ``cut`` is NULL where no document is taken more."""
    size = F.col("source_size")
    whole = F.when(size > 0, F.floor(F.col("target") / size)).otherwise(0)
    plan = scratch.table(targets.withColumn("whole", whole.cast("int"))
                         .withColumn("rest", F.col("target") - F.col("whole") * size), "plan")
    inside, cuts = sizes, plan.select("source", "rest")
    for shift in range(KEY_BITS - STEP, -1, -STEP):
        bucket = F.shiftright("key", shift)
        steps = (inside.groupBy("source", bucket.alias("bucket"))
                 .agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n"),
                      F.min("key").alias("lo"), F.max("key").alias("hi")))
        running = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        steps = steps.withColumn("upto", F.sum("words").over(running))
        c = cuts.select(F.col("source").alias("s"), "rest")
        cuts = scratch.table(
            steps.join(c, F.col("source").eqNullSafe(F.col("s")))
            .filter((F.col("upto") - F.col("words") <= F.col("rest")) & (F.col("rest") < F.col("upto")))
            .select("source", "bucket", (F.col("rest") - F.col("upto") + F.col("words")).alias("rest"),
                    "words", "n", "lo", "hi"), f"cuts-{shift}")
        if cuts.filter("lo < hi").isEmpty():
            break
        at = sized_broadcast(cuts.select(F.col("source").alias("s"), F.col("bucket").alias("b")))
        inside = scratch.table(inside.join(at, F.col("source").eqNullSafe(F.col("s")) & (bucket == F.col("b")))
                               .select("source", "key", "size"), f"inside-{shift}")
    ties = F.least(F.floor(F.col("rest") / (F.col("words") / F.col("n")) + 0.5), F.col("n"))
    found = cuts.select(F.col("source").alias("s"), F.col("lo").alias("cut"), F.col("n").alias("tied"), ties.alias("ties"))
    return scratch.table(plan.join(found, F.col("source").eqNullSafe(F.col("s")), "left")
                         .select("source", "source_size", "target", "whole", "cut", "tied", "ties"), "thresholds")


def _numbered_ties(scratch: Scratch, rows: DataFrame) -> DataFrame:
    """Rows (…, source) with ``place`` 0, 1, … in their source: numbered where they
    lie, partition by partition, so that a group of any size stays spread."""
    laid = scratch.table(rows.withColumn("part", F.spark_partition_id())
                         .withColumn("pos", F.monotonically_increasing_id()), "tied")
    counts = laid.groupBy("source", "part").agg(F.count(F.lit(1)).alias("here"))
    upto = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    before = counts.select(F.col("source").alias("its"), F.col("part").alias("p"),
                           (F.sum("here").over(upto) - F.col("here")).alias("before"))
    own = F.row_number().over(Window.partitionBy("source", "part").orderBy("pos")) - 1
    return (laid.withColumn("own", own)
            .join(before, F.col("source").eqNullSafe(F.col("its")) & (F.col("part") == F.col("p")))
            .withColumn("place", F.col("before") + F.col("own")))


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Every row of ``docs`` with its words, its source's words and target, and how
    often the mixture takes it (``mix_size``, ``mix_source_size``, ``mix_target``,
    ``mix_copies``). The sources in code-point order, NULL last, weigh ``weights``,
    repeating."""
    scratch = Scratch(docs.sparkSession, "mixing")
    rows = docs.select(F.struct("*").alias("row"), F.col("source").cast("string").alias("source"),
                       draw_key(F.col("doc_id"), F.col("text")).alias("key"), word_count(F.col("text")).alias("size"))
    sizes = scratch.table(rows.select("source", "key", "size"), "sizes")
    cuts = thresholds(scratch, sizes, source_targets(scratch, sizes, weights, share, most))
    scratch.drop(sizes)
    joined = rows.join(sized_broadcast(cuts.withColumnRenamed("source", "s")), F.col("source").eqNullSafe(F.col("s")))
    at_cut = F.coalesce(F.col("key") == F.col("cut"), F.lit(False))
    split = at_cut & (F.col("ties") > 0) & (F.col("ties") < F.col("tied"))
    below = F.coalesce(F.col("key") < F.col("cut"), F.lit(False)) | (at_cut & (F.col("ties") == F.col("tied")))

    def result(part: DataFrame, once_more: Column) -> DataFrame:
        return part.select(
            *[F.col("row").getField(c).alias(c) for c in docs.columns if c not in ADDED],
            F.col("size").alias("mix_size"), F.col("source_size").alias("mix_source_size"),
            F.col("target").alias("mix_target"), (F.col("whole") + once_more.cast("int")).alias("mix_copies"))

    if cuts.filter("0 < ties AND ties < tied").isEmpty():
        return result(joined, below)
    ties = _numbered_ties(scratch, joined.filter(split))
    return result(joined.filter(~split), below).unionByName(result(ties, F.col("place") < F.col("ties")))


def mixture(docs: DataFrame, **how) -> DataFrame:
    """The mixture itself: each row as often as :func:`mix` takes it, numbered by
    ``mix_copy`` from 1, with the columns of ``docs``."""
    taken = mix(docs, **how).filter("mix_copies > 0")
    kept = [c for c in docs.columns if c not in ADDED and c != "mix_copy"]
    return taken.select(*[F.col(f"`{c}`") for c in kept],
                        F.explode(F.sequence(F.lit(1), F.col("mix_copies"))).alias("mix_copy"))
