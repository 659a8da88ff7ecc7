"""Shared pieces of the training-data operators.

* :class:`Scratch` keeps intermediate tables under ``spark.checkpoint.dir``: a
  written table cuts lineage, survives a lost executor and lets Spark split a
  hot key of a following join, since both sides are then plain exchanges.
* :func:`components` labels the connected components of a link table.
* :func:`bucket_components` turns LSH buckets into confirmed links and
  components without emitting all pairs of a bucket.
* word and shingle hashing in numpy.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import remove_path, stage_path
from ..operators.bitmaps import bitmaps, has_bit

GOLDEN = 0x9E3779B97F4A7C15


class Scratch:
    """Tables of one operator run under the shared checkpoint folder."""

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark = spark
        self.root = stage_path(spark, purpose)
        self._n = 0

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` as Parquet and return the reread table."""
        self._n += 1
        path = f"{self.root}/{self._n:03d}-{name}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out.scratch_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Remove tables that nothing reads any more."""
        for t in tables:
            remove_path(self.spark, t.scratch_path)


#: Rows of an Arrow batch, where the session doesn't say: Spark's default of 10 000 whole
#: texts, and what is made of them, would take most of a worker's memory.
BATCH_CONF, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1000


#: Workers give freed Arrow buffers back to the system: the default pool keeps them, some
#: hundred MB a worker, for as long as the worker lives.
WORKER_ENV = {"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_MMAP_THRESHOLD_": "131072", "MALLOC_TRIM_THRESHOLD_": "131072"}


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, so
    that a caller's working folder doesn't matter; a cluster ships it as usual
    (``--py-files``). Workers get ``WORKER_ENV``, and batches of rows a size for texts
    unless the session's configuration has one."""
    if spark.conf.get(BATCH_CONF) == "10000":
        spark.conf.set(BATCH_CONF, str(BATCH_ROWS))
    env = spark.sparkContext.environment
    for name, value in WORKER_ENV.items():
        env.setdefault(name, value)
    root = str(Path(__file__).resolve().parents[2])
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [env.get("PYTHONPATH"), root]))


def table_of(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def docs_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_of(spark, sf_dir, "documents")


def drawn(share: float | Column, *columns: str) -> Column:
    """A repeatable draw of about ``share`` of the rows by a hash of ``columns``.
    Name doc_id among them: copies of one text are then drawn one by one."""
    part = F.lit(share) if isinstance(share, float) else share
    return F.pmod(F.xxhash64(*columns, F.lit("draw")), F.lit(10 ** 12)) < part * 10 ** 12


#: Places of a hash filter; its bitmaps take 16 MB at most, whatever it holds.
FILTER_BITS = 1 << 27


def may_be_in(df: DataFrame, columns: list, keys: DataFrame, key_columns: list, flag: str) -> DataFrame:
    """``df`` with boolean ``flag``: False where its ``columns`` surely don't occur among
    ``keys``. A broadcast bit for each hash value of a key tells; a wrong True is rare,
    so rows of a large table that a join would drop needn't be shuffled for it."""
    place = F.pmod(F.xxhash64(*key_columns), F.lit(FILTER_BITS)) + 1
    marks = F.broadcast(bitmaps(keys.select(place.alias("_ll_place")), "_ll_place"))
    at = F.pmod(F.xxhash64(*columns), F.lit(FILTER_BITS)) + 1
    return (df.join(marks, F.bitmap_bucket_number(at) == F.col("_ll_bucket"), "left")
            .withColumn(flag, has_bit(F.col("_ll_bitmap"), F.bitmap_bit_position(at))).drop("_ll_bucket", "_ll_bitmap"))


# --- components ------------------------------------------------------------

def _flat(scratch: Scratch, parent: DataFrame) -> DataFrame:
    """Pointer jumping: (node, root) until every root is its own root."""
    while True:
        up = parent.select(F.col("node").alias("root"), F.col("root").alias("up"))
        jumped = scratch.table(
            parent.join(up, "root", "left")
            .select("node", F.coalesce("up", "root").alias("up"), "root"), "jump")
        scratch.drop(parent)
        moved = not jumped.filter("up <> root").isEmpty()
        parent = scratch.table(jumped.select("node", F.col("up").alias("root")), "parent")
        scratch.drop(jumped)
        if not moved:
            return parent


def components(scratch: Scratch, links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links(a, b)``; root is the smallest node
    of its component.

    Each round hangs every node on its smallest neighbour, flattens the trees by
    pointer jumping and contracts the links to the roots. A round merges every
    node that isn't a local minimum, so a star or a path takes one or two. All
    steps are joins and ``min`` aggregates with map-side combine; links and
    labels are written between them, so a hub that holds a third of the links
    is split like any skewed join key.
    """
    a, b = F.col("a"), F.col("b")
    edges = scratch.table(
        links.filter(a != b).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
        .distinct(), "edges")
    labels = None
    while labels is None or not edges.isEmpty():
        near = edges.select(a.alias("node"), b.alias("near")).union(
            edges.select(b.alias("node"), a.alias("near")))
        parent = _flat(scratch, scratch.table(
            near.groupBy("node").agg(F.min("near").alias("near"))
            .select("node", F.least("node", "near").alias("root")), "parent"))
        if labels is None:
            merged = parent
        else:
            up = parent.select(F.col("node").alias("root"), F.col("root").alias("up"))
            merged = scratch.table(
                labels.join(up, "root", "left")
                .select("node", F.coalesce("up", "root").alias("root")), "labels")
        pa = parent.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        pb = parent.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        step = scratch.table(edges.join(pa, "a").select("ra", "b"), "step")
        contracted = scratch.table(
            step.join(pb, "b").filter("ra <> rb")
            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
            .distinct(), "edges")
        scratch.drop(edges, step)
        edges, labels = contracted, merged
    return labels


def named_components(scratch: Scratch, rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(node, component) for every node of ``rows(name, node)``: the smallest name of
    a row whose node is reachable, by ``labels(node, root)`` or through rows that share a
    name. NULL names link nothing; a component of those alone is NULL."""
    rooted = scratch.table(
        rows.join(labels, "node", "left").select("name", "node", F.coalesce("root", "node").alias("root")), "rooted")
    several = (rooted.filter("name is not null").groupBy("name").agg(F.min("root").alias("a"), F.max("root").alias("b"))
               .filter("a <> b").select("name", "a"))
    links = scratch.table(rooted.join(several, "name").select("a", F.col("root").alias("b")).distinct(), "shared-names")
    if not links.isEmpty():
        up = components(scratch, links).select(F.col("node").alias("root"), F.col("root").alias("up"))
        rooted = scratch.table(rooted.join(up, "root", "left").select("name", "node", F.coalesce("up", "root").alias("root")), "rooted")
    first = rooted.groupBy("root").agg(F.min("name").alias("component"))
    return scratch.table(rooted.select("node", "root").distinct().join(first, "root").select("node", "component"), "components")


def runs(batches: Iterator[pd.DataFrame], by: list[str]) -> Iterator[pd.DataFrame]:
    """Runs of equal ``by`` from batches sorted by it; the last run of a batch may
    go on in the next one and waits for it."""
    rest = None
    for pdf in batches:
        if rest is not None:
            pdf = pd.concat([rest, pdf], ignore_index=True)
        new = np.any([pdf[c].to_numpy()[1:] != pdf[c].to_numpy()[:-1] for c in by], axis=0)
        edges = [0, *(np.flatnonzero(new) + 1).tolist(), len(pdf)]
        for s, e in zip(edges[:-2], edges[1:-1]):
            yield pdf.iloc[s:e]
        rest = pdf.iloc[edges[-2]:]
    if rest is not None and len(rest):
        yield rest


def dealt(rows: DataFrame, sizes: DataFrame, block: int) -> DataFrame:
    """Members ``rows(key, id, ...)`` of buckets ``sizes(key, n)`` dealt into blocks
    of about ``block`` rows, once for every pair of blocks ``one <= two`` that
    their own block (``side``) is in. A bucket of up to ``block`` rows is one
    block; no task ever gets more than two blocks."""
    blocks = F.ceil(F.col("n") / block).cast("int")
    other = F.col("other")
    return (rows.join(sizes, "key")
            .withColumn("side", F.pmod(F.xxhash64("id", "key"), blocks).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
            .withColumn("one", F.least("side", other)).withColumn("two", F.greatest("side", other))
            .drop("n", "other"))


def _likely_pairs(load: Callable, likely: Callable):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                mask = likely(pdf["n_a"].to_numpy(), load(pdf["payload_a"]), pdf["n_b"].to_numpy(), load(pdf["payload_b"]))
                yield pdf.loc[mask, ["a", "b"]]
    return run


def _block_pairs(load: Callable, likely: Callable, exact: bool):
    """Likely pairs of different components inside a block pair, each only in the
    first bucket its ends share. If ``likely`` is exact, one link per pair of
    components is enough."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in runs(batches, ["key", "one", "two"]):
            ids, comp, side, n = (part[c].to_numpy() for c in ("id", "comp", "side", "n"))
            if (comp == comp[0]).all():
                continue
            payload = load(part["payload"])
            keys = np.frombuffer(b"".join(part["keys"]), np.int64).reshape(len(part), -1)
            bucket = int((keys[0] == part["key"].iloc[0]).argmax())
            across = part["one"].iloc[0] != part["two"].iloc[0]
            found = []
            for i in range(len(ids) - 1):
                other = comp[i + 1:] != comp[i]
                if across:
                    other &= side[i + 1:] != side[i]
                at = np.flatnonzero(other) + i + 1
                if len(at):
                    at = at[(keys[at] == keys[i]).argmax(axis=1) == bucket]
                if len(at):
                    at = at[likely(np.repeat(n[i], len(at)), payload[[i]], n[at], payload[at])]
                    found += [(ids[i], ids[k], comp[i], comp[k]) for k in at]
            if found:
                out = pd.DataFrame(found, columns=["a", "b", "ca", "cb"])
                if exact:
                    out = out.drop_duplicates(["ca", "cb"])
                yield pd.DataFrame({"a": out[["a", "b"]].min(axis=1), "b": out[["a", "b"]].max(axis=1)})
    return run


def bucket_components(scratch: Scratch, members: DataFrame, facts: Callable[[DataFrame], DataFrame],
                      load: Callable, likely: Callable, confirm: Callable[[DataFrame], DataFrame] | None = None,
                      block: int = 2048, alike: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """(node, root) labels from LSH buckets ``members(key, id)``.

    ``facts(ids)`` gives (id, n, payload, keys) of the members that share a
    bucket: set size, sketch or set as bytes, and their bucket keys as bytes (int64).
    ``load(payloads)`` makes an array of them; ``likely(n_a, a, n_b, b)`` tells which
    pairs may be linked (``a`` may be one row for all) and ``confirm(pairs(a, b))``
    which truly are; without it ``likely`` is exact. With ``alike(n_a, n_b)`` members have
    their set size ``n``, and pairs whose sizes it rules out are never made.

    A bucket isn't expanded into all its pairs: since components are wanted, a
    pair need not be checked once its ends are in one component.

    1. Every member is checked against the pivot it shares most buckets with, the one
       it is likeliest linked to (a bucket's pivot is its smallest member), and the
       components of these links are labelled. This settles near-copy groups with one
       check a member.
    2. In buckets that still hold several components, members are checked against
       pivots of other components than their own.
    3. Buckets that hold several components even then are dealt into blocks. A task
       compares two blocks in numpy and returns only likely pairs of different
       components, each once.

    So every pair that shares a bucket ends in one component or has been
    checked, and no link between bucket mates is lost.
    """
    sized = members if alike else members.withColumn("n", F.lit(0).cast("long"))
    fits = alike or (lambda x, y: F.lit(True))
    spans = scratch.table(
        sized.groupBy("key").agg(F.min(F.struct("id", "n")).alias("pivot"), F.max("id").alias("top"))
        .filter("pivot.id <> top").select("key", F.col("pivot.id").alias("pivot"), F.col("pivot.n").alias("pivot_n")), "buckets")
    sharing = may_be_in(sized, ["key"], spans, ["key"], "_ll_shared").filter("_ll_shared").drop("_ll_shared")
    shared = scratch.table(sharing.join(spans, "key").withColumn("alike", fits(F.col("n"), F.col("pivot_n"))).drop("n", "pivot_n"), "members")
    scratch.drop(spans)
    ids = scratch.table(shared.select("id").distinct(), "ids")
    known = scratch.table(facts(ids), "facts")
    scratch.drop(ids)
    side = {x: known.select(F.col("id").alias(x), F.col("n").alias(f"n_{x}"),
                            F.col("payload").alias(f"payload_{x}")) for x in "ab"}

    def checked(pairs: DataFrame) -> DataFrame:
        links = scratch.table(pairs.join(side["a"], "a").join(side["b"], "b")
                              .mapInPandas(_likely_pairs(load, likely), "a long, b long"), "likely")
        if not confirm:
            return links
        confirmed = scratch.table(confirm(links), "links")
        scratch.drop(links)
        return confirmed

    def labelled(labels: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The members with their components, and the buckets of several components."""
        roots = labels.select(F.col("node").alias("id"), "root")
        rows = scratch.table(shared.join(roots, "id", "left").select("key", "id", "alike", F.coalesce("root", "id").alias("comp")), "comps")
        mixed = scratch.table(
            rows.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("n"),
                                    F.min("id").alias("pivot"), F.min_by("comp", "id").alias("its"))
            .filter("lo <> hi").select("key", "n", "pivot", "its"), "mixed")
        return rows, mixed

    met = shared.filter("id <> pivot and alike").groupBy("id", "pivot").agg(F.count(F.lit(1)).alias("times"))
    pairs = scratch.table(met.groupBy(F.col("id").alias("b")).agg(F.min(F.struct(-F.col("times"), F.col("pivot").alias("a"))).alias("best"))
                          .select("best.a", "b"), "pairs")
    links = checked(pairs)
    labels = components(scratch, links)
    rows, mixed = labelled(labels)
    others = scratch.table(
        rows.join(mixed.select("key", "pivot", "its"), "key").filter("comp <> its and alike")
        .select(F.col("pivot").alias("a"), F.col("id").alias("b")).distinct().join(pairs, ["a", "b"], "left_anti"), "pairs")
    if not others.isEmpty():
        more = checked(others)
        if not more.isEmpty():
            links = scratch.table(links.unionByName(more), "links")
            labels = components(scratch, links)
            scratch.drop(rows, mixed)
            rows, mixed = labelled(labels)
    blocks = scratch.table(dealt(rows.drop("alike"), mixed.select("key", "n"), block), "blocks")
    found = scratch.table(
        blocks.join(known, "id").repartition("key", "one", "two").sortWithinPartitions("key", "one", "two")
        .mapInPandas(_block_pairs(load, likely, confirm is None), "a long, b long"), "likely")
    scratch.drop(shared, rows, blocks, known, mixed)
    fresh = scratch.table(found.join(pairs.unionByName(others), ["a", "b"], "left_anti"), "fresh")
    scratch.drop(found, pairs, others)
    if fresh.isEmpty():
        return labels
    if confirm:
        fresh = scratch.table(confirm(fresh), "links")
    return components(scratch, links.unionByName(fresh))


# --- hashing ---------------------------------------------------------------

def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finalizer over an array (public-domain splitmix constants)."""
    x = x + np.uint64(GOLDEN * (2 * seed + 1) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ascii_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def shingle_set(words: list[bytes], k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles; fewer words than k
    make one shingle, no words none."""
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    width = min(k, len(h))
    n = len(h) - width + 1
    acc = np.zeros(n, np.uint64)
    for j in range(width):
        acc = mix(acc ^ h[j:j + n], j)
    return np.unique(mix(acc, 64 + width))


def signature(s: np.ndarray) -> tuple[int, int]:
    """128 bits that identify a set: two independent order-free sums."""
    if not len(s):
        return 0, 0
    return tuple(int(v) for v in np.array(
        [mix(s, 101).sum(dtype=np.uint64), mix(s, 202).sum(dtype=np.uint64)]).view(np.int64))


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted distinct arrays."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = len(b) - 1
    return int((b[at] == a).sum())


def ints(col: np.ndarray) -> list[int]:
    return col.view(np.int64).tolist()
