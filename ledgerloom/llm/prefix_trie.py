"""Prefix trie of conversations over minimal-perfect-hash node tables.

A node is a distinct sequence of first turns (role, text), named by a chained
120-bit digest; the root is the empty sequence. Conversations are ordered by turn
and hashed where they are read; texts are never shuffled. Rows of one node are
aggregated with map-side combine, so a first turn that a third of all
conversations share costs one row a task.

Sums over subtrees run in shards, each a task of its own. A shard's digests get
slots of a minimal perfect hash, verified by the digest stored in the slot;
counts are scattered into flat numpy arrays by slot and added up through the
array of parent slots, deepest nodes first.

A shard must hold whole subtrees and yet be bounded, however hot a prefix is.
Every node has a weight, the turns that its members have at or below it, and so
a layer: up to ``shard_rows`` is layer 0, up to ``FAN`` times as much layer 1, and
so on. Weights fall along a path, so the nodes of one layer under one top node
form a connected piece that no other piece of the layer meets, of ``shard_rows``
nodes at most in layer 0 and of ``FAN`` a depth above. Pieces are dealt to shards
by their top node. The layers are worked off from the lowest; the sums of a
piece's top are added to its parent in a higher layer. Their number grows with the
logarithm of the table.

Defined results: rows with a NULL conv_id are no conversation. NULL role or text
is the empty string, a NULL turn comes first, equal turns are ordered by their
content; a repeated row is a turn of its own. Very long texts count in full; a
very long conversation passes through one task as a stream of digests. An empty
table has no nodes. Other columns aren't looked at, whatever their names.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.lookups import sized_broadcast
from .common import Scratch, importable, mix
from .mixing import word_count

#: Nodes that a shard may have, about; and the step of weight from layer to layer.
SHARD_ROWS, FAN = 50_000, 1000
ROOT = bytes(16)
PATHS = "conv_id long, depth int, hi long, lo long, p_hi long, p_lo long, turn_hi long, words long, below long, ends boolean"
SUMS = ("conv_id long, depth int, hi long, lo long, p_hi long, p_lo long, parent_conv_id long, "
        "n_convs long, n_children long, n_leaves long, saved_tokens long, top boolean")


# --- turns -------------------------------------------------------------------

def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, turn_hi, turn_lo, words): each turn's place, digest and words."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)

    def part(at):
        return F.conv(F.substring("digest", at, 15), 16, 10).cast("long")
    rows = (conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn",
                                 digest.alias("digest"), word_count(text).alias("words"))
            .filter("conv_id is not null")
            .select("conv_id", "turn", part(1).alias("turn_hi"), part(16).alias("turn_lo"), "words"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "turn_hi", "turn_lo")
    return rows.select("conv_id", (F.row_number().over(order) - 1).cast("long").alias("pos"), "turn_hi", "turn_lo", "words")


def rebuilt_turns(scratch: Scratch, turns: DataFrame, every: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv_id, total) and turns (conv_id, part, pos, …) where each
    takes its first ``crc32(conv_id) % most`` turns from the conversation
    ``conv_id - conv_id % every``, as far as that has them, and its own turns after
    as many; ``part`` orders the two."""
    sizes = scratch.table(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")), "sizes")
    first = F.crc32(F.col("conv_id").cast("string")) % most
    wanted = sizes.withColumn("h", first).withColumn("base", F.col("conv_id") - F.col("conv_id") % every)
    bases = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    convs = (wanted.join(bases, "base", "left")
             .withColumn("total", F.least("h", F.coalesce("n_base", F.lit(0))) + F.greatest(F.col("n") - F.col("h"), F.lit(0))))
    heads = (turns.filter((F.col("conv_id") % every == 0) & (F.col("pos") < most - 1))
             .withColumnRenamed("conv_id", "base"))
    taken = wanted.join(heads, "base").filter("pos < h")
    own = turns.filter(F.col("pos") >= first)
    columns = ["conv_id", "part", "pos", "turn_hi", "turn_lo", "words"]
    rows = taken.withColumn("part", F.lit(0)).select(*columns).unionByName(
        own.withColumn("part", F.lit(1)).select(*columns))
    return convs.select("conv_id", "total"), rows


def whole_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations and turns as they are, in the form of :func:`rebuilt_turns`."""
    return turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("total")), turns.withColumn("part", F.lit(1))


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted turns -> a row for each prefix; a conversation may span batches."""
    names = PATHS.replace(" long", "").replace(" int", "").replace(" boolean", "").split(", ")
    node, depth, total = ROOT, 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        c = {k: batch.column(k).to_pylist() for k in ("part", "turn_hi", "turn_lo", "total")}
        nodes, parents, depths, totals = [], [], [], []
        for part, hi, lo, n in zip(c["part"], c["turn_hi"], c["turn_lo"], c["total"]):
            if part < 0:  # the conversation itself: its root
                node, depth, total = ROOT, 0, n
                parents.append(ROOT)
            else:
                parents.append(node)
                node = hashlib.sha256(node + struct.pack(">qq", hi, lo)).digest()[:16]
                depth += 1
            nodes.append(node)
            depths.append(depth)
            totals.append(total)
        own, up = (np.frombuffer(b"".join(x), ">i8").astype(np.int64).reshape(-1, 2) for x in (nodes, parents))
        depths, totals = np.array(depths, np.int32), np.array(totals, np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), pa.array(depths), *[pa.array(x[:, j]) for x in (own, up) for j in (0, 1)],
             batch.column("turn_hi"), batch.column("words"), pa.array(totals - depths + 1), pa.array(depths == totals)],
            names=names)


def prefix_paths(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """A row for each conversation and prefix, the root included."""
    start = convs.select("conv_id", F.lit(-1).alias("part"), F.lit(0).cast("long").alias("pos"), F.lit(0).cast("long").alias("turn_hi"),
                         F.lit(0).cast("long").alias("turn_lo"), F.lit(0).cast("long").alias("words"), F.col("total").cast("long").alias("total"))
    rows = start.unionByName(turns.withColumn("total", F.lit(0).cast("long")))
    return (rows.repartition("conv_id").sortWithinPartitions("conv_id", "part", "pos")
            .mapInArrow(_chained, PATHS))


# --- the node table of a shard -------------------------------------------------

class SlotTable:
    """A minimal perfect hash over 128-bit digests. On each level every digest left
    names a place; those alone in theirs are settled, the others go on. A slot is
    the rank of its place, and it holds the digest, so foreign ones are told."""

    def __init__(self, hi: np.ndarray, lo: np.ndarray):
        self.levels = []
        left = np.arange(len(hi))
        place_of = np.zeros(len(hi), np.int64)
        taken = 0
        while len(left):
            at = self._place(hi[left], lo[left], len(self.levels), 2 * len(left))
            alone = np.bincount(at, minlength=2 * len(left)) == 1
            rank = np.where(alone, taken + np.cumsum(alone) - 1, -1)
            settled = rank[at] >= 0
            place_of[left[settled]] = rank[at[settled]]
            taken += int(alone.sum())
            self.levels.append(rank)
            left = left[~settled]
        self.hi, self.lo = np.empty(len(hi), np.int64), np.empty(len(hi), np.int64)
        self.hi[place_of], self.lo[place_of] = hi, lo

    @staticmethod
    def _place(hi: np.ndarray, lo: np.ndarray, level: int, size: int) -> np.ndarray:
        h = mix(hi.view(np.uint64) ^ mix(lo.view(np.uint64), level), level + 1)
        return (h % np.uint64(size)).astype(np.int64)

    def slots(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """The slot of each digest, -1 for one that the table doesn't hold."""
        out = np.full(len(hi), -1, np.int64)
        left = np.arange(len(hi))
        for level, rank in enumerate(self.levels):
            if not len(left):
                break
            found = rank[self._place(hi[left], lo[left], level, len(rank))]
            out[left] = found
            left = left[found < 0]
        known = out >= 0
        known[known] = (self.hi[out[known]] == hi[known]) & (self.lo[out[known]] == lo[known])
        return np.where(known, out, -1)


def _accumulated(pdf: pd.DataFrame) -> pd.DataFrame:
    """Subtree sums of one shard."""
    get = {c: pdf[c].to_numpy(np.int64) for c in
           ("hi", "lo", "p_hi", "p_lo", "conv_id", "depth", "n_convs", "words", "children", "leaves", "saved")}
    table = SlotTable(get["hi"], get["lo"])
    slot = table.slots(get["hi"], get["lo"])
    flat = {}
    for c, values in get.items():
        flat[c] = np.empty(len(slot), np.int64)
        flat[c][slot] = values
    parent = table.slots(flat["p_hi"], flat["p_lo"])
    parent[flat["depth"] == 0] = -1
    inner = parent >= 0
    children = flat["children"] + np.bincount(parent[inner], minlength=len(slot))
    leaves = flat["leaves"] + (children == 0)
    saved = flat["saved"] + (flat["n_convs"] - 1) * flat["words"]
    order = np.argsort(-flat["depth"], kind="stable")
    order = order[inner[order]]
    for same in np.split(order, np.flatnonzero(np.diff(flat["depth"][order])) + 1):
        np.add.at(leaves, parent[same], leaves[same])
        np.add.at(saved, parent[same], saved[same])
    up = pd.array(np.where(inner, flat["conv_id"][parent], 0), "Int64")
    up[~inner] = pd.NA
    return pd.DataFrame({
        "conv_id": flat["conv_id"], "depth": flat["depth"].astype(np.int32), "hi": table.hi, "lo": table.lo,
        "p_hi": flat["p_hi"], "p_lo": flat["p_lo"], "parent_conv_id": up, "n_convs": flat["n_convs"], "n_children": children,
        "n_leaves": leaves, "saved_tokens": saved, "top": ~inner & (flat["depth"] > 0)})


# --- the whole trie --------------------------------------------------------------

def _node_table(scratch: Scratch, paths: DataFrame, shard_rows: int) -> DataFrame:
    both = [f(c).alias(f"{c}_{f.__name__}") for c in ("depth", "p_hi", "p_lo", "turn_hi") for f in (F.min, F.max)]
    nodes = scratch.table(
        paths.groupBy("hi", "lo").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
                                      F.max("words").alias("words"), F.sum("below").alias("weight"), *both), "nodes")
    if not nodes.filter("depth_min <> depth_max or p_hi_min <> p_hi_max or p_lo_min <> p_lo_max or turn_hi_min <> turn_hi_max").isEmpty():
        raise RuntimeError("two prefixes have one digest")
    layer = F.greatest(F.ceil(F.log(F.col("weight") / shard_rows) / F.log(F.lit(float(FAN)))), F.lit(0)).cast("int")
    return nodes.select("hi", "lo", F.col("p_hi_min").alias("p_hi"), F.col("p_lo_min").alias("p_lo"),
                        F.col("depth_min").alias("depth"), "conv_id", "n_convs", "words", layer.alias("layer"))


def _ended(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
    """Streams (hi, lo, conv_id) sorted by all three into a hash a node."""
    node, digest = None, None
    for pdf in batches:
        out = []
        for hi, lo, conv in zip(pdf["hi"].tolist(), pdf["lo"].tolist(), pdf["conv_id"].tolist()):
            if node != (hi, lo):
                if node is not None:
                    out.append((*node, digest.hexdigest()))
                node, digest = (hi, lo), hashlib.sha256(str(conv).encode())
            else:
                digest.update(f",{conv}".encode())
        yield pd.DataFrame(out, columns=["hi", "lo", "ends_sha256"])
    if node is not None:
        yield pd.DataFrame([(*node, digest.hexdigest())], columns=["hi", "lo", "ends_sha256"])


def prefix_trie(scratch: Scratch, convs: DataFrame, turns: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """A row for each node: ``conv_id`` (the smallest member, whose first ``depth``
    turns are the node's), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens`` (words that members share, over the subtree),
    ``ends_sha256`` of the conversations that end there, and the node's digest
    ``prefix``."""
    importable(convs.sparkSession)
    paths = scratch.table(prefix_paths(convs, turns), "paths")
    nodes = scratch.table(_node_table(scratch, paths, shard_rows), "layers")
    counts = {r["layer"]: r["n"] for r in nodes.groupBy("layer").agg(F.count(F.lit(1)).alias("n")).collect()}
    layers = range(max(counts, default=0) + 1)

    upper = nodes.filter("layer > 0")
    marks = sized_broadcast(upper.select("hi", "lo", "layer"))
    level = F.coalesce("layer", F.lit(0))
    tops = paths.join(marks, ["hi", "lo"], "left").groupBy("conv_id").agg(
        *[F.min(F.when(level <= k, F.struct("depth", "hi", "lo"))).alias(f"top_{k}") for k in layers])
    top = F.element_at(F.array(*[F.col(f"top_{k}") for k in layers]), F.col("layer") + 1)
    shards = F.element_at(F.array(*[F.lit(max(1, -(-counts.get(k, 0) // shard_rows))) for k in layers]), F.col("layer") + 1)
    placed = scratch.table(
        nodes.join(tops, "conv_id").withColumn("of", top)
        .withColumn("shard", F.pmod(F.xxhash64("of.hi", "of.lo"), shards)).drop("of", *[f"top_{k}" for k in layers]), "placed")

    done, given = None, None
    for k in layers:
        rows = placed.filter(F.col("layer") == k)
        if given is None:
            zero = F.lit(0).cast("long")
            rows = rows.withColumns({"children": zero, "leaves": zero, "saved": zero})
        else:
            rows = rows.join(given, (F.col("hi") == F.col("g_hi")) & (F.col("lo") == F.col("g_lo")), "left") \
                       .drop("g_hi", "g_lo").fillna(0, ["children", "leaves", "saved"])
        sums = scratch.table(rows.groupBy("shard").applyInPandas(_accumulated, SUMS), f"sums-{k}")
        done = sums if done is None else done.unionByName(sums)
        if k < max(layers):
            given = scratch.table(
                done.filter("top").groupBy(F.col("p_hi").alias("g_hi"), F.col("p_lo").alias("g_lo"))
                .agg(F.count(F.lit(1)).alias("children"), F.sum("n_leaves").alias("leaves"),
                     F.sum("saved_tokens").alias("saved")), f"given-{k}")

    ended = (paths.filter("ends").select("hi", "lo", "conv_id")
             .repartition("hi", "lo").sortWithinPartitions("hi", "lo", "conv_id")
             .mapInPandas(_ended, "hi long, lo long, ends_sha256 string"))
    above = sized_broadcast(upper.select(F.col("hi").alias("u_hi"), F.col("lo").alias("u_lo"), F.col("conv_id").alias("u_conv")))
    named = done.join(above, F.col("top") & (F.col("p_hi") == F.col("u_hi")) & (F.col("p_lo") == F.col("u_lo")), "left")
    prefix = F.lower(F.concat(*[F.lpad(F.hex(c), 16, "0") for c in ("hi", "lo")]))
    return (named.join(ended, ["hi", "lo"], "left")
            .select("conv_id", F.col("depth").cast("long").alias("depth"), F.coalesce("parent_conv_id", "u_conv").alias("parent_conv_id"),
                    "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"), prefix.alias("prefix")))


def conversation_trie(conversations: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The trie of the conversations as they are."""
    scratch = Scratch(conversations.sparkSession, "trie")
    turns = scratch.table(ordered_turns(conversations), "turns")
    return prefix_trie(scratch, *whole_turns(turns), shard_rows)


def rebuilt_trie(conversations: DataFrame, every: int = 20, most: int = 4, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The trie of the conversations rebuilt by :func:`rebuilt_turns`."""
    scratch = Scratch(conversations.sparkSession, "trie")
    turns = scratch.table(ordered_turns(conversations), "turns")
    return prefix_trie(scratch, *rebuilt_turns(scratch, turns, every, most), shard_rows)
