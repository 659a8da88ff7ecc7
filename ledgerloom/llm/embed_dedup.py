"""Near-duplicate embeddings by Euclidean p-stable hashing.

Vectors are normalised; a table's key is the vector of ``PROJECTIONS``
quantised Gaussian projections floor((a.x + b) / WIDTH) together with label and
dimension. Two unit vectors with cosine 0.93 lie 0.374 apart and agree in one
projection with a probability of 0.85, in a table with 0.27; with 45 tables a
link at the threshold is missed with a probability of 5e-7. Bucket mates are
checked by their exact cosine in double precision.

A bucket is dealt into blocks of about ``BLOCK`` rows; each task compares two
blocks by a matrix product and returns one row per vector (its links in these
blocks) and a spanning forest of the links, never the pairs. A link is counted
only in the first table in which its ends share a key, so no distinct over
links is needed.

Defined results: a label may be of any type; labels of others than integers are
compared by 64 bits. Null or zero vectors, vectors with null or non-finite
components and vectors without label are linked with nothing, are their own
component and kept. Vectors of different length aren't compared. Equal vectors
of a label are one class with a count. A null vec_id has a null component, is
kept and still counts as a link of its copies. Rows that share a vec_id with different
vectors have links of their own and one component. Two cosines that tie at the threshold
are both links. An empty table gives an empty result. Other columns aren't looked at,
whatever their names; a vector is as long as a row of the table may be.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from .common import Scratch, components, dealt, importable, mix, named_components, runs

PROJECTIONS = 8
TABLES = 45
WIDTH = 2.0
BLOCK = 512


@lru_cache(maxsize=4)
def _planes(dim: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20_011 + dim)
    return (rng.standard_normal((dim, TABLES * PROJECTIONS)),
            rng.uniform(0, WIDTH, TABLES * PROJECTIONS))


def unit(vectors: list) -> np.ndarray:
    x = np.asarray(vectors, np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # keeps squares of extreme components finite
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def table_keys(x: np.ndarray, label: np.ndarray) -> np.ndarray:
    """64-bit keys, one row per unit vector and one column per table."""
    planes, shift = _planes(x.shape[1])
    cell = np.floor((x @ planes + shift) / WIDTH).astype(np.int64).astype(np.uint64)
    cell = cell.reshape(len(x), TABLES, PROJECTIONS)
    acc = mix(mix(label.astype(np.int64).astype(np.uint64), 3)[:, None]
              ^ np.arange(TABLES, dtype=np.uint64)[None, :], x.shape[1])
    for j in range(PROJECTIONS):
        acc = mix(acc ^ cell[:, :, j], j)
    return acc


def _by_dim(pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
    for _, part in pdf.groupby(pdf["vec"].map(len)):
        yield part


def _keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for part in _by_dim(pdf):
            keys = table_keys(unit(part["vec"].tolist()), part["label"].to_numpy())
            yield pd.DataFrame({"key": keys.reshape(-1).view(np.int64),
                                "id": np.repeat(part["id"].to_numpy(), TABLES)})


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest row reachable from each of n rows by links (a, b)."""
    root = np.arange(n)
    while True:
        low = root.copy()
        np.minimum.at(low, a, root[b])
        np.minimum.at(low, b, root[a])
        low = low[low]
        if (low == root).all():
            return root
        root = low


def _block(part: pd.DataFrame, cosine: float) -> pd.DataFrame | None:
    """Links between two blocks of a bucket, or inside one."""
    part = part.sort_values("id", kind="stable")
    side, ids = part["side"].to_numpy(), part["id"].to_numpy()
    x = unit(part["vec"].tolist())
    near = np.triu(x @ x.T >= cosine, 1)
    if part["one"].iloc[0] != part["two"].iloc[0]:
        near &= side[:, None] != side[None, :]
    a, b = np.nonzero(near)
    if not len(a):
        return None
    keys = table_keys(x, part["label"].to_numpy())
    table = int((keys[0] == np.uint64(int(part["key"].iloc[0]) & 0xFFFFFFFFFFFFFFFF)).argmax())
    first = (keys[a] == keys[b]).argmax(axis=1) == table
    copies = part["copies"].to_numpy()
    count = np.zeros(len(ids), np.int64)
    np.add.at(count, a[first], copies[b[first]])
    np.add.at(count, b[first], copies[a[first]])
    root = ids[_forest(len(ids), a, b)]
    tied = (count > 0) | (root != ids)
    return pd.DataFrame({"id": ids[tied], "links": count[tied], "root": root[tied]})


def _compare(cosine: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in runs(batches, ["key", "one", "two"]):
            out = _block(part, cosine)
            if out is not None:
                yield out
    return run


def near_embeddings(vectors: DataFrame, cosine: float = 0.93) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of
    ``vectors(vec_id, embedding, label)``."""
    importable(vectors.sparkSession)
    scratch = Scratch(vectors.sparkSession, "embeddings")
    x = F.col("vec")
    label = F.col("label") if isinstance(vectors.schema["label"].dataType, IntegralType) else F.xxhash64("label")
    fine = (F.col("label").isNotNull() & x.isNotNull()
            & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
            & F.exists(x, lambda v: v != 0))
    each = (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(F.col("label").isNotNull(), label.cast("long")).alias("label"),
                           F.col("embedding").alias("vec"))
            .withColumn("fine", F.coalesce(fine, F.lit(False)))
            .withColumn("sig1", F.xxhash64("label", "vec"))
            .withColumn("sig2", F.xxhash64(F.lit("second"), "vec", "label")))
    classes = scratch.table(
        each.filter("fine").groupBy("sig1", "sig2")
        .agg(F.count("vec_id").alias("named"), F.count(F.lit(1)).alias("copies"), F.first(F.struct("label", "vec")).alias("v"))
        .filter("named > 0").select("sig1", "sig2", F.monotonically_increasing_id().alias("id"), "copies", "v.label", "v.vec"), "classes")
    members = scratch.table(classes.select("id", "label", "vec").mapInPandas(_keys, "key long, id long"), "keys")
    buckets = scratch.table(members.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "buckets")
    blocks = scratch.table(dealt(members, buckets, BLOCK), "blocks")
    compared = scratch.table(
        blocks.join(classes.select("id", "label", "vec", "copies"), "id")
        .repartition("key", "one", "two").sortWithinPartitions("key", "one", "two")
        .mapInPandas(_compare(cosine), "id long, links long, root long"), "compared")
    scratch.drop(members, buckets, blocks)
    roots = components(scratch, compared.select(F.col("id").alias("a"), F.col("root").alias("b")))
    counts = scratch.table(compared.groupBy("id").agg(F.sum("links").alias("links")), "counts")
    own = scratch.table(each.drop("vec", "label").join(classes.select("sig1", "sig2", "id", "copies", F.lit(True).alias("fine")), ["sig1", "sig2", "fine"], "left")
                        .select("vec_id", F.col("id").alias("node"), "copies"), "rows")
    scratch.drop(classes)
    named = named_components(scratch, own.filter("node is not null and vec_id is not null").select(F.col("vec_id").alias("name"), "node"), roots)
    found = named.join(counts.withColumnRenamed("id", "node"), "node", "left")
    # rows that share a vec_id are one vector with several values: one component
    whole = (own.filter("node is not null").select("vec_id", "node").join(named, "node")
             .groupBy("vec_id").agg(F.min("component").alias("of")))
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("of", "vec_id"))
    links = F.when(F.col("node").isNotNull(), F.coalesce("links", F.lit(0)) + F.col("copies") - 1).otherwise(0)
    return (own.join(found, "node", "left").join(whole, "vec_id", "left")
            .select("vec_id", links.cast("long").alias("n_links"), component.alias("component_id"),
                    F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept")))
