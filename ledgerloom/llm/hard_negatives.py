"""Hard negatives by segment summaries.

Vectors are quantised to integers, floor(``scale`` * x), and a score is their inner
product. Each vector is stored with a summary: for segments of 16 and of 4
components, the mean times the root of the segment's length, and the deviation
(the length of what the mean leaves). For two vectors

    sum(mean * mean) - sum(dev * dev)  <=  score  <=  sum(mean * mean) + sum(dev * dev)

so a pair is scored exactly only if neither the coarse nor the fine bounds show it
to lie outside every range that is still open.

Anchors are the rows whose vec_id ``every`` divides. They are taken in chunks of
``CHUNK`` that are broadcast; for each chunk the table is scanned twice. The first
scan gives each anchor its positives, the second, for each of these, the best
rows of another label within ``least`` to ``most`` per cent of its score. A task
keeps the best few rows of each range as it reads, and the last of them raises
the range's lower end, so that the bounds get sharper as it goes. Tasks hand out these
rows only, and one window joins them. A hot label or a large group of equal
vectors is spread like any other rows.

Defined results: rows with a NULL vec_id, label or vector, with a NULL or
non-finite component, or whose squared length in integers reaches 2^62 take no
part; a label that is no number is NULL. Vectors of different lengths aren't
compared. Rows equal in vec_id, label and vector are one row; those that share a
vec_id only are different rows. Ties go to the smaller vec_id. Fewer rows than asked
for are all returned; an anchor without a positive, or a positive without a
negative, has no row; an empty table gives an empty result. Other columns aren't
looked at, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, importable

SEGMENTS = (16, 4)          # components of a segment, coarse to fine
CHUNK = 32_768              # anchors that are broadcast at once
ANCHORS, ROWS = 512, 2048   # pairs that are bounded at once
SPARSE = 0.1                # share of pairs up to which they are scored one by one
PAIRS = 65_536              # of those, scored at once
LIMIT = 2.0 ** 62
STORED = "vec_id long, label long, n int, vec binary, means binary, devs binary"
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


# --- vectors and their summaries ---------------------------------------------

def _starts(n: int, width: int) -> np.ndarray:
    return np.arange(0, n, width)


def summaries(v: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Per level the scaled means and the deviations of the rows' segments."""
    means, devs = [], []
    for width in SEGMENTS:
        at = _starts(v.shape[1], width)
        size = np.diff(np.r_[at, v.shape[1]])
        mean = np.add.reduceat(v, at, axis=1) / np.sqrt(size) if len(at) else v[:, :0]
        square = np.add.reduceat(v * v, at, axis=1) if len(at) else v[:, :0]
        means.append(mean)
        devs.append(np.sqrt(np.maximum(square - mean * mean, 0)))
    return means, devs


def _stored(scale: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            column = batch.column("embedding")
            size = np.diff(column.offsets.to_numpy())
            flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
            at = np.r_[0, np.cumsum(size)]
            ids, labels = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("vec_id", "label"))
            for n in np.unique(size):
                own = np.flatnonzero(size == n)
                v = flat[at[own][:, None] + np.arange(n)]
                with np.errstate(over="ignore", invalid="ignore"):
                    v = np.floor(scale * v)
                    fine = np.isfinite(v).all(axis=1) & ((v * v).sum(axis=1) < LIMIT)
                own, v = own[fine], v[fine]
                means, devs = (np.hstack(x).astype("<f4") for x in summaries(v))
                yield pd.DataFrame({"vec_id": ids[own], "label": labels[own], "n": np.int32(n),
                                    "vec": [r.tobytes() for r in v.astype("<i4")],
                                    "means": [r.tobytes() for r in means], "devs": [r.tobytes() for r in devs]})
    return run


def stored_vectors(vectors: DataFrame, scale: float) -> DataFrame:
    """(vec_id, label, n, vec, means, devs) of the rows that take part."""
    rows = vectors.select(F.col("vec_id").try_cast("long").alias("vec_id"), F.col("label").try_cast("long").alias("label"),
                          F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.filter("vec_id is not null and label is not null and embedding is not null").mapInArrow(
        _to_arrow(_stored(scale)), STORED)


def _to_arrow(run):
    """A function of record batches that yields frames, as one that yields batches."""
    def wrapped(batches):
        for pdf in run(batches):
            yield pa.RecordBatch.from_pandas(pdf, preserve_index=False)
    return wrapped


@dataclass
class Block:
    """Vectors of one length, with their summaries."""
    vec_id: np.ndarray
    label: np.ndarray
    mark: np.ndarray
    vec: np.ndarray
    means: list[np.ndarray]
    devs: list[np.ndarray]
    norm: np.ndarray

    @classmethod
    def of(cls, pdf: pd.DataFrame) -> Block:
        n = int(pdf["n"].iloc[0])
        cuts = np.cumsum([len(_starts(n, w)) for w in SEGMENTS])
        vec, means, devs = (np.frombuffer(b"".join(pdf[c]), t).astype(float).reshape(len(pdf), -1 if n else 0)
                            for c, t in (("vec", "<i4"), ("means", "<f4"), ("devs", "<f4")))
        return cls(*[pdf[c].to_numpy(np.int64) for c in ("vec_id", "label", "mark")], vec,
                   np.split(means, cuts, axis=1)[:-1], np.split(devs, cuts, axis=1)[:-1], np.sqrt((vec * vec).sum(axis=1)))

    def __getitem__(self, at) -> Block:
        return Block(self.vec_id[at], self.label[at], self.mark[at], self.vec[at],
                     [m[at] for m in self.means], [d[at] for d in self.devs], self.norm[at])

    def __len__(self) -> int:
        return len(self.vec_id)


# --- scoring -------------------------------------------------------------------

def _exact(a: Block, b: Block) -> bool:
    """Whether doubles hold all partial sums (bounded by the lengths)."""
    return a.norm.max(initial=0) * b.norm.max(initial=0) < 2.0 ** 53


def _dense(a: Block, b: Block) -> np.ndarray:
    if _exact(a, b):
        return (a.vec @ b.vec.T).astype(np.int64)
    return a.vec.astype(np.int64) @ b.vec.astype(np.int64).T


def open_pairs(a: Block, b: Block, alive: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, score) of the pairs of ``alive`` whose bounds meet lo[i] .. hi[i]."""
    slack = 1e-5 * a.norm[:, None] * b.norm[None, :] + 1e-3  # the summaries are single precision
    for level in range(len(SEGMENTS)):
        if alive.mean() <= SPARSE:
            break
        mid, dev = a.means[level] @ b.means[level].T, a.devs[level] @ b.devs[level].T + slack
        alive = alive & (mid + dev >= lo[:, None]) & (mid - dev <= hi[:, None])
    else:
        if alive.mean() > SPARSE:
            s = _dense(a, b)
            i, j = np.nonzero(alive & (s >= lo[:, None]) & (s <= hi[:, None]))
            return i, j, s[i, j]
    found = []
    for at in np.array_split(np.flatnonzero(alive), max(1, -(-int(alive.sum()) // PAIRS))):
        i, j = np.divmod(at, len(b))
        for level in range(len(SEGMENTS)):
            mid, dev = (np.einsum("ij,ij->i", x[level][i], y[level][j]) for x, y in ((a.means, b.means), (a.devs, b.devs)))
            dev += slack[i, j]
            keep = (mid + dev >= lo[i]) & (mid - dev <= hi[i])
            i, j = i[keep], j[keep]
        kind = float if _exact(a, b) else np.int64
        s = np.einsum("ij,ij->i", a.vec[i].astype(kind), b.vec[j].astype(kind)).astype(np.int64)
        keep = (s >= lo[i]) & (s <= hi[i])
        found.append((i[keep], j[keep], s[keep]))
    return tuple(np.concatenate(x) for x in zip(*found))


class Best:
    """The best ``keep`` rows of every range (anchor, k) seen so far."""

    COLUMNS = ("at", "k", "score", "vec_id", "mark")

    def __init__(self, lo: np.ndarray, keep: int):
        self.lo, self.keep = lo.astype(float), keep
        self.rows = {c: np.empty(0, np.int64) for c in self.COLUMNS}

    def add(self, **new: np.ndarray) -> None:
        r = {c: np.concatenate([self.rows[c], new[c]]) for c in self.COLUMNS}
        order = np.lexsort((r["mark"], r["vec_id"], -r["score"], r["k"], r["at"]))
        r = {c: v[order] for c, v in r.items()}
        same = np.ones(len(order), bool)  # as the row before
        group = np.ones(len(order), bool)
        if len(order):
            group[1:] = (np.diff(r["at"]) == 0) & (np.diff(r["k"]) == 0)
            group[0] = same[0] = False
            same[1:] = group[1:] & (np.diff(r["vec_id"]) == 0) & (np.diff(r["mark"]) == 0)
        r = {c: v[~same] for c, v in r.items()}
        first = ~group[~same]
        start = np.flatnonzero(first)
        rank = np.arange(len(first)) - np.repeat(start, np.diff(np.r_[start, len(first)]))
        last = rank == self.keep - 1
        self.lo[r["at"][last], r["k"][last]] = np.maximum(self.lo[r["at"][last], r["k"][last]], r["score"][last])
        self.rows = {c: v[rank < self.keep] for c, v in r.items()}


def _merge(best: Best, first: int, anchors: Block, rows: Block, alive: np.ndarray, hi: np.ndarray) -> None:
    """Adds the open pairs of one block; the anchors' ranges are rows of lo and hi."""
    own = slice(first, first + len(anchors))
    lo, top = best.lo[own], hi[own]
    i, j, s = open_pairs(anchors, rows, alive, lo.min(axis=1), top.max(axis=1))
    for k in range(lo.shape[1]):
        at = np.flatnonzero((s >= lo[i, k]) & (s <= top[i, k]))
        if len(at) > 4 * best.keep * len(anchors):  # many at first: the best rows of the block are enough
            order = at[np.lexsort((rows.mark[j[at]], rows.vec_id[j[at]], -s[at], i[at]))]
            start = np.flatnonzero(np.r_[True, np.diff(i[order]) != 0])
            rank = np.arange(len(order)) - np.repeat(start, np.diff(np.r_[start, len(order)]))
            at = order[rank < best.keep]
        if len(at):
            best.add(at=i[at] + first, k=np.full(len(at), k), score=s[at], vec_id=rows.vec_id[j[at]], mark=rows.mark[j[at]])


def _scan(shared, same: bool, keep: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        chunk = {n: (block, Best(lo, keep), hi) for n, (block, lo, hi) in shared.value.items()}
        for pdf in batches:
            pdf = pdf.drop_duplicates(["vec_id", "mark"])
            for n, part in pdf[pdf["n"].isin(list(chunk))].groupby("n"):
                anchors, best, hi = chunk[n]
                part = part.sort_values("label")
                for r in range(0, len(part), ROWS):
                    rows = Block.of(part.iloc[r:r + ROWS])
                    # anchors lie by label, so for positives only a few blocks meet the rows
                    s, e = (np.searchsorted(anchors.label, rows.label[[0, -1]], side=x)[y] for x, y in (("left", 0), ("right", 1))) \
                        if same else (0, len(anchors))
                    for a in range(s, e, ANCHORS):
                        block = anchors[a:min(a + ANCHORS, e)]
                        alike = block.label[:, None] == rows.label[None, :]
                        if same:
                            alike &= (block.vec_id[:, None] != rows.vec_id[None, :]) | (block.mark[:, None] != rows.mark[None, :])
                        alive = alike if same else ~alike
                        if alive.any():
                            _merge(best, a, block, rows, alive, hi)
        for n, (anchors, best, _) in chunk.items():
            r = best.rows
            yield pd.DataFrame({"anchor_id": anchors.vec_id[r["at"]], "anchor_mark": anchors.mark[r["at"]], "k": r["k"],
                                "vec_id": r["vec_id"], "mark": r["mark"], "score": r["score"]})
    return run


def _best_rows(scratch: Scratch, rows: DataFrame, chunk: dict, same: bool, keep: int, name: str) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(chunk)
    found = rows.mapInPandas(_scan(shared, same, keep),
                             "anchor_id long, anchor_mark long, k long, vec_id long, mark long, score long")
    order = Window.partitionBy("anchor_id", "anchor_mark", "k").orderBy(F.col("score").desc(), "vec_id", "mark")
    return scratch.table(found.withColumn("rank", F.dense_rank().over(order)).filter(F.col("rank") <= keep).distinct(), name)


def _by_length(pdf: pd.DataFrame) -> dict[int, Block]:
    return {int(n): Block.of(part.sort_values(["label", "vec_id", "mark"])) for n, part in pdf.groupby("n")}


def _open(block: Block) -> tuple[Block, np.ndarray, np.ndarray]:
    return block, np.full((len(block), 1), -np.inf), np.full((len(block), 1), np.inf)


def _ranges(block: Block, positives: pd.DataFrame, count: int, least: int, most: int) -> tuple[Block, np.ndarray, np.ndarray]:
    """Range k of an anchor: ``least`` to ``most`` per cent of its k-th positive's score."""
    lo, hi = np.full((len(block), count), np.inf), np.full((len(block), count), -np.inf)
    row = pd.Series(np.arange(len(block)), index=pd.MultiIndex.from_arrays([block.vec_id, block.mark]))
    at = row.reindex(pd.MultiIndex.from_frame(positives[["anchor_id", "anchor_mark"]])).to_numpy()
    own = ~np.isnan(at)
    at, k, score = at[own].astype(int), positives["rank"].to_numpy()[own] - 1, positives["score"].to_numpy()[own]
    lo[at, k] = [float(-(-least * int(s) // 100)) for s in score]  # score >= least % of it, in integers
    hi[at, k] = [float(most * int(s) // 100) for s in score]
    return block, lo, hi


def hard_negatives(vectors: DataFrame, every: int = 100, positives: int = 5, negatives: int = 5,
                   least: int = 80, most: int = 100, scale: float = 256.0) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)."""
    spark = vectors.sparkSession
    importable(spark)
    scratch = Scratch(spark, "negatives")
    rows = scratch.table(stored_vectors(vectors, scale).withColumn("mark", F.xxhash64("label", "vec")), "vectors")
    anchors = scratch.table(rows.filter(F.col("vec_id") % every == 0).dropDuplicates(["vec_id", "mark"]), "anchors")
    chunks = -(-anchors.count() // CHUNK)
    out = spark.createDataFrame([], RESULT)
    for c in range(chunks):
        own = _by_length(anchors.filter(F.pmod(F.xxhash64("vec_id", "mark"), F.lit(chunks)) == c).toPandas())
        near = _best_rows(scratch, rows, {n: _open(b) for n, b in own.items()}, True, positives, "positives")
        known = near.toPandas()  # a few rows for each anchor of the chunk
        found = _best_rows(scratch, rows, {n: _ranges(b, known, positives, least, most) for n, b in own.items()},
                           False, negatives, "negatives")
        pairs = near.select("anchor_id", "anchor_mark", (F.col("rank") - 1).cast("long").alias("k"), F.col("vec_id").alias("positive_id"),
                            F.col("score").alias("positive_score"))
        out = out.unionByName(
            found.join(pairs, ["anchor_id", "anchor_mark", "k"])
            .select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"),
                    "positive_score", F.col("score").alias("negative_score")))
    return out
