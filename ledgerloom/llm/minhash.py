"""Near-duplicate documents by HyperMinHash.

A document's shingle set is hashed once. The top bits of a hash choose one of
1024 registers; of the smallest remaining value per register only the count of
its leading zeros and the next ``MANTISSA`` bits are stored, 8 bits in all. For
banding, an empty register copies the filled one that comes first in its own
random order, so that a register of two documents agrees with a probability equal
to their Jaccard similarity also for short texts. Bucket mates are estimated
from the registers that either fills, with the chance collisions of compressed
registers taken out, and what may reach the threshold is confirmed on the full
sets.

With 6 registers a band and 44 bands a pair at exactly 0.8 is missed with a
probability of (1 - 0.8^6)^44, about 1.5e-6.

Defined results: null or empty texts have the empty set (0 shingles), are
linked with nothing and kept. Rows that share a doc_id count as one document
with several texts: they have one component, to which the links of all of them belong.
A null doc_id has a null component and is kept. Texts with equal sets are one class
before banding, so thousands of copies cost one row. Very long texts are hashed
whole, a text at a time. An empty table gives an empty result. Columns other than
doc_id and text aren't looked at, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (Scratch, ascii_words, bucket_components, importable, may_be_in, mix, named_components, overlap,
                     shingle_set, signature)

BUCKET_BITS = 10
MANTISSA = 4
MAX_ZEROS = 14
ROWS = 6
BANDS = 44
M = 1 << BUCKET_BITS
EMPTY = np.uint8(0xFF)


def _ranks() -> np.ndarray:
    """Per banded register, the place of every register in its own random order."""
    b = np.arange(ROWS * BANDS, dtype=np.uint64)[:, None]
    value = mix(b * np.uint64(M) + np.arange(M, dtype=np.uint64)[None, :], 7)
    return value.argsort(axis=1).argsort(axis=1).astype(np.int16)


RANKS = _ranks()


def sketch(s: np.ndarray) -> np.ndarray:
    """Registers (leading zeros, mantissa) of a sorted hash set; uint8[M]."""
    regs = np.full(M, EMPTY, np.uint8)
    if not len(s):
        return regs
    bucket = (s >> np.uint64(64 - BUCKET_BITS)).astype(np.intp)
    first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    rest = s[first] << np.uint64(BUCKET_BITS)
    # leading zeros from the exponent of the top 53 bits
    zeros = 53 - np.frexp((rest >> np.uint64(11)).astype(np.float64))[1]
    zeros = np.minimum(zeros, MAX_ZEROS).astype(np.uint64)
    mant = (rest << (zeros + np.uint64(1))) >> np.uint64(64 - MANTISSA)
    regs[bucket[first]] = ((zeros << np.uint64(MANTISSA)) | mant).astype(np.uint8)
    return regs


def pack_regs(regs: np.ndarray) -> bytes:
    """A bit per register that is filled, then the filled ones."""
    full = regs != EMPTY
    return np.packbits(full).tobytes() + regs[full].tobytes()


def unpack_regs(packed) -> np.ndarray:
    """One row of registers per packed sketch."""
    packed = list(packed)
    full = np.unpackbits(np.frombuffer(b"".join(p[:M // 8] for p in packed), np.uint8)).reshape(-1, M).astype(bool)
    out = np.full(full.shape, EMPTY, np.uint8)
    out[full] = np.frombuffer(b"".join(p[M // 8:] for p in packed), np.uint8)
    return out


def filled(regs: np.ndarray) -> np.ndarray:
    """The banded registers, the empty ones copied from the filled register that
    comes first in their order."""
    out = regs[:ROWS * BANDS].copy()
    gaps, full = np.flatnonzero(out == EMPTY), np.flatnonzero(regs != EMPTY)
    if len(gaps) and len(full):
        out[gaps] = regs[full[RANKS[np.ix_(gaps, full)].argmin(axis=1)]]
    return out


def band_keys(regs: np.ndarray) -> np.ndarray:
    """One 64-bit key per band of compressed registers."""
    acc = np.arange(BANDS, dtype=np.uint64) + np.uint64(1)
    block = filled(regs).reshape(BANDS, ROWS).astype(np.uint64)
    for j in range(ROWS):
        acc = mix(acc ^ (block[:, j] + np.uint64(1)), j)
    return acc


def chance_collision(n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Probability that filled registers of unrelated sets of these sizes agree:
    both minima fall into the same (zeros, mantissa) cell. With k values a
    register the minimum is above x with probability (1 - x)^k."""
    level = np.arange(MAX_ZEROS + 1, dtype=np.float64)
    hi, lo = 2.0 ** -level, np.where(level < MAX_ZEROS, 2.0 ** -(level + 1), 0)

    def cells(n):
        k = np.maximum(n / M, 1.0)[:, None]
        return (1 - lo) ** k - (1 - hi) ** k
    return (cells(n_a) * cells(n_b)).sum(axis=1) / 2 ** MANTISSA


def estimate(regs_a: np.ndarray, regs_b: np.ndarray, n_a: np.ndarray,
             n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Collision-corrected Jaccard estimates, row by row, and the number of
    registers each rests on (those that either set fills)."""
    used = ((regs_a != EMPTY) | (regs_b != EMPTY)).sum(axis=1)
    both = ((regs_a != EMPTY) & (regs_b != EMPTY)).sum(axis=1)
    same = ((regs_a == regs_b) & (regs_a != EMPTY)).sum(axis=1)
    chance = chance_collision(n_a, n_b)
    # of the registers that both fill, unrelated ones agree by chance
    related = (same - chance * both) / (1 - chance)
    return np.clip(related / np.maximum(used, 1), 0, 1), used


def standard_error(want: float, used: np.ndarray, union: np.ndarray) -> np.ndarray:
    """Error of the estimate at similarity ``want``: registers are a sample of the
    union without replacement (variance of one-permutation hashing), plus the
    share of a register that compression adds."""
    rest = np.maximum(union - 1, 1)
    var = np.maximum((1 + 1 / rest) / np.maximum(used, 1) - 1 / rest, 0)
    return np.sqrt(want * (1 - want) * var + 0.02 * (1 - want) / np.maximum(used, 1))


def _sketches(k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for i, m, t in zip(pdf["doc_id"], pdf["mark"], pdf["text"]):
                s = shingle_set(ascii_words(t), k)
                rows.append((i, m, len(s), *signature(s), pack_regs(sketch(s))))
            yield pd.DataFrame(rows, columns=["doc_id", "mark", "n_shingles", "sig1", "sig2", "regs"]).astype(
                {"doc_id": "Int64"})
    return run


def _banded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        if len(pdf):
            yield pdf.assign(bands=[band_keys(r).view(np.int64) for r in unpack_regs(pdf["regs"])])


def _facts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pd.DataFrame({"id": pdf["id"], "n": pdf["n_shingles"], "payload": pdf["regs"],
                            "keys": [np.asarray(k, np.int64).tobytes() for k in pdf["bands"]]})


def _plausible(percent: int):
    """Pairs whose sizes and corrected estimate allow the threshold: the estimate
    must lie five standard errors below it to rule a pair out."""
    def run(n_a, a, n_b, b) -> np.ndarray:
        want = percent / 100
        n_a, n_b = np.asarray(n_a, float), np.asarray(n_b, float)
        est, used = estimate(a, b, n_a, n_b)
        slack = 5 * standard_error(want, used, (n_a + n_b) / (1 + want))
        return (100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b)) & (est >= want - slack - 1e-9)
    return run


def _full_sets(k: int):
    """The full set of each class, from the texts of the document it was first met in;
    of several texts the one with the class's signature."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for i in range(0, len(pdf), 200):
                rows = []
                for r in pdf.iloc[i:i + 200].itertuples():
                    s = shingle_set(ascii_words(r.text), k)
                    if signature(s) == (r.sig1, r.sig2):
                        rows.append((r.id, s.tobytes()))
                yield pd.DataFrame(rows, columns=["id", "full"])
    return run


def _confirmed(percent: int):
    """Exact test on the full sets."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keep = []
            for x, y in zip(pdf["full_a"], pdf["full_b"]):
                a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = overlap(a, b)
                union = len(a) + len(b) - both
                keep.append(union > 0 and 100 * both >= percent * union)
            yield pdf.loc[keep, ["a", "b"]]
    return run


def _classes(scratch: Scratch, docs: DataFrame, shingle_words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, mark, n_shingles, node), classes' labels (node, root) among them;
    ``node`` is the class of texts with equal sets, NULL for empty sets."""
    importable(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), "text")
    each = scratch.table(texts.mapInPandas(
        _sketches(shingle_words),
        "doc_id long, mark long, n_shingles long, sig1 long, sig2 long, regs binary"), "sketches")
    signed = ["sig1", "sig2", "n_shingles"]
    # the number of a class is fixed once the table is written
    classes = scratch.table(
        each.filter("n_shingles > 0 and doc_id is not null").groupBy(*signed)
        .agg(F.min(F.struct("doc_id", "mark")).alias("at"), F.first("regs").alias("regs"))
        .select(F.monotonically_increasing_id().alias("id"), *signed, "at.*", "regs")
        .mapInPandas(_banded, "id long, sig1 long, sig2 long, n_shingles long, doc_id long, mark long, regs binary, bands array<long>"),
        "classes")
    rows = scratch.table(each.join(classes.select("id", *signed), signed, "left")
                         .select("doc_id", "mark", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("id")).alias("node")), "rows")
    scratch.drop(each)

    def confirm(pairs: DataFrame) -> DataFrame:
        ids = scratch.table(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "wanted")
        wanted = scratch.table(classes.select("id", "sig1", "sig2", "doc_id", "mark").join(ids, "id"), "wanted")
        held = may_be_in(texts, ["doc_id", "mark"], wanted, ["doc_id", "mark"], "_ll_held").filter("_ll_held")
        full = scratch.table(held.join(wanted, ["doc_id", "mark"]).select("id", "sig1", "sig2", "text")
                             .mapInPandas(_full_sets(shingle_words), "id long, full binary"), "full-sets")
        side = {x: full.select(F.col("id").alias(x), F.col("full").alias(f"full_{x}")) for x in "ab"}
        links = scratch.table(pairs.join(side["a"], "a").join(side["b"], "b")
                              .mapInPandas(_confirmed(percent), "a long, b long").distinct(), "confirmed")
        scratch.drop(ids, wanted, full)
        return links

    def facts(ids: DataFrame) -> DataFrame:
        return classes.select("id", "n_shingles", "regs", "bands").join(ids, "id").mapInPandas(
            _facts, "id long, n long, payload binary, keys binary")

    def alike(x, y):
        return 100 * F.least(x, y) >= percent * F.greatest(x, y)

    members = classes.select(F.explode("bands").alias("key"), "id", F.col("n_shingles").alias("n"))
    labels = bucket_components(scratch, members, facts, unpack_regs, _plausible(percent), confirm, alike=alike)
    scratch.drop(classes)
    return rows, labels


def near_duplicates(docs: DataFrame, shingle_words: int = 2, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``docs(doc_id, text)``;
    links are pairs with 100 * intersection >= percent * union."""
    scratch = Scratch(docs.sparkSession, "minhash")
    rows, labels = _classes(scratch, docs, shingle_words, percent)
    named = named_components(scratch, rows.filter("node is not null").select(F.col("doc_id").alias("name"), "node"), labels)
    # a document of which only some texts have words is one document all the same
    whole = named_documents(rows, named)
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return (rows.join(whole, "doc_id", "left")
            .select("doc_id", "n_shingles", component.alias("component_id"),
                    F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept")))


def named_documents(rows: DataFrame, named: DataFrame) -> DataFrame:
    """(doc_id, component) of the documents with a text that has words."""
    return (rows.filter("node is not null").select("doc_id", "node").join(named, "node")
            .groupBy("doc_id").agg(F.min("component").alias("component")))


def keep_one(docs: DataFrame, shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each group of near-duplicate texts: that with the
    smallest (doc_id, hash of the text). Other texts under the same doc_id are texts of
    their own. Of rows equal in doc_id and text the one with the smallest hash over all
    columns stays. Rows without a doc_id or without words all stay. Columns of any name
    are handed on."""
    scratch = Scratch(docs.sparkSession, "keep-one")
    rows, labels = _classes(scratch, docs, shingle_words, percent)
    rooted = scratch.table(rows.filter("node is not null").join(labels, "node", "left")
                           .groupBy("doc_id", "mark", F.coalesce("root", "node").alias("root"))
                           .agg(F.count(F.lit(1)).alias("n")), "texts")
    first = rooted.groupBy("root").agg(F.min(F.struct("doc_id", "mark")).alias("first"))
    fate = scratch.table(
        rooted.join(first, "root").withColumn("stays", F.col("first") == F.struct("doc_id", "mark"))
        .filter("not stays or n > 1").select("doc_id", "mark", "stays"), "fate")
    scratch.drop(rows, rooted)
    packed = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"))
    # only rows that may have a fate are joined with it
    judged = may_be_in(packed, ["doc_id", "mark"], fate, ["doc_id", "mark"], "_ll_judged")
    again = judged.filter("_ll_judged").join(fate, ["doc_id", "mark"], "left")
    one = again.filter("stays").groupBy("doc_id", "mark").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return (judged.filter("not _ll_judged").select("row.*")
            .unionByName(again.filter("stays is null").select("row.*")).unionByName(one.select("row.*")))
