"""Packing into optimal length buckets.

Documents are cut into sequences of at most ``max_tokens`` tokens of a public
tokenizer. The global histogram of sequence lengths (at most ``max_tokens + 1``
rows, whatever the input) goes to a dynamic programme that chooses the
``buckets`` widths with the least padding. Inside a bucket, sequences are dealt
in order of (doc_id, chunk) to batches whose padded size stays within
``token_budget``. The dense position that this takes comes from the library's
distributed key builder (range partitions plus offsets), so no bucket is ever
one task's work, however many sequences share a length.

Defined results: null and empty texts make one sequence of 0 tokens in the
narrowest bucket; repeated rows are packed as often as they occur; null doc_id
comes first. Sequences that tie in (doc_id, chunk), under a repeated doc_id, are placed by
length and a hash of their tokens, so a rerun places them alike. Very long texts are
cut into as many sequences as they need; a task holds ``FLUSH`` tokens besides one
text. An empty table gives an empty result. Other columns aren't looked at, whatever
their names.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.keys import dense_key
from .common import Scratch, importable

#: Tokens that a task holds before it hands them on.
FLUSH = 300_000
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How the tokenizer of VOCABULARY splits text before merging (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=1)
def _encoding(ranks: bytes):
    import tiktoken
    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines()) if a}
    return tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})


def _code_type(ranks: bytes) -> np.dtype:
    """The narrowest of two- and four-byte integers that holds every token."""
    return np.dtype("<u2" if max(int(line.split()[1]) for line in ranks.splitlines() if line.strip()) < 1 << 16 else "<u4")


def _sequences(ranks, max_tokens: int, keep_tokens: bool, packed: np.dtype | None = None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoding(ranks.value).encode_ordinary
        rows: list[tuple] = []
        held: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            ids, chunks, sizes, marks = zip(*rows)
            out = [pa.array(ids, pa.int64()), pa.array(chunks, pa.int64()), pa.array(sizes, pa.int64()), pa.array(marks, pa.int64())]
            names = ["doc_id", "chunk", "n_tokens", "mark"]
            if keep_tokens:
                ends, codes = np.r_[0, np.cumsum(sizes)].astype(np.int32), np.concatenate(held)
                if packed is None:
                    out.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(codes)))
                else:
                    out.append(pa.BinaryArray.from_buffers(
                        pa.binary(), len(sizes), [None, pa.py_buffer(ends * np.int32(packed.itemsize)), pa.py_buffer(codes.astype(packed))]))
                names.append("tokens")
            rows.clear()
            held.clear()
            return pa.RecordBatch.from_arrays(out, names=names)
        n = 0
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                codes = np.array(encode(text.as_py() or ""), np.int32)
                for c, at in enumerate(range(0, max(len(codes), 1), max_tokens)):
                    part = codes[at:at + max_tokens]
                    rows.append((i, c, len(part), xxhash.xxh64_intdigest(part.tobytes()) - 2 ** 63))
                    held.append(part)
                    n += len(part) + 16
                    if n >= FLUSH:
                        yield flush()
                        n = 0
        if rows:
            yield flush()
    return run


def _unpacked(packed: np.dtype):
    """The last column's packed tokens as arrays of int."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            held = batch.column(batch.num_columns - 1).cast(pa.binary())
            ends = np.frombuffer(held.buffers()[1], np.int32)[held.offset:held.offset + len(held) + 1]
            codes = np.frombuffer(held.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]].view(packed).astype(np.int32)
            tokens = pa.ListArray.from_arrays(pa.array((ends - ends[0]) // packed.itemsize), pa.array(codes))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], tokens], names=batch.schema.names)
    return run


def sequences(docs: DataFrame, max_tokens: int = 4096, vocabulary: str = VOCABULARY,
              keep_tokens: bool = True, packed: np.dtype | None = None) -> DataFrame:
    """(doc_id, chunk, n_tokens, mark[, tokens]): the texts in runs of ``max_tokens``;
    ``mark`` is a hash of the tokens. With ``packed`` the tokens are bytes of that type."""
    with open(vocabulary, "rb") as f:
        ranks = docs.sparkSession.sparkContext.broadcast(f.read())
    schema = "doc_id long, chunk long, n_tokens long, mark long"
    if keep_tokens:
        schema += ", tokens array<int>" if packed is None else ", tokens binary"
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(_sequences(ranks, max_tokens, keep_tokens, packed), schema))


def best_widths(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Ascending bucket widths with the least total padded size. ``lengths`` are
    distinct and ascending; the last width is the greatest length."""
    n, d = np.r_[0, np.cumsum(counts, dtype=np.int64)].astype(float), len(lengths)
    widths = np.maximum(lengths, 1)
    cost = np.r_[0.0, widths * n[1:]]  # one bucket up to each length
    choice = []
    for _ in range(1, min(buckets, d)):
        best, at = np.zeros(d + 1), np.zeros(d + 1, np.int64)
        for j in range(1, d + 1):
            total = cost[:j] + widths[j - 1] * (n[j] - n[:j])
            at[j] = total.argmin()
            best[j] = total[at[j]]
        cost = best
        choice.append(at)
    ends, j = [], d
    for at in [*reversed(choice), np.zeros(d + 1, np.int64)]:
        if j == 0:
            break
        ends.append(int(widths[j - 1]))
        j = int(at[j])
    return sorted(set(ends))


def pack(docs: DataFrame, buckets: int = 16, max_tokens: int = 4096, token_budget: int = 65_536,
         vocabulary: str = VOCABULARY, keep_tokens: bool = True) -> DataFrame:
    """One row per sequence: doc_id, chunk, n_tokens, width (padded length),
    batch_id, slot (place in the batch), tokens. Without ``keep_tokens`` the assignment
    alone. On the way tokens are bytes, two each where the vocabulary allows it: they are
    written, shuffled and written again, which takes most of the disk and memory."""
    importable(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "packing")
    with open(vocabulary, "rb") as f:
        packed = _code_type(f.read())

    def unpacked(placed: DataFrame) -> DataFrame:
        return placed.mapInArrow(_unpacked(packed), (
            "doc_id long, chunk long, n_tokens long, width long, batch_id long, slot long, tokens array<int>")) if keep_tokens else placed
    rows = scratch.table(sequences(docs, max_tokens, vocabulary, keep_tokens, packed), "sequences")
    histogram = rows.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")).orderBy("n_tokens").toPandas()
    if histogram.empty:
        return unpacked(rows.select("doc_id", "chunk", "n_tokens", F.lit(0).cast("long").alias("width"),
                                    F.lit(0).cast("long").alias("batch_id"), F.lit(0).cast("long").alias("slot"),
                                    *rows.columns[4:]))
    lengths, counts = histogram["n_tokens"].to_numpy(), histogram["n"].to_numpy()
    widths = best_widths(lengths, counts, buckets)
    # per width: sequences before it, sequences a batch, batches before it
    at = np.searchsorted(widths, np.maximum(lengths, 1))
    size = np.bincount(at, weights=counts, minlength=len(widths)).astype(np.int64)
    per = np.maximum(token_budget // np.array(widths), 1)
    first = np.r_[0, np.cumsum(size)[:-1]]
    batch = np.r_[0, np.cumsum(-(-size // per))[:-1]]

    def by_width(values) -> F.Column:
        out = F.lit(int(values[-1])).cast("long")
        for w, v in list(zip(widths, values))[-2::-1]:
            out = F.when(F.col("n_tokens") <= w, F.lit(int(v)).cast("long")).otherwise(out)
        return out
    sized = rows.withColumn("width", by_width(widths))
    placed = dense_key(sized, ["width", "doc_id", "chunk", "n_tokens", "mark"], "place", start=0, stage_dir=scratch.root)
    scratch.drop(rows)
    inside = F.col("place") - by_width(first)
    return unpacked(placed.select(
        "doc_id", "chunk", "n_tokens", "width",
        (by_width(batch) + F.floor(inside / by_width(per))).cast("long").alias("batch_id"),
        (inside % by_width(per)).cast("long").alias("slot"), *rows.columns[4:]))
