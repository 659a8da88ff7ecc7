"""Repeated passages by paragraph MinHash banding and exact word runs.

A paragraph is a line; a line of more than ``LONG_LINE`` words is cut after
sentences chosen by their own hash, so that a passage inside two different long
lines is cut alike in both. Paragraphs of at least ``min_words`` words take
part. Equal ones (same words, by 128 bits) are one class; classes are banded on 16
MinHash values of their 5-word shingles, 8 bands of 2 rows: a pair at Jaccard 0.8 is
missed with a probability of 2.8e-4, at 0.85 of 3.5e-5. Few rows a band are enough,
since unrelated paragraphs hardly share five words in a row. Bucket mates are verified on
the exact shingle sets, components over the confirmed links give the clusters,
and of each cluster the first paragraph in (doc_id, mark, start) order stays.

Besides, every run of ``RUN`` equal words or more is found wherever it lies, also
inside a line or across line ends. A window of ``RUN`` words is anchored at the smallest hash
of its ``GRAM``-word shingles, so equal windows have equal anchors; a document has one
row for each anchor, about one for 16 words, with the range of windows it stands for and
128 bits of all their words. Only anchors whose shingle occurs twice go on. Occurrences
with equal contexts are one class, and one row of it tells where its windows occur
first; windows are listed one by one only for classes that share a shingle with a
different class, once for each class. A window is removed if its first occurrence is an
earlier place that it doesn't overlap. Of removed windows, what no removed paragraph
covers is removed as spans of its own. Either rule refers to an earlier place, so the
first copy stays.

Defined results: a document is a row; rows equal in doc_id and text are treated alike,
so what stays in one stays in each, and other texts under the same doc_id are
documents of their own, told apart by ``mark``, a hash of the text. Null and empty
texts have no paragraph; a paragraph repeated inside one document keeps its first
place; offsets are code points with exclusive ends; documents with null doc_id are
left as they are. Very long texts are read whole, one at a time. An empty table gives an
empty result. Other columns, whatever their names, aren't looked at by
:func:`repeated_passages` and handed on by :func:`remove_repeats`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, ascii_words, bucket_components, importable, may_be_in, mix, overlap, shingle_set

SHINGLE = 5
ROWS, BANDS = 2, 8
LONG_LINE = 60
CUT_ONE_IN = 3
RUN, GRAM = 50, 20
SENTENCE = re.compile(r"[.!?]\s+")
FACTORS = mix(np.arange(ROWS * BANDS, dtype=np.uint64), 11) | np.uint64(1)


def paragraphs(text: str | None, min_words: int) -> list[tuple[int, int, list[bytes]]]:
    """(start, end, words) of the paragraphs with at least ``min_words`` words."""
    out, at = [], 0
    for line in text.split("\n") if text else ():
        words = ascii_words(line)
        if len(words) <= LONG_LINE:
            if len(words) >= min_words:
                out.append((at, at + len(line), words))
        else:
            start = last = 0
            for m in SENTENCE.finditer(line):
                chosen = xxhash.xxh64_intdigest(line[last:m.start()].strip().encode("utf-8", "surrogatepass"))
                last = m.end()
                if chosen % CUT_ONE_IN == 0:
                    _add(out, at, line, start, m.end(), min_words)
                    start = m.end()
            _add(out, at, line, start, len(line), min_words)
        at += len(line) + 1
    return out


def _add(out: list, at: int, line: str, start: int, end: int, min_words: int) -> None:
    words = ascii_words(line[start:end])
    if len(words) >= min_words:
        out.append((at + start, at + end, words))


def band_keys(paras: list[list[bytes]]) -> np.ndarray:
    """One row of band keys per paragraph; all shingles of the batch at once."""
    size = np.fromiter(map(len, paras), np.int64, len(paras))
    h = np.fromiter((xxhash.xxh64_intdigest(w) for ws in paras for w in ws), np.uint64, int(size.sum()))
    h = np.r_[h, np.zeros(SHINGLE, np.uint64)]
    n = int(size.sum())
    grams = np.zeros(n, np.uint64)
    for j in range(SHINGLE):
        grams = mix(grams ^ h[j:n + j], j)
    # shingles that run over the end of a paragraph are left out; a paragraph of
    # fewer words keeps its first one
    first = np.r_[0, np.cumsum(size)[:-1]]
    inside = np.arange(n) - np.repeat(first, size) <= np.repeat(np.maximum(size - SHINGLE, 0), size)
    grams, per = grams[inside], np.maximum(size - SHINGLE + 1, 1)
    starts = np.r_[0, np.cumsum(per)[:-1]]
    keys = np.zeros((len(paras), BANDS), np.uint64)
    for b in range(BANDS):
        acc = np.full(len(paras), b + 1, np.uint64)
        for j in range(ROWS):
            i = b * ROWS + j
            value = grams * FACTORS[i]
            acc = mix(acc ^ np.minimum.reduceat(value ^ (value >> np.uint64(32)), starts), j)
        keys[:, b] = acc
    return keys


def word_bounds(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code point starts and ends of the ``ascii_words`` of a text."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = np.r_[False, (code != 32) & ((code < 9) | (code > 13)), False]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def grams(h: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Hashes of all runs of ``k`` word hashes, put together from powers of two."""
    def joined(a: np.ndarray, b: np.ndarray, shift: int) -> np.ndarray:
        n = max(len(b) - shift, 0)
        return mix(a[:n] * FACTORS[0] ^ b[shift:], seed)
    part, size, out, done = mix(h, seed), 1, None, 0
    while done < k:
        if k & size:
            out = part if out is None else joined(out, part, done)
            done += size
        if done < k:
            part, size = joined(part, part, size), 2 * size
    return out


def anchors(grams_: np.ndarray) -> np.ndarray:
    """Per window of ``RUN`` words the place of its smallest shingle hash, the first
    one if it occurs twice in the window."""
    width, size = RUN - GRAM + 1, 1
    at, low = np.arange(len(grams_)), grams_

    def lesser(at, low, shift):
        left = low[:-shift] <= low[shift:]
        return np.where(left, at[:-shift], at[shift:]), np.where(left, low[:-shift], low[shift:])
    while 2 * size <= width:
        at, low = lesser(at, low, size)
        size *= 2
    return lesser(at, low, width - size)[0] if width > size else at


#: Words whose windows are hashed together: many short texts at once, a longer one alone.
CHUNK_WORDS = 100_000


def _hashed(texts: Iterator) -> Iterator[tuple[np.ndarray, list[int], np.ndarray, np.ndarray]]:
    """Chunks of the texts of at least ``RUN`` words: the hashes of their words one text
    after another, places of the texts, where each begins, and its number of words."""
    parts, places, size, total = [], [], [], 0

    def chunk():
        n = np.array(size)
        return np.concatenate(parts), places, np.cumsum(n) - n, n
    for i, text in enumerate(texts):
        words = ascii_words(text)
        if len(words) < RUN:
            continue
        parts.append(np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)))
        places.append(i)
        size.append(len(words))
        total += len(words)
        if total >= CHUNK_WORDS:
            yield chunk()
            parts, places, size, total = [], [], [], 0
    if parts:
        yield chunk()


ANCHORS = "key long, doc_id long, mark long, w long, n int, c1 long, c2 long"


def _anchor_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A row for each anchor of a document: the shingle's hash, the windows ``w`` to
    ``w + n - 1`` it stands for, and their words as 128 bits. The first and the last of
    these windows overlap, so they cover all of them."""
    for pdf in batches:
        ids, marks = pdf["doc_id"].to_numpy(), pdf["mark"].to_numpy()
        for h, places, begin, size in _hashed(pdf["text"]):
            g = grams(h, GRAM, 1)
            # windows inside one text; those of two texts never have one anchor
            per = size - RUN + 1
            own = np.repeat(begin - (np.cumsum(per) - per), per) + np.arange(per.sum())
            at = anchors(g)[own]
            first = np.flatnonzero(np.r_[True, np.diff(at) != 0])
            last = np.r_[first[1:], len(at)] - 1
            a, z = own[first], own[last]
            shape = mix(((z - a) << 6 | (at[first] - a)).astype(np.uint64), 5)
            c = [mix(mix(w[a] ^ shape, 6) ^ w[z], 7).view(np.int64) for w in (grams(h, RUN, 2), grams(h, RUN, 3))]
            of = np.searchsorted(begin, a, "right") - 1
            rows = np.asarray(places)[of]
            yield pd.DataFrame({"key": g[at[first]].view(np.int64), "doc_id": ids[rows], "mark": marks[rows], "w": a - begin[of],
                                "n": (z - a + 1).astype(np.int32), "c1": c[0], "c2": c[1]})


def _window_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The windows of the contexts that ``at`` lists of a document."""
    for pdf in batches:
        ids, marks, listed = pdf["doc_id"].to_numpy(), pdf["mark"].to_numpy(), pdf["at"].tolist()
        for h, places, begin, _ in _hashed(pdf["text"]):
            h1, h2 = (grams(h, RUN, k).view(np.int64) for k in (2, 3))
            k = np.fromiter((len(listed[p]) for p in places), np.int64, len(places))
            w, n, c1, c2 = np.array([(r["w"], r["n"], r["c1"], r["c2"]) for p in places for r in listed[p]], np.int64).reshape(-1, 4).T
            rows, base = np.repeat(np.repeat(places, k), n), np.repeat(np.repeat(begin, k), n)
            i = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            w = np.repeat(w, n) + i
            yield pd.DataFrame({"h1": h1[base + w], "h2": h2[base + w], "doc_id": ids[rows], "mark": marks[rows], "w": w,
                                "c1": np.repeat(c1, n), "c2": np.repeat(c2, n), "i": i})


def _of_documents(texts: DataFrame, rows: DataFrame) -> DataFrame:
    """``texts`` with the columns of ``rows(doc_id, mark, …)``, one for a document. Texts of
    other documents aren't shuffled."""
    held = may_be_in(texts, ["doc_id", "mark"], rows, ["doc_id", "mark"], "_ll_held").filter("_ll_held")
    return held.join(rows, ["doc_id", "mark"])


def repeated_windows(texts: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc_id, mark, w, to): windows ``w`` to before ``to`` of ``RUN`` words that also
    occur in an earlier place. ``texts(doc_id, mark, text)`` are distinct."""
    found = scratch.table(texts.mapInPandas(_anchor_rows, ANCHORS), "anchors")
    shared = scratch.table(
        found.groupBy("key").agg(F.count(F.lit(1)).alias("k"), *[f(c).alias(f"{c}_{f.__name__}") for c in ("c1", "c2") for f in (F.min, F.max)])
        .filter("k > 1").select("key", F.expr("c1_min <> c1_max or c2_min <> c2_max").alias("mixed")), "shared")
    live = scratch.table(
        may_be_in(found, ["key"], shared, ["key"], "_ll_shared").filter("_ll_shared").drop("_ll_shared").join(shared, "key"), "live")
    scratch.drop(found, shared)
    spot = F.struct("doc_id", "mark", "w")
    classes = scratch.table(
        live.groupBy("c1", "c2").agg(F.min(spot).alias("first"), F.max("n").alias("n"), F.max("mixed").alias("mixed")), "contexts")
    # windows of contexts that others may share in part, once for each context
    listed = scratch.table(
        classes.filter("mixed").groupBy("first.doc_id", "first.mark")
        .agg(F.collect_list(F.struct("first.w", "n", "c1", "c2")).alias("at")), "listed")
    windows = scratch.table(
        _of_documents(texts, listed).mapInPandas(
            _window_rows, "h1 long, h2 long, doc_id long, mark long, w long, c1 long, c2 long, i int"), "windows")
    scratch.drop(listed)
    first = windows.groupBy("h1", "h2").agg(F.min(spot).alias("where"), F.count(F.lit(1)).alias("k")).filter("k > 1")
    elsewhere = scratch.table(
        windows.join(first, ["h1", "h2"]).filter(F.col("where") != spot)
        .groupBy("c1", "c2").agg(F.map_from_entries(F.collect_list(F.struct("i", "where"))).alias("elsewhere")), "elsewhere")
    scratch.drop(windows)

    def earlier(doc, mark, w, at):
        here, there = F.struct(F.col("doc_id"), F.col("mark")), F.struct(doc, mark)
        return (there < here) | ((there == here) & (w + RUN <= at))
    placed = live.select("doc_id", "mark", "w", "n", "c1", "c2").join(classes.select("c1", "c2", "first"), ["c1", "c2"]) \
                 .join(elsewhere, ["c1", "c2"], "left")
    whole = placed.filter("elsewhere is null").filter(
        earlier(F.col("first.doc_id"), F.col("first.mark"), F.col("first.w"), F.col("w"))).select(
        "doc_id", "mark", "w", (F.col("w") + F.col("n")).alias("to"))

    def gone(i):
        own = F.struct(F.col("first.doc_id").alias("doc_id"), F.col("first.mark").alias("mark"), (F.col("first.w") + i).alias("w"))
        x = F.coalesce(F.element_at("elsewhere", i), own)
        return earlier(x["doc_id"], x["mark"], x["w"], F.col("w") + i)
    single = placed.filter("elsewhere is not null").select(
        "doc_id", "mark", "w", F.explode(F.filter(F.sequence(F.lit(0), F.col("n") - 1), gone)).alias("i"))
    out = scratch.table(whole.unionByName(single.select("doc_id", "mark", (F.col("w") + F.col("i")).alias("w"),
                                                        (F.col("w") + F.col("i") + 1).alias("to"))), "gone")
    scratch.drop(live, classes, elsewhere)
    return out


def merged(paras: list[dict], windows: list[dict], start: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """Spans of the removed paragraphs and of the words of removed windows outside
    them, in order; ``start`` and ``end`` are the offsets of the text's words."""
    out = [(p["start"], p["end"]) for p in paras]
    joined: list[list[int]] = []
    for x in windows:
        if joined and x["w"] <= joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], x["to"] - 1 + RUN)
        else:
            joined.append([x["w"], x["to"] - 1 + RUN])
    i = 0
    for at, stop in joined:
        while i < len(paras) and paras[i]["w1"] <= at:
            i += 1
        k = i
        begin, last = int(start[at]), int(end[stop - 1])
        while k < len(paras) and paras[k]["w0"] < stop:
            if paras[k]["w0"] > at:
                out.append((begin, paras[k]["start"]))
            at, begin = paras[k]["w1"], paras[k]["end"]
            k += 1
        if at < stop:
            out.append((begin, last))
    return sorted(out)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        spans = []
        for text, p, w in zip(*(batch.column(c).to_pylist() for c in ("text", "removed", "windows"))):
            spans.append([{"start": s, "end": e} for s, e in merged(p or [], w or [], *word_bounds(text))])
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("doc_id", "mark")), pa.array(spans, kind)], names=["doc_id", "mark", "removed"])


def _paragraph_rows(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 500):
                batch = whole.slice(i, 500)
                per, starts, ends, w0, words = [], [], [], [], []
                for text in batch.column("text").to_pylist():
                    found = paragraphs(text, min_words)
                    per.append(len(found))
                    if found:
                        begin, end, ws = zip(*found)
                        starts += begin
                        ends += end
                        w0.append(np.searchsorted(word_bounds(text)[0], begin))
                        words += ws
                if not words:
                    continue
                sigs = b"".join(xxhash.xxh3_128_digest(b" ".join(ws)) for ws in words)
                sig = np.frombuffer(sigs, ">i8").astype(np.int64).reshape(-1, 2)
                w0 = np.concatenate(w0)
                size = np.fromiter(map(len, words), np.int64, len(words))
                keys = band_keys(words).view(np.int64)
                of = np.repeat(np.arange(batch.num_rows), per)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).take(pa.array(of)) for c in ("doc_id", "mark")), pa.array(starts, pa.int64()), pa.array(ends, pa.int64()),
                     pa.array(w0.astype(np.int32)), pa.array((w0 + size).astype(np.int32)), pa.array(sig[:, 0].copy()), pa.array(sig[:, 1].copy()),
                     pa.ListArray.from_arrays(np.arange(len(words) + 1, dtype=np.int32) * BANDS, keys.ravel())],
                    names=["doc_id", "mark", "start", "end", "w0", "w1", "sig1", "sig2", "bands"])
    return run


def _facts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        sets = [shingle_set(ascii_words(t), SHINGLE) for t in pdf["text"]]
        yield pd.DataFrame({"id": pdf["id"], "n": [len(s) for s in sets], "payload": [s.tobytes() for s in sets],
                            "keys": [np.asarray(k, np.int64).tobytes() for k in pdf["bands"]]})


def _sets(payload) -> np.ndarray:
    out = np.empty(len(payload), object)
    out[:] = [np.frombuffer(p, np.uint64) for p in payload]
    return out


def _similar(percent: int):
    """Exact Jaccard test on the shingle sets."""
    def run(n_a, sets_a, n_b, sets_b) -> np.ndarray:
        out = np.zeros(len(n_a), bool)
        for i, (na, nb) in enumerate(zip(n_a, n_b)):
            if 100 * min(na, nb) >= percent * max(na, nb):
                both = overlap(sets_a[i if len(sets_a) > 1 else 0], sets_b[i])
                out[i] = 100 * both >= percent * (na + nb - both)
        return out
    return run


def distinct_texts(scratch: Scratch, docs: DataFrame) -> DataFrame:
    """(doc_id, mark, text) of the documents, each once. Rows that repeat both are
    few or none, so the texts stay where they are unless there are any."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), "text") \
                .filter("doc_id is not null and text is not null")
    twice = scratch.table(texts.groupBy("doc_id", "mark").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("doc_id", "mark"), "twice")
    if twice.isEmpty():
        return texts
    told = may_be_in(texts, ["doc_id", "mark"], twice, ["doc_id", "mark"], "_ll_twice")
    once = told.filter("_ll_twice").groupBy("doc_id", "mark").agg(F.first("text").alias("text"))
    return told.filter("not _ll_twice").drop("_ll_twice").unionByName(once)


PARAGRAPHS = "doc_id long, mark long, start long, end long, w0 int, w1 int, sig1 long, sig2 long, bands array<long>"


def repeated_paragraphs(texts: DataFrame, min_words: int, percent: int, scratch: Scratch) -> DataFrame:
    """(doc_id, mark, start, end, w0, w1, cluster, n, first) per paragraph that takes part:
    its words from ``w0`` to before ``w1``, ``n`` paragraphs in its cluster,
    ``first`` if it is the one that stays."""
    each = scratch.table(texts.mapInArrow(_paragraph_rows(min_words), PARAGRAPHS), "paragraphs")
    # the number of a class is fixed once the table is written
    classes = scratch.table(
        each.groupBy("sig1", "sig2").agg(
            F.min(F.struct("doc_id", "mark", "start", "end")).alias("at"), F.first("bands").alias("bands"))
        .withColumn("id", F.monotonically_increasing_id()), "classes")
    rows = scratch.table(each.drop("bands").join(classes.select("sig1", "sig2", "id"), ["sig1", "sig2"]).drop("sig1", "sig2"), "rows")
    scratch.drop(each)

    def facts(ids: DataFrame) -> DataFrame:
        where = scratch.table(classes.select("id", "at.*", "bands").join(ids, "id"), "places")
        held = may_be_in(texts, ["doc_id", "mark"], where, ["doc_id", "mark"], "_ll_held").filter("_ll_held")
        cut = F.substring("text", F.col("start") + 1, F.col("end") - F.col("start"))
        return (held.join(where, ["doc_id", "mark"]).select("id", cut.alias("text"), "bands")
                .mapInPandas(_facts, "id long, n long, payload binary, keys binary"))

    members = classes.select(F.explode("bands").alias("key"), "id")
    labels = bucket_components(scratch, members, facts, _sets, _similar(percent))
    scratch.drop(classes)
    named = scratch.table(
        rows.join(labels.withColumnRenamed("node", "id"), "id", "left")
        .select("doc_id", "mark", "start", "end", "w0", "w1", F.coalesce("root", "id").alias("cluster")), "named")
    scratch.drop(rows)
    spot = F.struct("doc_id", "mark", "start")
    clusters = scratch.table(
        named.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.min(spot).alias("keeper")).filter("n > 1"), "clusters")
    return named.join(clusters, "cluster", "left").select(
        "doc_id", "mark", "start", "end", "w0", "w1", "cluster", F.coalesce("n", F.lit(1)).alias("n"),
        F.coalesce(F.col("keeper") == spot, F.lit(True)).alias("first"))


def _per_document(docs: DataFrame, min_words: int, percent: int) -> DataFrame:
    """Per (doc_id, mark): counts of its paragraphs and the removed spans in order."""
    importable(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "substring")
    texts = distinct_texts(scratch, docs)
    gone = ~F.col("first")
    paras = scratch.table(
        repeated_paragraphs(texts, min_words, percent, scratch).groupBy("doc_id", "mark").agg(
            F.count(F.lit(1)).alias("n_paragraphs"),
            F.count(F.when(F.col("n") > 1, 1)).alias("n_repeated"),
            F.array_sort(F.collect_list(F.when(gone, F.struct("start", "end", "w0", "w1")))).alias("removed")), "per-document")
    windows = scratch.table(repeated_windows(texts, scratch).groupBy("doc_id", "mark").agg(
        F.array_sort(F.collect_set(F.struct("w", "to"))).alias("windows")), "runs")
    cut = paras.filter(F.size("removed") > 0).select("doc_id", "mark", "removed").join(windows, ["doc_id", "mark"], "full")
    spans = scratch.table(
        _of_documents(texts, scratch.table(cut, "cut")).select("doc_id", "mark", "text", "removed", "windows").mapInArrow(
            _merged, "doc_id long, mark long, removed array<struct<start:long,end:long>>"), "spans")
    return paras.drop("removed").join(spans, ["doc_id", "mark"], "full")


def repeated_passages(docs: DataFrame, min_words: int = 15, percent: int = 80) -> DataFrame:
    """Per document: doc_id, n_paragraphs (that take part), n_repeated (that have
    a copy anywhere), n_removed, removed_chars, removed (``start:end``, comma-joined)."""
    spans = _per_document(docs, min_words, percent)
    gone = F.coalesce("removed", F.array().cast("array<struct<start:long,end:long>>"))
    zero = F.lit(0).cast("long")
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"))
            .join(spans, ["doc_id", "mark"], "left")
            .select("doc_id", F.coalesce("n_paragraphs", zero).alias("n_paragraphs"),
                    F.coalesce("n_repeated", zero).alias("n_repeated"),
                    F.size(gone).cast("long").alias("n_removed"),
                    F.aggregate(gone, zero, lambda n, s: n + s["end"] - s["start"]).alias("removed_chars"),
                    F.array_join(F.transform(gone, lambda s: F.concat_ws(
                        ":", s["start"].cast("string"), s["end"].cast("string"))), ",").alias("removed")))


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("removed").to_pylist()):
            for s in reversed(spans):
                before, after = text[:s["start"]], text[s["end"]:]
                text = before + (after.removeprefix("\n") if before[-1:] in ("", "\n") else after)
            texts.append(text)
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], names=["row", "text"])


def remove_repeats(docs: DataFrame, min_words: int = 15, percent: int = 80) -> DataFrame:
    """``docs`` with every repeated paragraph and word run but the first cut from the text."""
    spans = _per_document(docs, min_words, percent).filter(F.size("removed") > 0).select("doc_id", "mark", "removed")
    spans = Scratch(docs.sparkSession, "substring").table(spans, "removed")
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"))
    told = may_be_in(rows, ["doc_id", "mark"], spans, ["doc_id", "mark"], "_ll_cut")
    joined = told.filter("_ll_cut").join(spans, ["doc_id", "mark"], "left")
    touched = joined.filter("removed is not null").select("row", F.col("row.text").alias("text"), "removed")
    cut = touched.mapInArrow(_without, touched.select("row", "text").schema)
    return (told.filter("not _ll_cut").select("row.*").unionByName(joined.filter("removed is null").select("row.*"))
            .unionByName(cut.select(*[F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns])))
