"""Benchmark decontamination with a generalised suffix automaton.

The normalised test items are built into one suffix automaton (a state per set
of end positions, all items inserted from the root). A document's words are
streamed through it while the longest length that matches is tracked: a word
that ends a match of ``window`` words or more is inside the occurrence of a
window, and so are the words before it as far as the match reaches. Items of
fewer words count only as a whole; their states are marked and found along the
suffix links.

Words are runs of characters outside ``\\x00-\\x2F \\x3A-\\x60 \\x7B-\\x7F`` after
lower-casing A-Z. The items must fit a pass of ``tokens_per_pass`` words (the
automaton is then at most twice as many states, broadcast once); more items take
further passes over the documents with the matches so far written between them,
so any number of items is handled exactly.

Defined results: null and empty texts have no words and no hits; an item with
null or empty text matches nothing; an item with null item_id hits but isn't
listed; repeated items and documents count as they come.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch

KEEP = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32
             for c in range(256))
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
STATE = ("_n_words", "_hits", "_items")  # columns added to the documents while matching


def item_words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(KEEP).split() if text else []


class ItemAutomaton:
    """Suffix automaton over the items' word ids with the marks for matching."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        coded = [(name, [self.vocab.setdefault(w, len(self.vocab)) for w in words])
                 for name, words in items if words]
        for _, ids in coded:
            last = 0
            for c in ids:
                last = self._extend(last, c)
        self.windows: list[set | None] = [None] * len(self.len)
        self.shorts: list[list | None] = [None] * len(self.len)
        for name, ids in coded:
            self._mark(name, ids)
        self.near = [-1] * len(self.len)  # nearest state up the links where a short item ends
        for v in sorted(range(1, len(self.len)), key=self.len.__getitem__):
            self.near[v] = v if self.shorts[v] else self.near[self.link[v]]
        self.least = min([window, *(len(ids) for _, ids in coded)])

    def _state(self, length: int, link: int, edges: dict[int, int]) -> int:
        self.next.append(edges)
        self.len.append(length)
        self.link.append(link)
        return len(self.len) - 1

    def _split(self, p: int, q: int, c: int) -> int:
        """The state for the suffixes of q that are one word longer than p."""
        copy = self._state(self.len[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = copy
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, c: int) -> int:
        q = self.next[last].get(c)
        if q is not None:  # another item had these words already
            return q if self.len[q] == self.len[last] + 1 else self._split(last, q, c)
        new = self._state(self.len[last] + 1, 0, {})
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[new] = q if self.len[q] == self.len[p] + 1 else self._split(p, q, c)
        return new

    def _holding(self, v: int, length: int) -> int:
        """The state of the suffix of that length of v's words."""
        while self.len[self.link[v]] >= length:
            v = self.link[v]
        return v

    def _mark(self, name: str | None, ids: list[int]) -> None:
        v = 0
        for i, c in enumerate(ids):
            v = self.next[v][c]
            if i + 1 >= self.window:
                u = self._holding(v, self.window)
                self.windows[u] = (self.windows[u] or set()) | {name}
        if len(ids) < self.window:
            u = self._holding(v, len(ids))
            self.shorts[u] = [*(self.shorts[u] or []), (len(ids), name)]

    def match(self, words: list[bytes]) -> tuple[list[list[int]], set]:
        """Merged half-open ranges of hit words, and the names of items that occur."""
        get, nxt, link, length, near, least, window = (
            self.vocab.get, self.next, self.link, self.len, self.near, self.least, self.window)
        ranges: list[list[int]] = []
        names: set = set()
        v = run = 0
        for i, w in enumerate(words):
            c = get(w)
            if c is None:
                v = run = 0
                continue
            to = nxt[v].get(c)
            while to is None and v:
                v = link[v]
                run = length[v]
                to = nxt[v].get(c)
            if to is None:
                continue
            v, run = to, run + 1
            if run < least:
                continue
            reach = 0
            if run >= window:
                reach = run
                names |= self.windows[self._holding(v, window)]
            s = near[v]
            while s > 0:
                for k, name in self.shorts[s]:
                    if k <= run:
                        names.add(name)
                        reach = max(reach, k)
                s = near[link[s]]
            if reach:
                start = i + 1 - reach
                while ranges and ranges[-1][1] >= start:
                    start = min(start, ranges.pop()[0])
                ranges.append([start, i + 1])
        return ranges, names


def _merged(ranges: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for s, e in sorted(ranges):
        if out and out[-1][1] >= s:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


def _passes(items: DataFrame, tokens_per_pass: int) -> Iterator[list[tuple[str | None, list[bytes]]]]:
    """Items streamed to the driver in groups of a bounded number of words. A
    single longer item makes a pass of its own."""
    group, size = [], 0
    for row in items.select(F.col("item_id").cast("string").alias("name"), "text").toLocalIterator():
        words = item_words(row["text"])
        if group and size + len(words) > tokens_per_pass:
            yield group
            group, size = [], 0
        group.append((row["name"], words))
        size += len(words)
    yield group


def _with(batch: pa.RecordBatch, columns: dict[str, list]) -> pa.RecordBatch:
    for name, values in columns.items():
        at = batch.schema.get_field_index(name)
        batch = batch.set_column(at, batch.schema.field(at), pa.array(values, batch.schema.field(at).type))
    return batch


def _matching(automaton, last: Callable[[pa.RecordBatch], pa.RecordBatch] | None = None) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = automaton.value
        for batch in batches:
            n_words, hits, items = [], [], []
            for text, old_hits, old_items in zip(*(batch.column(c).to_pylist() for c in ("text", *STATE[1:]))):
                words = item_words(text)
                ranges, names = own.match(words)
                if old_hits:
                    ranges = _merged([*ranges, *([x["start"], x["end"]] for x in old_hits)])
                n_words.append(len(words))
                hits.append([{"start": s, "end": e} for s, e in ranges])
                items.append(sorted({*old_items, *(x for x in names if x is not None)}))
            matched = _with(batch, dict(zip(STATE, (n_words, hits, items))))
            yield last(matched) if last else matched
    return run


def match_items(docs: DataFrame, items: DataFrame, window: int = 10, tokens_per_pass: int = 500_000,
                last: Callable[[pa.RecordBatch], pa.RecordBatch] | None = None) -> DataFrame:
    """``docs`` with ``_n_words``, ``_hits`` (merged ranges of word positions) and
    ``_items`` (sorted ids, as strings, of the items that occur). ``last`` goes over the
    matched batches of the last pass in the worker that made them."""
    spark = docs.sparkSession
    state = docs.withColumns({
        STATE[0]: F.lit(0).cast("long"),
        STATE[1]: F.array().cast("array<struct<start:long,end:long>>"),
        STATE[2]: F.array().cast("array<string>")})
    scratch, shared, schema = Scratch(spark, "decontam"), None, state.schema
    for group in _passes(items, tokens_per_pass):
        if shared is not None:
            state = scratch.table(state.mapInArrow(_matching(shared), schema), "pass")
        shared = spark.sparkContext.broadcast(ItemAutomaton(group, window))
    return state.mapInArrow(_matching(shared, last), schema)


def hit_words():
    """Number of hit words of a matched document, as a column."""
    return F.aggregate(F.col(STATE[1]), F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])


def cut_words(text: str, ranges: list[dict]) -> str:
    """The text without the hit words and what lies between words of one range."""
    at = [m.span() for m in WORD.finditer(text)]
    out, done = [], 0
    for r in ranges:
        out.append(text[done:at[r["start"]][0]])
        done = at[r["end"] - 1][1]
    return "".join([*out, text[done:]])


def _cutting(max_coverage: float) -> Callable[[pa.RecordBatch], pa.RecordBatch]:
    """Matched documents without the hit words; those over ``max_coverage`` are left out."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, kept = [], []
        for text, n, hits in zip(*(batch.column(c).to_pylist() for c in ("text", *STATE[:2]))):
            kept.append(sum(h["end"] - h["start"] for h in hits) <= max_coverage * n)
            texts.append(cut_words(text, hits) if hits and kept[-1] else text)
        return _with(batch, {"text": texts}).filter(pa.array(kept, pa.bool_()))
    return run


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 10,
                  max_coverage: float = 0.5) -> DataFrame:
    """``docs`` with contaminated spans removed from the text; a document of whose
    words more than ``max_coverage`` are hit is dropped. One Python worker a task matches
    and cuts, so texts go there and back once."""
    rows = docs.select(F.struct("*").alias("_row"), "text")  # columns of any name pass through
    return match_items(rows, items, window, last=_cutting(max_coverage)).select(
        *(F.col("text") if c == "text" else F.col("_row")[c].alias(c) for c in docs.columns))


def contamination(docs: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = match_items(docs.select("doc_id", "text"), items, window)
    return found.select(
        "doc_id", F.col(STATE[0]).alias("n_words"), hit_words().alias("n_hit"),
        F.size(STATE[2]).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", STATE[2]), 256).alias("items_sha256"),
        (F.size(STATE[1]) > 0).alias("contaminated"))
