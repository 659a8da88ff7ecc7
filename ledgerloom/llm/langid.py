"""Language ID with segmentation-marginalised unigrams.

The pieces come from a fixed public vocabulary. Each language has one
probability per piece. A word's likelihood is the sum over all its
segmentations into pieces, computed by a forward pass over its characters; a
text's log-likelihood is the sum over its words, and the score is the posterior
of the best language under equal priors.

The probabilities are learned by expectation maximisation on a bounded sample of
labelled rows (``sample_rows``, chosen by a hash of the row): word counts per
language are aggregated by Spark, and each E-step is a job over the distinct
words that returns expected piece counts, summed per (language, piece).

Forward and backward passes run in numpy over all distinct words of a batch at
once: substring ids by a rolling hash against the sorted hashes of the pieces'
prefixes, then one vector step per (end position, piece length).

Words are runs of letters, lower-cased; runs of more than ``LONGEST`` letters are
scored in parts of that length, so that no likelihood underflows. All letters of
a text count; a batch is scored ``WORDS`` words at a time, so that memory follows
neither the length nor the number of its texts.

Defined results: null texts and texts without a letter (signs like a half or a
superscript two are none) are ``und`` with score 0; repeated rows get equal rows; ties
go to the language that sorts first; without any labelled row everything is ``und``; an
empty table gives an empty result. Extra columns aren't looked at by
:func:`identify` and handed on by :func:`accept`, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, drawn, importable

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
LETTERS = re.compile(r"[^\W\d_]+")
SPACE = re.compile(r"\s")
PART = 500_000
START = "▁"  # marks the start of a word in the vocabulary
LONGEST = 32
FLOOR = 1e-7  # probability of a character that is no piece of its own
BASE = np.uint64(0x100000001B3)
MAX_CELLS = 8_000_000  # languages x pieces that a model may hold
WORDS, NODES = 100_000, 200_000  # words, and lattice nodes of them, scored at a time
MEMO_CELLS = 800_000  # languages x words whose likelihoods a task remembers


def pieces_of(text: str | None) -> Iterator[str]:
    """The text in parts of about ``PART`` characters, cut at white space."""
    at = 0
    while text and at < len(text):
        m = SPACE.search(text, at + PART)
        end = m.start() if m else len(text)
        yield text[at:end]
        at = end


def words_of(text: str | None) -> list[str]:
    found = LETTERS.findall(text.lower()) if text else []
    if found and (not "".join(found).isalpha() or max(map(len, found)) > LONGEST):
        # the pattern also takes signs that are numeric without being digits
        runs = [w for run in found for w in ((run,) if run.isalpha() else "".join(c if c.isalpha() else " " for c in run).split())]
        found = [w[i:i + LONGEST] for w in runs for i in range(0, len(w), LONGEST)]
    return found


def vocabulary_pieces(path: str = VOCABULARY) -> list[str]:
    """Pieces of letters in lower case, with or without the start mark."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {sp.id_to_piece(i) for i in range(sp.get_piece_size())}
    return sorted(p for p in pieces if p == p.lower() and LETTERS.fullmatch(p.removeprefix(START)))


class Lattice:
    """All occurrences of pieces in a list of words, ready for vector passes."""

    def __init__(self, pieces: list[str]):
        self.n = len(pieces)
        self.depth = max(map(len, pieces))
        self.levels = []  # per length: sorted prefix hashes, piece ids or -1
        found: list[dict[int, int]] = [{} for _ in range(self.depth)]
        for i, p in enumerate(pieces):
            h = 0
            for k, c in enumerate(p):
                h = (h * int(BASE) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
                found[k].setdefault(h, -1)
            found[len(p) - 1][h] = i
        for level in found:
            keys = np.array(sorted(level), np.uint64)
            self.levels.append((keys, np.array([level[int(k)] for k in keys], np.int64)))

    def occurrences(self, words: list[str]) -> tuple[np.ndarray, list[tuple[int, int, np.ndarray, np.ndarray]]]:
        """Word offsets into a flat array of lattice nodes, and per (end, length)
        the end nodes and piece ids. A word of c characters has c + 1 nodes."""
        marked = [START + w for w in words]
        size = np.fromiter(map(len, marked), np.int64, len(marked))
        chars = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        first = np.r_[0, np.cumsum(size)[:-1]]
        offset = np.arange(len(chars)) - np.repeat(first, size)
        left = np.repeat(size, size) - offset
        node = np.arange(len(chars)) + np.repeat(np.arange(len(size)), size)
        alive = np.arange(len(chars))
        h = np.zeros(len(chars), np.uint64)
        parts = []
        for k in range(1, self.depth + 1):
            alive = alive[left[alive] >= k]
            if not len(alive):
                break
            h[alive] = h[alive] * BASE + chars[alive + k - 1] + np.uint64(1)
            keys, ids = self.levels[k - 1]
            at = np.minimum(np.searchsorted(keys, h[alive]), len(keys) - 1)
            known = keys[at] == h[alive]
            piece = np.where(known, ids[at], -1)
            if k == 1:  # a character that is no piece has the floor probability
                parts.append((alive, 1, np.where(piece >= 0, piece, self.n)))
            else:
                hit = piece >= 0
                parts.append((alive[hit], k, piece[hit]))
            alive = alive[known]
        steps = []
        for start, k, piece in parts:
            end = offset[start] + k
            order = np.argsort(end, kind="stable")
            cut = np.flatnonzero(np.diff(end[order])) + 1
            for group in np.split(order, cut):
                if len(group):
                    steps.append((int(end[group[0]]), k, node[start[group]] + k, piece[group]))
        steps.sort(key=lambda s: (s[0], s[1]))
        return first + np.arange(len(size)), size, steps

    def forward(self, words: list[str], p: np.ndarray):
        """alpha over the nodes (rows) and languages, with the lattice used."""
        first, size, steps = self.occurrences(words)
        alpha = np.zeros((int(size.sum()) + len(size), p.shape[1]))
        alpha[first] = 1
        for _, k, node, piece in steps:
            alpha[node] += alpha[node - k] * p[piece]
        return alpha, first, size, steps

    def log_likelihood(self, words: list[str], p: np.ndarray) -> np.ndarray:
        alpha, first, size, _ = self.forward(words, p)
        return np.log(alpha[first + size])

    def expected(self, words: list[str], counts: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Expected number of uses of each piece for one language."""
        alpha, first, size, steps = self.forward(words, p)
        beta = np.zeros_like(alpha)
        last = first + size
        beta[last] = (counts / alpha[last, 0])[:, None]
        out = np.zeros(self.n + 1)
        for _, k, node, piece in reversed(steps):
            flow = beta[node, 0] * p[piece, 0]
            beta[node - k, 0] += flow
            out += np.bincount(piece, alpha[node - k, 0] * flow, self.n + 1)
        return out


class Model:
    """Languages and their piece probabilities (a column each, last row the floor)."""

    def __init__(self, pieces: list[str], langs: list[str], expected: np.ndarray | None = None):
        if (len(pieces) + 1) * len(langs) > MAX_CELLS:
            raise ValueError(f"{len(langs)} languages are more than a broadcast model may hold")
        self.pieces, self.langs = pieces, langs
        p = np.ones((len(pieces) + 1, len(langs))) if expected is None else expected + 0.05
        p[-1] = 0
        p /= p.sum(axis=0)
        p = np.maximum(p, FLOOR)
        self.p = p
        self._lattice = None
        self._at: dict[str, int] = {}
        self._logs: np.ndarray | None = None

    def __getstate__(self):
        return {**self.__dict__, "_lattice": None, "_at": {}, "_logs": None}

    @property
    def lattice(self) -> Lattice:
        if self._lattice is None:
            self._lattice = Lattice(self.pieces)
        return self._lattice

    def _likelihoods(self, distinct: list[str]) -> np.ndarray:
        """Log-likelihoods of words, those of frequent ones from the memo."""
        room = max(MEMO_CELLS // len(self.langs), 2 * len(distinct))
        if self._logs is None or len(self._logs) < room:
            self._at, self._logs = {}, np.empty((room, len(self.langs)))
        new = [w for w in distinct if w not in self._at]
        if len(self._at) + len(new) > len(self._logs):
            self._at, new = {}, distinct
        first = 0
        while first < len(new):
            last, nodes = first, 0
            while last < len(new) and nodes < NODES:
                nodes += len(new[last]) + 2
                last += 1
            at = len(self._at)
            self._logs[at:at + last - first] = self.lattice.log_likelihood(new[first:last], self.p)
            self._at.update(zip(new[first:last], range(at, at + last - first)))
            first = last
        return self._logs[[self._at[w] for w in distinct]]

    def scores(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Best language and its posterior, text by text."""
        langs, score = np.full(len(texts), "und", object), np.zeros(len(texts))
        if not self.langs:
            return langs.tolist(), score
        total, size = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts), np.int64)
        words: list[str] = []
        owner: list[tuple[int, int]] = []
        most = max(1000, min(WORDS, MEMO_CELLS // (4 * len(self.langs))))

        def flush() -> None:
            at, distinct = pd.factorize(np.array(words, object))
            logs = self._likelihoods(list(distinct))[at]
            rows, counts = np.array(owner).T
            np.add.at(total, rows, np.add.reduceat(logs, np.r_[0, np.cumsum(counts)[:-1]], axis=0))
            words.clear()
            owner.clear()
        for i, text in enumerate(texts):
            for piece in pieces_of(text):
                found = words_of(piece)
                for k in range(0, len(found), most):
                    part = found[k:k + most]
                    size[i] += len(part)
                    words += part
                    owner.append((i, len(part)))
                    if len(words) >= most:
                        flush()
        if words:
            flush()
        full = np.flatnonzero(size)
        best = total[full].argmax(axis=1)
        langs[full] = np.array(self.langs, object)[best]
        score[full] = 1 / np.exp(total[full] - total[full].max(axis=1, keepdims=True)).sum(axis=1)
        return langs.tolist(), score


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        c: Counter = Counter()
        for lang, text in zip(pdf["lang"], pdf["text"]):
            for piece in pieces_of(text):
                c.update((lang, w) for w in words_of(piece))
        yield pd.DataFrame([(lang, w, n) for (lang, w), n in c.items()], columns=["lang", "word", "n"])


def _expected(shared):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model: Model = shared.value
        total = np.zeros((len(model.pieces) + 1, len(model.langs)))
        for pdf in batches:
            for lang, part in pdf.groupby("lang"):
                j = model.langs.index(lang)
                total[:, j] += model.lattice.expected(
                    part["word"].tolist(), part["n"].to_numpy(float), model.p[:, [j]])
        piece, lang = np.nonzero(total)
        yield pd.DataFrame({"piece": piece, "lang": lang, "n": total[piece, lang]})
    return run


def train(labelled: DataFrame, sample_rows: int = 6000, rounds: int = 2,
          vocabulary: str = VOCABULARY) -> Model:
    """Model from ``labelled(doc_id, text, lang)``; rows without text or lang are left
    out, and about ``sample_rows`` of the others drawn. Every language is learned: of
    one with a small share, a quarter of an even part of the sample, or all of it, is
    drawn instead of its share."""
    spark = labelled.sparkSession
    importable(spark)
    rows = labelled.select("doc_id", "text", F.col("lang").cast("string").alias("lang")).filter("text is not null and lang is not null")
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MAX_CELLS).collect()  # more couldn't be learned
    even = sample_rows / max(sum(r["n"] for r in sizes), 1)
    if even < 1:
        least = sample_rows / (4 * len(sizes))
        shares = spark.createDataFrame([(r["lang"], min(1.0, max(even, least / r["n"]))) for r in sizes], "l string, share double")
        rows = (rows.join(F.broadcast(shares), F.col("lang") == F.col("l"))
                .filter(drawn(F.col("share"), "doc_id", "text")).select("doc_id", "text", "lang"))
    scratch = Scratch(spark, "langid")
    counts = scratch.table(rows.select("text", "lang").mapInPandas(_counted, "lang string, word string, n long")
                           .groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    langs = sorted(r[0] for r in counts.select("lang").distinct().collect())
    model = Model(vocabulary_pieces(vocabulary), langs)
    for _ in range(rounds if langs else 0):
        got = (counts.mapInPandas(_expected(spark.sparkContext.broadcast(model)), "piece long, lang long, n double")
               .groupBy("piece", "lang").agg(F.sum("n").alias("n")).toPandas())  # at most MAX_CELLS rows
        expected = np.zeros((len(model.pieces) + 1, len(langs)))
        expected[got["piece"], got["lang"]] = got["n"]
        model = Model(model.pieces, langs, expected)
    scratch.drop(counts)
    return model


def held_out() -> Column:
    """Documents that are never learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def _predicted(shared):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            lang, score = shared.value.scores(pdf["text"].tolist())
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "held_out": pdf["held_out"],
                                "lang_pred": lang, "score": score})
    return run


def identify(docs: DataFrame, sample_rows: int = 6000) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score; learned from the labelled rows
    of ``docs`` that aren't held out."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").withColumn("held_out", held_out())
    model = train(own.filter(~F.col("held_out")), sample_rows)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return own.select("doc_id", "held_out", "text").mapInPandas(
        _predicted(shared), "doc_id long, held_out boolean, lang_pred string, score double")


def _accepted(shared, least: float):
    @F.pandas_udf("boolean")
    def keep(texts: pd.Series) -> pd.Series:
        if shared.value.langs:
            lang, score = shared.value.scores(texts.tolist())
            return pd.Series([x != "und" and s >= least for x, s in zip(lang, score)], dtype=bool)
        # nothing to learn from: only texts without a letter go
        return pd.Series([any(map(words_of, pieces_of(t))) for t in texts], dtype=bool)
    return keep


def accept(docs: DataFrame, least_score: float = 0.5, sample_rows: int = 6000) -> DataFrame:
    """``docs`` without the rows that have no letter, or whose best language
    stays under ``least_score``. Only the texts go through Python."""
    model = train(docs.filter(~held_out()), sample_rows)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.filter(_accepted(shared, least_score)(F.col("text")))
