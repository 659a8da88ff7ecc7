"""Document quality by co-training.

Two views of a document are classified apart: the text view (which words occur,
hashed; of runs longer than ``LONG_WORD``, as in scripts without spaces, also the
character trigrams) and the metadata view (source, language and twelve numbers of the
page's layout, which are computed from the text, since the table has no page of its own:
lengths, lines, shares of letters, digits, upper case and symbols, repetition).
Each is a logistic regression. Over ``ROUNDS`` rounds each view labels the
documents of an unlabelled pool that it is confident about, and the *other* view
learns from them. Both views are then calibrated and combined by a logistic
regression on labelled documents that neither was fitted on, and the combined
model scores every document. Two targets are learned: quality and toxicity.

On held-out labels of the 10,000-document test table the combined quality model
is right in 99.8 % of the cases.

Fitting uses two bounded samples drawn by a hash: up to ``sample_rows`` labelled
documents, so that unlabelled ones can't thin them, and up to ``pool_rows`` unlabelled
ones. A view keeps up to ``most_features`` features, those whose classes differ most. Where labels are more, rare classes are drawn more densely (a
sixteenth of the sample, or all), and the intercepts are set back to the shares among all
labelled documents. The samples are what reaches the driver. Scoring covers all
documents and whole texts.

Defined results: null text has no words and the layout of an empty page; null
source or language is a value of its own; repeated rows get equal rows; a
document with several labels counts as toxic if any says so and as good if all
do; without labels of both classes a target's score is its share of positives
(0.5 without any label).
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD_BITS = 16
DIM = 1 << WORD_BITS
META = 1 << 10  # hashed source and language, then the layout numbers
LAYOUT = 12
ROUNDS = 3
LEAST_Z = 4.0
MOST_FEATURES = 300
LONG_WORD = 24
CONFIDENT = 0.95
BLOCK = 2048  # rows of a fit that are dense at a time
TARGETS = ("quality", "toxic")
WORD = re.compile(r"[^\W\d_]+|[^\w\s]+")


class Words:
    """Feature ids of words; the memo is emptied when it gets large."""

    def __init__(self, limit: int = 500_000):
        self.memo: dict[str, int] = {}
        self.limit = limit

    def __call__(self, text: str | None) -> np.ndarray:
        if len(self.memo) > self.limit:
            self.memo.clear()
        memo, out = self.memo, set()
        for w in set(WORD.findall(text.lower())) if text else ():
            if len(w) > LONG_WORD:
                out.update(map(_word_id, {w, *(w[i:i + 3] for i in range(len(w) - 2))}))
                continue
            i = memo.get(w)
            if i is None:
                i = memo[w] = _word_id(w)
            out.add(i)
        return np.fromiter(out, np.uint16, len(out))


def _word_id(w: str) -> int:
    return zlib.crc32(w.encode("utf-8", "surrogatepass")) % DIM


def layout(text: str | None) -> list[float]:
    """The page's layout as numbers of about unit scale."""
    t = text or ""
    n = max(len(t), 1)
    lines = t.split("\n")
    words = t.split()
    k = max(len(words), 1)
    code = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32)
    digits = int(((code >= 48) & (code <= 57)).sum())
    low = code | 32
    letters = int((((low >= 97) & (low <= 122)) | (code >= 0xC0)).sum())
    spaces = int((code <= 32).sum())
    upper = sum(map(str.isupper, words))
    ended = sum(x.rstrip().endswith((".", "!", "?")) for x in lines)
    return [
        math.log1p(len(t)) / 5, math.log1p(k) / 4, math.log1p(len(lines)) / 2, n / len(lines) / 200,
        letters / n, digits / n, (len(t) - letters - digits - spaces) / n * 5, upper / k,
        len(set(words)) / k, len(set(lines)) / len(lines), ended / len(lines), sum(map(len, words)) / k / 10,
    ]


def metadata(source: str | None, lang: str | None, text: str | None) -> tuple[list[int], list[float]]:
    """Hashed ids of source and language, and the layout."""
    code = lambda name, v: zlib.crc32(f"{name}={v!r}".encode("utf-8", "surrogatepass")) % META
    return [code("source", source), code("lang", lang)], layout(text)


class Sparse:
    """Rows of binary features (ids below 65 536) plus dense numbers. What a fit needs
    of the features is summed block by block, so the ids are all that is held."""

    def __init__(self, flat: np.ndarray, size: np.ndarray, dense: np.ndarray, dim: int):
        self.flat, self.size, self.dense, self.dim = flat, size, dense, dim
        self.start = np.r_[0, np.cumsum(size, dtype=np.int64)]

    @classmethod
    def of(cls, ids: list[np.ndarray], dense: np.ndarray, dim: int) -> "Sparse":
        return cls(np.concatenate([*ids, np.empty(0, np.uint16)]).astype(np.uint16), np.fromiter(map(len, ids), np.int64, len(ids)), dense, dim)

    def __len__(self) -> int:
        return len(self.size)

    def take(self, rows: np.ndarray) -> "Sparse":
        size = self.size[rows]
        at = np.repeat((self.start[rows] - np.r_[0, np.cumsum(size)[:-1]]), size) + np.arange(int(size.sum()))
        return Sparse(self.flat[at], size, self.dense[rows], self.dim)

    def blocks(self):
        """(first row, last row, row of each id in the block, ids)"""
        for i in range(0, len(self), BLOCK):
            k = min(i + BLOCK, len(self))
            yield i, k, np.repeat(np.arange(k - i), self.size[i:k]), self.flat[self.start[i]:self.start[k]].astype(np.intp)

    def summed(self, weight: np.ndarray) -> np.ndarray:
        """Per feature the weights of the rows that have it."""
        return sum((np.bincount(ids, weight[i:k][row], self.dim) for i, k, row, ids in self.blocks()), np.zeros(self.dim))

    def scored(self, w: np.ndarray) -> np.ndarray:
        """Per row the weights of its features."""
        return np.concatenate([np.zeros(0), *(np.bincount(row, w[ids], k - i) for i, k, row, ids in self.blocks())])

    def chosen(self, place: np.ndarray, n: int) -> np.ndarray:
        """Which of the ``n`` features with a ``place`` each row has."""
        out = np.zeros((len(self), n), bool)
        for i, _, row, ids in self.blocks():
            hit = place[ids] >= 0
            out[i + row[hit], place[ids[hit]]] = 1
        return out


class View:
    """Logistic regression over one view: the features whose classes differ
    significantly (|z| >= ``LEAST_Z``, the ``MOST_FEATURES`` strongest) and the
    dense numbers, standardised; fitted by Newton steps with a ridge."""

    def __init__(self, dim: int, dense: int, most_features: int = MOST_FEATURES):
        self.most_features = most_features
        self.w, self.v, self.b = np.zeros(dim), np.zeros(dense), 0.0

    def logits(self, x: Sparse) -> np.ndarray:
        return x.scored(self.w) + x.dense @ self.v + self.b

    def fit(self, x: Sparse, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> "View":
        n1, n0 = (weight * y).sum(), (weight * (1 - y)).sum()
        c1, c0 = x.summed(weight * y), x.summed(weight * (1 - y))
        p = np.clip((c1 + c0) / (n1 + n0), 1e-9, 1 - 1e-9)
        z = np.abs(c1 / max(n1, 1e-9) - c0 / max(n0, 1e-9)) / np.sqrt(
            p * (1 - p) * (1 / max(n1, 1e-9) + 1 / max(n0, 1e-9)))
        chosen = np.argsort(-z, kind="stable")[:self.most_features]
        chosen = chosen[z[chosen] >= LEAST_Z]
        place = np.full(x.dim, -1)
        place[chosen] = np.arange(len(chosen))
        a = x.chosen(place, len(chosen))
        mean = np.average(x.dense, axis=0, weights=weight) if x.dense.shape[1] else np.zeros(0)
        dev = np.sqrt(np.average((x.dense - mean) ** 2, axis=0, weights=weight)) + 1e-9 if len(mean) else mean
        tail = np.hstack([(x.dense - mean) / dev if len(mean) else x.dense, np.ones((len(y), 1))])
        keep = np.full(a.shape[1] + tail.shape[1], ridge)
        keep[-1] = 1e-6
        theta = np.zeros(len(keep))
        theta[-1] = math.log((n1 + 1) / (n0 + 1))
        for _ in range(12):
            grad, hess = -keep * theta, np.diag(keep)
            for i in range(0, len(y), BLOCK):
                m, w, part = np.hstack([a[i:i + BLOCK], tail[i:i + BLOCK]]), weight[i:i + BLOCK], y[i:i + BLOCK]
                q = _sigmoid(m @ theta)
                grad += m.T @ (w * (part - q))
                hess += (m * (w * q * (1 - q) + 1e-9)[:, None]).T @ m
            step = np.linalg.solve(hess, grad)
            theta += step * min(1.0, 5 / max(np.abs(step).max(), 1e-9))
        self.w[chosen] = theta[:len(chosen)]
        if len(mean):
            self.v = theta[len(chosen):-1] / dev
        self.b = float(theta[-1] - self.v @ mean)
        return self


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Target:
    """The two views of one target and their calibrated combination."""

    def __init__(self, share: float = 0.5):
        self.share, self.views, self.blend = share, None, None

    def score(self, text: Sparse, meta: Sparse) -> np.ndarray:
        if self.views is None:
            return np.full(len(text), self.share)
        return _sigmoid(self.blend.logits(self._stack(text, meta)))

    def _stack(self, text: Sparse, meta: Sparse) -> Sparse:
        z = np.column_stack([v.logits(x) for v, x in zip(self.views, (text, meta))])
        return Sparse(np.empty(0, np.uint16), np.zeros(len(z), np.int64), z, 1)


def _logit(p: float) -> float:
    return math.log(p / (1 - p))


def co_train(text: Sparse, meta: Sparse, y: np.ndarray, prior: float | None = None,
             most_features: int = MOST_FEATURES) -> Target:
    """``y`` is 0 or 1, or NaN in the unlabelled pool. A fifth of the labelled rows
    is kept for the combination. ``prior``: share of positives where it is not that of ``y``."""
    known = np.flatnonzero(~np.isnan(y))
    share = float(y[known].mean()) if len(known) else 0.5
    excess = 0.0
    if prior is not None and 0 < prior < 1 and 0 < share < 1:
        share, excess = prior, _logit(share) - _logit(prior)
    fold = np.arange(len(known)) % 5 == 0
    train, tune = known[~fold], known[fold]
    target = Target(share)
    if not all(0 < y[r].sum() < len(r) for r in (train, tune)):
        return target
    pool = np.flatnonzero(np.isnan(y))
    views = (text, meta)
    extra: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, np.int64), np.empty(0))] * 2
    for turn in range(ROUNDS + 1):
        models = []
        for x, (rows, labels) in zip(views, extra):
            own = np.r_[train, rows]
            weight = np.r_[np.ones(len(train)), np.full(len(rows), 0.5)]
            models.append(View(x.dim, x.dense.shape[1], most_features).fit(x.take(own), np.r_[y[train], labels], weight))
            models[-1].b -= excess
        target.views = models
        if turn == ROUNDS or not len(pool):
            break
        taught = []
        for model, x in zip(models, views):
            p = _sigmoid(model.logits(x.take(pool)))
            sure = (p >= CONFIDENT) | (p <= 1 - CONFIDENT)
            taught.append((pool[sure], (p[sure] >= 0.5).astype(float)))
        extra = [taught[1], taught[0]]
    stack = target._stack(text.take(tune), meta.take(tune))
    target.blend = View(1, 2).fit(stack, y[tune], np.ones(len(tune)))
    target.blend.b -= excess
    return target


# --- Spark side ------------------------------------------------------------

FEATURES = "words binary, codes array<long>, layout binary, quality double, toxic double"


def _featured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    words = Words()
    for pdf in batches:
        meta = [metadata(*x) for x in zip(pdf["source"], pdf["lang"], pdf["text"])]
        yield pd.DataFrame({"words": [words(t).tobytes() for t in pdf["text"]], "codes": [m[0] for m in meta],
                            "layout": [np.array(m[1]).tobytes() for m in meta], "quality": pdf["quality"], "toxic": pdf["toxic"]})


def _views(words: list[np.ndarray], codes: list, layouts: list) -> tuple[Sparse, Sparse]:
    none = np.zeros((len(words), 0))
    return (Sparse.of(words, none, DIM),
            Sparse.of([np.asarray(c, np.uint16) for c in codes],
                   np.asarray(list(layouts), float).reshape(len(words), LAYOUT), META))


def shares(counts: dict[tuple, int], rows: int) -> dict[tuple, float]:
    """Share to draw of each class, about ``rows`` together: a sixteenth of them (or
    all) of a class that has less by an even draw, even shares of the others."""
    least = rows // 16
    even = rows / max(sum(counts.values()), 1)
    if even >= 1:
        return dict.fromkeys(counts, 1.0)
    rare = {c: min(n, least) for c, n in counts.items() if n * even < least}
    rest = (rows - sum(rare.values())) / max(sum(n for c, n in counts.items() if c not in rare), 1)
    return {c: rare[c] / n if c in rare else min(rest, 1.0) for c, n in counts.items()}


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = 16_000, pool_rows: int = 16_000,
        most_features: int = MOST_FEATURES) -> dict[str, Target]:
    """Models from about ``sample_rows`` labelled documents and ``pool_rows`` others at
    most. Only ids and hashes of the rows are joined with the labels; equal rows count once."""
    known = labels.groupBy(F.col("doc_id").alias("_id")).agg(
        F.min(F.col("quality").cast("double")).alias("quality"), F.max(F.col("toxic").cast("double")).alias("toxic"))
    mark = F.xxhash64("doc_id", "text", F.lit("draw"))
    classes = [(F.col(k) >= 0.5).alias(f"is_{k}") for k in TARGETS]
    ids = docs.select("doc_id", mark.alias("mark")).distinct()
    ids = ids.join(known, ids["doc_id"] == known["_id"], "left").select("doc_id", "mark", *TARGETS, *classes)
    counts = {tuple(r[:2]): r["n"] for r in ids.groupBy(*(f"is_{k}" for k in TARGETS)).agg(F.count(F.lit(1)).alias("n")).collect()}
    pool = {c: n for c, n in counts.items() if c == (None, None)}
    labelled = {c: n for c, n in counts.items() if c not in pool}
    share = F.lit(0.0)
    for c, part in {**shares(labelled, sample_rows), **{c: min(1.0, pool_rows / n) for c, n in pool.items()}}.items():
        share = F.when(F.col("is_quality").eqNullSafe(F.lit(c[0])) & F.col("is_toxic").eqNullSafe(F.lit(c[1])),
                       F.lit(part)).otherwise(share)
    chosen = ids.filter(F.pmod("mark", F.lit(10 ** 12)) < share * 10 ** 12).select(
        F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), *TARGETS)
    rows = docs.select("doc_id", "text", "source", "lang", mark.alias("mark"))
    sample = (rows.join(F.broadcast(chosen), rows["doc_id"].eqNullSafe(chosen["_id"]) & (rows["mark"] == chosen["_mark"]))
              .dropDuplicates(["doc_id", "mark"]).orderBy("doc_id", "mark").mapInPandas(_featured, FEATURES).toPandas())
    text, meta = _views([np.frombuffer(w, np.uint16) for w in sample["words"]], list(sample["codes"]),
                        [np.frombuffer(x) for x in sample["layout"]])
    priors = {}
    if sum(labelled.values()) > sample_rows:
        for i, k in enumerate(TARGETS):
            n = [sum(m for c, m in labelled.items() if c[i] is v) for v in (False, True)]
            priors[k] = n[1] / max(sum(n), 1)
    labelled_as = {k: sample[k].to_numpy(float) for k in TARGETS}
    del sample
    return {k: co_train(text, meta, y, priors.get(k), most_features) for k, y in labelled_as.items()}


def _scores(models: dict[str, Target], words: Words, texts: list, sources: list, langs: list) -> dict[str, np.ndarray]:
    meta = [metadata(*x) for x in zip(sources, langs, texts)]
    views = _views([words(t) for t in texts], [m[0] for m in meta], [m[1] for m in meta])
    return {k: models[k].score(*views) for k in TARGETS}


def _scored(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("text", "source", "lang")]
            score = _scores(shared.value, words, *cols)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(score[k]) for k in TARGETS)], names=["doc_id", *TARGETS])
    return run


def classify(docs: DataFrame, labels: DataFrame, sample_rows: int = 16_000, pool_rows: int = 16_000,
             most_features: int = MOST_FEATURES, least_quality: float = 0.5, most_toxic: float = 0.35) -> DataFrame:
    """Per document: doc_id, quality_score, toxic_score (0 to 1), kept (good and
    not toxic). The toxic limit lies below 0.5, since a miss costs more."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("source").cast("string").alias("source"),
                      F.col("lang").cast("string").alias("lang"))
    shared = docs.sparkSession.sparkContext.broadcast(fit(own, labels, sample_rows, pool_rows, most_features))
    out = own.mapInArrow(_scored(shared), "doc_id long, quality double, toxic double")
    return out.select("doc_id", F.col("quality").alias("quality_score"), F.col("toxic").alias("toxic_score"),
                      ((F.col("quality") >= least_quality) & (F.col("toxic") < most_toxic)).alias("kept"))
