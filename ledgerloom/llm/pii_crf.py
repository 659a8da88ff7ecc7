"""Personal data by fixed patterns and a linear-chain conditional random field.

Base spans (email, ip, card, phone) come from fixed patterns with their checks.
Beyond them, a CRF over word-shape features labels tokens as outside or as
beginning or continuing a kind. It learns from a small labelled table of its own
(``pii_table``: written-out and bracketed addresses, numbers in spellings that no
pattern takes, and sentences that look alike and hold nothing), each row counting
``TABLE_WEIGHT`` times, and from windows of the documents themselves, drawn by hash, in
which the patterns can tell every open token: it belongs to a base span, to a match that
failed its check, or is a short number by itself. So a shape which the checks
often reject (a long number that is no card) gets its true, low probability. Documents
are decoded in numpy batches by Viterbi; a decoded entity that touches no base
span is added if the mean marginal probability of its labels reaches ``least``.

Tokens are runs of non-space characters. Open tokens may be inside an entity: those with a
digit or ``@``, and those within ``REACH`` of a cue (the word dot, or at and dot in
brackets). All others are outside; windows are the tokens within ``CONTEXT`` of an open
one, and since the chain is fixed outside, decoding the windows alone
equals decoding the whole text. Windows of any length are decoded whole.

Bounds of the fit, all parameters: ``train_rows`` documents are drawn, ``train_windows`` of
their windows, and windows of more than ``LONG`` tokens or ``LONG_CHARS`` characters are no
training rows.

Defined results: null text is empty and has no spans; offsets are code points,
ends exclusive; repeated rows get equal rows; paths that tie go to the label that
comes first; an empty table gives an empty result; without a document to learn from the
labelled table is all there is. Extra columns aren't looked at by
:func:`personal_data` and handed on by :func:`mask`, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drawn, importable
from .pii_table import labelled

# Kinds in the order they are listed, and their patterns. Possessive
# repeats and the look-behind keep long runs linear and change no match.
KINDS = ("email", "ip", "card", "phone")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

TOKEN = re.compile(r"\S+")
MARK = re.compile(r"[0-9@]")
CUE = re.compile(r"(?i)^dot$|[\[({<](?:at|dot)[\])}>]")  # of a token
HINT = re.compile(r"(?i)[0-9@]|\bdot\b|[\[({<]at[\])}>]")  # of a text that may have open tokens
SHORT = re.compile(r"\W*[0-9]{1,4}\W*")
CONTEXT, REACH = 1, 3
TABLE_WEIGHT, LONG, LONG_CHARS = 4, 200, 4000
LABELS = ["O"] + [f"{p}-{k}" for k in KINDS for p in "BI"]
DIM = 1 << 14
FEATURES = 12


# --- base patterns ---------------------------------------------------------

def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) << (i & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(s: str) -> str:
    return re.sub(r"[^0-9]", "", s)


def emails(text: str) -> list[tuple[int, int]]:
    """Matches found from their ``@``: the local part is the run before it, as far
    back as the last match's end."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and LOCAL.match(text[start - 1]):
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            done = m.end()
            out.append((start, done))
        at = text.find("@", m.end() if m else at + 1)
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end), by kind, then start."""
    out = [(0, s, e) for s, e in emails(text)] if "@" in text else []
    if MARK.search(text):
        out += [(1, *m.span()) for m in IP.finditer(text) if all(
            len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split("."))]
        for m in CARD.finditer(text):
            digits = _digits(m.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append((2, *m.span()))
        if "+" in text:
            out += [(3, *m.span()) for m in PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return out


# --- features --------------------------------------------------------------

def shape(token: str) -> str:
    """Digits as 9, letters as a and A, runs as one symbol with their length up to 20."""
    s = re.sub(r"[0-9]", "9", re.sub(r"[^\W\d_]", lambda m: "A" if m.group().isupper() else "a", token))
    return re.sub(r"(.)\1+", lambda m: f"{m.group(1)}{min(len(m.group()), 20)}", s)


def open_tokens(words: list[str]) -> np.ndarray:
    """Which tokens may be inside an entity."""
    out = np.array([bool(MARK.search(w)) for w in words])
    for i, w in enumerate(words):
        if CUE.search(w.strip(".,;:!?")):
            out[max(i - REACH, 0):i + REACH + 1] = True
    return out


def windows(text: str) -> list[list[tuple[int, int]]]:
    """Token offsets of the windows around open tokens."""
    if not HINT.search(text):
        return []
    tokens = [m.span() for m in TOKEN.finditer(text)]
    marks = np.flatnonzero(open_tokens([text[s:e] for s, e in tokens])).tolist()
    out, end = [], -1
    for i in marks:
        lo, hi = max(i - CONTEXT, 0), min(i + CONTEXT + 1, len(tokens))
        if lo <= end and out:
            out[-1] += tokens[max(end, lo):hi]
        else:
            out.append(tokens[lo:hi])
        end = max(end, hi)
    return out


def cue(word: str) -> str:
    """The word itself if it may join the parts of an address, else nothing."""
    w = word.strip(".,;:!?").lower()
    return w if w in ("at", "dot") or (len(w) < 8 and CUE.search(w)) else "in" if CUE.search(w) else ""


def features(words: list[str]) -> np.ndarray:
    """(tokens, FEATURES) hashed feature ids."""
    full = [shape(w.rstrip(".,;:!?\"'") or w) for w in words]
    core = [re.sub(r"\d+", "", f.replace("9", "d")) for f in full]
    cues = ["", *map(cue, words), ""]
    out = np.empty((len(words), FEATURES), np.int64)
    for i, w in enumerate(words):
        before, after = (core[i - 1] if i else "^"), (core[i + 1] if i + 1 < len(words) else "$")
        digits = sum("0" <= c <= "9" for c in w)
        plain = words[i - 1].lower() if i and not MARK.search(words[i - 1]) else ""
        for j, f in enumerate((f"s{full[i]}", f"c{core[i]}", f"p{before}|{core[i]}", f"n{core[i]}|{after}",
                               f"d{min(digits, 20)}", f"@{'@' in w}{w.count('.')}", f"x{before}|{full[i]}|{after}",
                               f"w{plain}", f"e{w[0]}{len(w) > 3}", f"q{cues[i]}|{cues[i + 1]}|{cues[i + 2]}",
                               f"y{cues[i + 1]}|{full[i]}", f"z{cues[i]}|{cues[i + 2]}|{core[i]}")):
            out[i, j] = zlib.crc32(f.encode("utf-8", "surrogatepass")) % DIM
    return out


# --- the field -------------------------------------------------------------

class Field:
    """Weights of the chain, and its passes over padded batches."""

    def __init__(self):
        k = len(LABELS)
        self.emit = np.zeros((DIM, k))
        self.move = np.zeros((k, k))
        # I-x follows only B-x or I-x
        self.allowed = np.array([[not b.startswith("I") or a[2:] == b[2:] for b in LABELS] for a in LABELS])

    def _pad(self, feats: list[np.ndarray], marked: list[np.ndarray]):
        t = max(map(len, feats))
        score = np.full((len(feats), t, len(LABELS)), -1e9)
        score[:, :, 0] = 0  # padding is outside
        size = np.array([len(f) for f in feats])
        at = np.arange(t)[None, :] < size[:, None]
        score[at] = self.emit[np.concatenate(feats)].sum(axis=1)
        plain = np.zeros((len(feats), t), bool)
        plain[at] = ~np.concatenate(marked)
        score[plain, 1:] = -1e9
        score[:, 0, 2::2] = -1e9  # no window starts inside an entity
        return score, at

    def _moves(self) -> np.ndarray:
        return np.where(self.allowed, self.move, -1e9)

    def marginals(self, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log P(label at t) and, for the gradient, expected moves per window step."""
        move, (n, t, k) = self._moves(), score.shape
        a, b = np.empty_like(score), np.zeros_like(score)
        a[:, 0] = score[:, 0]
        for i in range(1, t):
            a[:, i] = score[:, i] + _logsum(a[:, i - 1, :, None] + move)
        for i in range(t - 2, -1, -1):
            b[:, i] = _logsum((move + (score[:, i + 1] + b[:, i + 1])[:, None, :]).transpose(0, 2, 1))
        z = _logsum(a[:, -1, :, None])[:, 0]
        pair = np.zeros((k, k))
        for i in range(1, t):
            pair += np.exp(a[:, i - 1, :, None] + move + (score[:, i] + b[:, i])[:, None, :] - z[:, None, None]).sum(axis=0)
        return a + b - z[:, None, None], pair

    def viterbi(self, score: np.ndarray) -> np.ndarray:
        move, (n, t, k) = self._moves(), score.shape
        best, back = score[:, 0], np.zeros((n, t, k), np.int8)
        for i in range(1, t):
            total = best[:, :, None] + move
            back[:, i] = total.argmax(axis=1)
            best = total.max(axis=1) + score[:, i]
        out = np.zeros((n, t), np.int64)
        out[:, -1] = best.argmax(axis=1)
        for i in range(t - 1, 0, -1):
            out[:, i - 1] = back[np.arange(n), i, out[:, i]]
        return out

    def fit(self, feats: list, marked: list, gold: list, epochs: int = 60, rate: float = 0.5, decay: float = 1e-3) -> None:
        """Full-batch AdaGrad on the log-likelihood."""
        order = sorted(range(len(feats)), key=lambda i: len(feats[i]))
        groups = [g for g in _groups([len(feats[i]) for i in order])]
        seen_e, seen_m = np.full(self.emit.shape, 1e-6), np.full(self.move.shape, 1e-6)
        for _ in range(epochs):
            grad_e, grad_m = -decay * self.emit * len(feats), -decay * self.move * len(feats)
            for lo, hi in groups:
                own = [order[i] for i in range(lo, hi)]
                score, at = self._pad([feats[i] for i in own], [marked[i] for i in own])
                logp, pair = self.marginals(score)
                labels = np.zeros(at.shape, np.int64)
                labels[at] = np.concatenate([gold[i] for i in own])
                err = -np.exp(logp[at])
                err[np.arange(len(err)), labels[at]] += 1
                ids = np.concatenate([feats[i] for i in own])
                for k in range(err.shape[1]):
                    grad_e[:, k] += np.bincount(ids.reshape(-1), np.repeat(err[:, k], FEATURES), DIM)
                grad_m -= pair
                np.add.at(grad_m, (labels[:, :-1].reshape(-1), labels[:, 1:].reshape(-1)), 1)
            seen_e += grad_e ** 2
            seen_m += grad_m ** 2
            self.emit += rate * grad_e / np.sqrt(seen_e)
            self.move += rate * grad_m / np.sqrt(seen_m)

    def decode(self, feats: list, marked: list) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per window the labels and their marginal probabilities."""
        order = sorted(range(len(feats)), key=lambda i: len(feats[i]))
        out: list = [None] * len(feats)
        for lo, hi in _groups([len(feats[i]) for i in order]):
            own = [order[i] for i in range(lo, hi)]
            score, _ = self._pad([feats[i] for i in own], [marked[i] for i in own])
            path, (logp, _) = self.viterbi(score), self.marginals(score)
            prob = np.exp(np.take_along_axis(logp, path[:, :, None], axis=2))[:, :, 0]
            for row, i in enumerate(own):
                out[i] = path[row, :len(feats[i])], prob[row, :len(feats[i])]
        return out


def _logsum(x: np.ndarray) -> np.ndarray:
    """log sum exp over axis 1."""
    top = x.max(axis=1)
    return top + np.log(np.exp(x - top[:, None]).sum(axis=1))


def _groups(sizes: list[int], cells: int = 20_000) -> Iterator[tuple[int, int]]:
    """Ranges of ascending sizes whose padded batch stays within ``cells``, or
    holds one window."""
    lo = 0
    for i in range(1, len(sizes) + 1):
        if i == len(sizes) or sizes[i] * (i + 1 - lo) > cells:
            yield lo, i
            lo = i


# --- labelled table, decoding ---------------------------------------------

def _gold(spans: list[tuple[int, int]], base: list[tuple[int, int, int]]) -> list[int]:
    out, last = [], None
    for s, e in spans:
        hit = next((b for b in base if b[1] < e and s < b[2]), None)
        out.append(0 if hit is None else 1 + 2 * hit[0] + (hit is last))
        last = hit
    return out


def failed_spans(text: str) -> list[tuple[int, int]]:
    """Matches of the patterns that failed their check and are of no other kind either:
    four numbers of up to three digits, unbroken digits of a card's length, phones of the
    wrong length."""
    out = [m.span() for m in IP.finditer(text) if all(len(p) <= 3 for p in m.group().split(".")) and any(int(p) > 255 for p in m.group().split("."))]
    out += [m.span() for m in CARD.finditer(text) if m.group().isdigit() and 13 <= len(m.group()) <= 19 and not luhn(m.group())]
    if "+" in text:
        out += [m.span() for m in PHONE.finditer(text) if not 9 <= len(_digits(m.group())) <= 15]
    return out


def _told(words: list[str], spans: list[tuple[int, int]], known: list[tuple[int, int]]) -> bool:
    """Whether the patterns can tell every token of a window."""
    if any(map(cue, words)):
        return False
    digits = [False, *(bool(MARK.search(w)) for w in words), False]
    for i, (w, (s, e)) in enumerate(zip(words, spans)):
        alone = SHORT.fullmatch(w) and not digits[i] and not digits[i + 2]
        if digits[i + 1] and not alone and not any(a < e and s < b for a, b in known):
            return False
    return True


def _labelled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
            base = base_spans(text or "")
            known = [x[1:] for x in base] + failed_spans(text or "")
            for i, w in enumerate(windows(text or "")):
                words = [text[s:e] for s, e in w]
                if len(w) <= LONG and sum(map(len, words)) <= LONG_CHARS and _told(words, w, known):
                    rows.append((doc_id, i, words, _gold(w, base)))
        yield pd.DataFrame(rows, columns=["doc_id", "place", "tokens", "labels"]).astype({"doc_id": "Int64"})


def labelled_windows(docs: DataFrame, train_rows: int = 4000, train_windows: int = 4000) -> DataFrame:
    """The labelled table (doc_id, place, tokens, labels): windows of about
    ``train_rows`` documents drawn by hash, and of these about ``train_windows``."""
    share = min(1.0, train_rows / max(docs.count(), 1))
    found = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
             .filter(F.col("text").isNotNull() & drawn(share, "doc_id", "text"))
             .mapInPandas(_labelled, "doc_id long, place long, tokens array<string>, labels array<int>"))
    keep = min(1.0, train_windows / max(found.count(), 1))
    return found.filter(drawn(keep, "doc_id", "place", "tokens")) if keep < 1 else found


def table_windows() -> list[tuple[list[str], list[int]]]:
    """The windows of the labelled table: tokens and labels."""
    out = []
    for text, spans in labelled():
        truth = [(KINDS.index(k), s, e) for k, s, e in spans]
        out += [([text[s:e] for s, e in w], _gold(w, truth)) for w in windows(text)]
    return out


def train(docs: DataFrame, train_rows: int = 4000, train_windows: int = 4000) -> Field:
    table = labelled_windows(docs, train_rows, train_windows).toPandas()  # bounded in rows and bytes
    table = table.iloc[table["tokens"].map(lambda t: "\x00".join(t)).argsort(kind="stable")]
    rows = table_windows() * TABLE_WEIGHT + [(list(t), list(x)) for t, x in zip(table["tokens"], table["labels"])]
    field = Field()
    field.fit([features(w) for w, _ in rows], [open_tokens(w) for w, _ in rows], [np.asarray(x, np.int64) for _, x in rows])
    return field


def added_spans(field: Field, texts: list[str], base: list[list[tuple[int, int, int]]],
                least: float) -> list[list[tuple[int, int, int]]]:
    """Entities of the field that touch no base span, text by text."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    all_windows = [(i, w) for i, t in enumerate(texts) for w in windows(t)]
    if not all_windows:
        return out
    words = [[texts[i][s:e] for s, e in w] for i, w in all_windows]
    decoded = field.decode([features(w) for w in words], [open_tokens(w) for w in words])
    for (i, w), (path, prob) in zip(all_windows, decoded):
        at = 0
        while at < len(path):
            if not path[at]:
                at += 1
                continue
            end = at + 1
            while end < len(path) and path[end] and path[end] % 2 == 0 and (path[end] - 1) // 2 == (path[at] - 1) // 2:
                end += 1
            start, stop = w[at][0], w[end - 1][1]
            body = texts[i][start:stop]
            stop -= len(body) - len(body.rstrip(".,;:!?\"'"))
            start += len(body) - len(body.lstrip("\"'"))
            body = texts[i][start:stop]
            # brackets that open or close outside of the entity
            stop -= sum(body.endswith(b) and body.count(b) > body.count(a) for a, b in ("()", "[]", "{}"))
            start += sum(body.startswith(a) and body.count(a) > body.count(b) for a, b in ("()", "[]", "{}"))
            if (start < stop and prob[at:end].mean() >= least
                    and not any(s < stop and start < e for _, s, e in base[i])):
                out[i].append(((int(path[at]) - 1) // 2, start, stop))
            at = end
    return out


def _listing(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


def _spans(shared, least: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = [t or "" for t in pdf["text"]]
            base = [base_spans(t) for t in texts]
            more = added_spans(shared.value, texts, base, least)
            out = {"doc_id": pdf["doc_id"].astype("Int64")}
            for k, kind in enumerate(KINDS):
                out[f"n_{kind}"] = [sum(x[0] == k for x in b) for b in base]
            out["base_sha256"] = [hashlib.sha256(_listing(b).encode()).hexdigest() for b in base]
            out["spans"] = [_listing([*b, *m]) for b, m in zip(base, more)]
            out["n_added"] = [len(m) for m in more]
            yield pd.DataFrame(out)
    return run


def personal_data(docs: DataFrame, least: float = 0.9, train_rows: int = 4000, train_windows: int = 4000) -> DataFrame:
    """Per document: doc_id, n_email, n_ip, n_card, n_phone (base spans),
    base_sha256, spans (base and added), n_added."""
    importable(docs.sparkSession)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    shared = docs.sparkSession.sparkContext.broadcast(train(own, train_rows, train_windows))
    return own.mapInPandas(_spans(shared, least),
                           "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS)
                           + ", base_sha256 string, spans string, n_added long")


def _masked(shared, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            raw = batch.column("text").to_pylist()
            texts = [t or "" for t in raw]
            base = [base_spans(t) for t in texts]
            out = []
            for r, t, b, m in zip(raw, texts, base, added_spans(shared.value, texts, base, least)):
                parts, done = [], 0
                for s, e, k in sorted((s, e, k) for k, s, e in [*b, *m]):
                    if s >= done:
                        parts += [t[done:s], f"<{KINDS[k].upper()}>"]
                    done = max(done, e)
                out.append(r if not parts else "".join([*parts, t[done:]]))
            yield batch.set_column(at, batch.schema.field(at), pa.array(out, batch.schema.field(at).type))
    return run


def mask(docs: DataFrame, least: float = 0.9, train_rows: int = 4000, train_windows: int = 4000) -> DataFrame:
    """``docs`` with every span replaced by its kind."""
    importable(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, train_rows, train_windows))
    return docs.mapInArrow(_masked(shared, least), docs.schema)
