"""Prefix trie and hard negatives against plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from llm_brute import words

from ledgerloom.llm import hard_negatives as H
from ledgerloom.llm.prefix_trie import SlotTable, conversation_trie, rebuilt_trie

TURNS = "conv_id long, turn long, role string, text string, hi long, depth int, conv string"


def trie(paths: dict[int, list[tuple]]) -> set:
    """Rows of the contract from conversations as lists of (role, text)."""
    members: dict[tuple, list] = {}
    for c, turns in paths.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {n: [m for m in members if len(m) == len(n) + 1 and m[:len(n)] == n] for n in members}
    leaves, saved = {}, {}
    for n in sorted(members, key=len, reverse=True):
        leaves[n] = sum(leaves[m] for m in children[n]) or 1
        own = (len(members[n]) - 1) * len(words(n[-1][1])) if n else 0
        saved[n] = own + sum(saved[m] for m in children[n])
    return {(min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(children[n]), leaves[n], saved[n],
             hashlib.sha256(",".join(map(str, sorted(c for c in m if len(paths[c]) == len(n)))).encode()).hexdigest())
            for n, m in members.items()}


def ordered(rows: list[tuple]) -> dict[int, list[tuple]]:
    out: dict[int, list] = {}
    # equal turns in the order of their content's hash, as the docstring leaves open which
    def content(r):
        role, text = r[2] or "", r[3] or ""
        return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:30]
    for r in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0, content(r))):
        out.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    return out


def rebuilt(paths: dict[int, list[tuple]]) -> dict[int, list[tuple]]:
    h = {c: zlib.crc32(str(c).encode()) % 4 for c in paths}
    return {c: paths.get(c - int(math.fmod(c, 20)), [])[:h[c]] + own[h[c]:] for c, own in paths.items()}


def rows_of(df) -> set:
    got = df.collect()
    out = {(r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in got}
    assert len(out) == len(got)
    return out


def conversations() -> list[tuple]:
    rng = random.Random(4)
    rows = []
    for c in range(-30, 150):
        hot = c % 3 == 0
        for t in range(rng.randrange(1, 7)):
            text = "the same start" if hot and t < 2 else rng.choice(["a", "b c", "d  e f", "", None])
            rows.append((c, t, rng.choice(["user", None]) if t > 1 else "user", text, 9, 9, "x"))
    rows += [(200, t, "user", f"turn {t}" if t < 290 else "long " * 500, 9, 9, "x") for t in range(300)]
    rows += [(201, t, "user", f"turn {t}", 9, 9, "x") for t in range(150)]
    rows += [(None, 0, "user", "no conversation", 9, 9, "x"), (7, None, "system", "first", 9, 9, "x"),
             (8, 2, "user", "tie", 9, 9, "x"), (8, 2, "user", "other", 9, 9, "x"), (9, 1, "user", "twice", 9, 9, "x"),
             (9, 1, "user", "twice", 9, 9, "x"), (10, None, None, None, 9, 9, "x"), (40, 0, "u|1:", "x", 9, 9, "x"), (41, 0, "u", "|1:x", 9, 9, "x")]
    return rows


@pytest.mark.parametrize("shard_rows", [40, 50_000])
def test_trie_against_brute_force(spark, shard_rows):
    """Small shards give several layers; the long conversation is a chain through them."""
    rows = conversations()
    df = spark.createDataFrame(rows, TURNS).repartition(5)
    assert rows_of(rebuilt_trie(df, shard_rows=shard_rows)) == trie(rebuilt(ordered(rows)))


def test_trie_of_whole_conversations_and_empty_table(spark):
    rows = [r for r in conversations() if r[0] is None or r[0] < 40]
    df = spark.createDataFrame(rows, TURNS)
    assert rows_of(conversation_trie(df, shard_rows=60)) == trie(ordered(rows))
    assert rebuilt_trie(df.filter("false")).collect() == []


def test_slots_are_minimal_perfect_and_verified():
    rng = np.random.default_rng(2)
    for n in (0, 1, 5, 40_000):
        hi, lo = rng.integers(-2 ** 63, 2 ** 63 - 1, (2, n))
        lo[:n // 2] = 7  # halves alone don't name a node
        table = SlotTable(hi, lo)
        assert sorted(table.slots(hi, lo)) == list(range(n))
        assert (table.slots(hi + 1, lo) == -1).all() and (table.slots(hi, lo ^ 1) == -1).all()


def negatives(rows: list[tuple], every=100, scale=256) -> list[tuple]:
    """rows: (vec_id, vector, label) that take part, distinct."""
    ints = [(i, label, [math.floor(scale * float(x)) for x in v]) for i, v, label in rows]
    out = []
    for i, label, v in ints:
        if i % every:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), j, other) for j, other, w in ints
                  if (i, label, v) != (j, other, w) and len(v) == len(w)]
        same = sorted(s[:2] for s in scored if s[2] == label)[:5]
        for p, j in same:
            fit = sorted(s[:2] for s in scored if s[2] != label and -80 * p <= -100 * s[0] <= -100 * p)[:5]
            out += [(i, j, k, n, -p, -s) for k, (s, n) in enumerate(fit, 1)]
    return sorted(out)


def vectors(n: int, dim: int, labels: int, seed: int) -> list[tuple]:
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels * 2, dim))
    v = centres[rng.integers(0, labels * 2, n)] + 0.4 * rng.normal(size=(n, dim))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    v[n // 3:n // 2] = v[n // 3]  # a group of equal vectors: ties
    return [(i, [float(np.float32(x)) for x in v[i]], int(x)) for i, x in enumerate(rng.integers(0, labels, n))]


@pytest.mark.parametrize("dim", [64, 7])
def test_negatives_against_brute_force(spark, monkeypatch, dim):
    monkeypatch.setattr(H, "CHUNK", 20)  # several chunks
    rows = vectors(900, dim, 4, dim)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(6)
    got = H.hard_negatives(df, every=20)
    assert sorted(map(tuple, got.collect())) == negatives(rows, 20)


def test_negatives_awkward_rows(spark):
    good = vectors(120, 16, 3, 1)
    big = [(500 + i, [1e6 + i] * 16, i % 2) for i in range(4)]  # beyond what doubles add up exactly
    other = [(1000 + i, [0.5, 0.5 - i / 100], i % 2) for i in range(0, 300, 100)] + [(1300, [], 0), (1301, [], 1), (1302, [], 0)]
    bad = [(600, None, 1), (700, [0.1] * 15 + [None], 1), (800, [0.1] * 15 + [float("nan")], 1), (900, [float("inf")] * 16, 1),
           (0, good[1][1], None), (None, good[2][1], 1), (400, [1e300] * 16, 0), (800, [3e6] * 16, 0)]
    rows = [*good, *big, *other]
    df = spark.createDataFrame([(*r, "c", 1) for r in [*rows, *bad, *good[:9]]],
                               "vec_id long, embedding array<double>, label int, mark string, n int")
    assert sorted(map(tuple, H.hard_negatives(df).collect())) == negatives(rows)
    assert H.hard_negatives(df.filter("false")).collect() == []
    words_ = df.selectExpr("vec_id", "embedding", "concat('label ', label) as label")
    assert H.hard_negatives(words_).collect() == []


def test_bounds_hold_and_prune():
    """No pair outside its range by exact score is kept, none inside is lost, and
    the summaries alone settle most pairs of tight clusters."""
    import pandas as pd
    rng = np.random.default_rng(3)
    smooth = np.repeat(rng.normal(size=(400, 8)), 8, axis=1) * 200 + rng.normal(size=(400, 64)) * 5
    v = np.floor(smooth)
    means, devs = H.summaries(v)
    score = v @ v.T
    for m, d in zip(means, devs):
        assert (m @ m.T + d @ d.T >= score - 1e-6 * abs(score) - 1).all() and (m @ m.T - d @ d.T <= score + 1e-6 * abs(score) + 1).all()
    pdf = pd.DataFrame({"vec_id": range(400), "label": 0, "mark": range(400), "n": 64, "vec": [x.tobytes() for x in v.astype("<i4")],
                        "means": [x.tobytes() for x in np.hstack(means).astype("<f4")], "devs": [x.tobytes() for x in np.hstack(devs).astype("<f4")]})
    b = H.Block.of(pdf)
    lo, hi = np.quantile(score, 0.98, axis=1), score.max(axis=1)
    seen = []
    dense = H._dense
    H._dense = lambda *x: seen.append(1) or dense(*x)
    try:
        i, j, s = H.open_pairs(b, b, np.ones((400, 400), bool), lo, hi)
    finally:
        H._dense = dense
    want = np.argwhere((score >= lo[:, None]) & (score <= hi[:, None]))
    assert sorted(zip(i, j)) == sorted(map(tuple, want)) and (s == score[i, j]).all() and not seen
