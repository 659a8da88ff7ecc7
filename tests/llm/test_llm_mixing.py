"""Mixing sources against a sorted running sum."""

from __future__ import annotations

import hashlib
import math

import pytest
from llm_brute import SCHEMA, awkward, words

from ledgerloom.llm.mixing import mix, mixture


def targets(sizes: dict, weights=(5, 2, 1), share=1.5, most=2.0) -> dict:
    """Shares by weight; what a bounded source leaves is dealt again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out, left, open_ = {}, share * sum(sizes.values()), set(order)
    while open_:
        each = left / sum(w[s] for s in open_)
        above = {s for s in open_ if w[s] * each > most * sizes[s]}
        if not above:
            return out | {s: w[s] * each for s in open_}
        out |= {s: most * sizes[s] for s in above}
        left -= sum(out[s] for s in above)
        open_ -= above
    return out


def key(doc_id, text) -> int:
    return int(hashlib.md5(f"{'' if doc_id is None else doc_id}|{text or ''}".encode()).hexdigest()[:15], 16)


def check(rows: list[tuple], got: list) -> None:
    """rows: (doc_id, text, source)"""
    sizes, taken, longest = {}, {}, {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(words(t))
        longest[s] = max(longest.get(s, 0), len(words(t)))
    want = targets(sizes)
    assert len(got) == len(rows)
    for r in got:
        assert r.mix_target == pytest.approx(want[r.source]) and r.mix_source_size == sizes[r.source]
        assert 0 <= r.mix_copies <= 2 and r.mix_size == len(words(r.text))
        taken[r.source] = taken.get(r.source, 0) + r.mix_copies * r.mix_size
    for s, n in taken.items():
        assert abs(n - want[s]) <= longest[s] / 2 + 1e-6
        whole = math.floor(want[s] / sizes[s]) if sizes[s] else 0
        # nested: no row taken once more has a larger key than a row that isn't
        more = [key(r.doc_id, r.text) for r in got if r.source == s and r.mix_copies > whole]
        rest = [key(r.doc_id, r.text) for r in got if r.source == s and r.mix_copies == whole and r.mix_size]
        assert not more or not rest or max(more) <= min(rest)


def test_mix_meets_its_targets(spark):
    rows = [(i, " ".join(["w"] * (i * 7 % 40)), ["a", "b", "é", "Z", None][i * i % 5]) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mix(df).collect()
    check(rows, got)
    assert sorted(map(str, got)) == sorted(map(str, mix(df.repartition(7)).collect()))
    assert mixture(df).count() == sum(r.mix_copies for r in got)


def test_mix_splits_a_group_of_equal_rows(spark):
    """A third of a source is one repeated row; the threshold falls inside it."""
    rows = [(7, "one two three", "a")] * 300 + [(i, "x y", "a") for i in range(100, 200)] + [(i, "z " * 90, "b") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    for share in (0.7, 1.5):
        got = mix(df, share=share).collect()
        for s in "ab":
            own = [r for r in got if r.source == s]
            assert len(own) == sum(r[2] == s for r in rows)
            assert abs(sum(r.mix_copies * r.mix_size for r in own) - own[0].mix_target) <= 45.001


def test_smaller_mixtures_are_nested(spark):
    rows = [(i, "w " * (1 + i % 9), "ab"[i % 2]) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    small, large = ({r.doc_id: r.mix_copies for r in mix(df, share=s).collect()} for s in (0.2, 0.6))
    assert all(large[i] >= n for i, n in small.items()) and sum(small.values()) < sum(large.values())


def test_mix_awkward_rows(spark):
    rows = awkward()
    df = spark.createDataFrame([(*r, 5, 6) for r in rows], SCHEMA + ", mix_size int, _mix int")
    got = mix(df).collect()
    check([(r[0], r[1], r[3]) for r in rows], got)
    assert all(r.kept == "k" and r["_mix"] == 6 for r in got)
    assert mix(df.filter("false")).collect() == []
    empty = mix(df.filter("doc_id in (4, 5, 6)")).collect()
    assert len(empty) == 3 and all(r.mix_target == 0 and r.mix_size == 0 for r in empty)


def test_mix_runs_no_python(spark):
    df = spark.createDataFrame([(1, "a b", "s")], "doc_id long, text string, source string")
    plan = mix(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
