"""Which pairs of bucket mates are made before they are checked."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from ledgerloom.llm.common import Scratch, bucket_components, importable


class Seen(Scratch):
    """Scratch tables that keep the candidate pairs."""

    def table(self, df, name):
        out = super().table(df, name)
        if name == "pairs":
            self.pairs = getattr(self, "pairs", []) + [sorted((r["a"], r["b"]) for r in out.collect())]
        return out


def _run(spark, buckets, sizes, linked):
    """Labels and candidate pairs of ``buckets`` (key: ids); ``linked(a, b)`` is exact."""
    importable(spark)
    scratch = Seen(spark, "buckets")
    keys = {i: [k if i in ids else -k for k, ids in buckets.items()] for i in sizes}
    known = spark.createDataFrame(
        [(i, n, np.array([i], np.int64).tobytes(), np.array(keys[i], np.int64).tobytes()) for i, n in sizes.items()],
        "id long, n long, payload binary, keys binary")
    members = spark.createDataFrame([(k, i, sizes[i]) for k, ids in buckets.items() for i in ids], "key long, id long, n long")

    def load(payload):
        return np.array([np.frombuffer(p, np.int64)[0] for p in payload], np.int64)

    def likely(n_a, a, n_b, b):
        return np.array([(int(min(x, y)), int(max(x, y))) in linked for x, y in zip(np.broadcast_to(a, b.shape), b)], bool)

    def alike(x, y):
        return 100 * F.least(x, y) >= 80 * F.greatest(x, y)
    labels = bucket_components(scratch, members, lambda ids: known.join(ids, "id"), load, likely, alike=alike)
    return {r["node"]: r["root"] for r in labels.collect()}, scratch.pairs


def test_pairs_ruled_out_by_their_sizes_are_not_made(spark):
    got, pairs = _run(spark, {1: [1, 2, 3, 4]}, {1: 100, 2: 10, 3: 95, 4: 10}, {(1, 3), (2, 4)})
    assert got == {1: 1, 3: 1, 2: 2, 4: 2}
    assert pairs[0] == [(1, 3)] and pairs[1] == []


def test_first_pivot_is_the_one_most_buckets_are_shared_with(spark):
    got, pairs = _run(spark, {1: [1, 9], 2: [2, 9], 3: [2, 9], 4: [1, 2]}, {1: 10, 2: 10, 9: 10}, {(2, 9)})
    assert got == {2: 2, 9: 2}
    assert (2, 9) in pairs[0] and (1, 9) not in pairs[0]


def test_anchors_and_windows_of_many_texts_are_made_together(monkeypatch):
    """Short texts share their arrays and come in one frame; the rows are those of each
    text alone, and none is made of words of two texts."""
    from ledgerloom.llm import substring_dedup as S
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 40, n)) for n in (0, 49, 50, 51, 130, 400)] + [None, "x " * 200]
    pdf = pd.DataFrame({"doc_id": range(10, 18), "mark": range(20, 28), "text": texts})
    alone = pd.concat([f for i in range(len(pdf)) for f in S._anchor_rows(iter([pdf.iloc[i:i + 1]]))], ignore_index=True)
    together = list(S._anchor_rows(iter([pdf])))
    assert len(together) == 1
    pd.testing.assert_frame_equal(together[0], alone)
    assert alone.groupby("doc_id")["n"].sum().to_dict() == {12: 1, 13: 2, 14: 81, 15: 351, 17: 151}
    monkeypatch.setattr(S, "CHUNK_WORDS", 100)
    pd.testing.assert_frame_equal(pd.concat(S._anchor_rows(iter([pdf])), ignore_index=True), alone)
    at = {d: g[["w", "n", "c1", "c2"]].to_dict("records") for d, g in alone.groupby("doc_id")}
    listed = pdf[pdf["doc_id"].isin(at)].assign(at=lambda d: [at[i] for i in d["doc_id"]])
    windows = pd.concat(S._window_rows(iter([listed])), ignore_index=True)
    for d, g in windows.groupby("doc_id"):
        words = np.fromiter((S.xxhash.xxh64_intdigest(x.encode()) for x in texts[d - 10].split()), np.uint64)
        h = S.grams(words, S.RUN, 2).view(np.int64)
        assert g["w"].tolist() == list(range(len(h))) and g["h1"].tolist() == h.tolist()
