"""Near-duplicate operators against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
from llm_brute import SCHEMA, awkward, component_of, linked, near_components, shingles, words

from ledgerloom.llm import common, minhash
from ledgerloom.llm.embed_dedup import near_embeddings
from ledgerloom.llm.substring_dedup import paragraphs, remove_repeats, repeated_passages


def test_components_of_paths_stars_and_hubs(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(100, 160)] + [(500, 600 + i) for i in range(80)]
    links += [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(60)] + [(7, 7)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.root for r in common.components(common.Scratch(spark, "t"), df).collect()}
    ids = list({x for a, b in links if a != b for x in (a, b)})
    want = component_of(ids, [x for x in links if x[0] != x[1]])
    assert got == want


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates_awkward_rows(spark, k):
    rows = awkward()
    got = minhash.near_duplicates(spark.createDataFrame(rows, SCHEMA), k).collect()
    want = near_components([(r[0], r[1]) for r in rows], k)
    assert len(got) == len(rows)
    for r in got:
        assert r.component_id == want.get(r.doc_id) and r.kept == (r.doc_id is None or want[r.doc_id] == r.doc_id)
    sizes = sorted(len(shingles(r[1], k)) for r in rows)
    assert sorted(r.n_shingles for r in got) == sizes


def test_near_duplicates_group_with_outliers(spark):
    """Copies edited to different degrees: buckets hold several components."""
    rng = random.Random(5)
    base = [f"w{rng.randrange(300)}" for _ in range(120)]
    rows = []
    for i in range(150):
        own = [w if rng.random() > (i % 10) / 60 else f"e{rng.randrange(4000)}" for w in base]
        rows.append((i, " ".join(own)))
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == near_components(rows, 2)
    assert 1 < len(set(got.values())) < 150


def test_estimate_is_collision_corrected():
    rng = np.random.default_rng(1)
    for n in (60, 400, 5000):
        for share in (0.0, 0.5, 0.8, 1.0):
            both = rng.integers(0, 2 ** 63, int(n * share)).astype(np.uint64) * np.uint64(2)
            sets = [np.unique(np.r_[both, rng.integers(0, 2 ** 63, n - len(both)).astype(np.uint64) * np.uint64(2)])
                    for _ in range(2)]
            true = common.overlap(*sets) / (len(sets[0]) + len(sets[1]) - common.overlap(*sets))
            regs = [minhash.sketch(s)[None, :] for s in sets]
            est, used = minhash.estimate(*regs, np.array([float(len(sets[0]))]), np.array([float(len(sets[1]))]))
            error = minhash.standard_error(max(min(true, 0.99), 0.01), used, np.array([2 * n / (1 + true)]))
            assert abs(est[0] - true) <= 5 * error[0] + 0.01


def test_keep_one(spark):
    rows = awkward()
    df = spark.createDataFrame(rows, SCHEMA)
    kept = minhash.keep_one(df)
    assert kept.columns == df.columns
    want = near_components([(r[0], r[1]) for r in rows], 5)
    got = sorted((r.doc_id for r in kept.collect() if r.doc_id is not None))
    assert got == sorted({i for i in want if want[i] == i})
    assert sum(r.doc_id is None for r in kept.collect()) == 2


def test_embeddings_against_all_pairs(spark):
    rng = np.random.default_rng(2)
    centre = rng.standard_normal((30, 16))
    rows = []
    for i in range(400):
        v = centre[i % 30] + rng.standard_normal(16) * rng.uniform(0, 0.35)
        rows.append((i, [float(np.float32(x)) for x in v], int(i % 30) % 3))
    rows += [(1000 + i, rows[0][1], 0) for i in range(30)] + [(2000, [float(2 * x) for x in rows[0][1]], 0)]
    bad = [(3000, None, 1), (3001, [0.0] * 16, 1), (3002, [float("nan")] * 16, 1), (3003, [1.0, None] + [0.0] * 14, 1),
           (3004, rows[0][1], None), (3005, [float("inf")] * 16, 0), (3006, [], 0), (3007, [1.0, 2.0], 0)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: r for r in near_embeddings(df).collect()}
    x = np.array([r[1] for r in rows], np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows])
    near = (x @ x.T >= 0.93) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    ids = [r[0] for r in rows]
    want = component_of(ids, [(ids[a], ids[b]) for a, b in zip(*np.nonzero(np.triu(near)))])
    assert {i: got[i].component_id for i in ids} == want
    assert [got[i].n_links for i in ids] == near.sum(axis=1).tolist()
    for i, *_ in bad:
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)


def test_repeated_paragraphs_against_all_pairs(spark):
    rng = random.Random(9)
    passage = " ".join(f"p{i}" for i in range(55))
    near = passage.replace("p20 ", "q20 ")
    rows = []
    for i in range(40):
        own = [" ".join(f"d{i}w{rng.randrange(10 ** 6)}" for _ in range(25)) for _ in range(3)]
        if i % 4 == 0:
            own.insert(1, passage if i % 8 else near)
        rows.append((i, "\n".join(own)))
    rows += [(50, None), (51, ""), (52, "short line\nshort line"), (53, rows[0][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in repeated_passages(df).collect()}
    paras = sorted((i, s, e, shingles(t[s:e], 5)) for i, t in rows for s, e, _ in paragraphs(t, 15))
    names = list(range(len(paras)))
    comp = component_of(names, [(a, b) for a in names for b in names[a + 1:] if linked(paras[a][3], paras[b][3])])
    removed: dict = {i: [] for i, _ in rows}
    for a in names:
        if comp[a] != a:
            removed[paras[a][0]].append(f"{paras[a][1]}:{paras[a][2]}")
    assert {i: r.removed for i, r in got.items()} == {i: ",".join(v) for i, v in removed.items()}
    assert got[0].n_repeated == 4 and got[0].n_removed == 0 and got[53].n_removed == 4
    texts = {r.doc_id: r.text for r in remove_repeats(df).collect()}
    assert texts[53] == "" and texts[0] == rows[0][1] and passage not in (texts[4] or "") and texts[50] is None


def test_passage_inside_long_lines_is_cut_alike():
    rng = random.Random(1)
    sentence = lambda: " ".join(f"v{rng.randrange(900)}" for _ in range(9)) + ". "
    shared = "".join(sentence() for _ in range(14))
    found = []
    for _ in range(2):
        text = "".join(sentence() for _ in range(6)) + shared + "".join(sentence() for _ in range(6))
        found.append({tuple(w) for _, _, w in paragraphs(text, 15)})
    assert sum(map(len, found[0] & found[1])) >= 40


def test_repeated_runs_against_all_windows(spark):
    """Runs anywhere: inside long lines, without sentence ends, wrapped in short lines."""
    rng = random.Random(4)
    new = lambda n: [f"u{rng.randrange(10 ** 8)}" for _ in range(n)]
    wrap = lambda ws, n: "\n".join(" ".join(ws[i:i + n]) for i in range(0, len(ws), n))
    run, other = new(70), new(50)
    texts = [" ".join(new(90) + run + new(80)), wrap(new(33) + run + new(41), 7), " ".join(new(8) + run[:49] + new(99)),
             " ".join(new(61) + other + new(3)) + "\n\n" + " ".join(new(30) + other + new(30)),
             wrap(new(5) + other, 11) + " \t " + " ".join(run[10:] + new(200)), " ".join(["x"] * 180), "é " + wrap(run, 20)]
    texts.append("\n".join([" ".join(new(20)), texts[6], " ".join(new(70))]))
    df = spark.createDataFrame(list(enumerate([*texts, None, ""])), "doc_id long, text string")
    first, want = {}, {}
    for i, t in enumerate(texts):
        w, want[i] = words(t), set()
        for p in range(len(w) - 49):
            d, q = first.setdefault(tuple(w[p:p + 50]), (i, p))
            if d < i or q + 50 <= p:
                want[i] |= set(range(p, p + 50))
    got = {r.doc_id: r for r in repeated_passages(df).collect()}
    for i, t in enumerate(texts):
        at, place = [], 0
        for w in words(t):
            place = t.lower().index(w, place)
            at.append(place)
            place += len(w)
        spans = [tuple(map(int, s.split(":"))) for s in got[i].removed.split(",") if s]
        lines = [(s, e) for s, e, _ in paragraphs(t, 15)]
        gone = {k for k, p in enumerate(at) if any(s <= p < e for s, e in spans)}
        # whole repeated lines go as well; nothing else does
        assert want[i] <= gone
        assert all(any(s <= at[k] < e and (s, e) in spans for s, e in lines) for k in gone - want[i])
        assert got[i].n_removed == len(spans) and sorted(spans) == spans
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    assert [bool(want[i]) for i in range(8)] == [False, True, False, True, True, True, True, True]
    out = {r.doc_id: r.text for r in remove_repeats(df).collect()}
    assert words(out[1]) == words(texts[1])[:33] + words(texts[1])[103:] and out[0] == texts[0] and out[9] == ""


def test_dedup_of_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.near_duplicates(none).collect() == [] and repeated_passages(none).collect() == []
    assert minhash.keep_one(none).collect() == []
    assert near_embeddings(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).collect() == []


def test_words_are_those_of_the_contract():
    text = "A b  c\x1fd\x0be É"
    assert [w.decode() for w in common.ascii_words(text)] == words(text)


def same_id_rows() -> list[tuple]:
    """doc_ids that repeat with another text, with the same text, or are NULL; the
    extra columns have names that operators might use inside."""
    rng = random.Random(12)
    x, y, z = (" ".join(f"{c}{rng.randrange(10 ** 7)}" for _ in range(110)) for c in "xyz")
    near = lambda t, i: t.replace(t.split()[i], "edited")
    rows = [(5, x), (5, y), (7, near(x, 3)), (8, near(y, 9)), (6, z), (6, z), (4, z + " tail"), (None, x), (None, x), (9, ""), (9, None),
            (3, " ".join(y.split()[20:90]) + " " + " ".join(f"n{i}" for i in range(60)))]
    return [(i, t, f"row {k}", 1, True, 2, 3, "h") for k, (i, t) in enumerate(rows)]


SAME_ID = "doc_id long, text string, _id string, _removed int, _kept boolean, _n int, mark int, row string"


def test_links_of_a_doc_id_with_several_texts(spark):
    rows = same_id_rows()
    got = minhash.near_duplicates(spark.createDataFrame(rows, SAME_ID).repartition(3)).collect()
    want = near_components([r[:2] for r in rows], 2)
    assert len(got) == len(rows)
    for r in got:
        assert r.component_id == want.get(r.doc_id) and r.kept == (r.doc_id is None or want[r.doc_id] == r.doc_id)
    assert want[7] == want[8] == want[5] == 5 and want[6] == want[4] == 4


def test_keep_one_keeps_every_different_text(spark):
    rows = same_id_rows()
    df = spark.createDataFrame(rows, SAME_ID)
    out = [tuple(r) for r in minhash.keep_one(df, 2).collect()]
    assert sorted(out, key=str) == sorted((tuple(r) for r in minhash.keep_one(df.repartition(5), 2).collect()), key=str)
    assert sorted((r[0], r[1]) for r in out if r[0] and r[1]) == sorted(
        [(5, rows[0][1]), (5, rows[1][1]), (4, rows[6][1]), (3, rows[11][1])])
    # rows without a doc_id or words all stay, and every row handed on is one of the input
    assert sum(r[0] is None for r in out) == 2 and sum(r[0] == 9 for r in out) == 2 and set(out) <= set(rows)


def test_passages_of_a_doc_id_with_several_texts(spark):
    """Only what a text itself repeats is cut from it."""
    rows = same_id_rows()
    df = spark.createDataFrame(rows, SAME_ID).repartition(4)
    out = {r[2]: tuple(r) for r in remove_repeats(df).collect()}
    assert len(out) == len(rows)
    for r in rows:
        text = out[r[2]][1]
        assert out[r[2]][:1] + out[r[2]][2:] == r[:1] + r[2:]
        if r[0] is None or not r[1] or r[0] in (3, 4):  # the first copies, and rows that are left alone
            assert text == r[1] or (r[0] == 4 and text == r[1])
    one = {r[2]: words(out[r[2]][1]) for r in rows}
    assert words(rows[0][1]) == one["row 0"]  # x under doc 5: its copy in doc 7 is later
    assert one["row 4"] == one["row 5"] == []  # both copies of z are later than doc 4's
    assert one["row 2"] == [] and one["row 3"] == []  # near copies of whole paragraphs
    # y under doc 5 repeats 70 words of doc 3
    y = words(rows[1][1])
    assert one["row 1"] == y[:20] + y[90:]
    counts = {(r.doc_id, r.n_removed) for r in repeated_passages(df).collect()}
    assert {(3, 0), (4, 0), (5, 0), (5, 1), (6, 1), (7, 1), (8, 1), (9, 0), (None, 0)} == counts


def test_runs_of_partly_equal_contexts(spark):
    """Copies that begin and end at random places of one long text share windows with
    several different contexts."""
    rng = random.Random(8)
    base = [f"b{rng.randrange(10 ** 8)}" for _ in range(400)]
    texts = []
    for _ in range(30):
        s, n = rng.randrange(340), rng.randrange(30, 160)
        texts.append([*(f"u{rng.randrange(10 ** 8)}" for _ in range(20)), *base[s:s + n], *(f"u{rng.randrange(10 ** 8)}" for _ in range(20))])
    texts.append([f"p{i % 7}" for i in range(130)])
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    got = {r.doc_id: r.text for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), min_words=1000).collect()}
    first = {}
    for i, t in enumerate(texts):
        gone = set()
        for p in range(len(t) - 49):
            d, q = first.setdefault(tuple(t[p:p + 50]), (i, p))
            if d < i or q + 50 <= p:
                gone |= set(range(p, p + 50))
        assert words(got[i]) == [w for k, w in enumerate(t) if k not in gone]


def test_embeddings_of_string_labels_and_shared_ids(spark):
    a, b, c = [1.0, 0.0, 0.1], [0.0, 1.0, 0.1], [0.0, 0.1, 1.0]
    near = lambda v: [x + 0.01 for x in v]
    rows = [(1, a, "x"), (2, near(a), "x"), (3, near(a), "y"), (4, near(a), None), (5, b, "x"), (5, c, "x"),
            (6, near(b), "x"), (7, near(c), "x"), (None, a, "x")]
    df = spark.createDataFrame([(*r, 1, 2, True) for r in rows], "vec_id long, embedding array<double>, label string, id int, key int, fine boolean")
    got = sorted(((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in near_embeddings(df).collect()), key=str)
    assert got == sorted([(1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True), (4, 0, 4, True), (5, 1, 5, True), (5, 1, 5, True),
                          (6, 1, 5, False), (7, 1, 5, False), (0, 2, None, True)], key=str)
