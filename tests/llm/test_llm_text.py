"""Scans, decontamination, language ID, packing and quality."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pandas as pd
import pytest
from conftest import SF_SMALL, plan_text
from llm_brute import SCHEMA, awkward, contamination, listing, pii_base, secret_base, sha

from ledgerloom.llm import decontam, langid, packing, pii_crf, quality, secret_scan


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(awkward(), SCHEMA)


EMPTY = "doc_id long, text string, lang string, source string"


# --- language ID -------------------------------------------------------------

def test_signs_are_no_letters_and_long_texts_are_read_in_parts(monkeypatch):
    assert langid.words_of("½ ² Ⅷ 5 _ a²b") == ["a", "b"] and langid.words_of("½²") == []
    text = "one two three " * 40
    whole = langid.words_of(text)
    monkeypatch.setattr(langid, "PART", 30)
    assert [w for p in langid.pieces_of(text) for w in langid.words_of(p)] == whole
    model = langid.Model(["o", "n", "e", "t", "w", "on", "tw", "▁o"], ["a", "b"], np.random.default_rng(1).random((9, 2)) * 50)
    want = model.scores([text, None, "²", "one"])
    monkeypatch.setattr(langid, "WORDS", 1)
    monkeypatch.setattr(langid, "NODES", 5)
    monkeypatch.setattr(langid, "MEMO_CELLS", 4)
    again = langid.Model(model.pieces, model.langs)
    again.p = model.p
    got = again.scores([text, None, "²", "one"])
    assert got[0] == want[0] and np.allclose(got[1], want[1]) and got[0][1:3] == ["und", "und"]


def test_every_language_is_learned(spark):
    """A language with one document in a thousand is still one of the model's."""
    rows = [(i, f"alpha beta gamma {i}", "big") for i in range(3000)] + [(5000 + i, "ypsilon omega zeta", "rare") for i in range(3)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample_rows=200, rounds=1)
    assert model.langs == ["big", "rare"]
    assert model.scores(["ypsilon omega"])[0] == ["rare"]



def segmentations(word, pieces, p):
    """Sum over all segmentations, by recursion; a character outside the vocabulary
    has the floor probability."""
    if not word:
        return 1.0
    total = 0.0
    for k in range(1, len(word) + 1):
        if word[:k] in pieces:
            total += p[pieces.index(word[:k])] * segmentations(word[k:], pieces, p)
        elif k == 1:
            total += p[-1] * segmentations(word[1:], pieces, p)
    return total


def test_forward_sums_all_segmentations():
    pieces = sorted(["▁", "▁a", "a", "ab", "b", "abc", "c", "bc", "▁ab", "é"])
    rng = np.random.default_rng(0)
    p = rng.uniform(0.01, 1, (len(pieces) + 1, 2))
    lattice = langid.Lattice(pieces)
    words = ["abc", "a", "cab", "zab", "éabcabc", "bbbb"]
    got = np.exp(lattice.log_likelihood(words, p))
    want = [[segmentations("▁" + w, pieces, p[:, j]) for j in range(2)] for w in words]
    assert np.allclose(got, want, rtol=1e-12)


def test_expected_counts_are_the_gradient():
    """E[count of a piece] = p * d log F / d p."""
    pieces = sorted(["▁", "▁a", "a", "ab", "b", "abc", "c", "bc"])
    p = np.random.default_rng(1).uniform(0.05, 1, (len(pieces) + 1, 1))
    lattice, words, counts = langid.Lattice(pieces), ["abc", "abcab", "zb"], np.array([2.0, 1.0, 3.0])
    got = lattice.expected(words, counts, p)
    for i in range(len(pieces) + 1):
        q = p.copy()
        q[i] *= 1 + 1e-6
        d = (lattice.log_likelihood(words, q)[:, 0] - lattice.log_likelihood(words, p)[:, 0]) @ counts / 1e-6
        assert got[i] == pytest.approx(d, abs=1e-4)


def test_language_id_rows(spark, docs):
    got = langid.identify(docs).collect()
    assert len(got) == len(awkward())
    for r in got:
        assert 0 <= r.score <= 1 and r.lang_pred in ("und", "en", "fr", "de")
    by = {r.doc_id: r for r in got}
    assert by[4].lang_pred == by[5].lang_pred == by[6].lang_pred == by[13].lang_pred == "und" and by[13].score == 0
    assert by[12].lang_pred != "und"


def test_language_id_held_out_accuracy(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.identify(d).toPandas().merge(d.select("doc_id", "lang").toPandas(), on="doc_id")
    held = got[got.held_out]
    assert len(held) > 200 and (held.lang == held.lang_pred).mean() > 0.98


def test_accept_without_labels_or_rows(spark):
    d = spark.createDataFrame([(1, "abc", None), (2, "12", None), (3, None, None)], "doc_id long, text string, lang string")
    assert [r.doc_id for r in langid.accept(d).collect()] == [1]
    none = spark.createDataFrame([], EMPTY)
    assert langid.identify(none).collect() == [] and langid.accept(none).collect() == []


# --- decontamination ---------------------------------------------------------

def test_automaton_against_all_windows():
    rng = random.Random(4)
    for trial in range(60):
        vocab = [f"v{i}" for i in range(rng.choice([2, 4, 12]))]
        text = lambda n: " ".join(rng.choice(vocab + ["out"] * (trial % 2)) for _ in range(n))
        items = [(str(i), text(rng.randrange(0, 9))) for i in range(rng.randrange(1, 7))]
        window = rng.choice([2, 3, 5])
        auto = decontam.ItemAutomaton([(i, decontam.item_words(t)) for i, t in items], window)
        doc = text(rng.randrange(0, 40))
        ranges, names = auto.match(decontam.item_words(doc))
        want = contamination(doc, items, window)
        assert (sum(e - s for s, e in ranges), sorted(names)) == want[1:]


def test_contamination_rows_and_passes(spark, docs):
    items = [(1, "beta gamma delta epsilon zeta eta theta iota kappa lambda mu"), (10, "ONE"), (2, None), (3, ""),
             (None, "alpha beta"), (1, "one two"), (10, "ONE")]
    df = spark.createDataFrame(items, "item_id long, text string")
    want = sorted((str(r[0]), *contamination(r[1], items)[:2], sha(",".join(contamination(r[1], items)[2]))) for r in awkward())
    for found in (decontam.contamination(docs, df), None):
        if found is None:  # the same in several passes over the documents
            found = decontam.match_items(docs.select("doc_id", "text"), df, 10, tokens_per_pass=3).selectExpr(
                "doc_id", "_n_words n_words", "aggregate(_hits, 0L, (n, r) -> n + r.end - r.start) n_hit",
                "sha2(concat_ws(',', _items), 256) items_sha256")
        assert sorted((str(r.doc_id), r.n_words, r.n_hit, r.items_sha256) for r in found.collect()) == want


def test_decontaminate_cuts_spans(spark, docs):
    df = spark.createDataFrame([(1, "Beta gamma, delta")], "item_id long, text string")
    out = {r.doc_id: r for r in decontam.decontaminate(docs, df).collect()}
    assert out[1].text.split() == "alpha epsilon zeta eta theta iota kappa lambda mu".split()
    assert out[10].text == awkward()[9][1] and out[4].text is None and out[1]["_text"] == "u" and out[1].kept == "k"
    whole = spark.createDataFrame([(1, "one")], "item_id long, text string")
    assert not {7, 8} & {r.doc_id for r in decontam.decontaminate(docs, whole).collect()}
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.decontaminate(docs, none).count() == len(awkward())


def test_decontaminate_has_one_python_worker_a_task(spark, docs):
    """A check saw this step stand still when tasks matched in one worker and cut in another."""
    df = spark.createDataFrame([(1, "Beta gamma, delta")], "item_id long, text string")
    assert plan_text(decontam.decontaminate(docs, df), "simple").count("MapInArrow") == 1
    rows = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e"), (3, None), (4, "")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "b c"), (2, "E")], "item_id long, text string")
    found = decontam.match_items(rows, items, tokens_per_pass=1, last=decontam._cutting(0.5)).collect()
    assert sorted((r.doc_id, r.text) for r in found) == [(1, "a  d  f"), (3, None), (4, "")]


# --- secrets -----------------------------------------------------------------

def test_secret_rows(spark, docs):
    got = secret_scan.secret_spans(docs).collect()
    want = sorted((str(r[0]), sha(listing(secret_base(r[1])))) for r in awkward())
    assert sorted((str(r.doc_id), r.base_sha256) for r in got) == want
    row = next(r for r in got if r.doc_id == 14)
    assert (row.n_assign, row.n_access, row.n_hex) == (1, 1, 1)


def battery(token: str, enc: str) -> float:
    """Fisher's combination in numpy and by exact normal tails."""
    from math import erfc, exp, log, sqrt
    alphabet = secret_scan.ALPHABETS[enc]
    x = np.array([alphabet.index(c) for c in token])
    n, size = len(x), len(alphabet)
    two = lambda z: erfc(abs(z) / sqrt(2))
    cells = np.bincount(x * 8 // size, minlength=8)
    chi = ((cells - n / 8) ** 2 / (n / 8)).sum()
    z = ((chi / 7) ** (1 / 3) - (1 - 2 / 63)) / sqrt(2 / 63)
    p1 = erfc(z / sqrt(2)) / 2
    high = x * 2 >= size
    a, b = int(high.sum()), int((~high).sum())
    mu = 2 * a * b / n + 1
    var = (mu - 1) * (mu - 2) / (n - 1)
    p2 = two((1 + (high[1:] != high[:-1]).sum() - mu) / sqrt(var)) if var > 0 else 0
    off = x - x.mean()
    p3 = two(((off[1:] * off[:-1]).sum() / (off ** 2).sum() + 1 / n) * sqrt(n)) if (off ** 2).sum() else 0
    h = -sum(log(max(p, 1e-30)) for p in (p1, p2, p3))
    return exp(-h) * (1 + h + h * h / 2)


def test_battery_and_thresholds(spark):
    rng = random.Random(8)
    alphabet = secret_scan.ALPHABETS["base64"]
    make = lambda n: "".join(rng.choice(alphabet[:62]) for _ in range(n))
    secrets = [make(rng.choice([36, 40, 44])) for _ in range(300)]
    texts = [(i, f"see {s} here") for i, s in enumerate(secrets)]
    texts += [(1000 + i, "plain words and AveryLongIdentifierName1 with aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa1B") for i in range(50)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    scored = secret_scan.with_spans(df.withColumnRenamed("text", "_text")).selectExpr(
        "doc_id", "substring(_text, _tokens[0].start + 1, _tokens[0].end - _tokens[0].start) t", "_tokens[0].p p").filter("doc_id < 1000")
    rows = scored.collect()
    assert len(rows) == 300
    for r in rows:
        assert r.p == pytest.approx(battery(r.t, "base64"), abs=2e-5)
    found = {r.doc_id: r.n_random for r in secret_scan.secret_spans(df).collect()}
    assert sum(found[i] for i in range(300)) >= 270 and not any(found[1000 + i] for i in range(50))


def test_thresholds_refuse_bands_without_random_tokens(spark):
    rng = np.random.default_rng(6)
    letters = [*secret_scan.ALPHABETS["base64"][:62]]
    random_ = np.array([battery("".join(rng.choice(letters, 44)), "base64") for _ in range(4_000)])
    text = rng.beta(0.1, 3, 200_000)
    scores = {4: text, 5: np.r_[text, random_], 6: rng.beta(0.1, 3, 3_000), 7: 1 - np.sqrt(1 - rng.random(20_000)),
              8: random_, 9: np.r_[random_, 0.01 * rng.random(60_000)], 10: rng.beta(0.1, 3, 200)}
    rows = [(band, [("base64", band, float(v)) for v in p]) for band, p in scores.items()]
    df = spark.createDataFrame(rows, "id long, _tokens array<struct<enc:string,band:int,p:double>>")
    got = secret_scan.thresholds(df, 0.05)
    assert set(got) == {("base64", 8), ("base64", 9)} and max(got.values()) <= 0.1


def test_redact(spark, docs):
    out = {r.doc_id: r for r in secret_scan.redact(docs).collect()}
    assert out[14].text == "<SECRET>\" and password:short <SECRET> <SECRET>"
    assert out[4].text is None and out[15].text == awkward()[-1][1] and out[1]["_text"] == "u"
    none = spark.createDataFrame([], EMPTY)
    assert secret_scan.secret_spans(none).collect() == [] and secret_scan.redact(none).collect() == []


# --- personal data -----------------------------------------------------------

def test_pii_patterns_against_plain_ones(spark, docs):
    got = pii_crf.personal_data(docs).collect()
    want = sorted((str(r[0]), sha(",".join(f"{pii_crf.KINDS[k]}:{s}:{e}" for k, s, e in pii_base(r[1])))) for r in awkward())
    assert sorted((str(r.doc_id), r.base_sha256) for r in got) == want
    rng = random.Random(6)
    for _ in range(3000):
        t = "".join(rng.choice("a1. @+-()9%255") for _ in range(rng.randrange(40)))
        assert sorted(pii_crf.base_spans(t)) == sorted(pii_base(t)), t


def test_field_against_enumeration():
    field = pii_crf.Field()
    rng = np.random.default_rng(3)
    field.emit, field.move = rng.standard_normal(field.emit.shape), rng.standard_normal(field.move.shape)
    words = ["call", "+1", "(017)", "now"]
    feats, marked = pii_crf.features(words), np.array([False, True, True, False])
    score, _ = field._pad([feats], [marked])
    paths = {}
    for path in itertools.product(range(9), repeat=4):
        ok = all(field.allowed[a, b] for a, b in zip(path, path[1:]))
        total = sum(score[0, i, k] for i, k in enumerate(path)) + sum(field.move[a, b] for a, b in zip(path, path[1:]))
        if ok and total > -1e8:
            paths[path] = total
    assert tuple(field.viterbi(score)[0]) == max(paths, key=paths.get)
    z = np.logaddexp.reduce(list(paths.values()))
    logp, _ = field.marginals(score)
    for i in range(4):
        for k in range(9):
            want = sum(np.exp(v - z) for path, v in paths.items() if path[i] == k)
            assert np.exp(logp[0, i, k]) == pytest.approx(want, abs=1e-9)


def test_field_finds_what_no_pattern_takes(spark):
    """Forms of the labelled table with other names, hosts and numbers, in other
    sentences, among the given documents: found exactly in most cases; sentences that look
    alike and the documents themselves gain nothing."""
    rng = random.Random(1)
    pick = lambda *x: rng.choice(x)
    name = lambda: pick("otto", "greta", "liam", "noor", "pavel", "yuki", "amir", "zoe")
    host = lambda: pick("acme", "foobar", "postbox", "univ", "kiosk")
    top = lambda: pick("com", "org", "net", "example", "de")
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    forms = [
        lambda: ("email", f"{name()} dot {name()} at {host()} dot {top()}"), lambda: ("email", f"{name()} at {host()} dot {top()}"),
        lambda: ("email", f"{name()}.{name()} (at) {host()} (dot) {top()}"), lambda: ("email", f"{name()} [at] {host()} [dot] {top()}"),
        lambda: ("email", f"{name()}(at){host()}.{top()}"), lambda: ("email", f"{name()}[at]{host()}[dot]{top()}"),
        lambda: ("phone", f"({d(3)}) 555-{d(4)}"), lambda: ("phone", f"{d(3)}-555-{d(4)}"), lambda: ("phone", f"{d(3)}.555.{d(4)}"),
        lambda: ("phone", f"0049 {d(2)} {d(7)}"), lambda: ("card", f"{d(4)}.{d(4)}.{d(4)}.{d(4)}"),
        lambda: ("card", f"{d(4)}_{d(4)}_{d(4)}_{d(4)}"), lambda: ("ip", f"{d(2)}[.]{d(3)}[.]{d(1)}[.]{d(2)}")]
    frames = ["the letter went to {} last week", "so {} is what they gave", "please note {} as new", "they said {} was right. Then",
              "we wrote {}, and more", "at home {} rang"]
    planted = {}
    for i in range(130):
        kind, x = forms[i % len(forms)]()
        text = rng.choice(frames).format(x)
        s = text.index(x)
        planted[10_000 + i] = (text, f"{kind}:{s}:{s + len(x)}")
    clean = ["it was the dot at the end of page 12", "a dot on the i at noon", "he met 3 people at 4 and 5", "version 2.4.1 of 2021-05-06",
             "order 8812-77 at 10.30", "the dot com boom of 1999", "see (at 7) there", "12.50 or 13.75 each", "ISBN 978-0-306-40615-7 sold",
             "9777946427004852 at the", "chapter 7.3 at [the] end", "one dot two dot three"]
    given = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    rows = [(i, t) for i, (t, _) in planted.items()] + [(20_000 + i, t) for i, t in enumerate(clean)]
    got = {r.doc_id: r for r in pii_crf.personal_data(given.unionByName(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    found = sum(span in got[i].spans.split(",") for i, (_, span) in planted.items())
    added = sum(r.n_added for i, r in got.items() if i >= 10_000)
    assert found >= 0.8 * len(planted) and found >= 0.95 * added
    assert all(got[20_000 + i].n_added == 0 for i in range(len(clean)))
    assert sum(r.n_added for i, r in got.items() if i < 10_000) == 0


def test_field_learns_and_adds(spark):
    rng = random.Random(2)
    rows = [(i, f"some text and +1 ({rng.randrange(100, 999)}) 555-{rng.randrange(1000, 9999)} follows {rng.randrange(99)} times")
            for i in range(300)]
    rows.append((900, "some text and 1 (415) 555-1234 follows"))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in pii_crf.personal_data(df, least=0.5).collect()}
    assert all(got[i].n_phone == 1 and got[i].n_added == 0 for i in range(300))
    assert spark.createDataFrame([], EMPTY).transform(pii_crf.personal_data).collect() == []
    masked = {r.doc_id: r.text for r in pii_crf.mask(df).collect()}
    assert masked[0].startswith("some text and <PHONE> follows")


# --- packing -----------------------------------------------------------------

def test_best_widths_against_enumeration():
    rng = np.random.default_rng(5)
    for _ in range(40):
        lengths = np.unique(rng.integers(1, 60, rng.integers(1, 9)))
        counts = rng.integers(1, 20, len(lengths))
        for k in (1, 2, 3, 4):
            cost = lambda widths: sum(c * min(w for w in widths if w >= n) for n, c in zip(lengths, counts))
            tries = [(*rest, lengths[-1]) for m in range(min(k, len(lengths)))
                     for rest in itertools.combinations(lengths[:-1], m)]
            got = packing.best_widths(lengths, counts, k)
            assert len(got) <= k and cost(got) == min(map(cost, tries))


def test_packing_rows(spark, docs):
    out = packing.pack(docs, buckets=4, max_tokens=512, token_budget=2048, keep_tokens=True).toPandas()
    want = packing.sequences(docs, 512, keep_tokens=True).toPandas()
    assert len(out) == len(want) and out.n_tokens.sum() == want.n_tokens.sum()
    assert (out.n_tokens <= out.width).all() and out.width.nunique() <= 4
    encode = packing._encoding(open(packing.VOCABULARY, "rb").read())
    for doc_id, part in out[out.doc_id.isin([1, 10, 15])].groupby("doc_id"):
        text = next(r[1] for r in awkward() if r[0] == doc_id)
        tokens = [t for ts in part.sort_values("chunk").tokens for t in ts]
        assert encode.decode(tokens) == text
    batches = out.groupby("batch_id").agg(width=("width", "nunique"), rows=("slot", "size"), first=("slot", "min"),
                                          last=("slot", "max"), wide=("width", "max"))
    assert (batches.width == 1).all() and (batches["first"] == 0).all() and (batches["last"] == batches.rows - 1).all()
    assert ((batches.rows * batches.wide <= 2048) | (batches.rows == 1)).all()
    full = (batches.rows < (2048 // batches.wide).clip(lower=1)).groupby(batches.wide).sum()
    assert (full <= 1).all()
    assert sorted(out.batch_id.unique()) == list(range(out.batch_id.nunique()))
    assert packing.pack(spark.createDataFrame([], EMPTY)).collect() == []
    # a doc_id under several texts: reruns place alike
    twice = spark.createDataFrame([(1, f"text {i % 7} {'x ' * (i % 5)}") for i in range(40)], "doc_id long, text string")
    first, second = (sorted(map(str, packing.pack(d, token_budget=64).collect())) for d in (twice, twice.repartition(7)))
    assert first == second


def test_packing_moves_tokens_as_bytes(spark, docs, monkeypatch):
    moved = []
    key = packing.dense_key

    def spy(df, *args, **kwargs):
        moved.append(dict(df.dtypes)["tokens"])
        return key(df, *args, **kwargs)
    monkeypatch.setattr(packing, "dense_key", spy)
    out = packing.pack(docs, max_tokens=64)
    assert moved == ["binary"] and dict(out.dtypes)["tokens"] == "array<int>"
    plain = packing.sequences(docs, 64).select("doc_id", "chunk", "tokens")
    assert sorted(map(str, out.select("doc_id", "chunk", "tokens").collect())) == sorted(map(str, plain.collect()))
    assert packing._code_type(b"YQ== 0\nYg== 65535\n").itemsize == 2 and packing._code_type(b"YQ== 65536\n").itemsize == 4
    wide = packing.sequences(docs, 64, packed=np.dtype("<u4"))
    back = wide.select("doc_id", "chunk", "tokens").mapInArrow(packing._unpacked(np.dtype("<u4")), "doc_id long, chunk long, tokens array<int>")
    assert sorted(map(str, back.collect())) == sorted(map(str, plain.collect()))


# --- quality -----------------------------------------------------------------

def test_quality_held_out_accuracy(spark):
    d = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    train = labels.filter("doc_id % 4 <> 0")
    got = quality.classify(d, train).toPandas().merge(labels.filter("doc_id % 4 = 0").toPandas(), on="doc_id")
    assert ((got.quality_score >= 0.5) == (got.quality == 1)).mean() > 0.98
    assert ((got.toxic_score >= 0.5) == (got.toxic == 1)).mean() > 0.95


def test_quality_rows(spark, docs):
    labels = spark.createDataFrame([(1, 1, 0), (10, 0, None), (None, 1, 1), (1, 0, 0)], "doc_id long, quality int, toxic int")
    got = quality.classify(docs, labels).collect()
    assert len(got) == len(awkward()) and all(0 <= r.quality_score <= 1 and 0 <= r.toxic_score <= 1 for r in got)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.quality_score for r in quality.classify(docs, none).collect()} == {0.5}
    assert quality.classify(spark.createDataFrame([], EMPTY), none).collect() == []


def test_quality_labels_are_not_thinned(spark):
    """Few labels beside many documents, and a rare class among many labels."""
    rng = random.Random(12)
    toxic = {i: i % 40 == 0 for i in range(12_000)}
    say = lambda i: " ".join(["vile"] * toxic[i] + [f"w{rng.randrange(60)}" for _ in range(12)])
    docs = spark.createDataFrame([(i, say(i), "en", "s") for i in toxic], "doc_id long, text string, lang string, source string")
    for known in (range(0, 12_000, 20), [i for i in toxic if i % 40 or i % 800 == 0]):
        labels = spark.createDataFrame([(i, i % 2, int(toxic[i])) for i in known], "doc_id long, quality int, toxic int")
        got = {r.doc_id: r.toxic_score for r in quality.classify(docs, labels, sample_rows=700).collect()}
        true, clean = ([v for i, v in got.items() if toxic[i] == x] for x in (True, False))
        assert len(true) == 300 and min(true) > max(clean)
        assert np.mean(clean) < 0.05


def test_metadata_layout_of_empty_text():
    assert len(quality.layout(None)) == quality.LAYOUT and pd.notna(quality.layout(None)).all()
