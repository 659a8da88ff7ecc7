"""The pipeline's stages and rows against brute force; the entry without llm."""

from __future__ import annotations

import re
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest
from conftest import SF_SMALL, duck_bag, spark_bag
from llm_brute import SCHEMA, awkward, contamination, item_words, near_components, secret_base

import corpus_pipeline
from ledgerloom.llm import langid, packing
from ledgerloom.llm.oracle import ORACLE
from ledgerloom.llm.queries import QUERIES

ROOT = Path(__file__).resolve().parents[2]


def cut(text: str, items: list[tuple]) -> str | None:
    """Text without the words of matched windows; None if they are more than half."""
    w = item_words(text)
    hit = set()
    for _, item in items:
        iw = item_words(item)
        k = min(10, len(iw))
        for s in range(len(iw) - k + 1) if k else ():
            hit |= {q for p in range(len(w) - k + 1) if w[p:p + k] == iw[s:s + k] for q in range(p, p + k)}
    if 2 * len(hit) > len(w):
        return None
    at = [m.span() for m in re.finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)]
    out = list(text)
    for p in hit:
        end = at[p + 1][0] if p + 1 in hit else at[p][1]
        out[at[p][0]:end] = [""] * (end - at[p][0])
    return "".join(out)


def hide(text: str) -> str:
    done, out = 0, []
    for s, _, e, _ in secret_base(text):
        if s >= done:
            out += [text[done:s], "<SECRET>"]
        done = max(done, e)
    return "".join([*out, text[done:]])


def test_pipeline_rows_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    model = langid.train(docs.filter(~langid.held_out()))
    lang, score = model.scores([t for _, t in rows])
    rows = [r for r, x, s in zip(rows, lang, score) if x != "und" and s >= 0.5]
    comp = near_components(rows, 5)
    rows = [(i, cut(t, items)) for i, t in rows if comp[i] == i]
    rows = [(i, hide(t)) for i, t in rows if t is not None]
    encode = packing._encoding(open(packing.VOCABULARY, "rb").read()).encode_ordinary
    want = sorted((i, c, codes[c * 4096:(c + 1) * 4096]) for i, t in rows for codes in [encode(t)]
                  for c in range(max(1, -(-len(codes) // 4096))))
    out = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert sorted((r.doc_id, r.chunk, list(r.tokens)) for r in out) == want
    assert all(r.n_tokens == len(r.tokens) <= r.width for r in out)


def test_stages_take_awkward_rows(spark):
    docs = spark.createDataFrame(awkward(), SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_SMALL)
        rows = out.collect()
        none = stage(spark, docs.filter("false"), SF_SMALL)
        assert none.collect() == []
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns and len(rows) <= len(awkward())
            assert all(r.kept == "k" and r["_text"] == "u" for r in rows)
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        path = Path(SF_SMALL, f"{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}{'/*.parquet' if path.is_dir() else ''}')")
    assert spark_bag(QUERIES[name](spark, SF_SMALL)) == duck_bag(con, ORACLE[name])


def test_sql_and_query_agree_on_counted_contamination(spark):
    items = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    got = {r.doc_id: r for r in QUERIES["op6_benchmark_decontamination"](spark, SF_SMALL).collect()}
    for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(40).collect():
        n, hit, names = contamination(r.text, items)
        assert (got[r.doc_id].n_words, got[r.doc_id].n_hit, got[r.doc_id].n_items) == (n, hit, len(names))


def test_every_operator_has_one_query():
    assert sorted(int(re.match(r"op(\d+)_", k).group(1)) for k in QUERIES) == list(range(1, 14))


def test_entry_imports_without_the_subpackage(tmp_path):
    """A copy of the repository without llm and the pipeline still registers the rest."""
    code = ("import sys; sys.path.insert(0, '.'); import __spark_entry__ as e; "
            "print(len(e.queries()), any(k.startswith('op') for k in e.queries()), 'pipeline' in e.oracle_sql())")
    import shutil
    shutil.copytree(ROOT, tmp_path / "r", ignore=shutil.ignore_patterns("llm", ".git", "__pycache__", "corpus_pipeline.py"))
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "r", capture_output=True, text=True, timeout=120)
    n, ops, piped = out.stdout.split()
    assert int(n) > 30 and (ops, piped) == ("False", "False"), out.stderr
