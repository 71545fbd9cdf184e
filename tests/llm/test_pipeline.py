from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import duckdb
import public_tokenizers
import pytest

import corpus_pipeline
from caseload.llm import language_id, queries


from .test_decontaminate import plain_search
from .test_dedup import roots_of, slow_fingerprint
from .test_tokens import library_ids

ROOT = Path(__file__).resolve().parents[2]
SF = "/root/testdata/sf0.001"


def plain_pipeline(docs, items, samples):
    """Document ids that are left before packing, by the plain versions of the stages."""
    langs, scores = language_id.CrossParser(samples).predict([t for _, t in docs])
    docs = [d for d, lang, score in zip(docs, langs, scores) if lang != "und" and score >= corpus_pipeline.MIN_LANGUAGE_SCORE]
    last = {}
    for i, t in docs:
        last[t] = max(i, last.get(t, i))
    docs = [d for d in docs if last[d[1]] == d[0]]
    fps = {i: slow_fingerprint(t) for i, t in docs}
    ids = sorted(fps)
    roots = roots_of([(a, b) for k, a in enumerate(ids) for b in ids[:k] if (fps[a] ^ fps[b]).bit_count() <= 4], ids)
    return [(i, t) for i, t in docs if roots[i] == i and not plain_search(t, items)[1]]


def test_pipeline_matches_plain_version(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    docs = [(r.doc_id, r.text) for r in documents.collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    samples = language_id.labelled_sample(documents.where(~language_id.held_out_fold()))
    left = plain_pipeline(docs, items, samples)
    pieces = corpus_pipeline.run(spark, SF).collect()
    assert {p.doc_id for p in pieces} == {i for i, _ in left} and len(left) < len(docs)
    sizes = {i: len(ids) + 1 for (i, _), ids in zip(left, library_ids(public_tokenizers.path("word_bpe_49k.json"), [t for _, t in left]))}
    assert {p.doc_id: p.doc_tokens for p in pieces} == sizes and sum(p.length for p in pieces) == sum(sizes.values())


@pytest.mark.parametrize("k", range(5))
def test_stages_take_edge_tables(spark, edge_docs, empty_docs, k):
    _, stage = corpus_pipeline.STAGES[k]
    for docs in (edge_docs, empty_docs):
        out = stage(spark, docs, SF)
        assert k == 4 or out.columns == docs.columns
        out.collect()


def test_stage_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "simhash", "decontamination", "packing"]


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql_oracles(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    df = queries.queries()[name](spark, SF)
    columns = sorted(df.columns)
    expected = con.sql(f"SELECT {', '.join(columns)} FROM ({queries.oracle_sql()[name]})").fetchall()
    assert sorted(map(str, (tuple(r[c] for c in columns) for r in df.collect()))) == sorted(map(str, expected))


def test_entry_without_this_package():
    """The other queries are there when this package cannot be imported."""
    code = ("import sys; sys.modules['caseload.llm'] = None\nclass Gone:\n def find_spec(self, name, path=None, target=None):\n"
            "  if name == 'caseload.llm': raise ModuleNotFoundError(name=name)\nsys.modules.pop('caseload.llm'); sys.meta_path.insert(0, Gone())\n"
            "import __spark_entry__ as e; q = e.queries(); assert 'region_op' in q and 'pipeline' not in q; e.oracle_sql()")
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)


