from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest

from caseload.llm import periodic_runs as R
from caseload.llm.queries import queries

from .conftest import EDGE_TEXTS

SF = "/root/testdata/sf0.001"


def slow_runs(words, min_length=6, min_exponent=4):
    """(start, end, smallest period) by comparing every word with the one each period later."""
    n, out = len(words), []
    for q in range(1, n // min_exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            found = words[i:j + q]
            if j > i and len(found) >= max(min_length, min_exponent * q) and not any(
                    all(found[k] == found[k + r] for k in range(len(found) - r)) for r in range(1, q)):
                out.append((i, j + q, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def random_words(rng):
    n, k = rng.choice([0, 1, 5, 6, 7, 20, 60, 120]), rng.choice([1, 2, 2, 3, 10])
    words = [rng.randrange(k) for _ in range(n)]
    for _ in range(rng.randint(0, 3) if n else 0):
        a = rng.randrange(n)
        p, b = 1 + (n - a) // rng.randint(3, 10), rng.randint(a, n)
        for i in range(a, b):
            words[i] = words[a + (i - a) % p]
    return words


@pytest.mark.parametrize("min_length,min_exponent", [(6, 4), (3, 3), (10, 5)])
def test_runs_are_those_of_comparing_every_period(min_length, min_exponent):
    rng = random.Random(min_length)
    for _ in range(400):
        docs = [random_words(rng) for _ in range(rng.randint(1, 4))]
        expected, at = [], 0
        for words in docs:
            expected += [(s + at, e + at, q) for s, e, q in slow_runs(words, min_length, min_exponent)]
            at += len(words)
        got = R.find_runs(np.array(sum(docs, []), np.int64), np.array([len(w) for w in docs]), min_length, min_exponent)
        assert [tuple(r) for r in got.tolist()] == expected


@pytest.mark.parametrize("words", [[0] * 100_000, [i % 7 for i in range(100_000)], [0, 0, 0, 0, 0, 0, 1] * 10_000])
def test_long_runs_take_no_longer_than_others(words):
    got = R.find_runs(np.array(words), np.array([len(words)])).tolist()
    assert (0, len(words)) in {(s, e) for s, e, _ in got}


def test_fewer_than_three_periods_are_refused(edge_docs):
    with pytest.raises(ValueError):
        R.periodic_runs(edge_docs, min_exponent=2)


def test_runs_edges(edge_docs, empty_docs):
    got = R.periodic_runs(edge_docs).collect()
    assert len(got) == len(EDGE_TEXTS) + 3
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    assert (by_id[0].n_words, by_id[0].runs, by_id[0].collapsed) == (0, [], "")  # a null text
    assert [tuple(r) for r in by_id[7].runs] == [(0, 30_000, 1)] and by_id[7].collapsed == "word"
    assert [tuple(r) for r in by_id[14].runs] == [(0, 6, 1)]
    assert by_id[6].collapsed == "A b" and by_id[13].collapsed == "x y"
    assert R.periodic_runs(empty_docs).count() == 0


def test_query_is_the_contract(spark):
    table = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"])
    got = {r.doc_id: r for r in queries()["op12_periodic_runs"](spark, SF).collect()}
    assert len(got) == len(table)
    with_runs = 0
    for doc_id, text in zip(table["doc_id"].to_pylist(), table["text"].to_pylist()):
        words = re.findall("[^\x20\x09-\x0D]+", text or "")
        h = zlib.crc32(str(doc_id).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = slow_runs(words)
        with_runs += bool(runs)
        drop = {i for s, e, q in runs for i in range(s + q, e)}
        best = max(runs, key=lambda r: (r[1] - r[0], -r[0], -r[2]), default=None)
        r = got[doc_id]
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (
            (len(runs), best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (0, None, None, None, None))
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{e - s},{q}\n" for s, e, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in drop).encode()).hexdigest()
    assert with_runs > 5
