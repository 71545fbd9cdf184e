from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import pyarrow.parquet as pq
import pytest

from caseload.llm import spelling as S
from caseload.llm.queries import queries

from .conftest import frame

SF = "/root/testdata/sf0.001"


def near_words(words):
    """Words at edit distance one, by their forms with one letter left out or open."""
    open_, near = defaultdict(set), defaultdict(set)
    for w in words:
        for k in range(len(w)):
            open_[w[:k] + "\0" + w[k + 1:]].add(w)
    for w in words:
        for k in range(len(w)):
            near[w] |= open_[w[:k] + "\0" + w[k + 1:]] - {w}
            shorter = w[:k] + w[k + 1:]
            if shorter in words:
                near[w].add(shorter)
                near[shorter].add(w)
    return near


def expected_rows(counts, dominance=5):
    near, form = near_words(counts), {}
    for w in counts:
        best = min(near[w], key=lambda o: (-counts[o], o), default=None)
        if best is not None and counts[best] >= dominance * counts[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {w: (n, len(near[w]), form.get(w), counts.get(form.get(w)), root(w)) for w, n in counts.items()}


def test_distance_is_one(spark):
    """The brute-force version itself, on words whose neighbours are plain."""
    near = near_words({"abcdef", "abcdeg", "abcde", "xabcdef", "abdcef"})
    assert near["abcdef"] == {"abcdeg", "abcde", "xabcdef"} and near["abdcef"] == set()


@pytest.mark.parametrize("letters,frequent", [("ab", 3), ("abcdé", 20), ("abcdefgh", 500)])
def test_pairs_are_all_pairs(spark, letters, frequent):
    rng = random.Random(len(letters))
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(4, 14))) for _ in range(900)}
    for w in list(words)[:300]:  # and a letter more, less or another
        k = rng.randrange(len(w))
        words |= {w[:k] + rng.choice(letters) + w[k:], w[:k] + rng.choice(letters) + w[k + 1:]}
        if len(w) > 4:
            words.add(w[:k] + w[k + 1:])
    words |= {"a" * n for n in range(4, 40)}
    counts = {w: rng.randint(1, 50) for w in words}
    got = S.near_pairs(spark.createDataFrame(list(counts.items()), "word string, n long"), frequent=frequent).collect()
    near = near_words(counts)
    assert len(got) == len({frozenset((r.word, r.other)) for r in got})
    assert {frozenset((r.word, r.other)) for r in got} == {frozenset((w, o)) for w in counts for o in near[w]}
    assert all((counts[r.word], counts[r.other]) == (r.n, r.other_n) for r in got)


def test_forms_and_roots(spark):
    counts = {"letters": 1000, "lettters": 40, "leters": 30, "letterz": 200, "lletters": 6, "letterzz": 6, "alonely": 9,
              "tiewordx": 60, "tiewordy": 60, "tieword": 7}
    docs = frame(spark, [(1, " ".join(f"{w.upper()}!" for w, n in counts.items() for _ in range(n))), (2, None), (2, ""), (None, "Words words")])
    got = {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in S.spelling_variants(docs).collect()}
    assert got == expected_rows(counts)
    assert got["letterzz"][2:] == ("letterz", 200, "letters")  # a form of a form
    assert got["tieword"][2] == "tiewordx"  # of equally frequent ones the first


def test_spelling_edges(spark, edge_docs, empty_docs):
    assert S.spelling_variants(edge_docs).collect() == []  # no word of six letters occurs five times
    got = S.spelling_variants(edge_docs, min_letters=4, min_count=4).collect()
    assert {(r.word, r.n) for r in got} == {("word", 30_000), ("same", 4), ("text", 4), ("here", 4)}
    assert S.spelling_variants(empty_docs).count() == 0
    long = "ab" * 5_000
    got = S.spelling_variants(frame(spark, [(1, f"{long} {long}c")]), min_count=1).collect()
    assert {(r.word, r.n_near) for r in got} == {(long, 1), (long + "c", 1)}
    with pytest.raises(ValueError):
        S.spelling_variants(empty_docs, min_letters=3)


def test_query_is_the_contract(spark):
    table = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"])
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts = Counter()
    for doc_id, text in zip(table["doc_id"].to_pylist(), table["text"].to_pylist()):
        for word in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = word.translate(lower)
            h = zlib.crc32(f"{doc_id}:{word}".encode())
            k = h % len(word)
            counts[word[:k] + word[k + 1:] if h % 199 == 0 else word] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    got = queries()["op13_spelling_variants"](spark, SF).collect()
    assert len(got) == len(counts)
    assert {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in got} == expected_rows(counts)
