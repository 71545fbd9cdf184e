from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from caseload.llm import decontaminate as dc

from .conftest import EDGE_TEXTS, frame, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain_search(text, items, window=10):
    words, hit, found = plain_words(text), set(), set()
    for item_id, item in items:
        iw = plain_words(item)
        n = min(window, len(iw))
        phrases = {tuple(iw[k:k + n]) for k in range(len(iw) - n + 1)} if n else set()
        for i in range(len(words) - n + 1):
            if tuple(words[i:i + n]) in phrases:
                hit.update(range(i, i + n))
                found.add("" if item_id is None else str(item_id))
    return len(words), len(hit), sorted(found)


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


@pytest.fixture(scope="module")
def case():
    rng = random.Random(5)
    items = [(i, prose(1000 + i, rng.choice([3, 9, 10, 11, 30]))) for i in range(25)]
    items += [(100, None), (101, ""), (102, "?!"), (7, prose(1007, 12)), (None, prose(2000, 14)), (103, "the of the of the of the of the of the of")]
    docs = []
    for i in range(120):
        text = prose(i, rng.randint(0, 80))
        for _ in range(rng.choice([0, 0, 1, 3])):
            piece = plain_words(rng.choice(items)[1])
            a = rng.randint(0, max(0, len(piece) - 9))
            text += rng.choice([" ", ", ", "\n"]) + " ".join(piece[a:a + rng.randint(5, 25)]).upper() + "; " + prose(i + 500, 6)
        docs.append((i, text))
    return items, docs


@pytest.mark.parametrize("block_phrases, segment_words", [(dc.BLOCK_PHRASES, dc.SEGMENT_WORDS), (60, 200)])
def test_matches_plain_search(spark, case, block_phrases, segment_words):
    items, docs = case
    got = dc.contamination(frame(spark, docs), bench(spark, items), block_phrases=block_phrases, segment_words=segment_words).collect()
    assert len(got) == len(docs)
    texts = dict(docs)
    for r in got:
        n, hit, found = plain_search(texts[r.doc_id], items)
        assert (r.n_words, r.n_hit, r["items"], r.n_items, r.contaminated) == (n, hit, found, len(found), hit > 0)
    assert sum(r.contaminated for r in got) > 20


def test_positions_and_proximity(spark):
    item = "alpha beta gamma delta epsilon"
    docs = frame(spark, [(1, f"x {item} y {item}"), (2, "alpha beta so gamma delta epsilon"), (3, "epsilon delta gamma x x x x x beta alpha"),
                         (4, "alpha beta gamma delta")])
    got = {r.doc_id: r for r in dc.phrase_matches(docs, bench(spark, [(5, item)]), slop=1).collect()}
    assert [(h.item_id, h.start, h.length) for h in got[1].hits] == [("5", 1, 5), ("5", 7, 5)]
    assert got[2].hits == [] and got[2].near == ["5"]
    assert all(got[k].hits == [] and got[k].near == [] for k in (3, 4))


def plain_near(docs, items, window=10, slop=3):
    """Items (by document) with a phrase whose terms all stand near their places, seen from the rarest one, but no hit."""
    texts = {i: plain_words(t) for i, t in docs}
    frequency = Counter(w for ws in texts.values() for w in ws)
    out = {}
    for doc_id, ws in texts.items():
        at = {}
        for i, w in enumerate(ws):
            at.setdefault(w, []).append(i)
        close = set()
        for item_id, item in items:
            iw = plain_words(item)
            n = min(window, len(iw))
            for s in range(len(iw) - n + 1 if n else 0):
                phrase = iw[s:s + n]
                k = min(range(n), key=lambda k: (frequency[phrase[k]], k))
                if any(all(any(abs(q - (p - k + j)) <= slop for q in at.get(phrase[j], ())) for j in range(n)) for p in at.get(phrase[k], ())):
                    close.add("" if item_id is None else str(item_id))
        out[doc_id] = len(close - set(plain_search(" ".join(ws), items, window)[2]))
    return out


def test_near_matches_plain_search(spark, case):
    items, docs = case
    rng = random.Random(9)
    moved = [(1000 + i, " ".join(w for w in plain_words(items[i % 25][1]) for w in ([w, "um"] if rng.random() < 0.15 else [w]))) for i in range(30)]
    got = dc.contamination(frame(spark, docs + moved), bench(spark, items), segment_words=300).collect()
    want = plain_near(docs + moved, items)
    assert {r.doc_id: r.n_near for r in got} == want and sum(map(bool, want.values())) > 10


def test_the_index_holds_every_token(spark, case, edge_docs):
    _, docs = case
    index = dc.build_index(frame(spark, docs), segment_words=100)
    counts = Counter(w for _, t in docs for w in plain_words(t))
    assert {r.term: r.n for r in index.postings.groupBy("term").agg({"n": "sum"}).toDF("term", "n").collect()} == counts
    assert index.postings.where("n <> size(places) OR places <> array_sort(array_distinct(places))").count() == 0
    assert index.postings.groupBy("term", "segment").count().where("count > 1").count() == 0
    assert dc.build_index(edge_docs).documents.count() == len(EDGE_TEXTS) + 3


def test_decontaminate_edges(spark, edge_docs, empty_docs):
    items = bench(spark, [(1, "same text"), (2, "word " * 30), (None, "😀 😀")])
    got = dc.contamination(edge_docs, items).collect()
    assert len(got) == len(EDGE_TEXTS) + 3
    assert {r.doc_id for r in got if r.contaminated} == {7, 9, 10, 14, None}
    long = next(r for r in got if r.doc_id == 7)
    assert (long.n_words, long.n_hit, long["items"]) == (30_000, 30_000, ["2"])
    assert dc.contamination(empty_docs, items).count() == 0
    clean = dc.contamination(edge_docs, bench(spark, [])).collect()
    assert len(clean) == len(EDGE_TEXTS) + 3 and not any(r.contaminated or r["items"] for r in clean)


def test_keep_clean(spark, edge_docs):
    kept = dc.keep_clean(edge_docs, bench(spark, [(1, "same text")]))
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == edge_docs.columns and 9 not in ids and 10 not in ids and ids.count(None) == 2 and 8 in ids
