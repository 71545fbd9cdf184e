from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from caseload.llm import lm_score as lm

from .conftest import EDGE_TEXTS, frame, prose


def split(text):
    return (text or "").lower().split()


def slow_score(text, counts, frequent, raw):
    """Log-probabilities token by token, in plain loops: that of the class, and the word's share of it."""
    embed, bias, weights, out_bias = lm.Network.load(raw).parameters
    classes = lm.Ids(frequent)
    tokens = Counter()
    for w, n in counts.items():
        tokens[classes[w]] += n
    ids = [0] * lm.SIDE + [classes[w] for w in split(text)] + [0] * lm.SIDE
    total = 0.0
    for i, word in enumerate(split(text), lm.SIDE):
        hidden = bias.astype(float).copy()
        for table, place in zip(embed, [p for p in range(-lm.SIDE, lm.SIDE + 1) if p]):
            hidden += table[ids[i + place]]
        logits = np.tanh(hidden) @ weights + out_bias
        total += logits[ids[i]] - math.log(sum(math.exp(x) for x in logits)) + math.log(counts[word] / tokens[ids[i]])
    return total


@pytest.mark.parametrize("known", [0, 90, lm.KNOWN])
def test_scores_match_a_plain_version(spark, edge_docs, monkeypatch, known):
    texts = [(100 + k, prose(k, 150)) for k in range(8)]
    docs = edge_docs.select("doc_id", "text").union(spark.createDataFrame(texts, "doc_id long, text string"))
    trained, train = [], lm.train
    monkeypatch.setattr(lm, "train", lambda *a: trained.append(train(*a)) or trained[0])
    got = lm.score_documents(docs, rounds=1, stride=2, known=known).collect()
    all_texts = [r.text for r in docs.collect()]
    counts = Counter(w for t in all_texts for w in split(t))
    frequent = lm.Vocabulary.of(lm.word_counts(docs)).frequent
    assert frequent[0] == "word" and len(frequent) == lm.FREQUENT and len(counts) > 500
    want = sorted((len(split(t)), slow_score(t, counts, frequent, trained[0])) for t in all_texts if len(t or "") < 5000)
    have = sorted((r.n_tokens, r.log_likelihood) for r in got if r.n_tokens < 5000)
    assert len(got) == len(all_texts) and [n for n, _ in have] == [n for n, _ in want]
    assert max(abs(a - b) for (_, a), (_, b) in zip(have, want)) < 2e-3


def test_training_prefers_the_corpus_to_noise(spark):
    docs = frame(spark, [(i, "the cat sat on the mat and the dog lay by the door " * 20) for i in range(60)])
    vocabulary = lm.Vocabulary.of(lm.word_counts(docs))
    raw = lm.train(lm.encode(docs, vocabulary), rounds=2, stride=3)
    ids = [lm.Ids(vocabulary.frequent).of(t.split()) for t in ("the cat sat on the mat and the dog", "mat the the dog on cat and the sat")]
    good, bad = lm.class_likelihoods(ids, raw)
    assert good / 9 > bad / 9 + 0.5
    assert good > lm.class_likelihoods(ids, lm.Network.new().dump())[0] + 5


def test_a_second_copy_raises_a_text_above_what_it_was(spark):
    docs = [(i, prose(i, 120)) for i in range(60)]
    once, twice = ({r.doc_id: r.mean_log_likelihood for r in lm.score_documents(frame(spark, rows, 1)).collect()}
                   for rows in (docs, docs + [(1000 + i, docs[i][1]) for i in range(6)]))
    rise = [twice[i] - once[i] for i in range(60)]
    assert min(rise[:6]) > max(rise[6:]) + 0.1


def test_counts_cover_every_document(spark):
    docs = frame(spark, [(i, f"Common rare{i}") for i in range(50)] + [(99, prose(1))])
    counts = lm.word_counts(docs)
    assert lm.Vocabulary.of(counts, frequent=1, known=1).frequent == ["common"]
    assert {r.word: r.n for r in counts.collect()} == Counter(w for r in docs.collect() for w in split(r.text))


def test_lm_edges(edge_docs, empty_docs):
    got = lm.score_documents(edge_docs, rounds=1, stride=2).collect()
    assert len(got) == len(EDGE_TEXTS) + 3
    for r in got:
        assert (r.n_tokens == 0) == (r.log_likelihood == 0.0) == (r.mean_log_likelihood is None)
        assert r.n_tokens == 0 or abs(r.mean_log_likelihood * r.n_tokens - r.log_likelihood) < 1e-6
    assert lm.score_documents(empty_docs).count() == 0


def test_rounds_learn_from_every_token_once(monkeypatch):
    texts = [prose(k, 700 + k) for k in range(5)]
    frequent = sorted(set(" ".join(texts).split()))[:lm.FREQUENT]
    ids = [lm.Ids(frequent).of(split(t)) for t in texts]
    batches = [pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in part])], ["ids"]) for part in (ids[:2], ids[2:])]
    learned = []
    monkeypatch.setattr(lm.Network, "learn", lambda self, ids, at: learned.append(ids[at].copy()))
    assert lm.ROUNDS >= lm.STRIDE
    raw = lm.Network.new().dump()
    for k in range(lm.STRIDE):
        list(lm._trainer(raw, lm.STRIDE, k)(batches))
    own = np.concatenate([x[lm.SIDE:-lm.SIDE] for x in ids])
    assert np.bincount(np.concatenate(learned), minlength=lm.IDS).tolist() == np.bincount(own, minlength=lm.IDS).tolist()
