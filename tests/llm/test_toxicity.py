from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from caseload.llm import toxicity as T
from caseload.llm.queries import queries

from .conftest import EDGE_TEXTS, frame, prose

INSULTS = ["zorkqu", "vlimpo", "grubzak", "wexxit"]


def documents(count, seed=0, share=0.3):
    rng, out = random.Random(seed), []
    for k in range(count):
        words = prose(seed * 100_000 + k, 70).split()
        words = [w + rng.choice(["", "", "", ".", ".\n"]) for w in words]
        bad = rng.random() < share
        for _ in range(rng.randint(2, 4) if bad else 0):
            words.insert(rng.randrange(len(words)), rng.choice(INSULTS) + rng.choice(["", "ab", "ed"]))
        out.append((" ".join(words), int(bad)))
    return out


@pytest.fixture(scope="module")
def machine():
    learned = documents(400)
    return T.train([t for t, _ in learned], [y for _, y in learned])


def scores(machine, texts):
    return machine.score(T.Symbols(machine.letters), texts)


def test_held_out_accuracy(machine):
    fresh = documents(400, seed=1)
    said = scores(machine, [t for t, _ in fresh]) >= 0.3
    wrong = sum(bool(s) != bool(y) for s, (_, y) in zip(said, fresh))
    assert wrong <= 4


def test_gaps_and_inserted_letters(machine):
    plain = prose(7_000_000, 40)
    assert scores(machine, [plain])[0] < 0.1
    for insult in INSULTS:
        for disguise in (insult, insult.upper(), ".".join(insult), insult[:3] + "-" + insult[3:], insult[:3] + "x" + insult[3:]):
            assert scores(machine, [f"{plain} {disguise} {plain}"])[0] >= 0.3, disguise


def test_weights_are_the_expansion_over_windows(machine):
    """The value of a window is the sum over its subsequences by definition."""
    symbols = T.Symbols(machine.letters)
    read, _ = symbols.read([prose(3, 30)])
    got = T.window_scores(read, machine.weights, symbols.size)
    table = machine.weights.reshape(symbols.size, symbols.size, symbols.size)
    for place in range(0, len(read), 17):
        value = 0.0
        for i in range(place, min(place + T.WINDOW, len(read))):
            for j in range(i + 1, min(i + T.SPAN, len(read))):
                for k in range(j + 1, min(i + T.SPAN + 1, len(read))):
                    value += T.DECAY ** (k - i + 1) * table[read[i], read[j], read[k]]
        assert got[place] == pytest.approx(value, abs=1e-4)


def test_symbols(machine):
    symbols = T.Symbols("abc")
    read, begins = symbols.read(["aB \t c.a b! ", "", "\n\n", "ж1a"])
    gap = [T.BREAK] * T.WINDOW
    a, b, c = T.FIRST, T.FIRST + 1, T.FIRST + 2
    first = [a, b, T.SPACE, c, a, T.SPACE, b, *gap, *gap]
    assert read.tolist()[:len(first)] == first and begins.tolist()[1] == len(first)
    assert read.tolist()[begins[1]:begins[2]] == gap and read.tolist()[begins[3]:] == [T.OTHER, a, *gap]


def test_long_texts_are_read_whole(machine):
    plain = "\n".join(prose(50 + k, 2_000) for k in range(120))
    assert len(plain) > T.PIECE
    low, early, late = scores(machine, [plain, f"{INSULTS[0]} {plain}", f"{plain} {INSULTS[0]}"])
    assert low < 0.3 <= min(early, late)


def test_sample_is_bounded_and_only_of_the_fold(spark):
    rows = [(i, t) for i, (t, _) in enumerate(documents(60))]
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(documents(60))] + [(3, None), (None, 1), (900, 1), (5, 7)], "doc_id long, toxic int")
    texts, known, shares = T.labelled_sample(frame(spark, rows), labels, F.col("doc_id") % 2 == 0, sample_docs=(10, 4), sample_chars=(2_000, 5_000))
    by_text = {t: (i, y) for (i, t), (_, y) in zip(rows, documents(60))}
    assert all(by_text[t][0] % 2 == 0 and by_text[t][1] == y for t, y in zip(texts, known))
    assert 0 < known.count(0) <= 10 and sum(len(t) for t, y in zip(texts, known) if y == 0) <= 2_000 and 0 < known.count(1) <= 4
    assert sum(shares) == 31  # 30 even ids and one without a document


def test_toxicity_edges(spark, edge_docs, empty_docs):
    learned = documents(200)
    docs = edge_docs.unionByName(frame(spark, [(1_000 + k, t) for k, (t, _) in enumerate(learned)]))
    labels = spark.createDataFrame([(1_000 + k, y, "x") for k, (_, y) in enumerate(learned)] + [(None, 1, "y")], "doc_id long, toxic int, text string")
    got = T.toxicity_scores(docs, labels).where("doc_id < 1000 or doc_id is null").collect()
    assert len(got) == len(EDGE_TEXTS) + 3 and all(0 <= r.score < 0.3 for r in got)
    assert T.toxicity_scores(empty_docs, labels).count() == 0
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in T.toxicity_scores(edge_docs, none).collect()} == {0.0}
    one_kind = spark.createDataFrame([(4, 1), (5, 1)], "doc_id long, toxic int")
    assert {r.score for r in T.toxicity_scores(edge_docs, one_kind).collect()} == {1.0}


def test_query_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    texts = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.lower("text").alias("text"))
    plain = "loser|idiot|pathetic|scum|worthless|moron|trash|clown|disgusting|stupid"
    got = queries()["op11_toxicity"](spark, sf)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = got.where("held_out").join(labels, "doc_id").join(texts.select("doc_id", F.col("text").rlike(plain).alias("plain")), "doc_id").collect()
    said, plain = np.array([r.predicted for r in rows]), np.array([r.plain for r in rows])
    assert said[plain].mean() > 0.97 and said[~plain].mean() < 0.03  # labels themselves have 5 % noise
