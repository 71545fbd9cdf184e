from __future__ import annotations

import random
import zlib

import pytest
from pyspark.sql import functions as F

from caseload.llm import language_id as li

from .conftest import EDGE_TEXTS, frame

LANGS = {"xa": "la lo le mi ma ro ra ti ta".split(), "xb": "sch ung heit kei ver ber zu der und".split(), "xc": "the ing tion ed er on ou ea sh".split()}


def text(lang, seed, words=120):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(LANGS[lang]) for _ in range(rng.randint(1, 4))) for _ in range(words)).capitalize() + "."


def slow_phrases(text, learned):
    count = 0
    for k in range(0, len(text), li.LANE):
        lane, i = text[k:k + li.LANE], 0
        while i < len(lane):
            j = i + 1
            while j <= len(lane) and lane[i:j] in learned:
                j += 1
            i, count = max(i + 1, j - 1), count + 1
    return count


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(i, text(lang, i), lang if i % 5 else None) for i, lang in enumerate(list(LANGS) * 60)]
    return frame(spark, rows), {i: lang for i, lang in enumerate(list(LANGS) * 60)}


def test_phrases_match_a_plain_parse():
    samples = {lang: li.normalised(text(lang, 1, 400)) for lang in LANGS}
    parser = li.CrossParser(samples)
    texts = [li.normalised(text(lang, s, n)) for lang in LANGS for s, n in ((5, 3), (6, 700))] + ["ж", "laжlo", "zzzz", "a"]
    got = parser.phrases(texts)
    for i, t in enumerate(texts):
        for j, lang in enumerate(parser.languages):
            learned = samples[lang][:len(samples[lang]) - int(len(samples[lang]) * li.HELD_BACK)]
            assert got[i, j] == slow_phrases(t, learned)


def test_held_out_accuracy(labelled):
    docs, truth = labelled
    got = li.identify_languages(docs, learn_from=~li.held_out_fold()).collect()
    held = [r for r in got if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert len(held) > 20 and sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) >= 0.98
    assert all(0 <= r.score <= 1 for r in got)


def test_labels_of_the_held_out_fold_are_not_used(spark, labelled):
    docs, _ = labelled
    wrong = docs.withColumn("lang", F.when(li.held_out_fold(), F.lit("xa")).otherwise(F.col("lang")))
    pick = lambda d: {(r.doc_id, r.lang_pred) for r in li.identify_languages(d, learn_from=~li.held_out_fold()).collect()}
    assert pick(docs) == pick(wrong)


def test_fold(spark):
    got = spark.createDataFrame([(i,) for i in (0, 1, 77, 123456789, None)], "doc_id long").select("doc_id", li.held_out_fold().alias("h"))
    for r in got.collect():
        assert r.h == (zlib.crc32(b"" if r.doc_id is None else str(r.doc_id).encode()) % 4 == 2)


def test_language_edges(spark, edge_docs, empty_docs, labelled):
    samples = li.labelled_sample(labelled[0])
    assert set(samples) == set(LANGS) and all(len(s) <= li.SAMPLE_CHARS for s in samples.values())
    texts = [r.text for r in edge_docs.collect()]
    for t, lang, score in zip(texts, *li.CrossParser(samples).predict(texts)):
        letters = any(c.isalpha() for c in t or "")
        assert (lang == "und") == (not letters) and (letters or score == 0)
    # nothing to learn from: everything is unknown
    got = li.identify_languages(edge_docs).collect()
    assert len(got) == len(EDGE_TEXTS) + 3 and {(r.lang_pred, r.score) for r in got} == {("und", 0.0)}
    assert li.identify_languages(empty_docs).count() == 0
    assert li.keep_identified(edge_docs).count() == 0


def test_keep_identified(spark, labelled):
    docs = labelled[0].union(frame(spark, [(9000, None, "xa"), (9001, "12 34", "xa"), (9002, text("xb", 77), None)]))
    kept = li.keep_identified(docs)
    ids = {r.doc_id for r in kept.collect()}
    assert kept.columns == docs.columns and ids == set(range(180)) | {9002}


def test_every_label_is_learned_from_whole_texts(spark):
    rows = [(i, f"{text('xa', i, 20)} l{chr(97 + i // 26)}{chr(97 + i % 26)}", f"lang{i:02d}") for i in range(70)]
    rows += [(100 + i, "head " * 2000 + text("xb", i, 4000), "long") for i in range(3)]
    samples = li.labelled_sample(frame(spark, rows))
    assert len(samples) == 71 and len(samples["long"]) > 0.95 * li.SAMPLE_CHARS
    assert samples["long"].count("head") < 0.5 * len(samples["long"].split())
    parser = li.CrossParser({lang: samples[lang] for lang in sorted(samples)})
    assert len(parser.tables) == 71
    assert parser.predict([text("xb", 77, 300)])[0] == ["long"]
