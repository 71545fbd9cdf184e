from __future__ import annotations

import random

import pytest

#: Columns whose names the operators use inside.
CLASHING = "_drop string, places string, c1 string, fp long, h string, key long, n string, word string, _drop_id long, kept string, line string, id long, start long"
SCHEMA = f"doc_id long, text string, lang string, {CLASHING}"


def frame(spark, rows, partitions=3):
    """A documents table from (doc_id, text[, lang]) rows, with columns of clashing names."""
    full = [(*r, *([None] * (3 - len(r))), "d", "p", "c", 1, "x", 2, "y", "z", 3, "k", "l", 4, 5) for r in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(partitions) if full else spark.createDataFrame([], SCHEMA)


EDGE_TEXTS = [None, "", " ", "\n", "a", "!!!", "A b", "word " * 30_000, "é ü ß", "same text here", "same text here",
              "zero\x00byte   odd", "<|endoftext|>", "x\n\n\ny", "😀 😀 😀 😀 😀 😀", "½ ²"]


@pytest.fixture(scope="session")
def edge_docs(spark):
    rows = [(i, t) for i, t in enumerate(EDGE_TEXTS)]
    rows += [(9, "same text here"), (None, "same text here"), (None, None)]
    return frame(spark, rows)


@pytest.fixture(scope="session")
def empty_docs(spark):
    return frame(spark, [])


def prose(seed: int, words: int = 60) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice("the of and to in on with for from by".split()) if rng.random() < 0.3 else
                    "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(words))
