"""From documents to training sequences: language, exact copies, near copies, benchmark passages, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of the
documents they keep. ``run`` writes each stage's result as Parquet to the shared folder and hands what it reads
back to the next stage, so a stage never repeats an earlier one's work after losing executors.

Rows without text, with a text without letters, or in which no language stands out, go in the first stage; without labelled
documents no language is known, and all go. Rows without doc_id cannot be named by a stage's decision and pass the three
that drop by id. Empty documents give an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from caseload.llm import decontaminate, exact_dedup, language_id, packing, simhash
from caseload.llm.storage import stored


#: Least score of a document's language. Chance is one over the number of languages, a quarter here; of the labelled documents of the
#: 0.1 test tables whose language is found, 99.9 in 100 score above 0.84, and text that repeats one made-up word about 0.3.
MIN_LANGUAGE_SCORE = 0.3


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised."""
    return language_id.keep_identified(docs, learn_from=~language_id.held_out_fold(), min_score=MIN_LANGUAGE_SCORE)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with one text, that with the largest id."""
    return exact_dedup.keep_one(docs, keep="largest")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that SimHash links, that with the smallest id."""
    return simhash.keep_first(docs)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("simhash", drop_near_copies),
    ("decontamination", drop_benchmark_passages),
    ("packing", pack_sequences),
]

#: The first and the last two stages cannot be said in SQL; tests compare run() with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the documents in ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
