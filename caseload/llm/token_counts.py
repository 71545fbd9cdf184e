"""Token counts with a digest cache.

The cache is a Parquet table (content digest, tokenizer version digest, n_tokens) in a folder that all executors
share. A call joins the digests of its documents to the cache, encodes one text of every digest that misses,
appends those counts, and joins the documents to the counts. Nothing is counted twice, neither copies inside a
table nor texts of an earlier call; another tokenizer file or library version has other keys.

Texts are normalised by ``normalise`` before the digest (none by default: byte-level counts depend on every byte).
Null texts count as empty (0 tokens). Repeated rows and rows with null doc_id get one result row each. A call that
died after its append left valid counts behind; two calls at once may append a digest twice, and readers take
one. An empty table gives no rows and appends none. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseload.llm.tokens import encoder, read_tokenizer, slices, tokenizer_version
from caseload.llm.worker import map_batches

CACHE_SCHEMA = "digest binary, tokenizer string, n_tokens long"


def read_cache(spark: SparkSession, cache: str) -> DataFrame:
    """The stored counts; an absent or empty folder is an empty cache."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(cache)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return spark.createDataFrame([], CACHE_SCHEMA)
    return spark.read.schema(CACHE_SCHEMA).parquet(cache)


def _counter(content: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                counts = [len(ids) // 4 for ids in encoder(content).encode(part.column("text").to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column("digest"), pa.array(counts, pa.int64())], ["digest", "n_tokens"])

    return run


def count_tokens(docs: DataFrame, tokenizer_path: str, cache: str, id_col: str = "doc_id", text_col: str = "text",
                 normalise: Callable[[Column], Column] = lambda text: text) -> DataFrame:
    """One row per input row: doc_id, n_bytes (UTF-8), n_tokens. ``cache``: folder of the stored counts."""
    content = read_tokenizer(tokenizer_path)
    version = tokenizer_version(content)
    spark = docs.sparkSession
    text = normalise(F.coalesce(F.col(text_col), F.lit("")))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    digest = F.unhex(F.sha2("text", 256))
    known = read_cache(spark, cache).where(F.col("tokenizer") == version).select("digest").distinct()
    distinct = rows.select(digest.alias("digest"), "text").distinct()
    misses = distinct.join(known, "digest", "left_anti")
    counted = map_batches(misses, _counter(content), "digest binary, n_tokens long")
    counted.select("digest", F.lit(version).alias("tokenizer"), "n_tokens").write.mode("append").parquet(cache)
    counts = (read_cache(spark, cache).where(F.col("tokenizer") == version)
              .groupBy("digest").agg(F.min("n_tokens").alias("n_tokens")))
    keyed = rows.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), digest.alias("digest"))
    return keyed.join(counts, "digest").select("doc_id", "n_bytes", "n_tokens")
