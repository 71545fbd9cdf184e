"""Token-ID files: ids of whole texts in ascending document order, coded by :mod:`caseload.llm.range_coder`.

Documents are range-partitioned and sorted by id; every partition is a shard. A shard is a run of segments; a segment
holds whole documents (about SEGMENT_IDS ids), the rank table of its ids, the coded blocks of their stream, and the ids
and sizes of its documents. A segment is one row of a Parquet table in the given folder (shard, segment, n_ids, table,
blocks, doc_ids, doc_sizes), so writing is committed by Spark, a lost task is written again, and any segment is read alone.

Null texts count as empty; every document ends with ``end_id``. Rows that repeat a doc_id follow one another, ordered by
text; rows without doc_id come first. An empty table writes no segment and reads as no rows. Other columns of the input are
ignored. A damaged block fails its checksum and raises ValueError.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caseload.llm.range_coder import LANES, decode_blocks, encode_blocks, rank_table
from caseload.llm.tokens import encoder, read_tokenizer, slices
from caseload.llm.worker import map_batches

#: Ids of a block, and of a segment that is cut after the document that reaches this many.
BLOCK_IDS = 2048
SEGMENT_IDS = LANES * BLOCK_IDS

SCHEMA = ("shard int, segment int, n_ids long, table binary, blocks array<binary>, doc_ids array<long>, "
          "doc_sizes array<long>")


def _block_size(ids: int) -> int:
    """Ids of a block: small segments have shorter blocks, so that there are enough of them to code side by side."""
    size = BLOCK_IDS
    while size > 256 and ids < size * LANES // 2:
        size //= 2
    return size


def _segment(shard: int, number: int, docs: list[tuple[int | None, bytes]]) -> pa.RecordBatch:
    ids = np.frombuffer(b"".join(d for _, d in docs), "<u4")
    size = _block_size(len(ids))
    table = rank_table(ids)
    coded = encode_blocks([ids[k:k + size] for k in range(0, len(ids), size)], table)
    longs = pa.list_(pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array([shard], pa.int32()), pa.array([number], pa.int32()), pa.array([len(ids)], pa.int64()),
         pa.array([zlib.compress(table.astype("<u4").tobytes())], pa.binary()), pa.array([coded], pa.list_(pa.binary())),
         pa.array([[i for i, _ in docs]], longs), pa.array([[len(d) // 4 for _, d in docs]], longs)],
        [c.split()[0] for c in SCHEMA.split(", ")])


def _writer(content: str, end_id: int | None, segment_ids: int):
    end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number, held, size = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            for part in slices(batch):
                texts = part.column("text").to_pylist()
                for doc_id, coded in zip(part.column("doc_id").to_pylist(), encoder(content).encode(texts)):
                    held.append((doc_id, coded + end))
                    size += len(coded) // 4 + len(end) // 4
                    if size >= segment_ids:
                        yield _segment(shard, number, held)
                        number, held, size = number + 1, [], 0
        if held:
            yield _segment(shard, number, held)

    return run


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int | None = 0, id_col: str = "doc_id",
                      text_col: str = "text", segment_ids: int = SEGMENT_IDS) -> None:
    """Write the ids of ``docs`` to ``folder`` (a path that executors share)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    map_batches(ordered, _writer(read_tokenizer(tokenizer_path), end_id, segment_ids), SCHEMA).write.parquet(folder)


def _documents(row: dict) -> Iterator[tuple[int | None, int, np.ndarray]]:
    table = np.frombuffer(zlib.decompress(row["table"]), "<u4")
    blocks = decode_blocks(row["blocks"], table)
    ids = np.concatenate(blocks) if blocks else np.zeros(0, np.uint32)
    at = 0
    for doc_id, size in zip(row["doc_ids"], row["doc_sizes"]):
        yield doc_id, at, ids[at:at + size]
        at += size


def _reader(describe, names: list[str], kinds: list[pa.DataType]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                out = [(row["shard"], row["segment"], doc_id, at, *describe(ids)) for doc_id, at, ids in _documents(row)]
                columns = list(zip(*out)) if out else [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    return run


def _decoded(spark: SparkSession, folder: str, describe, more: dict[str, tuple[str, pa.DataType]]) -> DataFrame:
    """Per document: doc_id, start (ids of all documents before it) and what ``describe`` says of its ids."""
    files = spark.read.schema(SCHEMA).parquet(folder)
    names = ["shard", "segment", "doc_id", "at", *more]
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), *(t for _, t in more.values())]
    schema = ", ".join(["shard int, segment int, doc_id long, at long", *(f"{n} {s}" for n, (s, _) in more.items())])
    docs = files.mapInArrow(_reader(describe, names, kinds), schema)
    # Ids before each segment: a running sum inside every shard and one over the shards, of a row each.
    sizes = files.select("shard", "segment", "n_ids")
    shards = sizes.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = Window.partitionBy("shard").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    base = (sizes.withColumn("inside", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)))
            .join(shards.select("shard", before.alias("before")), "shard")
            .select("shard", "segment", (F.col("before") + F.col("inside")).alias("base")))
    return docs.join(base, ["shard", "segment"]).select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), *more)


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document in ``folder``: doc_id, start, ids (array<long>)."""
    return _decoded(spark, folder, lambda ids: (ids.astype(np.int64),), {"ids": ("array<long>", pa.list_(pa.int64()))})


def token_file_digests(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document in ``folder``: doc_id, start, n_tokens, ids_crc32 (of little-endian unsigned 32-bit ids)."""
    return _decoded(spark, folder, lambda ids: (len(ids), zlib.crc32(ids.astype("<u4").tobytes())),
                    {"n_tokens": ("long", pa.int64()), "ids_crc32": ("long", pa.int64())})
