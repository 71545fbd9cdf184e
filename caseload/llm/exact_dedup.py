"""Exact de-duplication: rows with the same text form a group and one of them stays.

Texts are grouped by a 128-bit content hash together with the bytes themselves, so two texts that
only share the hash never meet in a group. The grouping is a partial aggregation: the copies inside an
input partition collapse to one row before the shuffle, whatever the size of the group. Rows look up
their group by the hash and SHA-256, which are short; a group with a large share of the rows is a skewed
join key that adaptive execution splits.

Null texts count as empty. Rows that repeat a doc_id are one document: they stay or go together. A
group whose rows all lack an id has no keep_id and all its rows are kept. An empty table gives no rows.
Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseload.llm.storage import without_ids


def hash128(text: Column) -> Column:
    """128-bit content hash as 16 bytes."""
    return F.unhex(F.md5(text.cast("binary")))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest",
                     content_hash: Callable[[Column], Column] = hash128) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    ``keep`` names the row of a group that stays: the ``smallest`` or ``largest`` id.
    """
    choose = {"smallest": F.min, "largest": F.max}[keep]
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    groups = (rows.groupBy(content_hash(F.col("text")).alias("h"), "text")
              .agg(choose("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
              .where("group_size > 1")
              .select("h", F.unhex(F.sha2("text", 256)).alias("sha"), "keep_id", "group_size"))
    # Different texts under one (hash, SHA-256) pair could not be told apart below: fail, do not merge them.
    groups = (groups.groupBy("h", "sha")
              .agg(F.first("keep_id").alias("keep_id"), F.first("group_size").alias("group_size"),
                   F.count("*").alias("texts"))
              .withColumn("group_size", F.when(F.col("texts") == 1, F.col("group_size"))
                          .otherwise(F.raise_error(F.lit("two texts share both content hashes")).cast("long"))))
    keyed = rows.select("doc_id", content_hash(F.col("text")).alias("h"), F.unhex(F.sha2("text", 256)).alias("sha"))
    keep_id = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return keyed.join(groups, ["h", "sha"], "left").select(
        "doc_id", keep_id.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep_id).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    decided = exact_duplicates(docs, **options)
    return without_ids(docs, decided.where("not kept").select("doc_id").distinct(), options.get("id_col", "doc_id"))
