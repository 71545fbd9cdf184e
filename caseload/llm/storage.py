"""Tables that outlive a stage: written to the folder every executor shares, then read again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from caseload.session import ensure_checkpoint_dir

#: Largest number of 64-bit ids that is broadcast (8 MB); more are joined through a shuffle.
BROADCAST_IDS = 1_000_000


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path under the session's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """``df`` written as Parquet to the shared folder, or to ``path``, and read again (its lineage ends there)."""
    path = path or shared_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder of :func:`shared_folder` that nothing reads any more."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def without_ids(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` whose id is not in ``ids`` (one integer column); rows without an id stay.

    ``ids`` is stored once and counted: up to :data:`BROADCAST_IDS` ids are broadcast so that the
    texts do not move, more of them go through a shuffled anti join with the same result.
    """
    ids = stored(ids.toDF("_drop_id").where("_drop_id is not null"), "dropped-ids")
    side = ids.hint("broadcast") if ids.count() <= BROADCAST_IDS else ids.hint("merge")
    return docs.join(side, docs[id_col] == side["_drop_id"], "left_anti")
