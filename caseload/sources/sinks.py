"""Result sinks (SNK2-SNK4): partitioned parquet and gzipped JSON, written by the executors.

A run is several tables that must appear together. Each attempt at a set of runs writes to folders of its own
(``{out}/{kind}/attempt=<id>/...``) and becomes visible by one row per request in ``{out}/_manifest``, written last.
:func:`read_extracts` shows every request's last committed attempt: never some kinds of an attempt without the others,
never rows of an earlier attempt where the later one has none.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Fixed layout of a run's output: version / dataset / scenario / stamp, and the request, so that runs with
# the same labels and second do not replace each other.
RUN_PARTITIONS = ("app_version", "run_dataset", "scenario", "create_datetime", "request_id")


def write_extracts(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = RUN_PARTITIONS,
    order_by: Sequence[str] | None = None,
    rebalance: bool = True,
) -> None:
    """Write ``df`` as parquet partitioned by the run columns, replacing only the partitions the
    data touches (dynamic overwrite), so re-running one request rewrites its own folder and leaves
    the others. A rerun after a failure overwrites the partial output of the failed attempt.

    ``order_by`` deals the rows out in ranges of the run columns and these, and sorts each: read in the order of
    their names, a run's files hold its rows in order, however many files it takes (SRT1 at the sink).

    ``rebalance`` clusters rows by the run columns before writing (few files per run instead of one
    per task and run) while AQE splits a run that is too large for one writer and merges small ones.
    """
    if order_by:
        lead = [*partition_by, *order_by]
        writer_df = df.repartitionByRange(*lead).sortWithinPartitions(*lead)
    else:
        writer_df = rebalanced(df, partition_by) if rebalance else df
    (writer_df.write
     .mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by)
     .parquet(path))


def rebalanced(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` with a rebalance hint on ``columns`` (AQE sizes the resulting partitions)."""
    return df.hint("rebalance", *columns) if columns else df


MANIFEST_SCHEMA = "request_id string, attempt string, sequence long, committed_at timestamp, kinds map<string,string>"


def manifest(spark: SparkSession, out_path: str) -> DataFrame:
    """The committed attempts: a row per request and attempt, with the schema (JSON) of each kind that it wrote."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{out_path}/_manifest")
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return spark.read.schema(MANIFEST_SCHEMA).parquet(f"{out_path}/_manifest")


def commit_attempt(requests: DataFrame, out_path: str, attempt: str, schemas: Mapping[str, StructType]) -> None:
    """Make what ``attempt`` wrote for ``requests`` (request_id) visible, all kinds at once: one file, written last."""
    spark = requests.sparkSession
    sequence = (manifest(spark, out_path).agg(F.max("sequence")).first()[0] or 0) + 1
    kinds = F.create_map(*[F.lit(x) for kind, schema in schemas.items() for x in (kind, schema.json())])
    (requests.select("request_id", F.lit(attempt).alias("attempt"), F.lit(sequence).cast("long").alias("sequence"),
                     F.current_timestamp().alias("committed_at"), kinds.alias("kinds"))
     .coalesce(1).write.mode("append").parquet(f"{out_path}/_manifest"))


def read_extracts(spark: SparkSession, out_path: str, kind: str) -> DataFrame:
    """The rows of ``kind`` that the last committed attempt of each request wrote. A request whose last attempt did not
    include the kind has none."""
    last = manifest(spark, out_path).groupBy("request_id").agg(F.max_by(F.struct("attempt", "kinds"), "sequence").alias("last"))
    last = last.where(F.col("last.kinds")[kind].isNotNull()).select("request_id", F.col("last.attempt").alias("attempt"),
                                                                   F.col("last.kinds")[kind].alias("schema"))
    newest = manifest(spark, out_path).where(F.col("kinds")[kind].isNotNull()).agg(F.max_by(F.col("kinds")[kind], "sequence")).first()[0]
    if newest is None:
        raise ValueError(f"no committed attempt at {kind!r}")
    # Attempt and request are partition columns: the join prunes the folders that are read.
    schema = StructType.fromJson(json.loads(newest)).add("attempt", "string")
    rows = spark.read.schema(schema).option("mergeSchema", "true").parquet(f"{out_path}/{kind}")
    return rows.join(last.select("request_id", "attempt"), ["request_id", "attempt"], "left_semi").drop("attempt")


def drop_superseded(spark: SparkSession, out_path: str) -> list[str]:
    """Remove the folders of committed attempts that are no request's last; returns their ids. Attempts without a manifest row (running,
    or dead) stay."""
    rows = manifest(spark, out_path)
    last = rows.groupBy("request_id").agg(F.max_by("attempt", "sequence").alias("attempt")).select("attempt")
    old = rows.join(last, "attempt", "left_anti").select("attempt", F.explode(F.map_keys("kinds")).alias("kind")).distinct()
    gone = set()
    for row in old.toLocalIterator():
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{out_path}/{row['kind']}/attempt={row['attempt']}")
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
        gone.add(row["attempt"])
    return sorted(gone)


def write_json(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Gzipped JSON, a line per row. Partitioned by columns that name each row, every row is a document of its own."""
    writer = df.write.mode("overwrite").option("compression", "gzip")
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    writer.json(path)
