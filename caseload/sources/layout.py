"""Storage layout for the input tables at scale.

Extracts filter by financial year and join episodes to strategies on ``rn``. Written partitioned by
``fyear`` (so a year is a partition filter) and, for the episode-keyed tables, bucketed and sorted
by ``rn`` with one bucket count, the strategy semi join reads both sides already co-partitioned and
runs as a sort-merge join with no shuffle on either side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from caseload.sources import dataset as names

# Tables keyed by the episode id.
EPISODE_TABLES = (names.IP, *names.STRATEGY_TABLES.values())
# Target size of a bucket, and Spark's own default limit of buckets (spark.sql.sources.bucketing.maxBuckets).
BUCKET_BYTES = 256 * 1024 * 1024
MAX_BUCKETS = 100_000


def buckets_for(df: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Buckets of about ``bucket_bytes`` by Catalyst's size estimate of ``df`` (file sizes, for a plain scan)."""
    estimate = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().toString())
    return max(1, min(-(-estimate // bucket_bytes), MAX_BUCKETS))


def write_table(
    df: DataFrame,
    name: str,
    path: str,
    partition_by: Sequence[str] = ("fyear",),
    bucket_by: Sequence[str] | None = None,
    buckets: int | None = None,
    mode: str = "overwrite",
    statistics: bool = True,
) -> None:
    """Save ``df`` as a catalog table ``name`` stored at ``path`` (parquet), partitioned by
    ``partition_by`` and, when ``bucket_by`` is given, bucketed (and sorted) into ``buckets``.

    With ``statistics`` the catalog then holds the table's bytes and rows, by which Catalyst decides on broadcasts; without
    them it goes by the size of the compressed files."""
    if bucket_by:
        if not buckets:
            raise ValueError("bucketing needs a bucket count")
        # Tasks get whole buckets (the shuffle's hash is the buckets'): one file per bucket and partition
        # instead of one from every task.
        df = df.repartition(buckets, *bucket_by)
    writer = df.write.mode(mode).format("parquet").option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    writer.saveAsTable(name)
    if statistics:
        df.sparkSession.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS")


def write_episode_tables(tables: dict[str, DataFrame], root: str, database: str | None = None,
                         buckets: int | None = None) -> dict[str, str]:
    """Write the episode-keyed tables bucketed by ``rn`` (same bucket count, by default enough for the
    largest table's estimated bytes) and partitioned by ``fyear``; return the table-name overrides for
    :class:`~caseload.sources.dataset.Dataset`."""
    buckets = buckets or max(buckets_for(tables[name]) for name in EPISODE_TABLES if name in tables)
    out = {}
    for name in EPISODE_TABLES:
        if name not in tables:
            continue
        qualified = f"{database}.{name}" if database else name
        write_table(tables[name], qualified, f"{root.rstrip('/')}/{name}", bucket_by=["rn"], buckets=buckets)
        out[name] = qualified
    return out
