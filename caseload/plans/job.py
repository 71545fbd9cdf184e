"""The queue job: requests in, extracts out, all in one Spark application.

``serve_queue`` drains a folder of params files and writes every extract of all new requests with
:func:`extract_all` — one pass over each table for the whole batch instead of one pass per request.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseload.functions.scope import NATION
from caseload.operators.joins import small_side
from caseload.plans.batch import RequestBatch
from caseload.plans.cohorts import FACTOR_IDS
from caseload.sources.dataset import Dataset
from caseload.session import ensure_checkpoint_dir
from caseload.sources.sinks import RUN_PARTITIONS, commit_attempt, write_extracts, write_json
from caseload.streaming.intake import DEFAULT_YEAR_FIELD, drain_queue, quarantined, request_table

AGGREGATE_KINDS = ("op", "aae", "birth_factors", "demographic_factors", "hsa_activity", "inequalities")
ROW_KINDS = ("ip", "strategies_activity_avoidance", "strategies_efficiencies")


def run_requests(
    data: Dataset,
    requests: DataFrame,
    level: str,
    out_path: str,
    *,
    full: bool = False,
    kinds: Sequence[str] | None = None,
    **extract_options,
) -> list[str]:
    """Write the extracts of every request to ``{out_path}/{kind}/attempt=<id>``, partitioned by run, and one gzipped JSON
    document per run (its metadata and whole params) to ``{out_path}/_runs``; then commit the attempt, which makes all kinds
    of all its runs visible to ``read_extracts`` at once. Row-level extracts only when ``full``. Returns the kinds written."""
    kinds = list(kinds) if kinds else [*AGGREGATE_KINDS, *(ROW_KINDS if full else ())]
    runs = small_side(requests.select(
        "request_id", "app_version", F.col("code").alias("run_dataset"), "scenario", "create_datetime"))
    attempt = uuid.uuid4().hex
    schemas = {}
    batch = RequestBatch(data, requests, level, **extract_options)
    # Both strategy tables join the same cohort keys: compute them from one scan of the episodes.
    shared = batch.cohort_keys() if sum(k.startswith("strategies_") for k in kinds) > 1 else None
    if shared is not None:
        shared.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for kind in kinds:
            extract = batch.extract(kind, shared if kind.startswith("strategies_") else None)
            order = FACTOR_IDS if kind.endswith("factors") and level == NATION else None
            rows = extract.join(runs, "request_id")
            schemas[kind] = rows.schema
            write_extracts(rows, f"{out_path}/{kind}/attempt={attempt}", order_by=order)
    finally:
        if shared is not None:
            shared.unpersist()
    write_json(requests.select("params_path", "fyear", "seed", "sample_rate", "metadata", *[c for c in ("params",) if c in requests.columns],
                               *[F.col(c).alias(c) for c in RUN_PARTITIONS if c != "run_dataset"],
                               F.col("code").alias("run_dataset")),
               f"{out_path}/_runs", partition_by=RUN_PARTITIONS)
    commit_attempt(requests, out_path, attempt, schemas)
    return kinds


def serve_queue(
    spark: SparkSession,
    data: Dataset,
    queue_path: str,
    out_path: str,
    ledger: str,
    level: str,
    *,
    quarantine_path: str | None = None,
    year_field: str = DEFAULT_YEAR_FIELD,
    sample_rate: float | None = None,
    full: bool = False,
    clean_source: str | None = None,
    archive_dir: str | None = None,
    **extract_options,
) -> int:
    """Drain the queue once; returns the number of files taken. Files that are not JSON, or lack a needed
    field, go to ``quarantine_path`` (default ``{out_path}/_quarantine``) with the reason, one partition per
    request. A batch replayed after a failure (same file versions, same ids and stamps) is a new attempt at the same
    requests and takes the place of what it finds."""
    ensure_checkpoint_dir(spark)  # before anything is written

    def handle(raw: DataFrame) -> None:
        (quarantined(raw, level, year_field)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("request_id").parquet(quarantine_path or f"{out_path}/_quarantine"))
        requests = request_table(raw, level=level, year_field=year_field, sample_rate=sample_rate, stamp_from=F.col("taken_at"))
        if requests.isEmpty():
            return
        run_requests(data, requests, level, out_path, full=full, **extract_options)

    return drain_queue(spark, queue_path, ledger, handle, clean_source=clean_source, archive_dir=archive_dir)
