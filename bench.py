"""Bench: time every extract at $BENCH_SF_DIR on local[$BENCH_CPUS]; print one JSON line.

Steps
  1. ``prepare``: derive the reference-shaped tables from the test tables and write them once as
     parquet partitioned by ``fyear`` (the layout the extracts are designed for), into a scratch
     folder under the session's checkpoint folder's parent (or $BENCH_WORK_DIR).
  2. Each extract of each level runs to completion through Spark's ``noop`` sink (the full plan
     executes; nothing is collected).
  3. ``batch_<level>_<kind>``: every request of a request table in one plan (``extract_all``),
     against ``loop_<level>_<kind>``: the same requests one at a time.

Each extract and batch runs twice: ``cold`` has the first run (JVM code generation and class
loading included), ``queries`` the second. ``value`` is the sum of the second runs of steps 2 and 3
(not the one-off prepare, not the per-request loops, which run once); ``cold_total_sec`` is the sum
of the first runs.
``shuffle_bytes`` gives the shuffle bytes each query wrote, from Spark's event log (written to the
scratch folder).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from caseload import Cohorts, Dataset, Scope  # noqa: E402
from caseload.plans.batch import extract_all  # noqa: E402
from caseload.session import spark_session  # noqa: E402
from caseload.sources import dataset as names  # noqa: E402
from caseload.sources.testdata import mapped_dataset, raw  # noqa: E402

PARTITIONED = (names.IP, *names.STRATEGY_TABLES.values(), names.OP, names.AAE, names.BIRTH_FACTORS,
               names.DEMOGRAPHIC_FACTORS, names.HSA_ACTIVITY, names.INEQUALITIES, names.HSA_ACTIVITY_REGION)
UNPARTITIONED = (names.BIRTHS, names.DEMOGRAPHICS, names.CATCHMENTS)
YEAR, AAE_YEAR = 2000, 2024
EXTRACTS = ("ip", "strategies_activity_avoidance", "strategies_efficiencies", "op", "aae", "birth_factors",
            "demographic_factors", "hsa_activity", "inequalities")


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn, name: str | None = None) -> float:
    if name:
        # jobs of this query carry its name in the event log (shuffle bytes per query)
        SparkSession.getActiveSession().sparkContext.setJobGroup(name, name)
    t0 = time.perf_counter()
    fn()
    return round(time.perf_counter() - t0, 3)


COLD: dict[str, float] = {}


def twice(fn, name: str) -> float:
    """Run ``fn`` cold (first run: JVM code generation and class loading included; recorded in
    ``COLD``), then again; return the second (warm) time. Shuffle bytes are those of the first run."""
    COLD[name] = timed(fn, name)
    return timed(fn, f"{name}#warm")


def shuffle_bytes(log_dir: str) -> dict[str, int]:
    """Shuffle bytes written per job group, read from the Spark event log in ``log_dir``."""
    stage_group: dict[int, str] = {}
    written: dict[str, int] = {}
    for path in Path(log_dir).rglob("*"):
        if not path.is_file() or path.name.startswith((".", "appstatus")):
            continue
        with open(path) as lines:
            for line in lines:
                event = json.loads(line)
                kind = event.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (event.get("Properties") or {}).get("spark.jobGroup.id")
                    for stage in event.get("Stage IDs", []):
                        stage_group[stage] = group
                elif kind == "SparkListenerTaskEnd":
                    group = stage_group.get(event.get("Stage ID"))
                    metrics = (event.get("Task Metrics") or {}).get("Shuffle Write Metrics") or {}
                    if group:
                        written[group] = written.get(group, 0) + int(metrics.get("Shuffle Bytes Written", 0))
    return written


def prepare(spark, sf_dir: str, work: str) -> Dataset:
    src = mapped_dataset(spark, sf_dir)
    for name in PARTITIONED:
        src.table(name).write.mode("overwrite").partitionBy("fyear").parquet(f"{work}/{name}")
    for name in UNPARTITIONED:
        src.table(name).write.mode("overwrite").parquet(f"{work}/{name}")
    return Dataset(spark, work, {names.HSA_ACTIVITY_NATIONAL: f"{work}/{names.HSA_ACTIVITY_REGION}"})


def extract(c: Cohorts, kind: str) -> DataFrame:
    if kind.startswith("strategies_"):
        return c.strategies(kind[len("strategies_"):])
    return getattr(c, kind)()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    root = os.environ.get("BENCH_WORK_DIR") or tempfile.mkdtemp(prefix="caseload-bench-", dir="/tmp")
    work = tempfile.mkdtemp(prefix="layout-", dir=root)
    events = tempfile.mkdtemp(prefix="events-", dir=root)
    spark = spark_session(f"local[{cpus}]", cpus * 2, app_name="caseload-bench", driver_memory="16g",
                          extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": events,
                                 "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false"})

    times: dict[str, float] = {}
    prep = {}
    times_prepare = timed(lambda: prep.setdefault("data", prepare(spark, sf_dir, work)))
    data = prep["data"]
    region = raw(spark, sf_dir, "region").agg(F.min("r_name")).first()[0]
    scopes = {"provider": Scope.provider("NATION_3"), "region": Scope.region(region),
              "national": Scope.national(0.25, 42)}

    # warm-up (JIT, file listing caches): not timed
    run(Cohorts(data, scopes["provider"], YEAR).ip())

    for level, scope in scopes.items():
        for kind in EXTRACTS:
            year = AAE_YEAR if kind == "aae" else YEAR
            c = Cohorts(data, scope, year)
            times[f"{level}_{kind}"] = twice(lambda c=c, kind=kind: run(extract(c, kind)), f"{level}_{kind}")

    # one plan for many requests against one plan per request; request tables derived by Spark
    # from the nation and region tables (every provider and every region for two years; one
    # national request per region with its own rate and seed)
    years = F.array(F.lit(1999), F.lit(2000))
    req_df = (raw(spark, sf_dir, "nation").select(F.col("n_name").alias("code"), F.explode(years).alias("fyear"))
              .select(F.concat_ws("-", "code", F.col("fyear").cast("string")).alias("request_id"), "code", "fyear"))
    provider_reqs = [tuple(r) for r in req_df.collect()]
    nat_df = raw(spark, sf_dir, "region").select(
        F.concat(F.lit("n"), F.col("r_regionkey").cast("string")).alias("request_id"),
        F.when(F.col("r_regionkey") % 2 == 0, F.lit(2000)).otherwise(F.lit(1999)).alias("fyear"),
        ((F.col("r_regionkey") + 1) / 20.0).alias("sample_rate"),
        F.col("r_regionkey").cast("long").alias("seed"))
    national_reqs = [tuple(r) for r in nat_df.collect()]
    # (each loop runs before its batch, so the batch is not charged the JVM warm-up)
    for kind in ("ip", "op", "strategies_activity_avoidance"):
        times[f"loop_provider_{kind}"] = timed(lambda kind=kind: [
            run(extract(Cohorts(data, Scope.provider(code), y), kind)) for _, code, y in provider_reqs],
            f"loop_provider_{kind}")
        times[f"batch_provider_{kind}"] = twice(lambda kind=kind: run(extract_all(data, req_df, kind, "provider")),
                                                f"batch_provider_{kind}")
    region_df = (raw(spark, sf_dir, "region").select(F.col("r_name").alias("code"), F.explode(years).alias("fyear"))
                 .select(F.concat_ws("-", "code", F.col("fyear").cast("string")).alias("request_id"), "code", "fyear"))
    region_reqs = [tuple(r) for r in region_df.collect()]
    times["loop_region_op"] = timed(lambda: [
        run(extract(Cohorts(data, Scope.region(code), y), "op")) for _, code, y in region_reqs], "loop_region_op")
    times["batch_region_op"] = twice(lambda: run(extract_all(data, region_df, "op", "region")), "batch_region_op")
    for kind in ("ip", "op"):
        times[f"loop_national_{kind}"] = timed(lambda kind=kind: [
            run(extract(Cohorts(data, Scope.national(rate, seed), y), kind)) for _, y, rate, seed in national_reqs],
            f"loop_national_{kind}")
        times[f"batch_national_{kind}"] = twice(lambda kind=kind: run(extract_all(data, nat_df, kind, "national")),
                                                f"batch_national_{kind}")

    spark.stop()
    try:
        shuffled = shuffle_bytes(events)
        shuffled = {k: shuffled.get(k, 0) for k in times}
    except (OSError, ValueError):
        shuffled = {}
    single = {k: v for k, v in times.items() if not k.startswith("loop_")}
    print(json.dumps({
        "metric": "extracts_total_sec",
        "value": round(sum(single.values()), 3),
        "unit": "sec",
        "queries": times,
        "cold_total_sec": round(sum(COLD.values()), 3),
        "cold": COLD,
        "shuffle_bytes": shuffled,
        "prepare_sec": times_prepare,
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
