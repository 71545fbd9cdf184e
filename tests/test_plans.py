"""Physical plan checks: filters reach the scan, no Python evaluation, no cartesian products."""

from __future__ import annotations

import pytest

from caseload import Cohorts, Dataset, Scope
from caseload.plans.batch import extract_all
from caseload.sources.testdata import mapped_dataset

from .conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def partitioned(spark, tmp_path_factory):
    """The test tables written as the production layout: parquet partitioned by fyear."""
    base = tmp_path_factory.mktemp("tables")
    src = mapped_dataset(spark, SF_SMALL)
    for name in ("ip", "ip_activity_avoidance_strategies", "op", "inequalities"):
        src.table(name).write.partitionBy("fyear").parquet(str(base / name))
    return Dataset(spark, str(base))


def test_partition_and_pushed_filters(partitioned):
    df = Cohorts(partitioned, Scope.provider("NATION_3"), 2000).ip()
    plan = _plan(df)
    assert "PartitionFilters: [isnotnull(fyear" in plan and "(fyear#" in plan
    assert "PushedFilters: [IsNotNull(dataset), EqualTo(dataset,NATION_3)]" in plan


def test_semi_join_prunes_cohort_to_key(partitioned):
    df = Cohorts(partitioned, Scope.region("AFRICA"), 2000).strategies("activity_avoidance")
    plan = _plan(df)
    assert "LeftSemi" in plan
    assert "ReadSchema: struct<rn:bigint,icb:string>" in plan  # the cohort side reads two columns


@pytest.mark.parametrize("level", ["provider", "region", "national"])
def test_no_python_no_cartesian(spark, level):
    data = mapped_dataset(spark, SF_SMALL)
    scope = {"provider": Scope.provider("NATION_3"), "region": Scope.region("AFRICA"),
             "national": Scope.national(0.25, 42)}[level]
    c = Cohorts(data, scope, 2000, factor_years=(1999, 2000))
    for name, df in c.extracts().items():
        plan = _plan(df)
        for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert bad not in plan, (name, bad)


def test_batch_uses_one_scan_per_table(spark, partitioned):
    reqs = spark.createDataFrame([("a", "NATION_3", 2000), ("b", "NATION_5", 1999)], "request_id string, code string, fyear int")
    plan = _plan(extract_all(partitioned, reqs, "ip", "provider"))
    assert plan.count("FileScan parquet") == 1
    assert "BroadcastHashJoin" in plan


def test_bucketed_episode_tables_join_without_shuffle(spark, tmp_path):
    """ip and strategies bucketed by rn: the semi join reads co-partitioned sides, no Exchange."""
    from caseload.sources.layout import write_episode_tables

    src = mapped_dataset(spark, SF_SMALL)
    tables = {n: src.table(n) for n in ("ip", "ip_activity_avoidance_strategies")}
    names = write_episode_tables(tables, str(tmp_path / "tables"), buckets=4)
    data = Dataset(spark, tables=names)
    previous = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = Cohorts(data, Scope.region("AFRICA"), 2000).strategies("activity_avoidance")
        plan = _plan(df)
        assert "SortMergeJoin" in plan and "LeftSemi" in plan
        assert "Exchange" not in plan
        want = Cohorts(src, Scope.region("AFRICA"), 2000).strategies("activity_avoidance")
        assert df.count() == want.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", previous)
        for name in names.values():
            spark.sql(f"DROP TABLE IF EXISTS {name}")


@pytest.fixture(scope="module")
def bucketed(spark, tmp_path_factory):
    """Episodes and strategies bucketed by the episode key, and no broadcast but those that are asked for."""
    from caseload.sources.layout import write_episode_tables

    src = mapped_dataset(spark, SF_SMALL)
    tables = {n: src.table(n) for n in ("ip", "ip_activity_avoidance_strategies", "ip_efficiencies_strategies")}
    names = write_episode_tables(tables, str(tmp_path_factory.mktemp("bucketed")), buckets=4)
    previous = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield Dataset(spark, tables=names)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", previous)
    for name in names.values():
        spark.sql(f"DROP TABLE IF EXISTS {name}")


@pytest.mark.parametrize("level", ["provider", "region", "national"])
def test_batch_strategies_on_buckets_join_without_shuffle(spark, bucketed, level):
    from .test_batch import _requests

    src = mapped_dataset(spark, SF_SMALL)
    for kind in ("strategies_activity_avoidance", "strategies_efficiencies"):
        df = extract_all(bucketed, _requests(spark, level), kind, level)
        plan = _plan(df)
        below = plan[plan.index("SortMergeJoin [rn"):]  # both sides of the join on the episode key
        assert below.count("FileScan parquet") == 2 and "Exchange hashpartitioning(rn" not in plan
        shuffles = [line for line in below.splitlines() if "Exchange" in line and "BroadcastExchange" not in line]
        # What is shuffled is the requests alone (their distinct cohorts, or their thresholds), for a broadcast.
        assert all("request" in line or "hashpartitioning(dataset" in line or "hashpartitioning(icb" in line or "hashpartitioning(fyear" in line
                   or "_seed_prefix" in line for line in shuffles), shuffles
        assert df.count() == extract_all(src, _requests(spark, level), kind, level).count() > 0


def test_one_hash_per_row_and_seed(spark):
    from .test_batch import _requests

    df = extract_all(mapped_dataset(spark, SF_SMALL), _requests(spark, "national"), "ip", "national")
    assert _plan(df).count("md5(") == 1
