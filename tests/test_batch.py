"""``extract_all`` over a request table equals the union of the single-request extracts."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from caseload import Cohorts, Scope
from caseload.plans.batch import KINDS, extract_all
from caseload.sources.testdata import mapped_dataset

from .conftest import SF_SMALL, rows

YEARS = (1999, 2000)
FACTOR_YEARS = (1999, 2000)
REQUESTS = {
    "provider": [("p1", "NATION_3", 2000), ("p2", "NATION_7", 1999), ("p3", "NATION_3", 1999), ("p4", "NATION_3", 2000)],
    "region": [("r1", "AFRICA", 2000), ("r2", "ASIA", 2000), ("r3", "AFRICA", 2024), ("r4", "AFRICA", 2000)],
    "national": [("n1", 2000, 0.25, 42), ("n2", 2000, 0.5, 7), ("n3", 2024, 0.125, 3), ("n4", 2000, 1.0, 7)],
}


def _requests(spark, level):
    if level == "national":
        return spark.createDataFrame(REQUESTS[level], "request_id string, fyear int, sample_rate double, seed long")
    return spark.createDataFrame(REQUESTS[level], "request_id string, code string, fyear int")


def _scope(level, req):
    if level == "provider":
        return Scope.provider(req[1]), req[2]
    if level == "region":
        return Scope.region(req[1]), req[2]
    return Scope.national(req[2], req[3]), req[1]


def _single(data, level, req, kind):
    scope, year = _scope(level, req)
    c = Cohorts(data, scope, year, factor_years=FACTOR_YEARS)
    if kind.startswith("strategies_"):
        return c.strategies(kind[len("strategies_"):])
    return getattr(c, kind)()


@pytest.mark.parametrize("level", ["provider", "region", "national"])
@pytest.mark.parametrize("kind", KINDS)
def test_batch_equals_single(spark, level, kind):
    data = mapped_dataset(spark, SF_SMALL)
    batch = extract_all(data, _requests(spark, level), kind, level, factor_years=FACTOR_YEARS).cache()
    total = 0
    for req in REQUESTS[level]:
        single = _single(data, level, req, kind)
        part = batch.where(F.col("request_id") == req[0]).drop("request_id")
        assert sorted(part.columns) == sorted(single.columns)
        want = rows(single)
        assert rows(part) == want
        total += len(want)
    assert batch.count() == total
    batch.unpersist()


@pytest.mark.parametrize("level", ["provider", "region", "national"])
def test_salted_path_equals_broadcast_path(spark, level):
    """Above the broadcast bound the joins are salted; the rows are the same."""
    data = mapped_dataset(spark, SF_SMALL)
    reqs = _requests(spark, level)
    for kind in ("ip", "op", "demographic_factors", "hsa_activity"):
        small = extract_all(data, reqs, kind, level, factor_years=FACTOR_YEARS)
        salted = extract_all(data, reqs, kind, level, factor_years=FACTOR_YEARS, max_requests=1, salt_buckets=4)
        assert rows(salted) == rows(small)


@pytest.mark.parametrize("kind", ["op", "demographic_factors", "hsa_activity"])
def test_region_batch_aggregates_before_requests(spark, kind):
    """No aggregation carries a request id: requests of one cohort share its totals."""
    data = mapped_dataset(spark, SF_SMALL)
    df = extract_all(data, _requests(spark, "region"), kind, "region", factor_years=FACTOR_YEARS, id_method="window")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    aggregates = [line for line in plan.splitlines() if "Aggregate [" in line]
    assert aggregates and not any("request_id" in line for line in aggregates)
