"""Invariants (SURVEY §5 (3)): totals kept by roll-ups, reshaping round trips, strategies inside
the cohort, samples nested by rate."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from caseload import Cohorts, Scope, sample_rows, sum_factors
from caseload.operators.shape import long_to_wide, wide_to_long
from caseload.sources.testdata import FACTOR_YEARS, mapped_dataset

from .conftest import SF_SMALL, rows


@pytest.fixture(scope="module")
def data(spark):
    return mapped_dataset(spark, SF_SMALL)


def test_region_roll_up_keeps_totals(data):
    op = data.table("op").where("icb = 'AFRICA' AND fyear = 2000")
    want = op.agg(F.sum("attendances"), F.sum("tele_attendances")).first()
    got = Cohorts(data, Scope.region("AFRICA"), 2000).op().agg(F.sum("attendances"), F.sum("tele_attendances")).first()
    assert tuple(got) == tuple(want)


def test_national_roll_up_scales_totals(data):
    src = data.table("aae").where("fyear = 2024").agg(F.sum("arrivals")).first()[0]
    got = Cohorts(data, Scope.national(0.5, 1), 2024).aae().agg(F.sum("arrivals")).first()[0]
    assert got == pytest.approx(src * 0.5)


def test_unpivot_then_pivot_equals_direct_sums(data):
    wide = data.table("demographic_factors").select("variant", "age", "sex", *FACTOR_YEARS)
    direct = sum_factors(wide, ["variant", "age", "sex"], list(FACTOR_YEARS))
    long = wide_to_long(wide, ["variant", "age", "sex"], list(FACTOR_YEARS))
    round_trip = long_to_wide(long, ["variant", "age", "sex"], F.col("value"), years=list(FACTOR_YEARS))
    assert rows(round_trip) == rows(direct)


@pytest.mark.parametrize("scope", [Scope.provider("NATION_3"), Scope.region("AFRICA"), Scope.national(0.25, 42)])
def test_strategies_inside_cohort(data, scope):
    c = Cohorts(data, scope, 2000)
    cohort = {r["rn"] for r in c.ip().select("rn").collect()}
    for df in c.strategies().values():
        assert {r["rn"] for r in df.select("rn").distinct().collect()} <= cohort


def test_hash_samples_are_nested_by_rate(spark):
    df = spark.range(5000).withColumnRenamed("id", "rn")
    small = {r["rn"] for r in sample_rows(df, 0.1, 5).collect()}
    large = {r["rn"] for r in sample_rows(df, 0.4, 5).collect()}
    assert small < large
