"""Serve a whole table of requests in one pass over the data (BAT1).

A request row names a cohort and a year: ``request_id``, ``fyear`` and ``code`` (provider or
region code) or, for national requests, ``sample_rate`` and ``seed``. Each extract joins the data
once to the request table instead of rescanning it per request. The request table is broadcast
only after a bounded count proves it small; otherwise the join is a shuffle join.

Where requests share data (region and national activity, factors and health-status tables), it is
aggregated once per distinct cohort, or per year for the nation, and only the aggregated rows meet
the requests. Every output row carries its ``request_id``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseload.functions.rows import dense_id, sampled_requests, stable_id, threshold_index
from caseload.functions.scope import (
    NATION,
    PROVIDER,
    REGION,
    Scope,
    collapse,
    exclude_prefix,
    fyear_code,
    fyear_code_col,
    relabel,
)
from caseload.operators.joins import DEFAULT_BROADCAST_BYTES, DEFAULT_BROADCAST_ROWS, small_side, value_bytes
from caseload.operators.measure import mean_by, roll_up, sum_factors
from caseload.operators.shape import keys_except, long_to_wide, year_columns
from caseload.plans.cohorts import (
    AAE_MEASURES,
    BIRTHS_SEX,
    DEFAULT_PROJECTION_YEAR,
    FACTOR_IDS,
    HSA_KEYS,
    NATIONAL_OP_COLLAPSE,
    OP_MEASURES,
    ROW_INDEX,
)
from caseload.sources import dataset as names
from caseload.sources.dataset import Dataset

KINDS = ("ip", "strategies_activity_avoidance", "strategies_efficiencies", "op", "aae", "birth_factors",
         "demographic_factors", "hsa_activity", "inequalities")
_SCOPE_COLUMN = {PROVIDER: "dataset", REGION: "icb"}
NATIONAL_REQUEST_COLUMNS = ("sample_rate", "seed")
# Scope objects only used for their level in relabel().
_LEVEL_SCOPE = {PROVIDER: Scope.provider("-"), REGION: Scope.region("-"), NATION: Scope.national()}


def _beside(one: Column, other: Column) -> Column:
    """Equality that is tested on the rows of a join and does not become one of its keys."""
    return F.array_contains(F.array(other), one)


class RequestBatch:
    """The extracts of every request in a request table, one plan per extract kind.

    Built once per request table (one bounded probe of it), then :meth:`extract` per kind.
    """

    def __init__(self, data: Dataset, requests: DataFrame, level: str, *, keys: Sequence[str] = ("rn",),
                 projection_year: int = DEFAULT_PROJECTION_YEAR, factor_years: Sequence | None = None,
                 id_method: str = "auto", max_requests: int = DEFAULT_BROADCAST_ROWS,
                 salt_buckets: int | None = None):
        if level not in (PROVIDER, REGION, NATION):
            raise ValueError(f"unknown level {level!r}")
        self.data = data
        self.level = level
        self.keys = list(keys)
        self.projection_year = projection_year
        self.factor_years = factor_years
        self.id_method = id_method
        cols = ["request_id", "fyear"] + (["sample_rate", "seed"] if level == NATION else ["code"])
        req = requests.select(*cols)
        if level == NATION and len(self.keys) != 1:
            raise ValueError("hash sampling needs a single episode key")
        # One bounded job: at most max_requests + 1 rows are counted and their distinct years kept.
        seen = req.limit(max_requests + 1)
        probe = seen.agg(F.count(F.lit(1)).alias("n"), value_bytes(seen).alias("bytes"), F.collect_set("fyear").alias("years")).first()
        small = probe["n"] <= max_requests and probe["bytes"] <= DEFAULT_BROADCAST_BYTES
        self.small = small
        self.salt_buckets = salt_buckets or int(requests.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        self.requests = F.broadcast(req) if small else req
        # The requested years as literals reach the scan as partition filters (the join alone gets no
        # dynamic pruning from a request table). They are as few as the calendar has years.
        years = probe["years"] if small else [r[0] for r in req.select("fyear").distinct().collect()]
        self.years = sorted(y for y in years if y is not None)

    # ---- helpers -------------------------------------------------------------------------------------
    def _req(self, code_as: str | None = None, year_expr=None) -> DataFrame:
        """Request columns renamed to the data's column names for a USING join."""
        cols = [F.col("request_id"), (year_expr if year_expr is not None else F.col("fyear")).alias("fyear")]
        if self.level == NATION:
            cols += [F.col(c) for c in NATIONAL_REQUEST_COLUMNS]
        elif code_as:
            cols.append(F.col("code").alias(code_as))
        return self.requests.select(*cols)

    def _cohorts(self, code_as: str, year_expr=None) -> DataFrame:
        """The distinct cohorts (code and year) that the requests ask for."""
        cohorts = self._req(code_as, year_expr).drop("request_id").distinct()
        return F.broadcast(cohorts) if self.small else cohorts

    def _in_years(self, table: DataFrame, coded: bool = False) -> DataFrame:
        """Rows of the requested years: a static filter (a partition filter on fyear-partitioned tables)."""
        return table.filter(F.col("fyear").isin([fyear_code(y) for y in self.years] if coded else self.years))

    def _scoped(self, table: DataFrame, year_expr=None, cohorts: bool = False) -> DataFrame:
        """Join ``table`` to its requests on (scope column, fyear) or fyear alone; with ``cohorts``, to the
        distinct cohorts, so that no row is repeated for several requests of one cohort."""
        table = self._in_years(table, coded=year_expr is not None)
        code_as = _SCOPE_COLUMN.get(self.level)
        on = [code_as, "fyear"] if code_as else ["fyear"]
        req = self._cohorts(code_as, year_expr) if cohorts else self._req(code_as, year_expr)
        return self._spread(table, req, on)

    def _spread(self, many: DataFrame, few: DataFrame, on: list[str]) -> DataFrame:
        """Inner join of ``many`` rows to ``few``. When the request table is too large to broadcast, a join on
        (code, year) or year alone would send all rows of a large provider, or of a whole year, to one
        task: each of the many rows gets one of ``salt_buckets`` salts (one per shuffle partition) from a
        hash of its values and each of the few is repeated per salt."""
        if self.small:
            return many.join(few, on)
        salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in many.columns]), F.lit(self.salt_buckets))
        salted = few.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(self.salt_buckets - 1))))
        return many.withColumn("_salt", salt).join(salted, [*on, "_salt"]).drop("_salt")

    def _per_request(self, totals: DataFrame, on: list[str], code_as: str | None = None, year_expr=None) -> DataFrame:
        """Cohort totals with the id of every request that asks for the cohort. Many requests may ask for one
        cohort or year, so the requests are the side that is dealt out by salt."""
        return self._spread(self._req(code_as, year_expr), totals, on)

    def _relabel(self, df: DataFrame, include_icb: bool = False) -> DataFrame:
        code = F.col("icb") if self.level == REGION else None
        return relabel(df, _LEVEL_SCOPE[self.level], include_icb=include_icb, code=code)

    def _sampled(self, table: DataFrame) -> DataFrame:
        """Rows of the requested years that a national request samples, with ``_requests``, the ids of those that do: one row
        per seed that keeps it. The years' seeds and thresholds meet the rows, not the requests."""
        table = self._in_years(table)
        index = threshold_index(self.requests, ["fyear"], 1 if self.small else self.salt_buckets)
        index = F.broadcast(index) if self.small else index
        return sampled_requests(self._spread(table, index, ["fyear"]), self.keys[0])

    # ---- extracts ------------------------------------------------------------------------------------
    def ip(self) -> DataFrame:
        if self.level == NATION:
            rows = self._sampled(self.data.table(names.IP)).withColumn("request_id", F.explode("_requests"))
            return self._relabel(rows.drop("_requests"))
        return self._relabel(self._scoped(self.data.table(names.IP)))

    def strategies(self, kind: str, cohort: DataFrame | None = None) -> DataFrame:
        """Strategy rows of the requests' episodes: the same rows as a semi join per request.

        Shuffled, if at all, on the episode key alone: tables bucketed by it meet without a shuffle on either side. Years
        and codes are compared beside the join, and requests are added to what it leaves."""
        keys = cohort if cohort is not None else self.cohort_keys()
        table = self.data.table(names.STRATEGY_TABLES[kind])
        rows = self._sampled(table) if self.level == NATION else self._in_years(table)
        rows = rows.join(keys, self.keys).where(_beside(F.col("fyear"), F.col("_fyear"))).drop("_fyear")
        if self.level == NATION:  # the sample is a function of the key: it has pruned the strategies before the join
            return rows.withColumn("request_id", F.explode("_requests")).drop("_requests")
        if self.level == PROVIDER:  # strategies name their provider
            rows = rows.where(_beside(F.col("dataset"), F.col("_code"))).drop("_code")
            return self._spread(rows, self._req("dataset"), ["dataset", "fyear"])
        return self._spread(rows, self._req("_code"), ["_code", "fyear"]).drop("_code")

    def cohort_keys(self) -> DataFrame:
        """The distinct episode keys of the requested cohorts, with the cohorts they are in (``_fyear`` and, below the nation,
        ``_code``). Persist it to serve both strategy tables from one scan of the episodes."""
        episodes = self.data.table(names.IP)
        code = _SCOPE_COLUMN.get(self.level)
        rows = self._scoped(episodes, cohorts=True) if code else self._in_years(episodes)
        cohort = [F.col("fyear").alias("_fyear"), *([F.col(code).alias("_code")] if code else [])]
        return rows.select(*self.keys, *cohort).dropDuplicates()

    def activity(self, table_name: str, measures: Sequence[str], national_collapse: dict | None) -> DataFrame:
        source = self.data.table(table_name)
        if self.level == PROVIDER:
            return self._scoped(source).withColumnRenamed(ROW_INDEX, "rn")
        if self.level == REGION:
            rows = self._relabel(self._scoped(source, cohorts=True)).drop(ROW_INDEX)
            keys = keys_except(rows, measures)
            totals = roll_up(rows, measures, keys, null_sum=0, nan_as_null=True)
            numbered = dense_id(totals, keys, within=["icb", "fyear"], method=self.id_method)
            return self._per_request(numbered, ["icb", "fyear"], "icb")
        keys = keys_except(source, [ROW_INDEX, "fyear", *measures])
        rows = self._relabel(self._in_years(source), include_icb=True)
        if national_collapse:
            rows = collapse(rows, national_collapse)
        by_year = roll_up(rows, measures, [*keys, "fyear"])
        scaled = self._per_request(by_year, ["fyear"]).select(
            "request_id", *keys, *[(F.col(m) * F.col("sample_rate")).alias(m) for m in measures])
        return stable_id(scaled, keys)

    def factors(self, wide_name: str, long_name: str, sex: int | None) -> DataFrame:
        if self.level == PROVIDER:
            return self._scoped(self.data.table(wide_name)).drop("dataset")
        if self.level == REGION:
            projections = self.data.table(long_name).filter(F.col("projection_year") == F.lit(self.projection_year))
            codes = self._req("icb").select("icb").distinct()
            areas = small_side(self.data.table(names.CATCHMENTS).join(F.broadcast(codes) if self.small else codes, "icb"))
            joined = projections.join(areas, "area_code")
            if sex is not None:
                joined = joined.withColumn("sex", F.lit(sex))
            ids = ["icb", "age", "sex", F.col("projection").alias("variant")]
            totals = long_to_wide(joined, ids, F.col("value") * F.col("pcnt"), self.factor_years)
            return self._spread(self._req("icb").drop("fyear"), totals, ["icb"]).drop("icb")
        wide = exclude_prefix(self._in_years(self.data.table(wide_name)), "variant")
        by_year = sum_factors(wide, ["fyear", *FACTOR_IDS], sorted(year_columns(wide)))
        return self._per_request(by_year, ["fyear"]).drop("fyear", *NATIONAL_REQUEST_COLUMNS)

    def hsa_activity(self) -> DataFrame:
        if self.level == PROVIDER:
            return self._scoped(self.data.table(names.HSA_ACTIVITY)).drop("dataset", "fyear")
        code = fyear_code_col(F.col("fyear"))
        if self.level == REGION:
            rows = self._scoped(self.data.table(names.HSA_ACTIVITY_REGION), year_expr=code, cohorts=True)
            totals = mean_by(rows, ["icb", "fyear", *HSA_KEYS], "activity")
            return self._per_request(totals, ["icb", "fyear"], "icb", code).drop("icb", "fyear")
        table = self._in_years(self.data.table(names.HSA_ACTIVITY_NATIONAL), coded=True)
        by_year = mean_by(table, ["fyear", *HSA_KEYS], "activity")
        return self._per_request(by_year, ["fyear"], year_expr=code).drop("fyear", *NATIONAL_REQUEST_COLUMNS)

    def inequalities(self) -> DataFrame:
        df = self._scoped(self.data.table(names.INEQUALITIES))
        return df.drop(*NATIONAL_REQUEST_COLUMNS) if self.level == NATION else df

    def extract(self, kind: str, cohort: DataFrame | None = None) -> DataFrame:
        """Extract ``kind`` (one of :data:`KINDS`); ``cohort`` reuses :meth:`cohort_keys`."""
        if kind == "ip":
            return self.ip()
        if kind.startswith("strategies_"):
            return self.strategies(kind[len("strategies_"):], cohort)
        if kind == "op":
            return self.activity(names.OP, OP_MEASURES, NATIONAL_OP_COLLAPSE)
        if kind == "aae":
            return self.activity(names.AAE, AAE_MEASURES, None)
        if kind == "birth_factors":
            return self.factors(names.BIRTH_FACTORS, names.BIRTHS, BIRTHS_SEX)
        if kind == "demographic_factors":
            return self.factors(names.DEMOGRAPHIC_FACTORS, names.DEMOGRAPHICS, None)
        if kind == "hsa_activity":
            return self.hsa_activity()
        if kind == "inequalities":
            return self.inequalities()
        raise ValueError(f"unknown extract kind {kind!r}")


def extract_all(
    data: Dataset,
    requests: DataFrame,
    kind: str,
    level: str,
    *,
    keys: Sequence[str] = ("rn",),
    projection_year: int = DEFAULT_PROJECTION_YEAR,
    factor_years: Sequence | None = None,
    id_method: str = "auto",
    max_requests: int = DEFAULT_BROADCAST_ROWS,
    salt_buckets: int | None = None,
) -> DataFrame:
    """Extract ``kind`` (one of :data:`KINDS`) for every request of ``level`` in one plan.

    ``max_requests`` bounds the request table that is broadcast; above it the joins are salted
    shuffle joins with ``salt_buckets`` salts (default: one per shuffle partition).
    """
    batch = RequestBatch(data, requests, level, keys=keys, projection_year=projection_year,
                         factor_years=factor_years, id_method=id_method, max_requests=max_requests,
                         salt_buckets=salt_buckets)
    return batch.extract(kind)
