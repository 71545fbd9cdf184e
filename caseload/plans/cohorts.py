"""The extracts of one cohort for one financial year (the public surface).

``Cohorts(dataset, scope, year)`` has one method per extract, each returning a DataFrame. The plan of
each is filters (pushed to the scan), relabels (projections), then at most one aggregation or semi
join. All are lazy but two: region ``op`` and ``aae`` checkpoint their totals to number them, and
region factors without ``factor_years`` checkpoint theirs to find the years.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseload.functions.rows import dense_id, sample_predicate, stable_id
from caseload.functions.scope import (
    NATION,
    PROVIDER,
    REGION,
    Scope,
    collapse,
    exclude_prefix,
    fyear_code,
    in_scope,
    relabel,
)
from caseload.operators.joins import duplicate_keys, semi_join
from caseload.operators.measure import apportioned_factors, mean_by, roll_up, sum_factors
from caseload.operators.shape import keys_except, year_columns
from caseload.sources import dataset as names
from caseload.sources.dataset import Dataset

# Fixed values of the extracts.
OP_MEASURES = ("attendances", "tele_attendances")
AAE_MEASURES = ("arrivals",)
ROW_INDEX = "index"
NATIONAL_OP_COLLAPSE = {"sushrg_trimmed": "HRG", "imd_quintile": 0}
BIRTHS_SEX = 2
DEFAULT_PROJECTION_YEAR = 2022
FACTOR_IDS = ("variant", "age", "sex")
HSA_KEYS = ("hsagrp", "sex", "age")
STRATEGY_KINDS = tuple(names.STRATEGY_TABLES)


class Cohorts:
    """Extracts for ``scope`` in financial year ``year``.

    Parameters beyond the reference's:
      * ``keys``: episode key joining strategies to episodes (default ``rn``);
      * ``sample_method``: ``"hash"`` (partition-independent, default) or ``"bernoulli"``;
      * ``id_method``: how region op/aae ids are numbered (see ``dense_id``);
      * ``projection_year``: vintage of the population projections (default 2022);
      * ``factor_years``: year columns of the region factor pivots (found from the data when None).
    """

    def __init__(
        self,
        data: Dataset,
        scope: Scope,
        year: int,
        *,
        keys: Sequence[str] = ("rn",),
        sample_method: str = "hash",
        id_method: str = "auto",
        projection_year: int = DEFAULT_PROJECTION_YEAR,
        factor_years: Sequence | None = None,
    ):
        self.data = data
        self.scope = scope
        self.year = int(year)
        self.keys = list(keys)
        self.sample_method = sample_method
        self.id_method = id_method
        self.projection_year = projection_year
        self.factor_years = factor_years

    @property
    def level(self) -> str:
        return self.scope.level

    # ---- EXT1: inpatient episodes -----------------------------------------------------------------
    def ip(self) -> DataFrame:
        df = relabel(in_scope(self.data.table(names.IP), self.scope, self.year), self.scope)
        if self.level == NATION:
            df = self._sample(df)
        return df

    def _sample(self, df: DataFrame) -> DataFrame:
        rate, seed = self.scope.sample_rate, self.scope.seed
        if self.sample_method == "bernoulli":
            return df if rate >= 1 else df.sample(withReplacement=False, fraction=max(rate, 0.0), seed=seed)
        if len(self.keys) != 1:
            raise ValueError("hash sampling needs a single episode key")
        return df.filter(sample_predicate(rate, seed, self.keys[0]))

    # ---- EXT2/EXT3: strategies of the cohort's episodes -------------------------------------------
    def strategies(self, kind: str | None = None) -> DataFrame | dict[str, DataFrame]:
        """Strategy rows whose episode is in the cohort (left semi join on the episode key).

        ``kind`` is ``"activity_avoidance"`` or ``"efficiencies"``; without it, a dict of both.
        """
        if kind is None:
            return {k: self.strategies(k) for k in STRATEGY_KINDS}
        table = self.data.table(names.STRATEGY_TABLES[kind])
        # Provider strategies are also filtered by provider; region and national only by year.
        table = in_scope(table, self.scope, self.year, by_code=self.level == PROVIDER)
        if self.level == NATION and self.sample_method == "hash":
            # The sample is a function of the key alone, so it prunes the strategies before the
            # join: only ~rate of them reach the shuffle.
            table = self._sample(table)
        return semi_join(table, self.ip(), self.keys)

    # ---- EXT4/EXT5: outpatient and A&E activity ---------------------------------------------------
    def op(self) -> DataFrame:
        return self._activity(names.OP, OP_MEASURES, NATIONAL_OP_COLLAPSE)

    def aae(self) -> DataFrame:
        return self._activity(names.AAE, AAE_MEASURES, None)

    def _activity(self, table_name: str, measures: Sequence[str], national_collapse: dict | None) -> DataFrame:
        source = self.data.table(table_name)
        scoped = in_scope(source, self.scope, self.year)
        if self.level == PROVIDER:
            return scoped.withColumnRenamed(ROW_INDEX, "rn")
        if self.level == REGION:
            rows = relabel(scoped, self.scope).drop(ROW_INDEX)
            keys = keys_except(rows, measures)
            totals = roll_up(rows, measures, keys, null_sum=0, nan_as_null=True)
            return dense_id(totals, keys, method=self.id_method)
        # National: keys come from the source schema, before relabelling and collapsing.
        keys = keys_except(source, [ROW_INDEX, "fyear", *measures])
        rows = relabel(scoped, self.scope, include_icb=True)
        if national_collapse:
            rows = collapse(rows, national_collapse)
        totals = roll_up(rows, measures, keys, scale=self.scope.sample_rate)
        return stable_id(totals, keys)

    # ---- EXT6/EXT7: population factors ------------------------------------------------------------
    def birth_factors(self) -> DataFrame:
        return self._factors(names.BIRTH_FACTORS, names.BIRTHS, sex=BIRTHS_SEX)

    def demographic_factors(self) -> DataFrame:
        return self._factors(names.DEMOGRAPHIC_FACTORS, names.DEMOGRAPHICS, sex=None)

    def _factors(self, wide_name: str, long_name: str, sex: int | None) -> DataFrame:
        if self.level == PROVIDER:
            return in_scope(self.data.table(wide_name), self.scope, self.year).drop("dataset")
        if self.level == REGION:
            projections = self.data.table(long_name).filter(F.col("projection_year") == F.lit(self.projection_year))
            catchments = self.data.table(names.CATCHMENTS).filter(F.col("icb") == F.lit(self.scope.code))
            overrides = {"sex": F.lit(sex)} if sex is not None else None
            return apportioned_factors(projections, catchments,
                                       ids=["age", "sex", F.col("projection").alias("variant")],
                                       years=self.factor_years, overrides=overrides)
        wide = exclude_prefix(in_scope(self.data.table(wide_name), self.scope, self.year), "variant")
        return sum_factors(wide, FACTOR_IDS, sorted(year_columns(wide)))

    # ---- EXT8: health-status activity -------------------------------------------------------------
    def hsa_activity(self) -> DataFrame:
        if self.level == PROVIDER:
            return in_scope(self.data.table(names.HSA_ACTIVITY), self.scope, self.year).drop("dataset", "fyear")
        table = names.HSA_ACTIVITY_REGION if self.level == REGION else names.HSA_ACTIVITY_NATIONAL
        # The catalog tables code the year as yyyyYY; the literal is folded here so it pushes down.
        scoped = in_scope(self.data.table(table), self.scope, self.year, year_value=fyear_code(self.year))
        return mean_by(scoped, HSA_KEYS, "activity")

    # ---- EXT9: inequalities -----------------------------------------------------------------------
    def inequalities(self) -> DataFrame:
        return in_scope(self.data.table(names.INEQUALITIES), self.scope, self.year)

    # ---- key check ------------------------------------------------------------------------------------
    def duplicate_episode_keys(self) -> DataFrame:
        """Episode keys of the year that occur more than once across all providers (opt-in check:
        region and national strategies join on the key alone, which assumes it is unique)."""
        episodes = in_scope(self.data.table(names.IP), self.scope, self.year, by_code=False)
        return duplicate_keys(episodes, self.keys)

    # ---- health-status models ---------------------------------------------------------------------
    def hsa_gams(self):
        """Health-status adjustment models are not loaded from these tables (the source system does
        not support them either)."""
        raise NotImplementedError("health-status adjustment models are not part of the extracts")

    # ---- everything ---------------------------------------------------------------------------------
    def extracts(self) -> dict[str, DataFrame]:
        out = {"ip": self.ip()}
        out.update({f"strategies_{k}": df for k, df in self.strategies().items()})
        out.update({
            "op": self.op(),
            "aae": self.aae(),
            "birth_factors": self.birth_factors(),
            "demographic_factors": self.demographic_factors(),
            "hsa_activity": self.hsa_activity(),
            "inequalities": self.inequalities(),
        })
        return out


def cohort_factory(data: Dataset, level: str, *, sample_rate: float = 1.0, seed: int = 0,
                   **options) -> Callable[[int, str | None], Cohorts]:
    """A ``(year, code) -> Cohorts`` callable, the shape a model run asks its data loader for.

    ``code`` is the provider or region code; national cohorts ignore it and use ``sample_rate`` and
    ``seed``.
    """
    def make(year: int, code: str | None = None) -> Cohorts:
        if level == NATION:
            scope = Scope.national(sample_rate, seed)
        elif level == REGION:
            scope = Scope.region(code)
        else:
            scope = Scope.provider(code)
        return Cohorts(data, scope, year, **options)
    return make
