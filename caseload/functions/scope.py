"""Cohort scope: which rows belong to a provider, a region or the nation, and how they are relabelled."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values that must equal the source system's.
NATIONAL = "NATIONAL"
CUSTOM_VARIANT_PREFIX = "custom"
YEAR_COLUMN_PREFIX = "20"

PROVIDER, REGION, NATION = "provider", "region", "national"
_SCOPE_COLUMN = {PROVIDER: "dataset", REGION: "icb", NATION: None}


@dataclass(frozen=True)
class Scope:
    """A cohort: one provider (``dataset``), one region (``icb``) or the nation (sampled)."""

    level: str
    code: str | None = None
    sample_rate: float = 1.0
    seed: int = 0

    @classmethod
    def provider(cls, code: str) -> Scope:
        return cls(PROVIDER, code)

    @classmethod
    def region(cls, code: str) -> Scope:
        return cls(REGION, code)

    @classmethod
    def national(cls, sample_rate: float = 1.0, seed: int = 0) -> Scope:
        return cls(NATION, NATIONAL, float(sample_rate), int(seed))

    @property
    def scope_column(self) -> str | None:
        return _SCOPE_COLUMN[self.level]

    def __post_init__(self) -> None:
        if self.level not in _SCOPE_COLUMN:
            raise ValueError(f"unknown scope level {self.level!r}")
        if self.level != NATION and not self.code:
            raise ValueError(f"a {self.level} scope needs a code")


def fyear_code(year: int) -> int:
    """Financial-year code used by the catalog activity tables: 2023 -> 202324, 1999 -> 199900."""
    return year * 100 + (year + 1) % 100


def fyear_code_col(year: Column) -> Column:
    """Column form of :func:`fyear_code` (batch mode, one year per request row)."""
    return (year * 100 + (year + 1) % 100).cast("int")


def scope_predicate(scope: Scope, year: int, *, by_code: bool = True, year_col: str = "fyear",
                    year_value: int | None = None) -> Column:
    """``fyear = year`` and, unless national or ``by_code`` is off, ``<scope column> = code``.

    Literals are folded on the driver so the predicate reaches the parquet scan (or partition
    filter) unchanged.
    """
    cond = F.col(year_col) == F.lit(year if year_value is None else year_value)
    if by_code and scope.scope_column:
        cond = (F.col(scope.scope_column) == F.lit(scope.code)) & cond
    return cond


def in_scope(df: DataFrame, scope: Scope, year: int, **kwargs) -> DataFrame:
    return df.filter(scope_predicate(scope, year, **kwargs))


def relabel(df: DataFrame, scope: Scope, *, include_icb: bool = False, code: Column | None = None) -> DataFrame:
    """Relabel a cohort's organisation columns.

    * provider: unchanged;
    * region: ``sitetret`` takes the old ``dataset`` and ``dataset`` becomes the region code
      (one projection, so ``sitetret`` reads the value before it is overwritten);
    * national: ``dataset`` and ``sitetret`` (and ``icb`` when ``include_icb``) become ``NATIONAL``.

    ``code`` replaces the literal region code with a column (batch mode).
    """
    if scope.level == PROVIDER:
        return df
    if scope.level == REGION:
        return df.withColumns({"sitetret": F.col("dataset"),
                               "dataset": code if code is not None else F.lit(scope.code)})
    labels = {"dataset": F.lit(NATIONAL), "sitetret": F.lit(NATIONAL)}
    if include_icb:
        labels["icb"] = F.lit(NATIONAL)
    return df.withColumns(labels)


def exclude_prefix(df: DataFrame, column: str, prefix: str = CUSTOM_VARIANT_PREFIX) -> DataFrame:
    """Drop rows whose ``column`` starts with ``prefix`` (case-sensitive); NULL is dropped too,
    as ``NOT startswith(NULL)`` is NULL. Pushes down as a parquet StringStartsWith filter."""
    return df.filter(~F.col(column).startswith(prefix))


def collapse(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """Overwrite detail columns with constants (e.g. case mix collapsed for national outpatients)."""
    return df.withColumns({name: F.lit(value) for name, value in values.items()})
