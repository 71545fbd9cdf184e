"""Aggregations of activity and population factors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from caseload.operators.joins import small_side
from caseload.operators.shape import long_to_wide, year_columns


def _is_floating(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (DoubleType, FloatType))


def nan_to_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Read NaN as NULL in the floating-point ``columns`` (pandas treats them as one missing value)."""
    floating = [c for c in columns if _is_floating(df, c)]
    if not floating:
        return df
    return df.withColumns({c: F.when(F.isnan(c), F.lit(None)).otherwise(F.col(c)) for c in floating})


def roll_up(
    df: DataFrame,
    measures: Sequence[str],
    keys: Sequence[str],
    scale: float | Column | None = None,
    null_sum: object | None = None,
    nan_as_null: bool = False,
) -> DataFrame:
    """Group by ``keys`` and sum each measure; NULL keys form their own group.

    * ``scale``: multiply each sum by it (sampling rate of the national cohort);
    * ``null_sum``: value of an all-NULL sum (0 for the region extracts, NULL by default);
    * ``nan_as_null``: NaN keys and measures count as NULL (so NaN and NULL keys share a group).

    Spark plans this as a partial (map-side) then final hash aggregation: only one row per key and
    input partition crosses the shuffle, so a hot key is combined before it moves.
    """
    if nan_as_null:
        df = nan_to_null(df, [*keys, *measures])
    aggs = []
    for m in measures:
        total = F.sum(m)
        if scale is not None:
            total = total * (scale if isinstance(scale, Column) else F.lit(float(scale)))
        if null_sum is not None:
            total = F.coalesce(total, F.lit(null_sum))
        aggs.append(total.alias(m))
    return df.groupBy(*keys).agg(*aggs)


def sum_factors(df: DataFrame, ids: Sequence[str] = ("variant", "age", "sex"),
                years: Sequence[str] | None = None) -> DataFrame:
    """Sum every year column by ``ids`` (wide in, wide out).

    Equal to unpivoting, summing by (ids, year) and pivoting back, without multiplying the rows by
    the number of years, without the value-discovery job and with one shuffle instead of two. All
    year columns are present even when there are no rows.
    """
    years = list(years) if years is not None else sorted(year_columns(df))
    return df.groupBy(*ids).agg(*[F.sum(F.col(f"`{y}`")).alias(y) for y in years])


def mean_by(df: DataFrame, keys: Sequence[str], measure: str, alias: str | None = None) -> DataFrame:
    """Mean of ``measure`` by ``keys``."""
    return df.groupBy(*keys).agg(F.avg(measure).alias(alias or measure))


def apportion(
    projections: DataFrame,
    catchments: DataFrame,
    key: str = "area_code",
    weight: str = "pcnt",
    value: str = "value",
    max_catchment_rows: int | None = None,
) -> tuple[DataFrame, Column]:
    """Join projections to catchment weights (an area may serve several regions) and return the
    joined rows with the weighted value expression ``value * weight``.

    By default the join strategy is left to Catalyst and AQE, which broadcast the catchment side
    only within ``spark.sql.autoBroadcastJoinThreshold`` (file-size statistics when planning, the
    measured shuffle size at run time). With ``max_catchment_rows`` the side is broadcast after a
    bounded count proves it at most that many rows (for catchments without statistics).
    """
    if max_catchment_rows is not None:
        catchments = small_side(catchments, max_catchment_rows)
    joined = projections.join(catchments, key)
    return joined, F.col(value) * F.col(weight)


def apportioned_factors(
    projections: DataFrame,
    catchments: DataFrame,
    ids: Sequence[str | Column],
    years: Sequence | None = None,
    overrides: dict[str, Column] | None = None,
) -> DataFrame:
    """Weighted sums of projections over a region's catchment areas, one column per year."""
    joined, weighted = apportion(projections, catchments)
    if overrides:
        joined = joined.withColumns(overrides)
    return long_to_wide(joined, ids, weighted, years)
