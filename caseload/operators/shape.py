"""Reshaping between wide factor tables (one column per year) and long ones (year, value)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseload.functions.scope import YEAR_COLUMN_PREFIX


def year_columns(df: DataFrame, prefix: str = YEAR_COLUMN_PREFIX) -> list[str]:
    """Columns whose name starts with ``prefix`` (the year columns of a wide factor table)."""
    return [c for c in df.columns if c.startswith(prefix)]


def keys_except(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    """All columns but ``exclude``, in schema order (grouping keys taken from the schema)."""
    excluded = set(exclude)
    return [c for c in df.columns if c not in excluded]


def wide_to_long(
    df: DataFrame,
    ids: Sequence[str],
    years: Sequence[str] | None = None,
    year_col: str = "year",
    value_col: str = "value",
) -> DataFrame:
    """Unpivot year columns to (``year_col``, ``value_col``) rows.

    Year columns of different numeric types are coerced to their widest common type by Spark's
    unpivot (where a hand-written ``stack`` expression would fail analysis).
    """
    years = list(years) if years is not None else year_columns(df)
    if not years:
        raise ValueError("no year columns to unpivot")
    return df.unpivot(list(ids), years, year_col, value_col)


def long_to_wide(
    df: DataFrame,
    ids: Sequence[str | Column],
    value: Column,
    years: Sequence | None = None,
    year_col: str = "year",
) -> DataFrame:
    """Pivot ``sum(value)`` by ``year_col`` into one column per year, named by the year.

    Pass ``years`` to fix the output schema: every listed year gets a column even when no row has
    it, rows with a NULL or unlisted year are left out, and it is one partial/final aggregation.

    Without ``years`` every year of the data gets a column, in order, a NULL year the column
    ``null``. The rows are aggregated by (ids, year) once and checkpointed; the years are read from
    that small result, which is then widened, so the source is scanned once.
    """
    year = F.col(year_col)
    if years is not None:
        return df.groupBy(*ids).agg(*[F.sum(F.when(year == F.lit(y), value)).alias(str(y)) for y in years])
    totals = df.groupBy(*ids, year).agg(F.sum(value).alias("_total")).checkpoint(eager=True)
    names = totals.columns[:-2]
    found = sorted((r[0] for r in totals.select(year_col).distinct().collect()), key=lambda y: (y is not None, y))
    if not found:
        return totals.select(*names)
    return totals.groupBy(*names).agg(*[
        F.sum(F.when(year.eqNullSafe(F.lit(y)), F.col("_total"))).alias("null" if y is None else str(y)) for y in found])
