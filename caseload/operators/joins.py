"""Join helpers: semi joins to a cohort and size-checked broadcasts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Largest side broadcast after a bounded look at it (rows, and bytes of their values as text). A request
# table or a catchment table is far below this; anything above it is joined by shuffle.
DEFAULT_BROADCAST_ROWS = 200_000
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024


def value_bytes(df: DataFrame) -> Column:
    """Aggregate: bytes of all values of ``df``, written as JSON."""
    return F.coalesce(F.sum(F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))), F.lit(0))


def fits(df: DataFrame, max_rows: int, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and ``max_bytes`` of values. Looks at ``max_rows + 1`` rows at most."""
    seen = df.limit(max_rows + 1)
    found = seen.agg(F.count(F.lit(1)).alias("rows"), value_bytes(seen).alias("bytes")).first()
    return found["rows"] <= max_rows and found["bytes"] <= max_bytes


def small_side(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint for ``df`` only when a bounded look proves it small; otherwise return it
    unchanged so that Catalyst/AQE choose by the statistics."""
    return F.broadcast(df) if fits(df, max_rows, max_bytes) else df


def semi_join(df: DataFrame, cohort: DataFrame, keys: Sequence[str] = ("rn",)) -> DataFrame:
    """Rows of ``df`` whose ``keys`` occur in ``cohort`` (EXISTS). Left duplicates stay; right
    duplicates do not multiply; NULL keys never match. Only the key columns of the cohort are
    read, so Catalyst prunes its scan to them."""
    keys = list(keys)
    return df.join(cohort.select(*keys), keys, "left_semi")


def duplicate_keys(df: DataFrame, keys: Sequence[str] = ("rn",)) -> DataFrame:
    """Key values that occur on more than one row, with their row count (a distributed check: one
    partial/final aggregation; only the duplicates leave the executors)."""
    keys = list(keys)
    present = F.lit(True)
    for k in keys:  # a NULL in any key never joins, so such rows are not duplicates of anything
        present = present & F.col(k).isNotNull()
    return (df.where(present)
            .groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1))
