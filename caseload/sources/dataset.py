"""Where the input tables live: parquet directories under a base path, catalog tables, or
DataFrames supplied by the caller."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from contextlib import contextmanager
from typing import Union

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

# Logical table names the extracts read.
IP = "ip"
STRATEGY_TABLES = {
    "activity_avoidance": "ip_activity_avoidance_strategies",
    "efficiencies": "ip_efficiencies_strategies",
}
OP = "op"
AAE = "aae"
BIRTH_FACTORS = "birth_factors"
DEMOGRAPHIC_FACTORS = "demographic_factors"
HSA_ACTIVITY = "hsa_activity_tables"
INEQUALITIES = "inequalities"
BIRTHS = "births"
DEMOGRAPHICS = "demographics"
CATCHMENTS = "icb_catchments"
HSA_ACTIVITY_REGION = "hsa_activity_tables_icb"
HSA_ACTIVITY_NATIONAL = "hsa_activity_tables_national"

TABLE_NAMES = (IP, *STRATEGY_TABLES.values(), OP, AAE, BIRTH_FACTORS, DEMOGRAPHIC_FACTORS, HSA_ACTIVITY,
               INEQUALITIES, BIRTHS, DEMOGRAPHICS, CATCHMENTS, HSA_ACTIVITY_REGION, HSA_ACTIVITY_NATIONAL)

TableSource = Union[str, DataFrame, Callable[[SparkSession], DataFrame]]


class Dataset:
    """Resolve logical table names to DataFrames.

    ``tables`` overrides the default (``{base_path}/{name}`` parquet) per name with
    * a path (contains ``/`` or ``:``) read as parquet,
    * a catalog name (``catalog.schema.table``) read with ``spark.table``,
    * a DataFrame, or a callable building one from the session.

    Nothing is read until an action runs. The DataFrame of each table is built once and reused
    (file listing and schema resolution happen once per table, not once per extract); call
    :meth:`refresh` after the files of a table change.
    """

    def __init__(self, spark: SparkSession, base_path: str | None = None,
                 tables: Mapping[str, TableSource] | None = None):
        self.spark = spark
        self.base_path = base_path.rstrip("/") if base_path else None
        self.tables = dict(tables or {})
        self._resolved: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._resolved:
            self._resolved[name] = self._resolve(name)
        return self._resolved[name]

    def refresh(self, name: str | None = None) -> None:
        """Forget resolved tables (all, or one) so the next use lists their files again."""
        if name is None:
            self._resolved.clear()
        else:
            self._resolved.pop(name, None)

    def _resolve(self, name: str) -> DataFrame:
        source = self.tables.get(name)
        if source is None:
            if self.base_path is None:
                raise KeyError(f"no source for table {name!r}")
            return self.spark.read.parquet(f"{self.base_path}/{name}")
        if isinstance(source, DataFrame):
            return source
        if callable(source):
            return source(self.spark)
        if "/" in source or ":" in source:
            return self.spark.read.parquet(source)
        return self.spark.table(source)

    def with_tables(self, **tables: TableSource) -> Dataset:
        merged = dict(self.tables)
        merged.update(tables)
        return Dataset(self.spark, self.base_path, merged)


@contextmanager
def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """Persist ``df`` for the duration of a block and release it afterwards.

    Equal plans share one cache entry, so a cohort rebuilt inside the block is served from it.
    Cached blocks lost with an executor are recomputed from lineage.
    """
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()
