"""What bounds a Python worker's memory: small batches of rows, and one model kept between tasks."""

from __future__ import annotations

from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

T = TypeVar("T")

_KEPT: dict[object, object] = {}


def kept(key: object, build: Callable[[], T]) -> T:
    """The model under ``key``, built if it is not the one that the worker holds."""
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = build()
    return _KEPT[key]


#: Rows of an Arrow batch, on both sides of the pipe; Spark's default of 10,000 whole texts can be gigabytes.
BATCH_ROWS = 500
_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def map_batches(df: DataFrame, function, schema: StructType | str) -> DataFrame:
    """``df.mapInArrow`` with batches of at most :data:`BATCH_ROWS` rows: the session's setting is lowered to
    that if it is larger, as it holds when the plan runs."""
    conf = df.sparkSession.conf
    most = int(conf.get(_SETTING))
    if most <= 0 or most > BATCH_ROWS:
        conf.set(_SETTING, str(BATCH_ROWS))
    return df.mapInArrow(function, schema)
