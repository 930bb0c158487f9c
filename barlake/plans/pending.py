"""Days whose bars are stored and whose silver rows are not yet."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from barlake.sources.files import names_in, path_exists, remove

#: So many records are put together into one when another is made.
_TOGETHER = 64


def _root(warehouse: str) -> str:
    return f"{warehouse.rstrip('/')}/_pending_days"


def records(spark: SparkSession, warehouse: str) -> list[str]:
    """Paths of the complete records."""
    paths = [f"{_root(warehouse)}/{name}" for name in names_in(spark, _root(warehouse))]
    return [path for path in paths if path_exists(spark, f"{path}/_SUCCESS")]


def days_of(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``_day`` of some records, each once; there must be a record."""
    return spark.read.schema("_day string").parquet(*paths).distinct()


def _write(days: DataFrame, warehouse: str) -> str:
    path = f"{_root(warehouse)}/{uuid.uuid4().hex}"
    days.write.parquet(path)
    return path


def mark(days: DataFrame, warehouse: str) -> str:
    """Record days (``_day``), before their bars are stored; the record's path."""
    spark = days.sparkSession
    before = records(spark, warehouse)
    if len(before) >= _TOGETHER:
        _write(days_of(spark, before), warehouse)
        clear(spark, before)
    return _write(days, warehouse)


def clear(spark: SparkSession, paths: Iterable[str]) -> None:
    """Forget records whose days' silver is published, or that a new record takes in."""
    for path in paths:
        remove(spark, path)
