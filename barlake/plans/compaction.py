"""Many small files of a day into few."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.plans.recovery import recover
from barlake.schemas import Table
from barlake.sources.catalog import sync_partitions
from barlake.sources.lease import writer
from barlake.sources.staging import staged
from barlake.sources.tables import distinct_days, on_days, read_table, write_table

log = logging.getLogger(__name__)

#: Files below this size are small.
SMALL_BYTES = 32 << 20


def stored_files(spark: SparkSession, table: Table, warehouse: str) -> DataFrame:
    """The partition column, ``path`` and ``length`` of each file. Files are listed, not read."""
    return (
        spark.read.format("binaryFile")
        .load(table.path(warehouse))
        .select(table.partition, "path", "length")
    )


def crowded_days(
    spark: SparkSession, table: Table, warehouse: str, small: int = SMALL_BYTES, at_least: int = 8
) -> DataFrame:
    """``_day`` of the days that have so many small files."""
    files = stored_files(spark, table, warehouse)
    counts = files.groupBy(table.partition).agg(F.count_if(F.col("length") < small).alias("_n"))
    return distinct_days(counts.filter(F.col("_n") >= at_least), table.partition)


def compact(
    spark: SparkSession,
    table: Table,
    warehouse: str,
    small: int = SMALL_BYTES,
    at_least: int = 8,
    database: str | None = None,
) -> int:
    """Rewrite the days of a table that have many small files; how many days there were.

    Every append leaves a file or more in each day it has bars for, so a day that is polled often has
    hundreds. Days with ``at_least`` files below ``small`` bytes are found from the list of files alone
    and written anew, a few files each, all rows as they were; other days keep their files.
    Parquet tables only. An interrupted rewriting is completed by ``recover``.
    """
    if table.partition is None:
        raise ValueError(f"{table.name} has no days")
    with writer(spark, warehouse):
        recover(spark, warehouse, database)
        days = crowded_days(spark, table, warehouse, small, at_least)
        with staged(days, "crowded", warehouse) as crowded:
            n = crowded.count()
            if n:
                rows = on_days(read_table(spark, table, warehouse), table.partition, crowded)
                with staged(rows, "compact", warehouse, replaces=table) as copy:
                    write_table(copy, table, warehouse, "overwrite_days")
                if database is not None:
                    sync_partitions(spark, table, database, days=crowded)
                log.info("%d days of %s written anew", n, table.name)
    return n
