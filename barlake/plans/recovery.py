"""Complete replacements of days that were interrupted."""

from __future__ import annotations

import json
import logging

from pyspark.sql import SparkSession

from barlake.schemas import DAILY_TRADES, TRADE
from barlake.sources.catalog import sync_partitions
from barlake.sources.files import names_in, path_exists, read_file, remove
from barlake.sources.lease import writer
from barlake.sources.staging import intents_dir
from barlake.sources.tables import distinct_days, write_table

log = logging.getLogger(__name__)

_TABLES = {table.name: table for table in (TRADE, DAILY_TRADES)}


class CopyMissing(RuntimeError):
    """An intent names a copy that is not there (any more)."""


def recover(spark: SparkSession, warehouse: str, database: str | None = None) -> int:
    """Write again the days whose replacement was begun and not completed; how many there were.

    An intent file names the complete copy of all rows of the days that were being
    replaced. The days are overwritten from it, which may be repeated, then the intent goes and
    the copy last, so an interruption here leaves the same work to the next call. Entry points
    call this first, and a warehouse has one writer: nothing newer is undone. What Spark's
    own commit left half done is removed.
    """
    names = names_in(spark, intents_dir(warehouse))
    if not names:
        return 0
    with writer(spark, warehouse):
        names = [n for n in names_in(spark, intents_dir(warehouse)) if n.endswith(".json")]
        for name in names:
            path = f"{intents_dir(warehouse)}/{name}"
            intent = json.loads(read_file(spark, path))
            table, copy, fmt = _TABLES[intent["table"]], intent["copy"], intent["format"]
            if not path_exists(spark, f"{copy}/_SUCCESS"):
                raise CopyMissing(f"{path} names {copy}, which is gone; its days may lack rows")
            log.warning("completing the replacement of days of %s from %s", table.name, copy)
            rows = spark.read.schema(table.schema).parquet(copy)
            write_table(rows, table, warehouse, "overwrite_days", fmt)
            if database is not None:
                sync_partitions(spark, table, database, fmt, distinct_days(rows, table.partition))
            for left in names_in(spark, table.path(warehouse)):
                if left.startswith(".spark-staging-"):
                    remove(spark, f"{table.path(warehouse)}/{left}")
            remove(spark, path)
            remove(spark, copy)
    return len(names)
