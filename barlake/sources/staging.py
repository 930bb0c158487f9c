"""Tables written to the shared staging folder.

Used where a result is read more than once, or where the table it comes from is
about to be replaced. A written table survives the loss of executors and is read
back column by column.
"""

from __future__ import annotations

import json
import logging
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from barlake.schemas import Table
from barlake.sources.files import create_file, path_exists, remove

__all__ = ["new_dir", "path_exists", "remove", "staged", "staging_root"]

log = logging.getLogger(__name__)

_CHECKPOINT_DIR = "spark.checkpoint.dir"


def staging_root(spark: SparkSession, warehouse: str | None = None) -> str:
    """The shared folder named by ``spark.checkpoint.dir`` or ``setCheckpointDir``.

    Without either it is ``_staging`` beside the tables, which all executors reach
    too: under ``warehouse``, or Spark's own warehouse folder.
    """
    root = spark.conf.get(_CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if not root:
        beside = warehouse or spark.conf.get("spark.sql.warehouse.dir")
        root = f"{beside.rstrip('/')}/_staging"
    return root.rstrip("/")


def new_dir(spark: SparkSession, label: str, warehouse: str | None = None) -> str:
    """A path under the staging folder that nothing uses yet."""
    return f"{staging_root(spark, warehouse)}/{label}-{uuid.uuid4().hex}"


def intents_dir(warehouse: str) -> str:
    return f"{warehouse.rstrip('/')}/_intents"


def _declare(spark: SparkSession, warehouse: str, table: Table, copy: str, fmt: str) -> str:
    """Note beside the tables that days of one are about to be replaced by the rows of a copy."""
    path = f"{intents_dir(warehouse)}/{time.time_ns():020}-{uuid.uuid4().hex}.json"
    create_file(spark, path, json.dumps({"table": table.name, "copy": copy, "format": fmt}))
    return path


@contextmanager
def staged(
    df: DataFrame,
    label: str,
    warehouse: str | None = None,
    guards: bool = False,
    replaces: Table | None = None,
    fmt: str = "parquet",
) -> Iterator[DataFrame]:
    """Write ``df`` once and yield it as read back; the copy is removed at exit.

    With ``guards`` it holds rows of a table that is overwritten meanwhile. If that
    fails once the copy is complete, the copy may be the only one left of some rows:
    it is kept, and the error says where.

    With ``replaces`` it guards all rows of the days of that table that are overwritten, and an intent
    file beside the tables names it as long as that lasts. If the overwriting fails, or the process is
    lost, both stay, and ``recover`` writes the days from the copy.
    """
    spark = df.sparkSession
    path = new_dir(spark, label, warehouse)
    intent, complete = None, False
    try:
        df.write.parquet(path)
        complete = True
        if replaces is not None:
            intent = _declare(spark, warehouse, replaces, path, fmt)
        yield spark.read.schema(df.schema).parquet(path)
    except BaseException as error:
        if intent is not None or (guards and complete):
            note = f"the rows being written are kept in {path}"
            error.add_note(note)
            log.error(note)
        else:
            remove(spark, path)
        raise
    if intent is not None:
        remove(spark, intent)
    remove(spark, path)
