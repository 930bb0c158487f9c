"""Catalog tables over the same folders, for SQL users."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from barlake.schemas import DAILY_TRADES, TRADE, Table
from barlake.sources.files import age, folder_of, names_in, path_exists, qualified, remove
from barlake.sources.tables import aligned, clustered


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def _create(spark: SparkSession, table: Table, path: str, database: str, fmt: str) -> None:
    """Drop and create an external table; dropping it leaves its files alone."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema)
    name = f"{_quoted(database)}.{table.name}"
    location = table.path(path).replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)}")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING {fmt} "
        f"PARTITIONED BY ({table.partition}) LOCATION '{location}'"
    )
    if path_exists(spark, table.path(path)):
        sync_partitions(spark, table, database, fmt)


def create_tables(
    spark: SparkSession, path: str, database: str = "barlake", fmt: str = "parquet"
) -> None:
    """Database and bronze table over ``path``."""
    _create(spark, TRADE, path, database, fmt)


def create_silver_tables(
    spark: SparkSession, path: str, database: str = "barlake", fmt: str = "parquet"
) -> None:
    """Database and silver table over ``path``."""
    _create(spark, DAILY_TRADES, path, database, fmt)


def drop_silver_tables(spark: SparkSession, database: str = "barlake") -> None:
    if spark.catalog.databaseExists(database):
        spark.sql(f"DROP TABLE IF EXISTS {_quoted(database)}.{DAILY_TRADES.name}")


def drop_tables(spark: SparkSession, database: str = "barlake") -> None:
    """Drop both tables, then the database, which must be empty by then."""
    if spark.catalog.databaseExists(database):
        drop_silver_tables(spark, database)
        spark.sql(f"DROP TABLE IF EXISTS {_quoted(database)}.{TRADE.name}")
        spark.sql(f"DROP DATABASE IF EXISTS {_quoted(database)}")


#: Days that one statement announces.
_DAYS_AT_ONCE = 500


def sync_partitions(
    spark: SparkSession,
    table: Table,
    database: str = "barlake",
    fmt: str = "parquet",
    days: DataFrame | None = None,
) -> None:
    """Make days written by path visible to the catalog table.

    With ``days`` (``_day``, as ``distinct_days`` gives them) those are added, which
    the driver goes through one by one, as the catalog holds one entry for each;
    otherwise all folders are listed. Files that a rewrite has replaced are forgotten.
    """
    name = f"{_quoted(database)}.{table.name}"
    if fmt != "delta":
        if days is None:
            spark.catalog.recoverPartitions(name)
        else:
            _announce(spark, table, name, days)
    spark.catalog.refreshTable(name)


def _announce(spark: SparkSession, table: Table, name: str, days: DataFrame) -> None:
    undated, held = False, []

    def add() -> None:
        if held:
            specs = " ".join(f"PARTITION ({table.partition}='{day}')" for day in held)
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {specs}")
            held.clear()

    for row in days.toLocalIterator():
        if row["_day"] == "":
            undated = True
            continue
        held.append(row["_day"])
        if len(held) == _DAYS_AT_ONCE:
            add()
    add()
    if undated:
        # The folder of rows without a day has no name that a statement could give.
        spark.catalog.recoverPartitions(name)


def insert_table(df: DataFrame, table: Table, database: str = "barlake") -> None:
    """Append to a catalog table by column name.

    ``insertInto`` goes by position and the catalog moves partition columns to
    the end, so the columns are put in the catalog's order last.
    """
    name = f"{_quoted(database)}.{table.name}"
    order = df.sparkSession.table(name).columns
    clustered(aligned(df, table), table).select(*order).write.insertInto(name)


# --- days replaced by location ------------------------------------------------


def _versions(table: Table, warehouse: str) -> str:
    return f"{warehouse.rstrip('/')}/{table.name}_versions"


def swap_days(rows: DataFrame, table: Table, database: str, warehouse: str) -> None:
    """Replace days of a catalog table without a moment in which one is not there.

    ``rows`` are all there is for their days. They are written to a folder of their own, then the catalog
    is told, day by day, that the day is there: a statement each, after which new readers get the new day,
    while those that have begun go on with the old files. A reader in between gets the old day or the
    new one. The old folders go later, by :func:`drop_unused`.

    From then on the days are where the catalog says: read them by the table's name, not by path, and
    replace them by this function only. Repeating it changes nothing.
    """
    spark = rows.sparkSession
    name = f"{_quoted(database)}.{table.name}"
    folder = f"{_versions(table, warehouse)}/{time.time_ns():020}-{uuid.uuid4().hex}"
    clustered(aligned(rows, table), table).write.partitionBy(table.partition).parquet(folder)
    prefix = f"{table.partition}="
    for found in names_in(spark, folder):
        if found.startswith(prefix):
            _point(spark, name, table.partition, found.removeprefix(prefix), f"{folder}/{found}")
    spark.catalog.refreshTable(name)


#: What the folder of rows without a day is called.
_NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def _point(spark: SparkSession, name: str, column: str, day: str, folder: str) -> None:
    location = folder.replace("\\", "\\\\").replace("'", "\\'")
    value = "NULL" if day == _NO_DAY else f"'{day}'"
    spec = f"PARTITION ({column}={value})"
    spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {spec} LOCATION '{location}'")
    spark.sql(f"ALTER TABLE {name} {spec} SET LOCATION '{location}'")


def drop_unused(
    spark: SparkSession, table: Table, database: str, warehouse: str, seconds: float = 86_400
) -> int:
    """Remove day folders that the catalog names no more, and how many there were.

    Only those that are older than ``seconds``: a reader that began before a swap must have ended by
    then. What the catalog names is taken from the files that it would read.
    """
    name = f"{_quoted(database)}.{table.name}"
    spark.catalog.refreshTable(name)
    used = {folder_of(spark, file) for file in spark.table(name).inputFiles()}
    roots = [table.path(warehouse)]
    versions = _versions(table, warehouse)
    roots += [f"{versions}/{version}" for version in names_in(spark, versions)]
    dropped = 0
    for root in roots:
        left = [n for n in names_in(spark, root) if n.startswith(f"{table.partition}=")]
        for day in list(left):
            path = f"{root}/{day}"
            if qualified(spark, path) not in used and age(spark, path) >= seconds:
                remove(spark, path)
                left.remove(day)
                dropped += 1
        if not left and root != roots[0] and age(spark, root) >= seconds:
            remove(spark, root)
    return dropped
