"""Tables stored by path: read, write, replace days, CSV extract.

The format is Parquet unless given (``delta`` works where its jar is present).
"""

from __future__ import annotations

from contextlib import nullcontext
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.schemas import DAILY_TRADES, TRADE, Table
from barlake.sources.staging import path_exists, staged


def read_table(
    spark: SparkSession,
    table: Table,
    warehouse: str,
    condition: str | Column | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """A table in its column order, optionally filtered.

    The schema is given, not inferred: partition discovery would read a day
    written as text back as a date.
    """
    reader = spark.read.format(fmt)
    if fmt != "delta":
        reader = reader.schema(table.schema)
    df = reader.load(table.path(warehouse)).select(*table.columns)
    return df if condition is None else df.filter(condition)


def filter_bars(bars: DataFrame, date: str | None = None, symbol: str | None = None) -> DataFrame:
    """Bars of a day and/or a symbol; all of them if neither is given.

    ``date`` (``yyyy-MM-dd``) is compared with the partition column, so only that day's folder is
    read; ``symbol`` is pushed down to the files.
    """
    conditions = []
    if date:
        conditions.append(F.col("partition") == F.lit(str(date)))
    if symbol:
        conditions.append(F.col("symbol") == F.lit(symbol))
    return bars.filter(reduce(lambda a, b: a & b, conditions)) if conditions else bars


def read_bars(
    spark: SparkSession,
    warehouse: str,
    date: str | None = None,
    symbol: str | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Bronze bars with ``trade_date``, optionally of one day and/or symbol.

    ``trade_date`` is the stored day, not one cut from the timestamp again: it
    stays the same in any session time zone, and a filter on it prunes folders.
    """
    bars = filter_bars(read_table(spark, TRADE, warehouse, fmt=fmt), date, symbol)
    return bars.withColumn("trade_date", F.col("partition").cast("date"))


def _day_key(column: str) -> Column:
    """A partition value as text that is never NULL, so that plain equality finds it."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def distinct_days(df: DataFrame, column: str) -> DataFrame:
    """The values of a partition column, as ``_day`` (text, empty for NULL).

    To be staged before :func:`on_days` reads it, so that it is worked out once.
    """
    return df.select(_day_key(column).alias("_day")).distinct()


def on_days(df: DataFrame, column: str, days: DataFrame) -> DataFrame:
    """Rows of the given days, however many those are; prunes folders.

    A semi join. Spark prunes folders by one at run time if the condition is a plain
    equality and the days carry a comparison filter; it is there for that.
    """
    days = days.filter(F.col("_day") >= "")
    return df.join(days, _day_key(column) == F.col("_day"), "left_semi")


def aligned(df: DataFrame, table: Table) -> DataFrame:
    """Columns picked by name, in table order, with table types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in table.schema])


def clustered(df: DataFrame, table: Table) -> DataFrame:
    """Rows gathered by partition value, so that each day gets few files.

    ``rebalance`` is the shuffle that adaptive execution may split: a day that
    holds much of the data is written by several tasks, small days share one.
    Sorting by symbol inside a file lets a symbol filter skip row groups.
    """
    if table.partition is None:
        return df
    order = [table.partition, "symbol"]
    order += ["trade_timestamp"] if "trade_timestamp" in table.columns else []
    return df.hint("rebalance", F.col(table.partition)).sortWithinPartitions(*order)


def write_table(
    df: DataFrame,
    table: Table,
    warehouse: str,
    mode: str = "append",
    fmt: str = "parquet",
) -> None:
    """Write in any save mode; ``overwrite_days`` replaces only the days present in ``df``."""
    writer = clustered(aligned(df, table), table).write.format(fmt)
    if table.partition is not None:
        writer = writer.partitionBy(table.partition)
    if mode == "overwrite_days":
        writer, mode = writer.option("partitionOverwriteMode", "dynamic"), "overwrite"
    elif mode == "overwrite":
        # Whole-table overwrite, whatever the session default says.
        writer = writer.option("partitionOverwriteMode", "static")
    writer.mode(mode).save(table.path(warehouse))


def replace_days(
    new: DataFrame,
    warehouse: str,
    whole_days: bool = False,
    fmt: str = "parquet",
    written: bool = False,
    symbol: str | None = None,
) -> None:
    """Store recomputed daily rows in place of the ones they recompute.

    Repeating it changes nothing, unlike an append. With ``whole_days`` the new
    rows are all there is for their days, and the stored table is not read.
    Otherwise other symbols of those days are kept: their rows are read, from the
    folders of those days alone, and written again. With ``symbol`` all new rows are
    of that one and a filter tells the others; without, a null-safe join does (a NULL
    symbol or day must match itself).

    The rows to write are staged first, because the folders they are read from are
    the ones replaced; so are the new rows, which are read several times, unless they
    are ``written`` already. Days are published one by one as the job commits; one
    writer at a time is assumed. If publishing fails, ``recover`` completes it.
    """
    spark = new.sparkSession
    if whole_days or not path_exists(spark, DAILY_TRADES.path(warehouse)):
        write_table(new, DAILY_TRADES, warehouse, "overwrite_days", fmt)
        return
    new = aligned(new, DAILY_TRADES)
    with nullcontext(new) if written else staged(new, "replace-new", warehouse) as fresh:
        with staged(distinct_days(fresh, "trade_date"), "replace-of", warehouse) as days:
            stored = read_table(spark, DAILY_TRADES, warehouse, fmt=fmt)
            affected = on_days(stored, "trade_date", days)
            if symbol is not None:
                kept = affected.filter(~F.col("symbol").eqNullSafe(F.lit(symbol)))
            else:
                kept = _not_recomputed(fresh, affected)
            rows = kept.unionByName(fresh)
            with staged(rows, "replace-days", warehouse, replaces=DAILY_TRADES, fmt=fmt) as rows:
                write_table(rows, DAILY_TRADES, warehouse, "overwrite_days", fmt)


def _not_recomputed(fresh: DataFrame, stored: DataFrame) -> DataFrame:
    """Stored rows whose ``(trade_date, symbol)`` is not in ``fresh``."""
    keys = fresh.select(F.col("trade_date").alias("_day"), F.col("symbol").alias("_symbol"))
    same_day = stored["trade_date"].eqNullSafe(F.col("_day"))
    same_symbol = stored["symbol"].eqNullSafe(F.col("_symbol"))
    return stored.join(keys, same_day & same_symbol, "left_anti")


def write_csv(events: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Text bars as CSV with a header, in the DataFrame's column order.

    Values stay as they are: blanks are not trimmed, quotes are doubled as CSV
    readers outside Spark expect, and both NULL and empty text are empty fields.
    """
    options = {
        "header": True,
        "escape": '"',
        "emptyValue": "",
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
    }
    events.write.options(**options).mode(mode).csv(path)
