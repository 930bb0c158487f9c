"""Schemas and table definitions shared by every module."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Names, types and order of the columns of the two tables.

# Bronze: one row per intraday bar, in table column order.
BAR_SCHEMA = T.StructType(
    [
        T.StructField("batch_id", T.LongType()),
        T.StructField("trade_timestamp", T.TimestampType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("volume", T.IntegerType()),
        T.StructField("partition", T.StringType()),
    ]
)

# Silver: one row per (trade_date, symbol), in table column order.
DAILY_SCHEMA = T.StructType(
    [
        T.StructField("trade_date", T.DateType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("daily_volume", T.LongType()),
        T.StructField("daily_high", T.DoubleType()),
        T.StructField("daily_low", T.DoubleType()),
        T.StructField("daily_open", T.DoubleType()),
        T.StructField("daily_close", T.DoubleType()),
    ]
)

# Payloads that could not be turned into bars, with the reason.
REJECT_SCHEMA = T.StructType(
    [
        T.StructField("batch_id", T.LongType()),
        T.StructField("reason", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)

# Payloads of batches that failed their checks, with what failed.
QUARANTINE_SCHEMA = T.StructType(
    [
        T.StructField("batch_id", T.LongType()),
        T.StructField("failed", T.ArrayType(T.StringType())),
        T.StructField("value", T.StringType()),
    ]
)

# One row per data-quality check.
CHECK_RESULT_SCHEMA = T.StructType(
    [
        T.StructField("dataset", T.StringType()),
        T.StructField("check", T.StringType()),
        T.StructField("column_list", T.StringType()),
        T.StructField("metric", T.StringType()),
        T.StructField("value", T.LongType()),
        T.StructField("comparator", T.StringType()),
        T.StructField("threshold", T.DoubleType()),
        T.StructField("passed", T.BooleanType()),
    ]
)

# One row per group of rows and check; ``by`` names the columns, ``group`` their values.
GROUPED_RESULT_SCHEMA = T.StructType(
    [
        T.StructField("by", T.StringType()),
        T.StructField("group", T.ArrayType(T.StringType())),
        *CHECK_RESULT_SCHEMA.fields,
    ]
)

# Column order of the CSV extract.
CSV_COLUMNS = ["trade_timestamp", "symbol", "open", "high", "low", "close", "volume"]


@dataclass(frozen=True)
class Table:
    """A table: directory name under the warehouse, schema, partition column."""

    name: str
    schema: T.StructType
    partition: str | None = None

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    def path(self, warehouse: str) -> str:
        return f"{warehouse.rstrip('/')}/{self.name}"


TRADE = Table("trade", BAR_SCHEMA, "partition")
DAILY_TRADES = Table("daily_trades", DAILY_SCHEMA, "trade_date")
REJECTS = Table("rejects", REJECT_SCHEMA)
QUARANTINE = Table("quarantine", QUARANTINE_SCHEMA)
