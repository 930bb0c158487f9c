"""Daily roll-up of bars, per-bar annotation and removal of repeated bars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The columns of the daily table, in the order rows are given.
DAILY_COLUMNS = [
    "trade_date",
    "symbol",
    "daily_open",
    "daily_close",
    "daily_high",
    "daily_low",
    "daily_volume",
]
_VALUES = ["open", "high", "low", "close", "volume"]


def with_trade_date(bars: DataFrame) -> DataFrame:
    """Add ``trade_date`` unless the bars already have it."""
    if "trade_date" in bars.columns:
        return bars
    return bars.withColumn("trade_date", F.to_date("trade_timestamp"))


def daily_rollup(bars: DataFrame) -> DataFrame:
    """One row per ``(trade_date, symbol)``: open, close, high, low, volume.

    A single hash aggregate with partial aggregation: what is shuffled is one
    row per group and input task, so a symbol that holds most of the bars costs
    no more than any other. The first and last bar keep their NULLs; high, low
    and volume skip them. The result is not sorted: sorting is for display.

    Bars without a time come before all others. Several of them in a group have no
    order, so their smallest open and, where no bar has a time, their largest close
    counts, whatever the partitioning.
    """
    bars = with_trade_date(bars)
    when = F.col("trade_timestamp")
    untimed = F.count_if(when.isNull()) > 0
    first = F.when(untimed, F.min(F.when(when.isNull(), F.col("open"))))
    last = F.when(F.count(when) > 0, F.max_by("close", when))
    return (
        bars.groupBy("trade_date", "symbol")
        .agg(
            first.otherwise(F.min_by("open", when)).alias("daily_open"),
            last.otherwise(F.max("close")).alias("daily_close"),
            F.max("high").alias("daily_high"),
            F.min("low").alias("daily_low"),
            F.sum("volume").alias("daily_volume"),
        )
        .select(*DAILY_COLUMNS)
    )


def annotate_daily(bars: DataFrame) -> DataFrame:
    """Every bar beside the daily values of its ``(trade_date, symbol)``.

    Rolled up and joined back rather than computed by windows: a window sends a
    whole group to one task, whereas the aggregate is combined before the
    shuffle and the join (one row per group on the right side) is broadcast
    when small and split by adaptive execution when a group is hot.

    The bars are read twice, once only the columns that are rolled up: pass a
    stored table rather than a plan that is dear to evaluate.
    """
    bars = with_trade_date(bars)
    daily = daily_rollup(bars).select(
        F.col("trade_date").alias("_day"),
        F.col("symbol").alias("_symbol"),
        *[c for c in DAILY_COLUMNS if c.startswith("daily_")],
    )
    same_group = bars["trade_date"].eqNullSafe(F.col("_day")) & bars["symbol"].eqNullSafe(
        F.col("_symbol")
    )
    # Inner: each bar has exactly one match, the group it was counted in.
    return bars.join(daily, same_group).drop("_day", "_symbol")


def daily_distinct(annotated: DataFrame) -> DataFrame:
    """Distinct daily rows out of :func:`annotate_daily`."""
    return annotated.select(*DAILY_COLUMNS).distinct()


def bar_identity() -> list[Column]:
    """What makes two bars the same one: symbol and time, without a time the values."""
    unknown_time = F.when(F.col("trade_timestamp").isNull(), F.struct(*_VALUES))
    return [F.col("symbol"), F.col("trade_timestamp"), unknown_time.alias("_untimed")]


def days_with_repeats(bars: DataFrame) -> DataFrame:
    """``partition`` of stored bars that are there more than once, with repeats."""
    counts = bars.groupBy("partition", *bar_identity()).agg(F.count(F.lit(1)).alias("_n"))
    return counts.filter("_n > 1").select("partition")


def dedup_latest(bars: DataFrame) -> DataFrame:
    """One bar per ``(symbol, trade_timestamp)``: the one of the latest batch.

    Equal batches are decided by the values, in column order, so the outcome
    does not depend on row order. Bars without a timestamp have no identity, so
    for them only equal values count as a repeat.

    ``row_number() = 1`` lets the optimizer cut each group to one row per task
    before the shuffle, so a bar that was sent many times is no hot key.
    """
    window = Window.partitionBy(*bar_identity()).orderBy(
        F.desc("batch_id"), *[F.desc(c) for c in _VALUES]
    )
    return (
        bars.withColumn("_rank", F.row_number().over(window))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )
