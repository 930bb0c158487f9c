"""What a batch has that the stored table does not: change detection for repeated feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.operators.rollup import bar_identity
from barlake.schemas import BAR_SCHEMA

_VALUES = ["open", "high", "low", "close", "volume"]


def changed_bars(bars: DataFrame, stored: DataFrame) -> DataFrame:
    """One row for each bar of ``bars`` that ``stored`` has not, or has with other values by now.

    Both have the bronze columns; ``bars`` is a batch, all with one id, ``stored`` the table, best cut to the batch's days. A bar is known
    by its symbol and time, or without a time by its values. What counts as stored is
    the version of the latest batch, so a value that goes back to an earlier one is a change. Of several
    versions within the batch, or in one stored batch, the greatest values count, as in ``dedup_latest``. NULL equals NULL.

    One aggregate over both tables: versions are combined before the shuffle, so a
    bar that was sent many times is no hot key, and no join is needed.
    """
    values = F.struct(*_VALUES)
    sides = bars.withColumn("_new", F.lit(True)).unionByName(stored.withColumn("_new", F.lit(False)))
    newest = F.max(F.when(~F.col("_new"), F.struct("batch_id", *_VALUES)))
    found = sides.groupBy("partition", *bar_identity()).agg(
        F.max(F.when(F.col("_new"), F.col("batch_id"))).alias("batch_id"),
        F.max(F.when(F.col("_new"), values)).alias("_sent"),
        F.count_if(~F.col("_new")).alias("_versions"),
        F.struct(*[newest[c].alias(c) for c in _VALUES]).alias("_stored"),
    )
    differs = ~F.col("_sent").eqNullSafe(F.col("_stored"))
    fresh = found.filter(F.col("_sent").isNotNull() & ((F.col("_versions") == 0) | differs))
    return fresh.select("*", "_sent.*").select(*BAR_SCHEMA.fieldNames())
