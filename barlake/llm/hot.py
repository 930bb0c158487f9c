"""Joins whose hot keys are broadcast, so that no task gets more than its share of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key with more than one in so many of the left rows is hot. Fewer than this many are.
SHARE = 4096


def join_by_share(
    left: DataFrame, right: DataFrame, on: list[str], meets: str, total: int, how: str = "inner"
) -> DataFrame:
    """``left`` joined with ``right`` (a written table, one row per key) on columns never null.

    ``meets`` is a column of ``right``: how many rows of ``left`` have the key; ``total`` is
    their number. Keys with more than one in ``SHARE`` rows are broadcast, which are
    fewer than ``SHARE`` rows; the others are joined by a shuffle, whose keys are
    that small then. ``left`` is read twice. ``meets`` is not in the result.
    """
    hot = F.col(meets) * SHARE > F.lit(total)
    heavy = right.filter(hot).drop(meets)
    light = right.filter(~hot).drop(meets)
    rest = left.join(F.broadcast(heavy.select(*on)), on, "left_anti")
    return left.join(F.broadcast(heavy), on).unionByName(rest.join(light, on, how))
