"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm.storage import written


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node it is linked with, from pairs ``a``, ``b``.

    Large and small stars by turns: every node's larger neighbours are handed to its
    smallest one, then its smaller ones, until nothing moves. The number of edges
    does not grow, and a round is two aggregates with partial combining and two joins
    back. The aggregates are written first: both sides of a join are plain shuffles then, whose hot keys adaptive
    execution splits. Rounds are few (logarithmic in
    practice); each is written. Nulls and loops are left out; nodes without another
    one do not appear.
    """
    pairs = edges.filter("a <> b").select(
        F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")
    )
    now = written(pairs.distinct(), "edges")
    state = _state(now)
    while True:
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            now.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        least = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        large = (
            both.join(least, "u")
            .filter("v > u")
            .select(F.col("v").alias("hi"), F.col("m").alias("lo"))
            .distinct()
        )
        large = written(large, "large")
        least = written(large.groupBy("hi").agg(F.min("lo").alias("m")), "least")
        ends = F.explode(F.array("hi", "lo")).alias("hi")
        small = large.join(least, "hi").select(ends, F.col("m").alias("lo"))
        now = written(small.filter("hi <> lo").distinct(), "edges")
        before, state = state, _state(now)
        if state == before:
            break
    roots = now.select(F.col("lo").alias("node")).distinct()
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(
        roots.select("node", F.col("node").alias("root"))
    )


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo"))).first())
