"""Mixing sources to target weights by Pareto order sampling. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.llm.storage import global_rank, written

WORD = r"[^\x20\x09-\x0D]+"
#: Steps of the odds ratio by which the threshold is searched; see :func:`pareto_mix`.
BINS = 1024


#: Names that the mix uses itself.
_OWN = {
    "doc_id", "source", "size", "source_size", "target", "copies", "taken",
    "_hash", "_source", "_each", "_whole", "_p", "_want", "_cap", "_weight",
    "_u", "_odds", "_step", "_at", "_cross", "_before", "_pick",
}


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: Sequence[int], share: float, cap: float
) -> DataFrame:
    """``source``, ``source_size``, ``target`` from rows of ``source`` and ``size``.

    Sources in code point order, null last, take the weights in turn, repeating.
    They share ``share`` times all sizes by weight; a target stops at ``cap`` times
    its source's size and what is over goes to the others by weight, until none is
    above. Each round is one aggregate over the table of sources, and at least one
    source more is at its cap after it.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    totals = totals.withColumn("_null", F.col("source").isNull())
    ranked = global_rank(totals, ["_null", "source"], "_rank").drop("_null")
    turn = (F.col("_rank") % len(weights) + 1).cast("int")
    weighted = ranked.withColumn(
        "_weight", F.element_at(F.array(*[F.lit(int(w)) for w in weights]), turn)
    ).drop("_rank")
    weighted = written(weighted.withColumn("_cap", F.col("source_size") * F.lit(float(cap))), "mix")
    total = weighted.agg(F.sum("source_size")).first()[0] or 0
    budget, level, at_cap = float(total) * share, 0.0, -1
    while True:
        capped = F.col("_cap") <= F.col("_weight") * F.lit(level)
        row = weighted.agg(
            F.count_if(capped).alias("n"),
            F.sum(F.when(capped, F.col("_cap"))).alias("full"),
            F.sum(F.when(~capped, F.col("_weight"))).alias("open"),
        ).first()
        if row["n"] == at_cap or not row["open"]:
            break
        at_cap, level = row["n"], (budget - (row["full"] or 0.0)) / row["open"]
    target = F.least(F.col("_cap"), F.col("_weight") * F.lit(level))
    if row["n"] and not row["open"]:
        target = F.col("_cap")
    return weighted.select("source", "source_size", target.alias("target"))


def pareto_mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    cap: float = 2.0,
    seed: int = 0,
    carry: Sequence[str] = (),
) -> DataFrame:
    """How often each document is taken so that sources meet their target sizes.

    A document of a source with target ``t`` and size ``s`` should be taken
    ``t / s`` times. The whole part is allocated for certain; the rest is its
    inclusion probability ``p``. Documents are ranked by their random odds over
    their inclusion odds, ``(u / (1 - u)) / (p / (1 - p))``, and each source takes
    the front of that order up to the number of words it still wants: the sample
    has a fixed size, and a source misses its target by half a document at most.
    ``u`` is a hash of the seed, the id and the text, so reruns agree.

    The front is found without sorting a source: sizes are summed by source and
    step of the ranking (map-side), the step that crosses the target is looked up,
    and only the rows of that step are put in order. A source at a whole number of
    copies has nothing to choose: none of its rows are. A source may hold any share
    of the rows.

    Returns ``doc_id``, ``source``, ``size``, ``source_size``, ``target``,
    ``copies``, ``taken`` (``copies * size``) and the (narrow) columns named in
    ``carry``, a row for each input row. Null text has size 0. A null source is a
    source; null ids are ids. Rows that are wholly equal tie and their order does not
    matter. An empty table gives an empty one. Other columns are not read. A column to carry must not be called as one of the
    results, or as the columns that the operator works with: that is an error.
    """
    clashing = {c.lower() for c in carry} & _OWN
    if clashing:
        raise ValueError(f"cannot carry columns called {sorted(clashing)}")
    sizes = written(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).alias("source"),
            word_count(F.col(text_col)).alias("size"),
            F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)).alias("_hash"),
            *carry,
        ),
        "sizes",
    )
    targets = source_targets(sizes, weights, share, cap)
    per_copy = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
    plan = (
        targets.withColumn("_each", F.coalesce(per_copy, F.lit(0.0)))
        .withColumn("_whole", F.floor("_each"))
        .withColumn("_p", F.col("_each") - F.col("_whole"))
        .withColumn("_want", F.col("target") - F.col("_whole") * F.col("source_size"))
        .withColumnRenamed("source", "_source")
    )
    u = (F.shiftrightunsigned("_hash", 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    ranked = (
        sizes.join(plan, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("_u", u)
        # p = 0 puts every document behind, at the last step.
        .withColumn(
            "_odds",
            F.when(
                F.col("_p") > 0,
                F.col("_u") / (1 - F.col("_u")) * (1 - F.col("_p")) / F.col("_p"),
            ).otherwise(F.lit(float("inf"))),
        )
        .withColumn(
            "_step",
            F.when(F.col("_p") > 0, F.floor(BINS * F.col("_odds") / (1 + F.col("_odds"))))
            .otherwise(BINS)
            .cast("int"),
        )
    )
    # Sources with p = 0 have no crossing step, and no rows to put in order.
    steps = ranked.filter("_p > 0").groupBy("source", "_step").agg(
        F.sum("size").alias("_sum"), F.max("_want").alias("_want")
    )
    upto = Window.partitionBy("source").orderBy("_step").rowsBetween(Window.unboundedPreceding, 0)
    steps = steps.withColumn("_upto", F.sum("_sum").over(upto))
    # A row for each source at most, written so that its size is known: rows of a hot source are not
    # shuffled by it.
    crossing = written(
        steps.filter(F.col("_upto") > F.col("_want"))
        .groupBy(F.col("source").alias("_at"))
        .agg(
            F.min("_step").alias("_cross"),
            F.min_by(F.col("_upto") - F.col("_sum"), "_step").alias("_before"),
        ),
        "crossing",
    )
    placed = ranked.join(crossing, F.col("source").eqNullSafe(F.col("_at")), "left")
    last = F.coalesce(F.col("_cross"), F.lit(BINS + 1))
    cut = placed.filter(F.col("_step") == last)
    order = Window.partitionBy("source").orderBy("_odds", "_hash")
    running = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    cut = cut.withColumn("_pick", F.col("_before") + running - F.col("size") / 2 <= F.col("_want"))
    rest = placed.filter(F.col("_step") != last).withColumn(
        "_pick", (F.col("_step") < last) & (F.col("_p") > 0)
    )
    copies = (F.col("_whole") + F.col("_pick").cast("int")).cast("long")
    return (
        rest.unionByName(cut)
        .withColumn("copies", copies)
        .select(
            "doc_id",
            "source",
            "size",
            "source_size",
            "target",
            "copies",
            (F.col("copies") * F.col("size")).alias("taken"),
            *carry,
        )
    )
