"""Tables written to the folder all executors share, and small helpers around them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession, label: str) -> str:
    """An unused path under ``spark.checkpoint.dir``; under the warehouse where that is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_llm"
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as written once and read back.

    Cuts the lineage at files that outlive the executors. The files stay until
    the checkpoint folder is emptied, as those of ``DataFrame.checkpoint`` do.
    """
    path = shared_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def power_of_two(n: float) -> int:
    """The smallest power of two that is at least ``n`` (and at least 1)."""
    return 1 << max(0, int(n) - 1).bit_length() if n > 1 else 1


#: ``monotonically_increasing_id`` counts inside a partition in this many low bits.
PART_BITS = 33


def in_order(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` range-partitioned, sorted and written with a number that ascends in the order.

    The numbers have gaps: the partition is in the bits above ``PART_BITS``.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cols = [F.col(c) for c in order]
    placed = rows.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
    return written(placed.withColumn(name, F.monotonically_increasing_id()), "ordered")


def global_rank(keys: DataFrame, order: list[str], name: str) -> DataFrame:
    """Rows numbered from 0 in the order of the named columns, without one task for all.

    Rows are numbered inside their range partition, and shifted by the row counts of
    the partitions before it: the only table that meets in one task has a row for
    each partition.
    """
    placed = in_order(keys, order, "_place")
    part = F.shiftright("_place", PART_BITS)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    shifts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    inside = F.col("_place").bitwiseAND(F.lit((1 << PART_BITS) - 1))
    return (
        placed.join(F.broadcast(shifts), part == F.col("_part"))  # a row for each partition
        .withColumn(name, F.col("_shift") + inside)
        .drop("_part", "_place", "_shift")
    )
