"""The measurements over made data too large to keep; prints one JSON line.

``python bench_large.py BARS [CPUS]``: so many bars of 500 symbols over 30 days are
made by Spark and written to a new temporary folder, a third of them in one symbol, and
with ``hot`` that third in one day too. Then the roll-up (and its window form), the
annotated bars, the dedup and the checks are timed once each, results not stored; and a
payload of 40,000 bars is parsed with and without a repeated time.
"""

from __future__ import annotations

import json
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import barlake as b  # noqa: E402
from bench import rollup_by_windows, run  # noqa: E402


def made_bars(spark: SparkSession, n: int, hot: bool) -> DataFrame:
    """``n`` bars, times distinct within a symbol and day as far as seconds go."""
    key = F.xxhash64("id")
    third = F.pmod(key, F.lit(3)) == 0
    symbol = F.when(third, 0).otherwise(F.pmod(F.shiftright(key, 8), F.lit(500)))
    day = F.pmod(F.shiftright(key, 20), F.lit(30))
    day = F.when(third, 0).otherwise(day) if hot else day
    seconds = F.lit(1704067200) + day * 86400 + F.pmod(F.shiftright(key, 30), F.lit(86400))
    price = (F.pmod(key, F.lit(1000)) / 10).cast("double")
    return spark.range(n).select(
        F.lit(1).cast("long").alias("batch_id"),
        seconds.cast("timestamp").alias("trade_timestamp"),
        F.concat(F.lit("S"), symbol).alias("symbol"),
        price.alias("open"),
        (price + 1).alias("high"),
        (price - 1).alias("low"),
        (price + 0.5).alias("close"),
        F.pmod(key, F.lit(500)).cast("int").alias("volume"),
        F.to_date(seconds.cast("timestamp")).cast("string").alias("partition"),
    )


def payload(n: int, repeated: bool) -> str:
    times = [f"2024-01-{1 + i // 86400:02} {i % 86400 // 3600:02}:{i % 3600 // 60:02}:{i % 60:02}" for i in range(n)]
    times += times[:1] * repeated
    bars = ",".join(f'"{t}":{{"1. open":"1","5. volume":"{i}"}}' for i, t in enumerate(times))
    return f'{{"Meta Data":{{"2. Symbol":"A"}},"S":{{{bars}}}}}'


def main(n: int, cpus: str) -> None:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="barlake-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}

    def timed(name: str, df: DataFrame) -> None:
        start = time.perf_counter()
        run(df)
        seconds[name] = round(time.perf_counter() - start, 2)

    for label, hot in (("even", False), ("hot", True)):
        path = tempfile.mkdtemp(prefix="barlake-bench-") + "/bars"
        made_bars(spark, n, hot).write.parquet(path)
        bars = spark.read.parquet(path)
        run(b.daily_rollup(bars))
        timed(f"daily_rollup_{label}", b.daily_rollup(bars))
        timed(f"rollup_by_windows_{label}", rollup_by_windows(spark, bars))
        timed(f"annotate_daily_{label}", b.annotate_daily(bars))
        timed(f"dedup_latest_{label}", b.dedup_latest(bars))
        # An equal poll: everything is there already.
        timed(f"changed_bars_{label}", b.changed_bars(bars.withColumn("batch_id", F.lit(2)), bars))
        timed(f"checks_by_day_{label}", b.run_checks_by(bars, "trade", ["partition"], ["symbol"]))
        timed(f"bronze_checks_{label}", b.run_checks(bars, "trade"))
    for repeated in (False, True):
        raw = spark.createDataFrame([(payload(40_000, repeated),)], "value string")
        run(b.normalize_payloads(raw, 1)[0])
        timed(f"payload_of_40000_{'repeated' if repeated else 'plain'}", b.normalize_payloads(raw, 1)[0])
    print(json.dumps({"bars": n, "cpus": int(cpus), "seconds": seconds}))
    spark.stop()


if __name__ == "__main__":
    main(int(sys.argv[1]), sys.argv[2] if len(sys.argv) > 2 else "8")
