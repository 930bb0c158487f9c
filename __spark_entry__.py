"""

``entry`` is the smoke check, ``queries`` the operators run over the given
tables, ``oracle_sql`` the same results as DuckDB SQL.

Bars come from ``events`` (see ``barlake.sources.adapters``): an event type is a
symbol. Queries that write do so in a fresh folder of the shared staging area.
"""

from __future__ import annotations

import importlib
import importlib.util
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import barlake as b
from barlake.operators.normalize import parse_payloads
from barlake.operators.rollup import DAILY_COLUMNS
from barlake.plans.pipeline import loaded
from barlake.sources.staging import new_dir, remove, staged
from barlake.sources.adapters import bars_to_payloads, events_to_bars

DATE = "2024-01-05"
SYMBOL = "click"
BATCH = 1


# --- inputs -----------------------------------------------------------------


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _bars(spark: SparkSession, sf_dir: str, batch_id: int = BATCH) -> DataFrame:
    return events_to_bars(_table(spark, sf_dir, "events"), batch_id)


def _payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars_to_payloads(_bars(spark, sf_dir))


def _wall_clock(bars: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the given tables have them."""
    ts = F.col("trade_timestamp").cast("timestamp_ntz")
    return bars.withColumn("trade_timestamp", ts)


def _bronze(spark: SparkSession, sf_dir: str, label: str) -> str:
    """A fresh warehouse whose bronze table holds all bars."""
    warehouse = new_dir(spark, label)
    b.write_table(_bars(spark, sf_dir), b.TRADE, warehouse)
    return warehouse


def _land_files(payloads: DataFrame, folder: str) -> None:
    """Land payloads in the ``files`` layout: one file each, spread over several lines."""
    spread = F.regexp_replace("value", r"\},", "},\n")
    one_each = payloads.select(spread.alias("value"))
    writer = one_each.withColumn("payload", F.xxhash64("value")).write
    writer.option("maxRecordsPerFile", 1).partitionBy("payload").text(folder)


def _land(payloads: DataFrame, folder: str, part: str) -> None:
    """Land payloads in the ``lines`` layout."""
    payloads.write.text(f"{folder}/{part}")


# --- roll-up, annotation, sorts, distinct -----------------------------------


def daily_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.daily_rollup(_bars(spark, sf_dir))


def daily_rollup_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULL prices stay if first or last, NULL volumes are skipped, NULL symbols group."""
    symbol, volume = F.col("symbol"), F.col("volume")
    bars = _bars(spark, sf_dir).select(
        "trade_timestamp",
        F.when(symbol != "error", symbol).alias("symbol"),
        F.when(volume >= 40, F.col("open")).alias("open"),
        "high",
        F.when(volume >= 20, F.col("low")).alias("low"),
        F.when(volume < 60, F.col("close")).alias("close"),
        F.when(symbol != "view", volume).alias("volume"),
    )
    return b.daily_rollup(bars)


def daily_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.daily_rollup(_bars(spark, sf_dir)).orderBy("trade_date", "symbol")


def _daily_part(*columns: str) -> Callable[[SparkSession, str], DataFrame]:
    """Only some of the daily values; the others are pruned from the plan."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return daily_rollup(spark, sf_dir).select("trade_date", "symbol", *columns)

    return query


def annotate_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.annotate_daily(_bars(spark, sf_dir)).drop("batch_id", "partition")


def _annotated_part(*columns: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return annotate_daily(spark, sf_dir).select("trade_timestamp", "symbol", *columns)

    return query


def daily_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.daily_distinct(b.annotate_daily(_bars(spark, sf_dir)))


def daily_one_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    annotated = b.annotate_daily(_bars(spark, sf_dir)).select(*DAILY_COLUMNS)
    return annotated.dropDuplicates(["trade_date", "symbol"])


# --- projections, filters, casts --------------------------------------------


def bars_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bar columns that parsing selects, renames and casts."""
    return normalize_payloads(spark, sf_dir).drop("batch_id", "partition")


def bars_with_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The partition that parsing takes from the time, as the stored table has it."""
    bars, _ = b.normalize_payloads(_payloads(spark, sf_dir), BATCH)
    warehouse = new_dir(spark, "partition")
    b.write_table(bars, b.TRADE, warehouse)
    return _wall_clock(b.read_table(spark, b.TRADE, warehouse))


def bars_with_trade_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = b.with_trade_date(_bars(spark, sf_dir))
    return b.with_trade_date(bars).select("trade_timestamp", "symbol", "trade_date")


def bars_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.filter_bars(_bars(spark, sf_dir))


def bars_on_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.filter_bars(_bars(spark, sf_dir), date=DATE)


def bars_for_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.filter_bars(_bars(spark, sf_dir), symbol=SYMBOL)


def bars_date_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.filter_bars(_bars(spark, sf_dir), date=DATE, symbol=SYMBOL)


def lenient_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good text is cast, fractions are cut, bad and too large text is NULL."""
    k = F.get_json_object("props", "$.k")
    too_large = (F.col("event_id") + F.lit(3_000_000_000)).cast("string")
    return _table(spark, sf_dir, "events").select(
        "event_id",
        b.text_to_int(k).alias("whole"),
        b.text_to_int(F.concat(F.lit(" "), k, F.lit(".7 "))).alias("fraction"),
        b.text_to_int(F.col("props")).alias("bad_int"),
        b.text_to_int(too_large).alias("too_large"),
        b.text_to_double(F.col("value").cast("string")).alias("price"),
        b.text_to_double(F.col("event_type")).alias("bad_price"),
        b.text_to_timestamp(F.col("ts").cast("string")).cast("timestamp_ntz").alias("time"),
        b.text_to_timestamp(F.col("event_type")).cast("timestamp_ntz").alias("bad_time"),
    )


# --- payloads ---------------------------------------------------------------


def normalize_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars, _ = b.normalize_payloads(_payloads(spark, sf_dir), BATCH)
    return _wall_clock(bars)


def landed_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = new_dir(spark, "landing")
    _land(_payloads(spark, sf_dir), landing, "day")
    bars, _ = b.normalize_payloads(b.read_payloads(spark, landing, "lines"), BATCH)
    return _wall_clock(bars)


def landed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A payload per file, as the default layout has it: many lines, read as one text."""
    landing = new_dir(spark, "files")
    _land_files(_payloads(spark, sf_dir), landing)
    bars, _ = b.normalize_payloads(b.read_payloads(spark, landing), BATCH)
    return _wall_clock(bars)


def payload_repeated_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every time twice in its payload, first with other values: the last one counts."""
    series = F.regexp_replace("value", r'("[0-9-]+ [0-9:.]+"):\{[^}]*\}', '$1:{"1. open":"-1"}')
    inner = r"^(.*\{)(\"[0-9-]+ .*)(\}\})$"
    once = F.regexp_extract(series, inner, 2)
    twice = F.concat(
        F.regexp_extract("value", inner, 1), once, F.lit(","), F.regexp_extract("value", inner, 2),
        F.regexp_extract("value", inner, 3),
    )
    payloads = _payloads(spark, sf_dir).select(twice.alias("value"))
    return _wall_clock(b.normalize_payloads(payloads, BATCH)[0])


def payload_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text stage, cast for comparison."""
    events = b.payload_events(_payloads(spark, sf_dir))
    return events.select(
        F.col("trade_timestamp").cast("timestamp_ntz").alias("trade_timestamp"),
        "symbol",
        *[F.col(c).cast("double").alias(c) for c in ("open", "high", "low", "close")],
        F.col("volume").cast("int").alias("volume"),
    )


def payload_overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Symbol and time given inside a bar win; without any symbol it is ``N/A``."""
    inner = F.to_json(
        F.struct(
            F.col("open").cast("string").alias("1. open"),
            F.col("volume").cast("string").alias("5. volume"),
            F.when(F.col("symbol") != SYMBOL, F.col("symbol")).alias("symbol"),
            F.col("trade_timestamp").cast("string").alias("trade_timestamp"),
        )
    )
    payloads = _bars(spark, sf_dir).select(
        F.concat(F.lit('{"Meta Data":{},"S":{"t":'), inner, F.lit("}}")).alias("value")
    )
    bars, _ = b.normalize_payloads(payloads, BATCH)
    return _wall_clock(bars).drop("partition")


def payload_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payload per event, broken in a way that depends on the event type."""
    kind, time = F.col("event_type"), F.col("ts").cast("string")
    meta = '"Meta Data":{"2. Symbol":"A"}'
    payloads = _table(spark, sf_dir, "events").select(
        F.when(kind == "view", F.concat(F.lit(f'{{{meta},"S":{{"'), time, F.lit('":')))
        .when(kind == "signup", F.concat(F.lit('{"Information":"'), time, F.lit('"}')))
        .when(kind == "purchase", F.lit(f"{{{meta}}}"))
        .when(kind == "error", F.lit(f'{{{meta},"S":{{}}}}'))
        .otherwise(F.concat(F.lit(f'{{{meta},"S":{{"'), time, F.lit('":{}}}')))
        .alias("value")
    )
    outcome = F.coalesce("reason", F.lit("accepted")).alias("outcome")
    return parse_payloads(payloads, BATCH).groupBy(outcome).agg(F.count(F.lit(1)).alias("n"))


def rejected_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that are no payloads at all are rejected whole, none lost."""
    texts = _table(spark, sf_dir, "documents").select(F.col("text").alias("value"))
    _, rejects = b.normalize_payloads(texts, BATCH)
    return rejects.groupBy("batch_id", "reason").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("value")).alias("n_chars")
    )


# --- data quality -----------------------------------------------------------


def dq_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.run_checks(_bars(spark, sf_dir), "trade", [b.row_count()])


def dq_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A symbol is blanked out, so that there is something to find."""
    symbol = F.when(F.col("symbol") != SYMBOL, F.col("symbol"))
    bars = _bars(spark, sf_dir).withColumn("symbol", symbol)
    return b.run_checks(bars, "trade", [b.missing_count("symbol"), b.missing_count("open")])


def dq_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = [
        b.duplicate_count("symbol", "partition"),
        b.duplicate_count("trade_timestamp"),
        b.duplicate_count("symbol", "partition", comparator=">=", threshold=1),
    ]
    return b.run_checks(_bars(spark, sf_dir), "trade", checks)


def dq_invalid_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = [b.invalid_count("volume", valid_min=50), b.invalid_count("open", valid_min=0)]
    return b.run_checks(_bars(spark, sf_dir), "trade", checks)


def dq_bronze_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.run_checks(_bars(spark, sf_dir), "trade")


def dq_silver_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.run_checks(daily_rollup(spark, sf_dir), "daily_trades")


def _faulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver with repeated keys, missing days and negative values."""
    daily, mine = daily_rollup(spark, sf_dir), F.col("symbol") == SYMBOL
    negative = daily.withColumns(
        {
            "daily_open": F.when(mine, -F.col("daily_open")).otherwise(F.col("daily_open")),
            "daily_volume": F.col("daily_volume") - 2000,
        }
    )
    undated = daily.filter(~mine).withColumn("trade_date", F.lit(None).cast("date"))
    return negative.unionByName(daily.filter(mine)).unionByName(undated)


def dq_silver_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.run_checks(_faulty(spark, sf_dir), "daily_trades")


def dq_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver checks for each day and for each symbol, out of one pass over faulty rows."""
    results = b.run_checks_by(_faulty(spark, sf_dir), "daily_trades", ["trade_date"], ["symbol"])
    return results.select(
        F.col("by").alias("grouping"),
        F.col("group")[0].alias("value_of_group"),
        F.col("check"),
        F.col("value"),
        F.col("passed"),
    )


def dq_lineitem_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = [
        b.row_count(),
        b.missing_count("l_shipdate"),
        b.duplicate_count("l_orderkey", "l_linenumber"),
        b.duplicate_count("l_orderkey"),
        b.invalid_count("l_quantity", valid_min=10),
    ]
    return b.run_checks(_table(spark, sf_dir, "lineitem"), "lineitem", checks)


def dq_view_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checked data stays available to SQL under the name of its check set."""
    b.run_checks(_bars(spark, sf_dir), "trade", view=True)
    return spark.sql(
        "SELECT symbol, count(*) AS n, max(volume) AS max_volume FROM trade GROUP BY symbol"
    )


# --- tables -----------------------------------------------------------------


def bronze_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _wall_clock(b.read_table(spark, b.TRADE, _bronze(spark, sf_dir, "bronze")))


def bronze_pruned_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = _bronze(spark, sf_dir, "pruned")
    return _wall_clock(b.read_bars(spark, warehouse, date=DATE, symbol=SYMBOL))


def bronze_condition_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = _bronze(spark, sf_dir, "condition")
    condition = f"partition >= '{DATE}' AND volume < 50"
    return _wall_clock(b.read_table(spark, b.TRADE, warehouse, condition))


def append_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = _bronze(spark, sf_dir, "append")
    b.write_table(_bars(spark, sf_dir, batch_id=2), b.TRADE, warehouse)
    return _wall_clock(b.read_table(spark, b.TRADE, warehouse))


def union_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches of payloads loaded one after the other."""
    warehouse = new_dir(spark, "batches")
    for batch_id in (1, 2):
        b.load_bronze(_payloads(spark, sf_dir), warehouse, batch_id)
    return _wall_clock(b.read_table(spark, b.TRADE, warehouse))


def overwrite_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = _bronze(spark, sf_dir, "overwrite")
    day = b.filter_bars(_bars(spark, sf_dir, batch_id=2), date=DATE)
    b.write_table(day, b.TRADE, warehouse, mode="overwrite")
    return _wall_clock(b.read_table(spark, b.TRADE, warehouse))


def silver_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appending the same days twice keeps both copies."""
    warehouse = new_dir(spark, "silver")
    for _ in range(2):
        b.write_table(daily_rollup(spark, sf_dir), b.DAILY_TRADES, warehouse)
    return b.read_table(spark, b.DAILY_TRADES, warehouse)


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = b.export_bars_csv(_payloads(spark, sf_dir), new_dir(spark, "csv"))
    schema = (
        "trade_timestamp timestamp_ntz, symbol string, open double, high double,"
        " low double, close double, volume int"
    )
    return spark.read.schema(schema).option("header", True).csv(path)


def catalog_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create, fill, query and drop catalog tables; dropped tables keep their files."""
    path = new_dir(spark, "catalog")
    database = _database(path)
    b.create_tables(spark, path, database)
    b.create_silver_tables(spark, path, database)
    b.insert_table(_bars(spark, sf_dir), b.TRADE, database)
    b.insert_table(
        spark.sql(
            "SELECT to_date(trade_timestamp) AS trade_date, symbol,"
            " min_by(open, trade_timestamp) AS daily_open,"
            " max_by(close, trade_timestamp) AS daily_close, max(high) AS daily_high,"
            " min(low) AS daily_low, sum(volume) AS daily_volume"
            f" FROM {database}.trade GROUP BY 1, 2"
        ),
        b.DAILY_TRADES,
        database,
    )
    b.drop_tables(spark, database)
    return b.read_table(spark, b.DAILY_TRADES, path)


# --- repeated bars and re-runs ----------------------------------------------


def _sent_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some bars as a later batch sends them, with another close."""
    again = _bars(spark, sf_dir, batch_id=2).filter(F.col("volume") >= 50)
    return again.withColumn("close", F.col("close") + 1)


def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.dedup_latest(_bars(spark, sf_dir).unionByName(_sent_again(spark, sf_dir)))


def dedup_bronze_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored table rewritten without repeated bars."""
    warehouse = _bronze(spark, sf_dir, "dedup")
    b.write_table(_sent_again(spark, sf_dir), b.TRADE, warehouse)
    b.deduplicate_bronze(spark, warehouse)
    return _wall_clock(b.read_table(spark, b.TRADE, warehouse))


def catalog_after_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A session that has read the catalog table sees it rewritten."""
    warehouse = _bronze(spark, sf_dir, "catalog-dedup")
    database = _database(warehouse)
    b.write_table(_sent_again(spark, sf_dir), b.TRADE, warehouse)
    b.create_tables(spark, warehouse, database)
    spark.table(f"{database}.trade").count()
    b.deduplicate_bronze(spark, warehouse, database=database)
    return _wall_clock(_last_read(spark, f"{database}.trade", b.TRADE, database))


def catalog_after_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the incremental load stores is there for SQL users at once."""
    root = new_dir(spark, "catalog-stream")
    database = _database(root)
    b.create_tables(spark, f"{root}/wh", database)
    b.create_silver_tables(spark, f"{root}/wh", database)
    _land(_payloads(spark, sf_dir), f"{root}/landing", "a")
    b.ingest_stream(
        spark,
        f"{root}/landing",
        f"{root}/wh",
        f"{root}/state",
        layout="lines",
        database=database,
    ).awaitTermination()
    return _last_read(spark, f"{database}.daily_trades", b.DAILY_TRADES, database)


def catalog_recreated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables made anew over folders that are filled already have their rows."""
    warehouse = _bronze(spark, sf_dir, "recreated")
    database = _database(warehouse)
    for _ in range(2):
        b.create_tables(spark, warehouse, database)
    return _wall_clock(_last_read(spark, f"{database}.trade", b.TRADE, database))


def _database(path: str) -> str:
    return path.rsplit("/", 1)[-1].replace("-", "_")


def _last_read(spark: SparkSession, name: str, table, database: str) -> DataFrame:
    """A catalog table's rows as SQL reads them, kept beyond the table, which is dropped."""
    path = new_dir(spark, "last-read")
    b.write_table(spark.table(name), table, path)
    b.drop_tables(spark, database)
    return b.read_table(spark, table, path)


def daily_untimed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many bars without a time in a group: the same row however they are dealt out."""
    untimed = _bars(spark, sf_dir).withColumn("trade_timestamp", F.lit(None).cast("timestamp"))
    daily = b.daily_rollup(b.dedup_latest(untimed.repartition(7)))
    return daily.withColumn("trade_date", F.col("trade_date").cast("date"))


def dedup_same_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions of a bar within one batch: the values decide, not the row order."""
    bars = _bars(spark, sf_dir)
    higher = bars.withColumn("close", F.col("close") + 1)
    no_open = bars.withColumn("open", F.lit(None).cast("double"))
    return b.dedup_latest(no_open.unionByName(higher).unionByName(bars))


def _stale_silver(spark: SparkSession, sf_dir: str, label: str) -> str:
    """A silver table whose open prices are all too high by 1000."""
    warehouse = new_dir(spark, label)
    stale = daily_rollup(spark, sf_dir).withColumn("daily_open", F.col("daily_open") + 1000)
    b.write_table(stale, b.DAILY_TRADES, warehouse)
    return warehouse


def replace_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole days replaced."""
    warehouse = _stale_silver(spark, sf_dir, "days")
    b.replace_days(daily_rollup(spark, sf_dir), warehouse, whole_days=True)
    return b.read_table(spark, b.DAILY_TRADES, warehouse)


def replace_days_one_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One symbol replaced, twice; the other symbols of its days stay."""
    warehouse = _stale_silver(spark, sf_dir, "one-symbol")
    bars = b.filter_bars(_bars(spark, sf_dir), symbol=SYMBOL)
    for symbol in (SYMBOL, None):
        b.replace_days(b.daily_rollup(bars), warehouse, symbol=symbol)
    return b.read_table(spark, b.DAILY_TRADES, warehouse)


# --- end to end -------------------------------------------------------------


def end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_dir(spark, "run")
    _land(_payloads(spark, sf_dir), f"{root}/landing", "a")
    b.run_pipeline(spark, f"{root}/landing", f"{root}/wh", batch_id=BATCH, layout="lines")
    return b.read_table(spark, b.DAILY_TRADES, f"{root}/wh")


def end_to_end_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same landing folder loaded twice: bronze doubles, silver does not."""
    root = new_dir(spark, "rerun")
    _land(_payloads(spark, sf_dir), f"{root}/landing", "a")
    for batch_id in (1, 2):
        b.run_pipeline(spark, f"{root}/landing", f"{root}/wh", batch_id=batch_id, layout="lines")
    return b.read_table(spark, b.DAILY_TRADES, f"{root}/wh")


def end_to_end_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A backfill: silver is rolled up from all of bronze, also days the batch has nothing for."""
    root = new_dir(spark, "backfill")
    bars = _bars(spark, sf_dir)
    b.write_table(bars.filter(F.col("partition") != DATE), b.TRADE, f"{root}/wh")
    day = bars.filter(F.col("partition") == DATE)
    _land(bars_to_payloads(day), f"{root}/landing", "a")
    b.run_pipeline(
        spark,
        f"{root}/landing",
        f"{root}/wh",
        batch_id=BATCH,
        layout="lines",
        recompute="all",
    )
    return b.read_table(spark, b.DAILY_TRADES, f"{root}/wh")


def end_to_end_touched_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days appended batch by batch: those a batch has nothing for are not stored again."""
    root = new_dir(spark, "touched-append")
    bars = _bars(spark, sf_dir)
    early = F.col("partition") < DATE
    for batch_id, part in ((1, bars.filter(early)), (2, bars.filter(~early))):
        landing = f"{root}/landing-{batch_id}"
        _land(bars_to_payloads(part), landing, "a")
        b.run_pipeline(
            spark, landing, f"{root}/wh", batch_id=batch_id, layout="lines", mode="append"
        )
    return b.read_table(spark, b.DAILY_TRADES, f"{root}/wh")


def end_to_end_raise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch that fails its checks stops before the load; one that passes is loaded."""
    root = new_dir(spark, "raise")
    spark.createDataFrame([("nothing",)], "value string").write.text(f"{root}/bad")
    _land(_payloads(spark, sf_dir), f"{root}/good", "a")
    for batch_id, folder in ((1, "good"), (2, "bad")):
        try:
            b.run_pipeline(
                spark,
                f"{root}/{folder}",
                f"{root}/wh",
                batch_id=batch_id,
                layout="lines",
                on_fail="raise",
            )
        except b.CheckFailed as error:
            assert folder == "bad", error
    return b.read_table(spark, b.DAILY_TRADES, f"{root}/wh")


def end_to_end_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain appends: loading a folder twice leaves silver with two rows per key."""
    root = new_dir(spark, "append")
    _land(_payloads(spark, sf_dir), f"{root}/landing", "a")
    for batch_id in (1, 2):
        b.run_pipeline(
            spark,
            f"{root}/landing",
            f"{root}/wh",
            batch_id=batch_id,
            layout="lines",
            mode="append",
        )
    return b.read_table(spark, b.DAILY_TRADES, f"{root}/wh")


def end_to_end_touched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late bars: one symbol arrives after the others and its days are recomputed."""
    root = new_dir(spark, "touched")
    late = F.col("symbol") == SYMBOL
    bars = _bars(spark, sf_dir)
    for batch_id, part in ((1, bars.filter(~late)), (2, bars.filter(late))):
        landing = f"{root}/landing-{batch_id}"
        _land(bars_to_payloads(part), landing, "a")
        b.run_pipeline(
            spark,
            landing,
            f"{root}/wh",
            batch_id=batch_id,
            layout="lines",
            recompute="touched",
        )
    return b.read_table(spark, b.DAILY_TRADES, f"{root}/wh")


def end_to_end_date_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All bars are loaded, silver is computed for one day and symbol."""
    root = new_dir(spark, "date-symbol")
    _land(_payloads(spark, sf_dir), f"{root}/landing", "a")
    b.run_pipeline(
        spark,
        f"{root}/landing",
        f"{root}/wh",
        date=DATE,
        symbol=SYMBOL,
        batch_id=BATCH,
        layout="lines",
    )
    return b.read_table(spark, b.DAILY_TRADES, f"{root}/wh")


def _streamed(spark: SparkSession, sf_dir: str, label: str) -> str:
    """Two runs of the incremental load; the second sees only the late symbol."""
    root = new_dir(spark, label)
    late = F.col("symbol") == SYMBOL
    bars = _bars(spark, sf_dir)
    for part, rows in (("early", bars.filter(~late)), ("late", bars.filter(late))):
        _land(bars_to_payloads(rows), f"{root}/landing", part)
        b.ingest_stream(
            spark, f"{root}/landing", f"{root}/wh", f"{root}/state", layout="lines"
        ).awaitTermination()
    return f"{root}/wh"


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.read_table(spark, b.DAILY_TRADES, _streamed(spark, sf_dir, "stream"))


def stream_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default layout as a stream, bronze and silver; a payload per file."""
    root = new_dir(spark, "stream-files")
    _land_files(_payloads(spark, sf_dir), f"{root}/landing")
    b.ingest_stream(spark, f"{root}/landing", f"{root}/wh", f"{root}/state").awaitTermination()
    return b.read_table(spark, b.DAILY_TRADES, f"{root}/wh")


def stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each landed file was loaded exactly once."""
    bars = b.read_table(spark, b.TRADE, _streamed(spark, sf_dir, "stream-bronze"))
    return _wall_clock(bars).drop("batch_id")


# --- repeated polls, failed runs, small files ---------------------------------


def _corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All bars, some with another close."""
    bars = _bars(spark, sf_dir)
    close = F.col("close") + F.when(F.col("volume") >= 50, 1).otherwise(0)
    return bars.withColumn("close", close)


def ingest_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three polls of a feed that sends everything: first, equal, with corrections. Only changes are stored."""
    root = new_dir(spark, "delta")
    polls = [_bars(spark, sf_dir), _bars(spark, sf_dir), _corrected(spark, sf_dir)]
    for batch_id, bars in enumerate(polls, 1):
        b.load_bronze(bars_to_payloads(bars), f"{root}/wh", batch_id, store="changed")
    return _wall_clock(b.read_table(spark, b.TRADE, f"{root}/wh"))


def silver_after_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver kept up by such polls: the corrected closes count."""
    root = new_dir(spark, "delta-run")
    for batch_id, bars in enumerate((_bars(spark, sf_dir), _corrected(spark, sf_dir)), 1):
        _land(bars_to_payloads(bars), f"{root}/landing-{batch_id}", "a")
        b.run_pipeline(
            spark,
            f"{root}/landing-{batch_id}",
            f"{root}/wh",
            batch_id=batch_id,
            layout="lines",
            store="changed",
        )
    return b.read_table(spark, b.DAILY_TRADES, f"{root}/wh")


def end_to_end_after_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run fails between bronze and silver; the next one, for other days, publishes both."""
    root = new_dir(spark, "after-failure")
    bars = _bars(spark, sf_dir)
    early = F.col("partition") < DATE
    try:
        with loaded(bars_to_payloads(bars.filter(early)), f"{root}/wh", 1):
            raise InterruptedError("bronze is stored, silver is not")
    except InterruptedError:
        pass
    _land(bars_to_payloads(bars.filter(~early)), f"{root}/landing", "a")
    b.run_pipeline(spark, f"{root}/landing", f"{root}/wh", batch_id=2, layout="lines")
    return b.read_table(spark, b.DAILY_TRADES, f"{root}/wh")


def recovered_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A replacement of days is lost when one of them is gone; its rows are back after ``recover``."""
    warehouse = _bronze(spark, sf_dir, "recovered")
    b.write_table(_sent_again(spark, sf_dir), b.TRADE, warehouse)
    kept = b.dedup_latest(b.read_table(spark, b.TRADE, warehouse))
    try:
        with staged(kept, "lost", warehouse, replaces=b.TRADE):
            remove(spark, f"{b.TRADE.path(warehouse)}/partition={DATE}")
            raise InterruptedError("a day is gone")
    except InterruptedError:
        b.recover(spark, warehouse)
    return _wall_clock(b.read_table(spark, b.TRADE, warehouse))


def compacted_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days that many appends have left in small files, rewritten: the rows are the same."""
    warehouse = _bronze(spark, sf_dir, "compacted")
    late = _bars(spark, sf_dir).filter(F.col("partition") >= DATE)
    for batch_id in (2, 3):
        b.write_table(late.withColumn("batch_id", F.lit(batch_id)), b.TRADE, warehouse)
    b.compact(spark, b.TRADE, warehouse, at_least=3)
    return _wall_clock(b.read_table(spark, b.TRADE, warehouse))


def catalog_swapped_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stale days of a catalog table replaced by location, one symbol first, then all."""
    warehouse = _stale_silver(spark, sf_dir, "swapped")
    database = _database(warehouse)
    b.create_silver_tables(spark, warehouse, database)
    b.write_table(_bars(spark, sf_dir), b.TRADE, warehouse)
    how = {"mode": "swap", "database": database}
    b.refresh_silver(spark, warehouse, symbol=SYMBOL, **how)
    b.refresh_silver(spark, warehouse, date=DATE, **how)
    b.drop_unused(spark, b.DAILY_TRADES, database, warehouse, seconds=0)
    return _last_read(spark, f"{database}.daily_trades", b.DAILY_TRADES, database)


def rejected_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars whose time cannot be read, rejected by themselves; the others of their payload are loaded."""
    time = F.col("trade_timestamp").cast("string")
    bad = F.when(F.col("volume") < 20, F.concat(F.lit("no time "), time)).otherwise(time)
    payloads = bars_to_payloads(_bars(spark, sf_dir).withColumn("trade_timestamp", bad))
    bars, rejects = b.normalize_payloads(payloads, BATCH, untimed="reject")
    text = lambda name: F.get_json_object("value", f"$.{name}")
    rejected = rejects.select(
        "reason", text("symbol").alias("symbol"), text("volume").cast("int").alias("volume")
    )
    return rejected.unionByName(bars.select(F.lit("accepted").alias("reason"), "symbol", "volume"))


def quarantined_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that are no payloads are set aside as they are, good payloads before and after are loaded."""
    root = new_dir(spark, "quarantine")
    payloads = _payloads(spark, sf_dir)
    texts = _table(spark, sf_dir, "documents").select(F.col("text").alias("value"))
    for batch_id, raw in enumerate((payloads, texts, payloads), 1):
        b.load_bronze(raw, f"{root}/wh", batch_id, on_fail="divert")
    aside = b.read_table(spark, b.QUARANTINE, f"{root}/wh")
    rows = aside.select("batch_id", F.array_join("failed", "; ").alias("outcome"))
    bars = b.read_table(spark, b.TRADE, f"{root}/wh").select("batch_id", F.lit("loaded").alias("outcome"))
    return rows.unionByName(bars).groupBy("batch_id", "outcome").agg(F.count(F.lit(1)).alias("n"))


# --- contract ---------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    return daily_rollup(spark, "/root/testdata/sf0.001")


def _llm(name: str) -> dict:
    """What the optional subpackage ``barlake.llm`` adds; nothing where it is absent."""
    try:
        found = importlib.util.find_spec("barlake.llm.queries")
    except ModuleNotFoundError:
        found = None
    return getattr(importlib.import_module("barlake.llm.queries"), name)() if found else {}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One entry per operator; each callable takes (spark, sf_dir)."""
    return {
        **_llm("queries"),
        "daily_rollup": daily_rollup,
        "daily_rollup_nulls": daily_rollup_nulls,
        "daily_sorted": daily_sorted,
        "daily_open": _daily_part("daily_open"),
        "daily_close": _daily_part("daily_close"),
        "daily_high_low": _daily_part("daily_high", "daily_low"),
        "daily_volume": _daily_part("daily_volume"),
        "annotate_daily": annotate_daily,
        "window_open_close": _annotated_part("daily_open", "daily_close"),
        "window_high_low_volume": _annotated_part("daily_high", "daily_low", "daily_volume"),
        "daily_distinct": daily_distinct,
        "daily_one_per_key": daily_one_per_key,
        "bars_projection": bars_projection,
        "bars_with_partition": bars_with_partition,
        "bars_with_trade_date": bars_with_trade_date,
        "bars_all": bars_all,
        "bars_on_date": bars_on_date,
        "bars_for_symbol": bars_for_symbol,
        "bars_date_symbol": bars_date_symbol,
        "lenient_casts": lenient_casts,
        "normalize_payloads": normalize_payloads,
        "landed_payloads": landed_payloads,
        "landed_files": landed_files,
        "payload_repeated_times": payload_repeated_times,
        "payload_events": payload_events,
        "payload_overrides": payload_overrides,
        "payload_rejects": payload_rejects,
        "rejected_documents": rejected_documents,
        "dq_row_count": dq_row_count,
        "dq_missing": dq_missing,
        "dq_duplicates": dq_duplicates,
        "dq_invalid_min": dq_invalid_min,
        "dq_bronze_report": dq_bronze_report,
        "dq_silver_report": dq_silver_report,
        "dq_silver_faults": dq_silver_faults,
        "dq_lineitem_report": dq_lineitem_report,
        "dq_view_sql": dq_view_sql,
        "bronze_round_trip": bronze_round_trip,
        "bronze_pruned_read": bronze_pruned_read,
        "bronze_condition_read": bronze_condition_read,
        "append_batches": append_batches,
        "union_batches": union_batches,
        "overwrite_table": overwrite_table,
        "silver_append": silver_append,
        "csv_round_trip": csv_round_trip,
        "catalog_tables": catalog_tables,
        "dedup_latest": dedup_latest,
        "dedup_bronze_table": dedup_bronze_table,
        "dedup_same_batch": dedup_same_batch,
        "daily_untimed": daily_untimed,
        "catalog_after_dedup": catalog_after_dedup,
        "catalog_after_stream": catalog_after_stream,
        "catalog_recreated": catalog_recreated,
        "replace_days": replace_days,
        "replace_days_one_symbol": replace_days_one_symbol,
        "end_to_end": end_to_end,
        "end_to_end_rerun": end_to_end_rerun,
        "end_to_end_append": end_to_end_append,
        "end_to_end_all": end_to_end_all,
        "end_to_end_touched_append": end_to_end_touched_append,
        "end_to_end_raise": end_to_end_raise,
        "end_to_end_touched": end_to_end_touched,
        "end_to_end_date_symbol": end_to_end_date_symbol,
        "ingest_delta": ingest_delta,
        "silver_after_delta": silver_after_delta,
        "end_to_end_after_failure": end_to_end_after_failure,
        "recovered_days": recovered_days,
        "catalog_swapped_days": catalog_swapped_days,
        "quarantined_batches": quarantined_batches,
        "dq_by_day": dq_by_day,
        "compacted_table": compacted_table,
        "rejected_bars": rejected_bars,
        "stream_ingest": stream_ingest,
        "stream_bronze": stream_bronze,
        "stream_files": stream_files,
    }


_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"

# Bars and daily rows as common table expressions.
_WITH_BARS = f"""
WITH e AS (SELECT *, {_K} AS k FROM events),
bars AS (
  SELECT CAST({BATCH} AS BIGINT) AS batch_id, ts AS trade_timestamp, event_type AS symbol,
         value AS open, greatest(value, value + k) AS high, least(value, value + k) AS low,
         value + k AS close, k AS volume, CAST(CAST(ts AS DATE) AS VARCHAR) AS partition,
         CAST(ts AS DATE) AS trade_date
  FROM e)"""

_WITH_DAILY = f"""{_WITH_BARS},
daily AS (
  SELECT trade_date, symbol, arg_min(open, trade_timestamp) AS daily_open,
         arg_max(close, trade_timestamp) AS daily_close, max(high) AS daily_high,
         min(low) AS daily_low, CAST(sum(volume) AS BIGINT) AS daily_volume
  FROM bars GROUP BY trade_date, symbol)"""

_WITH_WINDOWS = f"""{_WITH_BARS},
annotated AS (
  SELECT trade_timestamp, symbol, open, high, low, close, volume, trade_date,
         first(open) OVER (g ORDER BY trade_timestamp) AS daily_open,
         first(close) OVER (g ORDER BY trade_timestamp DESC) AS daily_close,
         max(high) OVER g AS daily_high, min(low) OVER g AS daily_low,
         CAST(sum(volume) OVER g AS BIGINT) AS daily_volume
  FROM bars WINDOW g AS (PARTITION BY trade_date, symbol))"""

_DAILY = f"{_WITH_DAILY} SELECT * FROM daily"
_BARS = f"{_WITH_BARS} SELECT * EXCLUDE (trade_date) FROM bars"


def _check_sql(
    dataset: str, check: str, columns: str, metric: str, value: str, passed: str,
    comparator: str = "=", threshold: float = 0,
) -> str:
    """One check result row; ``value`` and ``passed`` are SQL over it."""
    return f"""
SELECT '{dataset}' AS dataset, '{check}' AS "check", '{columns}' AS column_list,
       '{metric}' AS metric, value, '{comparator}' AS comparator,
       CAST({threshold} AS DOUBLE) AS threshold, value {passed} AS passed
FROM (SELECT CAST(({value}) AS BIGINT) AS value)"""


def _repeated(source: str, *keys: str) -> str:
    """Number of keys, without a NULL part, that occur more than once."""
    known = " AND ".join(f"{key} IS NOT NULL" for key in keys)
    return (
        f"SELECT count(*) FROM (SELECT 1 FROM {source} WHERE {known}"
        f" GROUP BY {', '.join(keys)} HAVING count(*) > 1)"
    )


def _row_count_sql(dataset: str, source: str) -> str:
    return _check_sql(
        dataset, "row_count > 0", "", "row_count", f"SELECT count(*) FROM {source}", "> 0", ">"
    )


def _zero_sql(dataset: str, metric: str, columns: str, value: str) -> str:
    return _check_sql(dataset, f"{metric}({columns}) = 0", columns, metric, value, "= 0")


def _invalid_sql(dataset: str, column: str, source: str, least: int = 0) -> str:
    below = f"{column} < {least}"
    value = f"SELECT count(*) FROM {source} WHERE {below}"
    check = f"invalid_count({below}) = 0"
    return _check_sql(dataset, check, column, "invalid_count", value, "= 0")


def _union(*parts: str) -> str:
    return "\nUNION ALL".join(parts)


_FAULTY = f"""faulty AS (
  SELECT trade_date, symbol, daily_close, daily_volume - 2000 AS daily_volume,
         CASE WHEN symbol = '{SYMBOL}' THEN -daily_open ELSE daily_open END AS daily_open
  FROM daily
  UNION ALL BY NAME
  SELECT trade_date, symbol, daily_close, daily_volume, daily_open
  FROM daily WHERE symbol = '{SYMBOL}'
  UNION ALL BY NAME
  SELECT CAST(NULL AS DATE) AS trade_date, symbol, daily_close, daily_volume, daily_open
  FROM daily WHERE NOT symbol = '{SYMBOL}')"""


def _grouped_checks_sql(column: str) -> str:
    """The silver checks of ``faulty`` for each value of a column."""
    counts = {
        "duplicate_count(symbol, trade_date) = 0": "sum(repeated)",
        "missing_count(trade_date) = 0": "sum(missing)",
        **{
            f"invalid_count({c} < 0) = 0": f"sum({c})"
            for c in ("daily_volume", "daily_open", "daily_close")
        },
    }
    rows = ", ".join(
        f"{{'check': '{name}', 'value': CAST({sql} AS BIGINT)}}" for name, sql in counts.items()
    )
    return f"""
SELECT '{column}' AS grouping, value_of_group, r."check" AS "check", r.value AS value, r.value = 0 AS passed
FROM (SELECT CAST({column} AS VARCHAR) AS value_of_group, unnest([{rows}]) AS r
      FROM (SELECT trade_date, symbol,
                   CAST(count(*) > 1 AND trade_date IS NOT NULL AND symbol IS NOT NULL AS INT) AS repeated,
                   count_if(trade_date IS NULL) AS missing, count_if(daily_volume < 0) AS daily_volume,
                   count_if(daily_open < 0) AS daily_open, count_if(daily_close < 0) AS daily_close
            FROM faulty GROUP BY trade_date, symbol)
      GROUP BY {column})"""


def _silver_checks_sql(source: str) -> str:
    return _union(
        _zero_sql(
            "daily_trades",
            "duplicate_count",
            "symbol, trade_date",
            _repeated(source, "symbol", "trade_date"),
        ),
        _zero_sql(
            "daily_trades",
            "missing_count",
            "trade_date",
            f"SELECT count(*) FROM {source} WHERE trade_date IS NULL",
        ),
        *[
            _invalid_sql("daily_trades", c, source)
            for c in ("daily_volume", "daily_open", "daily_close")
        ],
    )


def oracle_sql() -> dict[str, str]:
    """The DuckDB equivalent of each query."""
    bars_plain = f"{_WITH_BARS} SELECT * EXCLUDE (trade_date, batch_id, partition) FROM bars"
    on_date = f"partition = '{DATE}'"
    for_symbol = f"symbol = '{SYMBOL}'"
    stale_open = "daily_open + 1000"
    latest = f"""{_WITH_BARS}
SELECT * EXCLUDE (trade_date) REPLACE (
  CAST(CASE WHEN volume >= 50 THEN 2 ELSE 1 END AS BIGINT) AS batch_id,
  CASE WHEN volume >= 50 THEN close + 1 ELSE close END AS close)
FROM bars"""

    dq_bronze = _union(
        _row_count_sql("trade", "bars"),
        _zero_sql(
            "trade", "missing_count", "symbol", "SELECT count(*) FROM bars WHERE symbol IS NULL"
        ),
    )
    symbol_days = _repeated("bars", "symbol", "partition")

    return {
        **_llm("oracle_sql"),
        "daily_rollup": _DAILY,
        "daily_rollup_nulls": f"""{_WITH_BARS}
SELECT trade_date, CASE WHEN symbol <> 'error' THEN symbol END AS symbol,
       first(CASE WHEN volume >= 40 THEN open END ORDER BY trade_timestamp) AS daily_open,
       first(CASE WHEN volume < 60 THEN close END ORDER BY trade_timestamp DESC) AS daily_close,
       max(high) AS daily_high, min(CASE WHEN volume >= 20 THEN low END) AS daily_low,
       CAST(sum(CASE WHEN symbol <> 'view' THEN volume END) AS BIGINT) AS daily_volume
FROM bars GROUP BY trade_date, bars.symbol""",
        "daily_sorted": f"{_DAILY} ORDER BY trade_date, symbol",
        "daily_open": f"{_WITH_DAILY} SELECT trade_date, symbol, daily_open FROM daily",
        "daily_close": f"{_WITH_DAILY} SELECT trade_date, symbol, daily_close FROM daily",
        "daily_high_low": f"{_WITH_DAILY} SELECT trade_date, symbol, daily_high, daily_low FROM daily",
        "daily_volume": f"{_WITH_DAILY} SELECT trade_date, symbol, daily_volume FROM daily",
        "annotate_daily": f"{_WITH_WINDOWS} SELECT * FROM annotated",
        "window_open_close": f"""{_WITH_WINDOWS}
SELECT trade_timestamp, symbol, daily_open, daily_close FROM annotated""",
        "window_high_low_volume": f"""{_WITH_WINDOWS}
SELECT trade_timestamp, symbol, daily_high, daily_low, daily_volume FROM annotated""",
        "daily_distinct": f"""{_WITH_WINDOWS}
SELECT DISTINCT {", ".join(DAILY_COLUMNS)} FROM annotated""",
        "daily_one_per_key": f"""{_WITH_WINDOWS}
SELECT DISTINCT ON (trade_date, symbol) {", ".join(DAILY_COLUMNS)} FROM annotated""",
        "bars_projection": bars_plain,
        "bars_with_partition": _BARS,
        "bars_with_trade_date": f"{_WITH_BARS} SELECT trade_timestamp, symbol, trade_date FROM bars",
        "bars_all": _BARS,
        "bars_on_date": f"{_BARS} WHERE {on_date}",
        "bars_for_symbol": f"{_BARS} WHERE {for_symbol}",
        "bars_date_symbol": f"{_BARS} WHERE {on_date} AND {for_symbol}",
        "lenient_casts": f"""
SELECT event_id, {_K} AS whole, {_K} AS fraction, CAST(NULL AS INTEGER) AS bad_int,
       CAST(NULL AS INTEGER) AS too_large, value AS price, CAST(NULL AS DOUBLE) AS bad_price,
       ts AS time, CAST(NULL AS TIMESTAMP) AS bad_time
FROM events""",
        "normalize_payloads": _BARS,
        "landed_payloads": _BARS,
        "landed_files": _BARS,
        "payload_repeated_times": _BARS,
        "payload_events": bars_plain,
        "payload_overrides": f"""{_WITH_BARS}
SELECT batch_id, trade_timestamp, CASE WHEN {for_symbol} THEN 'N/A' ELSE symbol END AS symbol,
       open, CAST(NULL AS DOUBLE) AS high, CAST(NULL AS DOUBLE) AS low,
       CAST(NULL AS DOUBLE) AS close, volume
FROM bars""",
        "payload_rejects": """
SELECT CASE event_type WHEN 'view' THEN 'malformed json' WHEN 'signup' THEN 'no metadata'
                       WHEN 'purchase' THEN 'no series' WHEN 'error' THEN 'empty series'
                       ELSE 'accepted' END AS outcome, count(*) AS n
FROM events GROUP BY 1""",
        "rejected_documents": f"""
SELECT CAST({BATCH} AS BIGINT) AS batch_id, 'malformed json' AS reason, count(*) AS n,
       CAST(sum(length(text)) AS BIGINT) AS n_chars
FROM documents""",
        "dq_row_count": _WITH_BARS + _row_count_sql("trade", "bars"),
        "dq_missing": _WITH_BARS
        + _union(
            _zero_sql(
                "trade",
                "missing_count",
                "symbol",
                f"SELECT count(*) FROM bars WHERE symbol IS NULL OR {for_symbol}",
            ),
            _zero_sql(
                "trade", "missing_count", "open", "SELECT count(*) FROM bars WHERE open IS NULL"
            ),
        ),
        "dq_duplicates": _WITH_BARS
        + _union(
            _zero_sql("trade", "duplicate_count", "symbol, partition", symbol_days),
            _zero_sql(
                "trade",
                "duplicate_count",
                "trade_timestamp",
                _repeated("bars", "trade_timestamp"),
            ),
            _check_sql(
                "trade",
                "duplicate_count(symbol, partition) >= 1",
                "symbol, partition",
                "duplicate_count",
                symbol_days,
                ">= 1",
                ">=",
                1,
            ),
        ),
        "dq_invalid_min": _WITH_BARS
        + _union(
            _invalid_sql("trade", "volume", "bars", 50),
            _invalid_sql("trade", "open", "bars"),
        ),
        "dq_bronze_report": _WITH_BARS + dq_bronze,
        "dq_silver_report": _WITH_DAILY + _silver_checks_sql("daily"),
        "dq_silver_faults": f"""{_WITH_DAILY},
{_FAULTY}"""
        + _silver_checks_sql("faulty"),
        "dq_by_day": f"{_WITH_DAILY},\n{_FAULTY}"
        + _union(*[_grouped_checks_sql(c) for c in ("trade_date", "symbol")]),
        "dq_lineitem_report": _union(
            _row_count_sql("lineitem", "lineitem"),
            _zero_sql(
                "lineitem",
                "missing_count",
                "l_shipdate",
                "SELECT count(*) FROM lineitem WHERE l_shipdate IS NULL",
            ),
            _zero_sql(
                "lineitem",
                "duplicate_count",
                "l_orderkey, l_linenumber",
                _repeated("lineitem", "l_orderkey", "l_linenumber"),
            ),
            _zero_sql(
                "lineitem",
                "duplicate_count",
                "l_orderkey",
                _repeated("lineitem", "l_orderkey"),
            ),
            _invalid_sql("lineitem", "l_quantity", "lineitem", 10),
        ),
        "dq_view_sql": f"""{_WITH_BARS}
SELECT symbol, count(*) AS n, max(volume) AS max_volume FROM bars GROUP BY symbol""",
        "bronze_round_trip": _BARS,
        "bronze_pruned_read": f"""{_WITH_BARS}
SELECT * FROM bars WHERE {on_date} AND {for_symbol}""",
        "bronze_condition_read": f"{_BARS} WHERE partition >= '{DATE}' AND volume < 50",
        "append_batches": f"{_BARS} UNION ALL SELECT * EXCLUDE (trade_date) REPLACE"
        " (CAST(2 AS BIGINT) AS batch_id) FROM bars",
        "union_batches": f"{_BARS} UNION ALL SELECT * EXCLUDE (trade_date) REPLACE"
        " (CAST(2 AS BIGINT) AS batch_id) FROM bars",
        "overwrite_table": f"""{_WITH_BARS}
SELECT * EXCLUDE (trade_date) REPLACE (CAST(2 AS BIGINT) AS batch_id)
FROM bars WHERE {on_date}""",
        "silver_append": f"{_DAILY} UNION ALL SELECT * FROM daily",
        "csv_round_trip": bars_plain,
        "catalog_tables": _DAILY,
        "dedup_latest": latest,
        "dedup_bronze_table": latest,
        "catalog_after_dedup": latest,
        "catalog_after_stream": _DAILY,
        "catalog_recreated": _BARS,
        "daily_untimed": f"""{_WITH_BARS}
SELECT CAST(NULL AS DATE) AS trade_date, symbol, min(open) AS daily_open,
       max(close) AS daily_close, max(high) AS daily_high, min(low) AS daily_low,
       CAST(sum(volume) AS BIGINT) AS daily_volume
FROM (SELECT DISTINCT symbol, open, high, low, close, volume FROM bars) GROUP BY symbol""",
        "dedup_same_batch": f"""{_WITH_BARS},
versions AS (
  SELECT * REPLACE (CAST(NULL AS DOUBLE) AS open) FROM bars
  UNION ALL SELECT * REPLACE (close + 1 AS close) FROM bars
  UNION ALL SELECT * FROM bars)
SELECT * EXCLUDE (trade_date) FROM versions
QUALIFY row_number() OVER (
  PARTITION BY symbol, trade_timestamp
  ORDER BY batch_id DESC, open DESC NULLS LAST, high DESC, low DESC, close DESC, volume DESC) = 1
""",
        "replace_days": _DAILY,
        "replace_days_one_symbol": f"""{_WITH_DAILY}
SELECT * REPLACE (CASE WHEN {for_symbol} THEN daily_open ELSE {stale_open} END AS daily_open)
FROM daily""",
        "end_to_end": _DAILY,
        "end_to_end_rerun": _DAILY,
        "end_to_end_append": f"{_DAILY} UNION ALL SELECT * FROM daily",
        "end_to_end_all": _DAILY,
        "end_to_end_touched": _DAILY,
        "end_to_end_touched_append": _DAILY,
        "end_to_end_raise": _DAILY,
        "end_to_end_date_symbol": f"""{_DAILY}
WHERE trade_date = DATE '{DATE}' AND {for_symbol}""",
        "ingest_delta": f"""{_BARS} UNION ALL
SELECT * EXCLUDE (trade_date) REPLACE (CAST(3 AS BIGINT) AS batch_id, close + 1 AS close)
FROM bars WHERE volume >= 50""",
        "silver_after_delta": f"""{_WITH_BARS}
SELECT trade_date, symbol, first(open ORDER BY trade_timestamp) AS daily_open,
       first(close + CASE WHEN volume >= 50 THEN 1 ELSE 0 END
             ORDER BY trade_timestamp DESC) AS daily_close,
       max(high) AS daily_high, min(low) AS daily_low, CAST(sum(volume) AS BIGINT) AS daily_volume
FROM bars GROUP BY trade_date, symbol""",
        "end_to_end_after_failure": _DAILY,
        "recovered_days": latest,
        "catalog_swapped_days": f"""{_WITH_DAILY}
SELECT * REPLACE (CASE WHEN {for_symbol} OR trade_date = DATE '{DATE}' THEN daily_open
                       ELSE {stale_open} END AS daily_open)
FROM daily""",
        "quarantined_batches": """
SELECT CAST(b AS BIGINT) AS batch_id, 'loaded' AS outcome, count(*) AS n
FROM events, (VALUES (1), (3)) AS v(b) GROUP BY b
UNION ALL SELECT CAST(2 AS BIGINT), 'trade: row_count > 0 (value 0)', count(*) FROM documents""",
        "compacted_table": f"""{_BARS}
UNION ALL SELECT * EXCLUDE (trade_date, b) REPLACE (CAST(b AS BIGINT) AS batch_id)
FROM bars, (VALUES (2), (3)) AS v(b) WHERE partition >= '{DATE}'""",
        "rejected_bars": f"""{_WITH_BARS}
SELECT CASE WHEN volume < 20 THEN 'unreadable time' ELSE 'accepted' END AS reason, symbol, volume
FROM bars""",
        "stream_ingest": _DAILY,
        "stream_files": _DAILY,
        "stream_bronze": f"{_WITH_BARS} SELECT * EXCLUDE (trade_date, batch_id) FROM bars",
    }
