"""End to end: landed payloads to bronze to silver, and payloads to CSV."""

from __future__ import annotations

import logging
import time
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from barlake.operators.changes import changed_bars
from barlake.operators.normalize import parse_payloads, payload_events, split_parsed
from barlake.operators.quality import enforce, failures, run_checks, run_checks_by
from barlake.operators.rollup import daily_rollup, days_with_repeats, dedup_latest
from barlake.plans import pending
from barlake.plans.recovery import recover
from barlake.schemas import DAILY_TRADES, QUARANTINE, REJECTS, TRADE, Table
from barlake.sources.catalog import swap_days, sync_partitions
from barlake.sources.lease import writer
from barlake.sources.payloads import read_payloads
from barlake.sources.staging import path_exists, staged
from barlake.sources.tables import (
    distinct_days,
    filter_bars,
    on_days,
    read_bars,
    read_table,
    replace_days,
    write_csv,
    write_table,
)

log = logging.getLogger(__name__)


#: How silver days are published.
MODES = ("replace", "append", "swap")
#: Which bars of a batch are stored.
STORE = ("all", "changed")


@dataclass
class BronzeLoad:
    batch_id: int
    checks: list[Row]
    rejected: int
    # Days the batch has bars to store for, while they are staged (see ``loaded``).
    days: DataFrame | None = None
    # Set aside whole, because checks failed.
    diverted: bool = False
    # Where its days are recorded as pending.
    record: str | None = None


@dataclass
class PipelineResult:
    batch_id: int
    rejected: int = 0
    bronze_checks: list[Row] = field(default_factory=list)
    silver_checks: list[Row] = field(default_factory=list)
    diverted: bool = False


def _last_id_path(warehouse: str) -> str:
    return f"{warehouse.rstrip('/')}/_last_batch_id"


def _last_id(spark: SparkSession, warehouse: str) -> int | None:
    if not path_exists(spark, f"{_last_id_path(warehouse)}/_SUCCESS"):
        return None
    return spark.read.schema("id long").parquet(_last_id_path(warehouse)).agg(F.max("id")).first()[0]


def new_batch_id(spark: SparkSession, warehouse: str, fmt: str = "parquet") -> int:
    """Epoch seconds, taken once per batch, but always above every earlier batch's id.

    The largest id is kept in a file beside the tables; where that is missing, it is
    looked up in bronze.
    """
    last = _last_id(spark, warehouse)
    if last is None and path_exists(spark, TRADE.path(warehouse)):
        last = read_table(spark, TRADE, warehouse, fmt=fmt).agg(F.max("batch_id")).first()[0]
    return max(int(time.time()), (last or 0) + 1)


def _remember_id(spark: SparkSession, warehouse: str, batch_id: int) -> None:
    """Keep the largest id so far: one given, or a repeated one, may be lower."""
    last = _last_id(spark, warehouse)
    if last is None or batch_id > last:
        spark.range(batch_id, batch_id + 1, 1, 1).write.mode("overwrite").parquet(
            _last_id_path(warehouse)
        )


@contextmanager
def _to_store(
    bars: DataFrame, warehouse: str, batch_id: int, store: str, fmt: str
) -> Iterator[DataFrame]:
    """The bars of a batch that are to be stored: all, or those that bronze has not as they are."""
    spark = bars.sparkSession
    if store == "all":
        yield bars
        return
    if not path_exists(spark, TRADE.path(warehouse)):
        with staged(dedup_latest(bars), "changed", warehouse) as fresh:
            yield fresh
        return
    with staged(distinct_days(bars, "partition"), "sent-days", warehouse) as days:
        stored = on_days(read_table(spark, TRADE, warehouse, fmt=fmt), "partition", days)
        # What a repeated micro-batch had stored under its id does not count.
        others = stored.filter(~F.col("batch_id").eqNullSafe(F.lit(batch_id)))
        with staged(changed_bars(bars, others), "changed", warehouse) as fresh:
            yield fresh


@contextmanager
def loaded(
    raw: DataFrame,
    warehouse: str,
    batch_id: int | None = None,
    on_fail: str = "report",
    fmt: str = "parquet",
    database: str | None = None,
    again: bool = False,
    store: str = "all",
    untimed: str = "store",
) -> Iterator[BronzeLoad]:
    """Load a batch as :func:`load_bronze` does; the days it has bars for stay staged inside.

    With ``again`` some of the batch may have been stored before, under the same id:
    its days are written anew without those rows. The warehouse's lease is held, also inside.
    """
    if store not in STORE:
        raise ValueError(f"store must be one of {STORE}, not {store!r}")
    spark = raw.sparkSession
    with writer(spark, warehouse):
        recover(spark, warehouse, database)
        if batch_id is None:
            batch_id = new_batch_id(spark, warehouse, fmt)
        with staged(parse_payloads(raw, batch_id, untimed), "batch", warehouse) as parsed:
            bars, rejects = split_parsed(parsed)
            checks = enforce(run_checks(bars, "trade"), on_fail)
            _remember_id(spark, warehouse, batch_id)
            rejected = rejects.count()
            failed = failures(checks)
            if failed and on_fail == "divert":
                if not (again and _has_rows(spark, QUARANTINE, warehouse, batch_id, fmt)):
                    _quarantine(raw, warehouse, batch_id, failed, fmt)
                none = spark.createDataFrame([], "_day string")
                yield BronzeLoad(batch_id, checks, rejected, none, diverted=True)
                return
            with (
                _to_store(bars, warehouse, batch_id, store, fmt) as fresh,
                staged(distinct_days(fresh, "partition"), "days", warehouse) as days,
            ):
                there = path_exists(spark, TRADE.path(warehouse))
                record = None if days.isEmpty() else pending.mark(days, warehouse)
                if again and there:
                    _store_again(fresh, warehouse, batch_id, fmt)
                elif store == "all" or not there or record is not None:
                    write_table(fresh, TRADE, warehouse, "append", fmt)
                if rejected:
                    log.warning("batch %d: %d rejected", batch_id, rejected)
                    if not (again and _has_rows(spark, REJECTS, warehouse, batch_id, fmt)):
                        write_table(rejects, REJECTS, warehouse, "append", fmt)
                if database is not None:
                    sync_partitions(spark, TRADE, database, fmt, days)
                yield BronzeLoad(batch_id, checks, rejected, days, record=record)


def _store_again(fresh: DataFrame, warehouse: str, batch_id: int, fmt: str) -> None:
    """Write the batch's rows in place of those that are stored under its id already."""
    spark = fresh.sparkSession
    table = read_table(spark, TRADE, warehouse, fmt=fmt)
    had = table.filter(F.col("batch_id") == batch_id).select("partition")
    both = distinct_days(fresh.select("partition").unionByName(had), "partition")
    with staged(both, "again-days", warehouse) as days:
        others = on_days(table, "partition", days).filter(
            ~F.col("batch_id").eqNullSafe(F.lit(batch_id))
        )
        with staged(others.unionByName(fresh), "again", warehouse, replaces=TRADE, fmt=fmt) as rows:
            write_table(rows, TRADE, warehouse, "overwrite_days", fmt)


def _quarantine(
    raw: DataFrame, warehouse: str, batch_id: int, failed: list[str], fmt: str
) -> None:
    """Keep the payloads of a batch, as they came, with what failed."""
    log.warning("batch %d is set aside: %s", batch_id, "; ".join(failed))
    rows = raw.select(
        F.lit(batch_id).cast("long").alias("batch_id"),
        F.array(*[F.lit(text) for text in failed]).alias("failed"),
        "value",
    )
    write_table(rows, QUARANTINE, warehouse, "append", fmt)


def _has_rows(
    spark: SparkSession, table: Table, warehouse: str, batch_id: int, fmt: str
) -> bool:
    if not path_exists(spark, table.path(warehouse)):
        return False
    mine = F.col("batch_id") == batch_id
    return not read_table(spark, table, warehouse, mine, fmt).isEmpty()


def load_bronze(
    raw: DataFrame,
    warehouse: str,
    batch_id: int | None = None,
    on_fail: str = "report",
    fmt: str = "parquet",
    database: str | None = None,
    store: str = "all",
    untimed: str = "store",
) -> BronzeLoad:
    """Parse, check and append one batch of payloads; rejects go to their own table.

    The parsed batch is staged, so JSON is parsed once although bars are checked,
    then written, and rejects are written too. With ``on_fail="raise"`` nothing is
    loaded when a check fails; with ``"divert"`` the payloads go to the quarantine table then, with what
    failed. With ``database`` the catalog table is told about the days written.

    ``store="changed"`` is for feeds that send a whole series at each poll: only bars
    that bronze has not, or has with other values, are appended (see ``changed_bars``).
    ``untimed="reject"`` sends bars without a readable time to the rejects.

    The days stored are recorded as pending until their silver is published.
    """
    with loaded(raw, warehouse, batch_id, on_fail, fmt, database, False, store, untimed) as load:
        return BronzeLoad(load.batch_id, load.checks, load.rejected, diverted=load.diverted)


def deduplicate_bronze(
    spark: SparkSession,
    warehouse: str,
    date: str | None = None,
    fmt: str = "parquet",
    database: str | None = None,
) -> None:
    """Rewrite the days of bronze that have repeated bars, or one such day, without them.

    Feeds that send a whole series again every day make bronze grow by copies;
    the roll-up skips them, this drops them. The days are found by an aggregate over
    the bars' identities; only those are staged and replaced, one by one as the job
    commits, and days without repeats keep their files. If that fails, ``recover``, which every entry
    point calls first, completes it.
    """
    with writer(spark, warehouse):
        recover(spark, warehouse, database)
        bars = filter_bars(read_table(spark, TRADE, warehouse, fmt=fmt), date)
        repeats = distinct_days(days_with_repeats(bars), "partition")
        with staged(repeats, "repeats", warehouse) as days:
            kept = dedup_latest(on_days(bars, "partition", days))
            with staged(kept, "dedup", warehouse, replaces=TRADE, fmt=fmt) as rows:
                write_table(rows, TRADE, warehouse, "overwrite_days", fmt)
            if database is not None:
                sync_partitions(spark, TRADE, database, fmt, days)


def refresh_silver(
    spark: SparkSession,
    warehouse: str,
    date: str | None = None,
    symbol: str | None = None,
    days: DataFrame | None = None,
    mode: str = "replace",
    on_fail: str = "report",
    fmt: str = "parquet",
    database: str | None = None,
) -> list[Row]:
    """Recompute silver from bronze: everything, or a day, a symbol, or staged ``days``.

    ``mode`` is ``replace`` (re-runnable), ``append``, or ``swap``: days of the catalog table are
    replaced by location, so that no reader ever misses one (see ``swap_days``). Repeated bars are
    removed first, so a bar sent twice does not count twice. With ``database`` the
    catalog table is told about the days written. With ``on_fail="divert"`` days that fail a check are held
    back: silver keeps what it has for them and they stay pending, the others are published. Returns the
    results of the silver checks. Recomputing everything clears all pending days.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    if mode == "swap" and database is None:
        raise ValueError("mode 'swap' needs a database")
    with writer(spark, warehouse):
        recover(spark, warehouse, database)
        # Read before bronze: days that are recorded later may have bars that are not seen here.
        taken = pending.records(spark, warehouse) if not (date or symbol) and days is None else []
        bars = read_bars(spark, warehouse, date, symbol, fmt)
        if days is not None:
            bars = on_days(bars, "partition", days)
        with staged(daily_rollup(dedup_latest(bars)), "daily", warehouse) as daily:
            checks = enforce(run_checks(daily, "daily_trades"), on_fail)
            if on_fail == "divert" and failures(checks):
                with staged(_failing_days(daily), "held", warehouse) as held:
                    _publish(_but_days(daily, held), warehouse, symbol, mode, fmt, database)
                    pending.mark(held, warehouse)
                    log.warning("%d days are held back", held.count())
            else:
                _publish(daily, warehouse, symbol, mode, fmt, database)
            pending.clear(spark, taken)
            return checks


def _publish(
    daily: DataFrame, warehouse: str, symbol: str | None, mode: str, fmt: str, database: str | None
) -> None:
    spark = daily.sparkSession
    if mode == "swap":
        _swap(daily, warehouse, symbol, database)
        return
    if mode == "append":
        write_table(daily, DAILY_TRADES, warehouse, "append", fmt)
    else:
        replace_days(daily, warehouse, not symbol, fmt, written=True, symbol=symbol or None)
    if database is not None:
        sync_partitions(spark, DAILY_TRADES, database, fmt, distinct_days(daily, "trade_date"))


def _swap(daily: DataFrame, warehouse: str, symbol: str | None, database: str) -> None:
    """Publish days by location, with the rows that other symbols have on them."""
    if not symbol:
        swap_days(daily, DAILY_TRADES, database, warehouse)
        return
    spark = daily.sparkSession
    with staged(distinct_days(daily, "trade_date"), "swap-of", warehouse) as days:
        stored = spark.table(f"{database}.{DAILY_TRADES.name}").select(*DAILY_TRADES.columns)
        others = on_days(stored, "trade_date", days).filter(
            ~F.col("symbol").eqNullSafe(F.lit(symbol))
        )
        swap_days(others.unionByName(daily), DAILY_TRADES, database, warehouse)


def _failing_days(daily: DataFrame) -> DataFrame:
    """``_day`` of the days that fail a check by themselves."""
    results = run_checks_by(daily, "daily_trades", ["trade_date"]).filter("NOT passed")
    return results.select(F.coalesce(F.col("group")[0], F.lit("")).alias("_day")).distinct()


def _but_days(daily: DataFrame, days: DataFrame) -> DataFrame:
    key = F.coalesce(F.col("trade_date").cast("string"), F.lit(""))
    return daily.join(days, key == F.col("_day"), "left_anti")


@contextmanager
def touched_days(
    spark: SparkSession, load: BronzeLoad, warehouse: str
) -> Iterator[DataFrame | None]:
    """The days to recompute after a batch: its own, and those that earlier ones left pending.

    All days recorded as pending, the batch's among them; their records are cleared when silver
    was published inside. None if there is nothing to do: the batch stored nothing, and nothing is
    pending.
    """
    records = pending.records(spark, warehouse)
    if not records:
        there = path_exists(spark, DAILY_TRADES.path(warehouse))
        # The first load makes the table, if only an empty one.
        yield None if there or load.diverted else load.days
        return
    if records == [load.record]:
        yield load.days
    else:
        with staged(pending.days_of(spark, records), "pending", warehouse) as days:
            yield days
    pending.clear(spark, records)


def run_pipeline(
    spark: SparkSession,
    landing: str | list[str],
    warehouse: str,
    date: str | None = None,
    symbol: str | None = None,
    batch_id: int | None = None,
    layout: str = "files",
    recompute: str = "touched",
    mode: str = "replace",
    on_fail: str = "report",
    fmt: str = "parquet",
    database: str | None = None,
    store: str = "all",
    untimed: str = "store",
) -> PipelineResult:
    """Landed payloads to bronze to silver.

    ``date`` and ``symbol`` restrict the silver step, not the load, and to the batch's own days. Without them
    ``recompute="touched"`` rolls up only the days this batch stores bars for, and those that earlier
    runs stored and did not get to publish; ``"all"`` rolls up
    the whole of bronze, for a backfill. With ``database`` the catalog tables of that
    name are told about the days written. ``store``, ``untimed`` and ``on_fail`` are as in :func:`load_bronze`
    and :func:`refresh_silver`.

    The run holds the warehouse's lease; a second writer fails at once. What an interrupted run left
    half replaced is completed first.
    """
    if recompute not in ("all", "touched"):
        raise ValueError(f"recompute must be 'all' or 'touched', not {recompute!r}")
    raw = read_payloads(spark, landing, layout)
    with loaded(raw, warehouse, batch_id, on_fail, fmt, database, False, store, untimed) as load:
        how = (mode, on_fail, fmt, database)
        silver: list[Row] = []
        if recompute == "touched" and not (date or symbol):
            with touched_days(spark, load, warehouse) as days:
                if days is not None:
                    silver = refresh_silver(spark, warehouse, None, None, days, *how)
        elif path_exists(spark, TRADE.path(warehouse)):
            days = load.days if recompute == "touched" else None
            silver = refresh_silver(spark, warehouse, date, symbol, days, *how)
            if load.record is not None:
                # What was asked for is done; days that earlier runs left stay pending.
                pending.clear(spark, [load.record])
    return PipelineResult(load.batch_id, load.rejected, load.checks, silver, load.diverted)


def export_bars_csv(raw: DataFrame, folder: str) -> str:
    """Bars of the payloads as CSV, values as the payload has them.

    Writes a new directory under ``folder``, named by the time, and returns it.
    """
    path = f"{folder.rstrip('/')}/trade_{time.strftime('%Y%m%d_%H%M%S')}"
    write_csv(payload_events(raw), path)
    return path
