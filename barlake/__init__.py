"""Intraday market bars on Spark: payloads to bronze bars to daily silver rows."""

from barlake.functions import text_to_double, text_to_int, text_to_timestamp
from barlake.operators import (
    CHECK_SETS,
    Check,
    CheckFailed,
    annotate_daily,
    changed_bars,
    daily_distinct,
    daily_rollup,
    dedup_latest,
    duplicate_count,
    enforce,
    invalid_count,
    missing_count,
    normalize_payloads,
    payload_events,
    row_count,
    run_checks,
    run_checks_by,
    with_trade_date,
)
from barlake.plans.compaction import compact
from barlake.plans.pipeline import (
    deduplicate_bronze,
    export_bars_csv,
    load_bronze,
    refresh_silver,
    run_pipeline,
)
from barlake.schemas import (
    BAR_SCHEMA,
    CHECK_RESULT_SCHEMA,
    DAILY_SCHEMA,
    DAILY_TRADES,
    GROUPED_RESULT_SCHEMA,
    QUARANTINE,
    QUARANTINE_SCHEMA,
    REJECT_SCHEMA,
    REJECTS,
    TRADE,
    Table,
)
from barlake.plans.recovery import CopyMissing, recover
from barlake.sources import (
    WriterBusy,
    create_silver_tables,
    create_tables,
    drop_silver_tables,
    drop_tables,
    drop_unused,
    filter_bars,
    insert_table,
    read_bars,
    read_payloads,
    read_table,
    replace_days,
    swap_days,
    sync_partitions,
    write_csv,
    write_table,
    writer,
)
from barlake.streaming import ingest_stream

__all__ = [name for name in dir() if not name.startswith("_")]
