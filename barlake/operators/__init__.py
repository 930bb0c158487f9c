from barlake.operators.changes import changed_bars
from barlake.operators.normalize import (
    normalize_payloads,
    parse_payloads,
    payload_events,
    split_parsed,
)
from barlake.operators.quality import (
    CHECK_SETS,
    Check,
    CheckFailed,
    duplicate_count,
    enforce,
    invalid_count,
    missing_count,
    row_count,
    run_checks,
    run_checks_by,
)
from barlake.operators.rollup import (
    annotate_daily,
    daily_distinct,
    daily_rollup,
    dedup_latest,
    with_trade_date,
)

__all__ = [
    "CHECK_SETS",
    "Check",
    "CheckFailed",
    "annotate_daily",
    "changed_bars",
    "daily_distinct",
    "daily_rollup",
    "dedup_latest",
    "duplicate_count",
    "enforce",
    "invalid_count",
    "missing_count",
    "normalize_payloads",
    "parse_payloads",
    "payload_events",
    "row_count",
    "run_checks",
    "run_checks_by",
    "split_parsed",
    "with_trade_date",
]
