"""Data-quality checks as DataFrame aggregates.

A check is a small record; a check set is a list of them. All checks of a set
are computed in one pass over the data.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from barlake.schemas import CHECK_RESULT_SCHEMA

log = logging.getLogger(__name__)

#: What is done about failed checks.
POLICIES = ("report", "raise", "divert")

_METRICS = ("row_count", "missing_count", "duplicate_count", "invalid_count")
_COMPARE = {
    "=": lambda value, threshold: value == threshold,
    "!=": lambda value, threshold: value != threshold,
    ">": lambda value, threshold: value > threshold,
    ">=": lambda value, threshold: value >= threshold,
    "<": lambda value, threshold: value < threshold,
    "<=": lambda value, threshold: value <= threshold,
}


class CheckFailed(Exception):
    """Raised by :func:`enforce` when checks fail and the policy is to raise."""

    def __init__(self, failed: list[Row]):
        self.failed = failed
        super().__init__("; ".join(_describe(row) for row in failed))


@dataclass(frozen=True)
class Check:
    metric: str
    columns: tuple[str, ...] = ()
    comparator: str = "="
    threshold: float = 0
    valid_min: float | None = None

    def __post_init__(self):
        if self.metric not in _METRICS:
            raise ValueError(f"unknown metric {self.metric!r}")
        if self.comparator not in _COMPARE:
            raise ValueError(f"unknown comparator {self.comparator!r}")
        if self.metric == "invalid_count" and self.valid_min is None:
            raise ValueError("invalid_count needs valid_min")
        if self.metric == "duplicate_count" and not self.columns:
            raise ValueError("duplicate_count needs at least one column")

    @property
    def column_list(self) -> str:
        return ", ".join(self.columns)

    @property
    def text(self) -> str:
        subject = f"{self.metric}({self.column_list})" if self.columns else self.metric
        if self.valid_min is not None:
            subject = f"{self.metric}({self.column_list} < {self.valid_min:g})"
        return f"{subject} {self.comparator} {self.threshold:g}"


def row_count(comparator: str = ">", threshold: float = 0) -> Check:
    return Check("row_count", (), comparator, threshold)


def missing_count(column: str, comparator: str = "=", threshold: float = 0) -> Check:
    """Rows where ``column`` is NULL."""
    return Check("missing_count", (column,), comparator, threshold)


def duplicate_count(*columns: str, comparator: str = "=", threshold: float = 0) -> Check:
    """Keys that occur more than once; a key with a NULL part is not counted."""
    return Check("duplicate_count", columns, comparator, threshold)


def invalid_count(
    column: str, valid_min: float, comparator: str = "=", threshold: float = 0
) -> Check:
    """Rows where ``column`` is below ``valid_min``; NULL is missing, not invalid."""
    return Check("invalid_count", (column,), comparator, threshold, valid_min)


# The check sets of the two tables.
CHECK_SETS: dict[str, list[Check]] = {
    "trade": [row_count(), missing_count("symbol")],
    "daily_trades": [
        duplicate_count("symbol", "trade_date"),
        missing_count("trade_date"),
        invalid_count("daily_volume", valid_min=0),
        invalid_count("daily_open", valid_min=0),
        invalid_count("daily_close", valid_min=0),
    ],
}


def _row_metric(check: Check) -> Column:
    """The count behind a check that looks at one row at a time."""
    if check.metric == "row_count":
        return F.count(F.lit(1))
    (column,) = check.columns
    if check.metric == "missing_count":
        return F.count_if(F.col(column).isNull())
    return F.count_if(F.col(column) < F.lit(check.valid_min))


def _result_row(dataset: str, check: Check, value: Column) -> Column:
    passed = _COMPARE[check.comparator](value.cast("double"), F.lit(float(check.threshold)))
    fields = [
        F.lit(dataset),
        F.lit(check.text),
        F.lit(check.column_list),
        F.lit(check.metric),
        value,
        F.lit(check.comparator),
        F.lit(float(check.threshold)),
        passed,
    ]
    return F.struct(*[f.alias(n) for f, n in zip(fields, CHECK_RESULT_SCHEMA.fieldNames())])


def _key_columns(keys: Sequence[str]) -> list[Column]:
    return [F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]


def _whole_key(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"k{i}").isNotNull() for i in range(len(keys))])


def _by_keys(
    checks: list[Check],
) -> tuple[dict[tuple[str, ...], dict[str, Check]], dict[str, Check]]:
    """Checks by result column: those of duplicates by their key columns, and the row-wise ones."""
    by_keys: dict[tuple[str, ...], dict[str, Check]] = {}
    row_wise: dict[str, Check] = {}
    for i, check in enumerate(checks):
        if check.metric == "duplicate_count":
            by_keys.setdefault(check.columns, {})[f"c{i}"] = check
        else:
            row_wise[f"c{i}"] = check
    return by_keys, row_wise


def _report(dataset: str, metrics: DataFrame, named: dict[str, Check]) -> DataFrame:
    """One-row ``metrics`` to one result row per check."""
    rows = [_result_row(dataset, check, F.col(name)) for name, check in named.items()]
    return metrics.select(F.inline(F.array(*rows)))


def run_checks(
    df: DataFrame, dataset: str, checks: list[Check] | None = None, view: bool = False
) -> DataFrame:
    """Evaluate a check set; one row per check (``CHECK_RESULT_SCHEMA``).

    ``checks`` defaults to the set registered under ``dataset``. With ``view``
    the data is also registered as a temp view of that name, for ad-hoc SQL.

    The row-wise checks and one set of duplicate keys share a pass: counts are
    taken per key, then summed. Further key sets take a pass each.
    """
    checks = CHECK_SETS[dataset] if checks is None else checks
    if not checks:
        raise ValueError(f"no checks for {dataset!r}")
    if view:
        df.createOrReplaceTempView(dataset)

    by_keys, row_wise = _by_keys(checks)
    if not by_keys:
        metrics = df.agg(*[_row_metric(c).alias(n) for n, c in row_wise.items()])
        return _report(dataset, metrics, row_wise)

    reports = []
    for keys, duplicates in by_keys.items():
        per_key = df.groupBy(*_key_columns(keys)).agg(
            F.count(F.lit(1)).alias("n"),
            *[_row_metric(c).alias(name) for name, c in row_wise.items()],
        )
        metrics = per_key.agg(
            *[F.count_if((F.col("n") > 1) & _whole_key(keys)).alias(n) for n in duplicates],
            *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in row_wise],
        )
        reports.append(_report(dataset, metrics, {**duplicates, **row_wise}))
        row_wise = {}
    return reduce(DataFrame.unionByName, reports)


def run_checks_by(
    df: DataFrame, dataset: str, *by: Sequence[str], checks: list[Check] | None = None
) -> DataFrame:
    """A check set evaluated for groups of rows: one row per group and check.

    Each of ``by`` lists the columns of a grouping, such as ``["trade_date"]`` and ``["symbol"]``; all
    groupings come out of the same pass, as grouping sets. ``by`` in the result names the
    columns, ``group`` has their values as text, NULL where a value is NULL. A key counts as a duplicate if it
    occurs more than once within the group. Without rows there is no group.

    Counts are taken per group and key, combined before the shuffle, then summed per
    group. A second set of duplicate keys takes a pass of its own, as in :func:`run_checks`.
    """
    checks = CHECK_SETS[dataset] if checks is None else checks
    if not checks:
        raise ValueError(f"no checks for {dataset!r}")
    if not by or not all(by):
        raise ValueError("each grouping needs at least one column")
    columns = list(dict.fromkeys(c for grouping in by for c in grouping))
    names = {c: f"g{i}" for i, c in enumerate(columns)}
    by_keys, row_wise = _by_keys(checks)
    reports = []
    for keys, duplicates in (by_keys or {(): {}}).items():
        needed = sorted({c for check in row_wise.values() for c in check.columns})
        rows = df.select(
            *[F.col(c).alias(names[c]) for c in columns], *_key_columns(keys), *needed
        )
        key_names = [f"k{i}" for i in range(len(keys))]
        counted = rows.groupingSets(
            [[*[names[c] for c in grouping], *key_names] for grouping in by],
            *names.values(),
            *key_names,
        ).agg(
            F.grouping_id().alias("_set"),
            F.count(F.lit(1)).alias("n"),
            *[_row_metric(c).alias(name) for name, c in row_wise.items()],
        )
        metrics = counted.groupBy("_set", *names.values()).agg(
            *[F.count_if((F.col("n") > 1) & _whole_key(keys)).alias(n) for n in duplicates],
            *[F.sum(n).alias(n) for n in row_wise],
        )
        # The id has a bit for each column left out, the last column's lowest.
        every = [*names.values(), *key_names]
        by_text = group = F.lit(None)
        for grouping in by:
            kept = {names[c] for c in grouping} | set(key_names)
            id_ = sum(1 << i for i, c in enumerate(reversed(every)) if c not in kept)
            mine = F.col("_set") == id_
            values = F.array(*[F.col(names[c]).cast("string") for c in grouping])
            by_text = F.when(mine, F.lit(", ".join(grouping))).otherwise(by_text)
            group = F.when(mine, values).otherwise(group)
        results = [_result_row(dataset, c, F.col(n)) for n, c in {**duplicates, **row_wise}.items()]
        reports.append(
            metrics.select(
                by_text.alias("by"), group.alias("group"), F.inline(F.array(*results))
            )
        )
        row_wise = {}
    return reduce(DataFrame.unionByName, reports)


def _describe(row: Row) -> str:
    return f"{row['dataset']}: {row['check']} (value {row['value']})"


def failures(rows: list[Row]) -> list[str]:
    """What failed, in words."""
    return [_describe(row) for row in rows if not row["passed"]]


def enforce(results: DataFrame, on_fail: str = "report") -> list[Row]:
    """Bring the check results in (one row per check) and apply the policy.

    ``report`` logs failed checks and lets the load go on; ``raise`` stops it. ``divert`` logs them
    too: the caller sets aside what failed.
    """
    if on_fail not in POLICIES:
        raise ValueError(f"on_fail must be one of {POLICIES}, not {on_fail!r}")
    rows = results.collect()
    failed = [row for row in rows if not row["passed"]]
    if failed and on_fail == "raise":
        raise CheckFailed(failed)
    for row in failed:
        log.warning("check failed: %s", _describe(row))
    if not failed:
        log.info("all %d checks passed", len(rows))
    return rows
