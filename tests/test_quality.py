"""Checks: metrics, null handling, single pass, outcome policy."""

from datetime import date

import pytest

import barlake as b

DAY = date(2024, 1, 2)
SCHEMA = (
    "trade_date date, symbol string, daily_volume long, daily_high double, daily_low double,"
    " daily_open double, daily_close double"
)


def silver(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def row(day=DAY, symbol="A", volume=1, open=1.0, close=1.0):
    return (day, symbol, volume, 1.0, 1.0, open, close)


def values(results):
    return {r.check: (r.value, r.passed) for r in results.collect()}


def test_silver_checks_find_each_fault(spark):
    df = silver(
        spark,
        row(),
        row(),
        row(symbol="B", open=-1.0),
        row(symbol="C", volume=-5, close=-0.5),
        row(day=None, symbol="D"),
    )
    assert values(b.run_checks(df, "daily_trades")) == {
        "duplicate_count(symbol, trade_date) = 0": (1, False),
        "missing_count(trade_date) = 0": (1, False),
        "invalid_count(daily_volume < 0) = 0": (1, False),
        "invalid_count(daily_open < 0) = 0": (1, False),
        "invalid_count(daily_close < 0) = 0": (1, False),
    }


def test_clean_silver_passes_and_result_schema(spark):
    results = b.run_checks(silver(spark, row(), row(symbol="B")), "daily_trades")
    assert [(f.name, f.dataType) for f in results.schema] == [
        (f.name, f.dataType) for f in b.CHECK_RESULT_SCHEMA
    ]
    assert all(r.passed for r in results.collect())


def test_null_and_nan_are_not_invalid_and_null_keys_not_repeated(spark):
    df = silver(
        spark,
        row(symbol=None),
        row(symbol=None),
        row(day=None, volume=None, open=float("nan"), close=None),
        row(day=None, volume=None, open=float("nan"), close=None),
    )
    got = values(b.run_checks(df, "daily_trades"))
    assert got["missing_count(trade_date) = 0"] == (2, False)
    assert [v for c, (v, _) in got.items() if "missing" not in c] == [0, 0, 0, 0]


def test_empty_data(spark):
    empty = silver(spark).limit(0)
    assert all(value == (0, True) for value in values(b.run_checks(empty, "daily_trades")).values())
    bars = spark.createDataFrame([], b.BAR_SCHEMA)
    assert values(b.run_checks(bars, "trade")) == {
        "row_count > 0": (0, False),
        "missing_count(symbol) = 0": (0, True),
    }


def test_repeated_keys_count_keys_not_rows(spark):
    df = silver(spark, *[row()] * 5, *[row(symbol="B")] * 2, row(symbol="C"))
    checks = [b.duplicate_count("symbol"), b.duplicate_count("daily_volume"), b.row_count("=", 8)]
    assert values(b.run_checks(df, "any", checks)) == {
        "duplicate_count(symbol) = 0": (2, False),
        "duplicate_count(daily_volume) = 0": (1, False),
        "row_count = 8": (8, True),
    }


@pytest.mark.parametrize(
    "comparator,passed",
    [("=", False), ("!=", True), (">", False), (">=", False), ("<", True), ("<=", True)],
)
def test_comparators(spark, comparator, passed):
    df = silver(spark, row())
    (result,) = b.run_checks(df, "any", [b.row_count(comparator, 2)]).collect()
    assert result.passed is passed


def test_one_scan_for_a_whole_set(spark, tmp_path):
    path = str(tmp_path / "silver")
    silver(spark, row()).write.parquet(path)
    results = b.run_checks(spark.read.parquet(path), "daily_trades")
    assert results._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_outcome_policy(spark, caplog):
    results = b.run_checks(silver(spark, row(open=-1.0)), "daily_trades")
    with caplog.at_level("WARNING"):
        rows = b.enforce(results)
    assert len(rows) == 5
    assert "invalid_count(daily_open < 0) = 0" in caplog.text
    with pytest.raises(b.CheckFailed, match="daily_open") as failure:
        b.enforce(results, "raise")
    assert [r.value for r in failure.value.failed] == [1]
    with pytest.raises(ValueError):
        b.enforce(results, "ignore")


def test_view_for_sql(spark):
    b.run_checks(silver(spark, row(), row()), "daily_trades", view=True)
    assert spark.sql("SELECT count(*) FROM daily_trades").first()[0] == 2


def test_unknown_names_are_refused(spark):
    with pytest.raises(ValueError):
        b.Check("row_count", comparator="~")
    with pytest.raises(ValueError):
        b.duplicate_count()
    with pytest.raises(KeyError):
        b.run_checks(silver(spark, row()), "unknown")
    with pytest.raises(ValueError):
        b.run_checks(silver(spark, row()), "any", [])
    with pytest.raises(ValueError):
        b.Check("odd", ("symbol",))
    with pytest.raises(ValueError):
        b.Check("invalid_count", ("daily_open",))
