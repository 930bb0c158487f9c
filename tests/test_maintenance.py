"""Checks by group, compaction, days replaced by location."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

import barlake as b
from barlake.__main__ import main
from barlake.operators import quality
from barlake.plans import compaction
from barlake.sources import catalog, files
from tests.test_pipeline import TWO, bar, land, silver, two_days


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- checks by group ----------------------------------------------------------

CHECKS = [
    b.row_count(">", 2),
    b.missing_count("v"),
    b.duplicate_count("k", "s"),
    b.invalid_count("v", valid_min=3),
]


def checked(rows):
    """Values of ``CHECKS`` over rows of ``(d, s, k, v)``."""
    keys = [(k, s) for _, s, k, _ in rows if k is not None and s is not None]
    return [
        len(rows),
        sum(v is None for *_, v in rows),
        len({x for x in keys if keys.count(x) > 1}),
        sum(v is not None and v < 3 for *_, v in rows),
    ]


def test_checks_by_group_against_a_model(spark):
    rng = random.Random(6)
    rows = [
        tuple(rng.choice(values) for values in ([1, 2, None], ["x", "y", None], [7, 8, None], [1, 5, None]))
        for _ in range(60)
    ]
    df = spark.createDataFrame(rows, "d int, s string, k int, v int")
    got = b.run_checks_by(df, "made", ["d"], ["s"], ["d", "s"], checks=CHECKS).collect()
    want = {}
    for by, cut in (("d", lambda r: r[:1]), ("s", lambda r: r[1:2]), ("d, s", lambda r: r[:2])):
        for group in {cut(r) for r in rows}:
            values = checked([r for r in rows if cut(r) == group])
            for check, value in zip(CHECKS, values):
                text = tuple(None if g is None else str(g) for g in group)
                passed = value > 2 if check.metric == "row_count" else value == 0
                want[by, text, check.text] = (value, passed)
    assert {(r["by"], tuple(r["group"]), r["check"]): (r["value"], r["passed"]) for r in got} == want
    assert [f.name for f in b.run_checks_by(df, "made", ["d"], checks=CHECKS).schema] == [
        f.name for f in b.GROUPED_RESULT_SCHEMA
    ]


def test_checks_by_group_read_once(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).select(
        (F.col("id") % 3).alias("d"), F.lit("s").alias("s"), F.col("id").alias("k"),
        F.col("id").alias("v"), F.lit("x").alias("other"),
    ).write.parquet(path)
    df = spark.read.parquet(path)
    text = plan(b.run_checks_by(df, "made", ["d"], ["s"], checks=CHECKS))
    assert text.count("FileScan") == 1 and "other" not in text.split("ReadSchema")[1].split("\n")[0]
    assert text.count("Exchange hashpartitioning") == 2  # by group and key, by group
    row_wise = [c for c in CHECKS if c.metric != "duplicate_count"]
    alone = b.run_checks_by(df, "made", ["d"], checks=row_wise).collect()
    assert len(alone) == 9 and sum(r["value"] for r in alone if r["metric"] == "row_count") == 100
    assert b.run_checks_by(df.limit(0), "made", ["d"], checks=CHECKS).collect() == []


@pytest.mark.parametrize("by", [[], [[]]])
def test_a_grouping_needs_columns(spark, by):
    with pytest.raises(ValueError):
        b.run_checks_by(spark.range(1), "made", *by, checks=[b.row_count()])
    with pytest.raises(ValueError):
        b.run_checks_by(spark.range(1), "made", ["id"], checks=[])
    assert quality.failures([]) == []


# --- compaction ---------------------------------------------------------------


def test_only_crowded_days_are_rewritten(spark, tmp_path):
    w = str(tmp_path / "wh")
    for batch_id in range(4):
        series = {"2024-01-02 09:30:00": bar(1, 2, batch_id), "no time": bar(1, 1, batch_id)}
        if batch_id < 2:
            series["2024-01-03 09:30:00"] = bar(3, 4, batch_id)
        land(tmp_path / str(batch_id), "a.json", "A", series)
        b.load_bronze(b.read_payloads(spark, str(tmp_path / str(batch_id))), w, batch_id + 1)
    rows = sorted(map(str, b.read_table(spark, b.TRADE, w).collect()))
    paths = lambda: set(b.read_table(spark, b.TRADE, w).inputFiles())
    before = paths()
    assert b.compact(spark, b.TRADE, w, at_least=3) == 2  # the second, and the one without a day
    after = paths()
    assert {p for p in before & after} == {p for p in before if "2024-01-03" in p}
    assert len(after) == 2 + 2
    assert sorted(map(str, b.read_table(spark, b.TRADE, w).collect())) == rows
    assert b.compact(spark, b.TRADE, w, at_least=3) == 0 and paths() == after
    # Large files are left alone.
    assert b.compact(spark, b.TRADE, w, small=1, at_least=2) == 0
    main(["compact", "--warehouse", w, "--at-least", "2"])
    assert len(paths()) == 3 and sorted(map(str, b.read_table(spark, b.TRADE, w).collect())) == rows
    with pytest.raises(ValueError):
        b.compact(spark, b.REJECTS, w)


def test_finding_crowded_days_reads_no_rows(spark, tmp_path):
    w = str(tmp_path / "wh")
    land(tmp_path / "a", "a.json", "A", two_days())
    b.load_bronze(b.read_payloads(spark, str(tmp_path / "a")), w, 1)
    text = plan(compaction.crowded_days(spark, b.TRADE, w))
    assert "FileScan binaryFile" in text or "FileScan" in text and "content" not in text
    assert "parquet" not in text


# --- days replaced by location ------------------------------------------------


@pytest.fixture
def market(spark, tmp_path):
    database = f"swap_{tmp_path.name}".replace("-", "_")
    b.create_tables(spark, str(tmp_path / "wh"), database)
    b.create_silver_tables(spark, str(tmp_path / "wh"), database)
    yield database
    b.drop_tables(spark, database)


def days(spark, market):
    rows = spark.table(f"{market}.daily_trades").collect()
    return sorted(
        (str(r.trade_date), r.symbol, r.daily_open, r.daily_close, r.daily_volume) for r in rows
    )


def test_a_reader_in_between_misses_no_day(spark, tmp_path, market, monkeypatch):
    w = str(tmp_path / "wh")
    land(tmp_path / "landing", "a.json", "A", two_days())
    land(tmp_path / "landing", "b.json", "B", two_days(0.5))
    how = {"mode": "swap", "database": market}
    b.run_pipeline(spark, str(tmp_path / "landing"), w, **how)
    assert days(spark, market) == TWO
    seen = []
    real = catalog._point

    def point(*args):
        seen.append(days(spark, market))
        real(*args)
        seen.append(days(spark, market))

    land(tmp_path / "landing", "a.json", "A", two_days(1))
    begun = spark.table(f"{market}.daily_trades")
    begun.count()
    monkeypatch.setattr(catalog, "_point", point)
    b.run_pipeline(spark, str(tmp_path / "landing"), w, store="changed", **how)
    new = [("2024-01-02", "A", 2.0, 3.0, 20), TWO[1], ("2024-01-03", "A", 6.0, 4.0, 7), TWO[3]]
    assert days(spark, market) == new
    # Whatever the moment: four rows, each the old or the new one.
    assert len(seen) == 4 and all(len(rows) == 4 for rows in seen)
    assert all(row in TWO or row in new for rows in seen for row in rows)
    # The old files are there for readers that have begun, until they are dropped.
    assert b.drop_unused(spark, b.DAILY_TRADES, market, w) == 0
    assert b.drop_unused(spark, b.DAILY_TRADES, market, w, seconds=0) == 2
    assert days(spark, market) == new
    assert b.drop_unused(spark, b.DAILY_TRADES, market, w, seconds=0) == 0


def test_one_symbol_and_rows_without_a_day(spark, tmp_path, market):
    w = str(tmp_path / "wh")
    land(tmp_path / "landing", "a.json", "A", two_days() | {"bad": bar(1, 2)})
    land(tmp_path / "landing", "b.json", "B", two_days(0.5) | {"bad": bar(3, 4)})
    how = {"mode": "swap", "database": market}
    b.run_pipeline(spark, str(tmp_path / "landing"), w, **how)
    undated = [("None", "A", 1.0, 2.0, 10), ("None", "B", 3.0, 4.0, 10)]
    assert days(spark, market) == [*TWO, *undated]
    land(tmp_path / "more", "a.json", "A", {"2024-01-02 09:30:00": bar(9, 2)})
    b.run_pipeline(spark, str(tmp_path / "more"), w, symbol="A", **how)
    assert days(spark, market) == [("2024-01-02", "A", 9.0, 3.0, 20), *TWO[1:], *undated]
    with pytest.raises(ValueError, match="database"):
        b.refresh_silver(spark, w, mode="swap")


def test_days_given_by_path_that_were_never_swapped_stay(spark, tmp_path, market):
    """What the catalog still names is not dropped."""
    w = str(tmp_path / "wh")
    day = datetime.date(2024, 1, 2)
    rows = spark.createDataFrame(
        [(day, "A", 1, 1.0, 1.0, 1.0, 1.0), (datetime.date(2024, 1, 3), "A", 1, 1.0, 1.0, 1.0, 1.0)],
        b.DAILY_SCHEMA,
    )
    b.write_table(rows, b.DAILY_TRADES, w)
    b.sync_partitions(spark, b.DAILY_TRADES, market)
    b.swap_days(rows.filter(F.col("trade_date") == F.lit(day)), b.DAILY_TRADES, market, w)
    assert b.drop_unused(spark, b.DAILY_TRADES, market, w, seconds=0) == 1
    assert spark.table(f"{market}.daily_trades").count() == 2
    assert files.path_exists(spark, f"{b.DAILY_TRADES.path(w)}/trade_date=2024-01-03")
    assert silver(spark, w)[0][0] == "2024-01-03"
