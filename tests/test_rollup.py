"""Roll-up semantics, parity with the window form, and plan shapes."""

import random
from datetime import date, datetime, timedelta

import pytest

import barlake as b
from barlake.sources.adapters import bars_to_payloads, events_to_bars

SCHEMA = (
    "batch_id long, trade_timestamp timestamp, symbol string, open double, high double,"
    " low double, close double, volume int"
)
T0 = datetime(2024, 1, 2, 9, 30)

# The same result by windows over every bar, for comparison only.
DAY_SYMBOL = "PARTITION BY to_date(trade_timestamp), symbol"
WINDOW_FORM = f"""
SELECT DISTINCT to_date(trade_timestamp) AS trade_date, symbol,
       first(open) OVER ({DAY_SYMBOL} ORDER BY trade_timestamp) AS daily_open,
       first(close) OVER ({DAY_SYMBOL} ORDER BY trade_timestamp DESC) AS daily_close,
       max(high) OVER ({DAY_SYMBOL}) AS daily_high,
       min(low) OVER ({DAY_SYMBOL}) AS daily_low,
       sum(volume) OVER ({DAY_SYMBOL}) AS daily_volume
FROM {{bars}}
"""


def bar(minute, symbol="A", batch=1, open=1.0, high=2.0, low=0.5, close=1.5, volume=10):
    ts = None if minute is None else T0 + timedelta(minutes=minute)
    return (batch, ts, symbol, open, high, low, close, volume)


def make(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def daily(df):
    return {(r.trade_date, r.symbol): r for r in b.daily_rollup(df).collect()}


def listed(df):
    """Rows as sorted text, so that NaN equals NaN."""
    return sorted(repr(tuple(r)) for r in df.collect())


def same_rows(a, b):
    return a.columns == b.columns and listed(a) == listed(b)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_bar_keeps_its_null(spark):
    df = make(spark, bar(1, open=5.0), bar(0, open=None), bar(2, close=None))
    (row,) = daily(df).values()
    assert (row.daily_open, row.daily_close) == (None, None)
    assert row.daily_volume == 30


def test_bars_without_time_form_a_group(spark):
    df = make(spark, bar(None, open=7.0, close=8.0), bar(0))
    row = daily(df)[(None, "A")]
    assert (row.daily_open, row.daily_close) == (7.0, 8.0)


def test_null_time_comes_first_in_a_given_day(spark):
    day = date(2024, 1, 2)
    df = spark.createDataFrame(
        [(*bar(None, open=7.0, close=8.0), day), (*bar(0, open=1.0, close=2.0), day)],
        SCHEMA + ", trade_date date",
    )
    (row,) = daily(df).values()
    assert (row.daily_open, row.daily_close) == (7.0, 2.0)


def test_aggregates_skip_nulls(spark):
    df = make(
        spark,
        bar(0, high=None, low=None, volume=None),
        bar(1, high=3.0, low=1.0, volume=5),
        bar(0, symbol="B", volume=None),
        bar(0, symbol=None),
    )
    rows = {symbol: r for (_, symbol), r in daily(df).items()}
    assert (rows["A"].daily_high, rows["A"].daily_low, rows["A"].daily_volume) == (3.0, 1.0, 5)
    assert rows["B"].daily_volume is None
    assert rows[None].daily_volume == 10


def test_volume_sum_is_wider_than_int(spark):
    df = make(spark, bar(0, volume=2**31 - 1), bar(1, volume=2**31 - 1))
    (row,) = daily(df).values()
    assert row.daily_volume == 2 * (2**31 - 1)


def random_bars(seed, n=400):
    rng = random.Random(seed)
    maybe = lambda value: None if rng.random() < 0.15 else value
    minutes = rng.sample(range(4 * 1440), n)
    return [
        bar(
            m if rng.random() > 0.02 or i else None,
            symbol=maybe(rng.choice("ABC")),
            open=maybe(rng.random()),
            high=maybe(rng.random()),
            low=maybe(float("nan") if rng.random() < 0.05 else rng.random()),
            close=maybe(rng.random()),
            volume=maybe(rng.randrange(1000)),
        )
        for i, m in enumerate(minutes)
    ]


@pytest.mark.parametrize("seed", range(5))
def test_equals_window_form(spark, seed):
    df = make(spark, *random_bars(seed))
    got = b.daily_rollup(df)
    want = spark.sql(WINDOW_FORM, bars=df)
    assert same_rows(got, want)


@pytest.mark.parametrize("seed", range(3))
def test_annotate_keeps_every_bar(spark, seed):
    df = make(spark, *random_bars(seed))
    annotated = b.annotate_daily(df)
    assert annotated.count() == df.count()
    assert same_rows(b.daily_distinct(annotated), b.daily_rollup(df))


def test_annotate_by_shuffled_join(spark):
    """The join gives the same rows when nothing is small enough to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    df = make(spark, *random_bars(11))
    small = listed(b.annotate_daily(df))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = b.annotate_daily(df)
        assert "SortMergeJoin" in plan(large)
        assert listed(large) == small
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_rollup_plan_is_one_hash_aggregate(spark):
    text = plan(b.daily_rollup(make(spark, bar(0))))
    assert text.count("Exchange") == 1
    assert "Window" not in text and "SortAggregate" not in text and "Sort " not in text


def test_dedup_keeps_the_latest_batch(spark):
    df = make(spark, bar(0, batch=1, close=1.0), bar(0, batch=2, close=0.5), bar(1, batch=1))
    rows = sorted(b.dedup_latest(df).collect(), key=lambda r: r.trade_timestamp)
    assert [(r.batch_id, r.close) for r in rows] == [(2, 0.5), (1, 1.5)]
    assert rows[0].__fields__ == df.columns


def test_dedup_ties_are_decided_by_value(spark):
    versions = [bar(0, close=c, open=o) for c in (1.0, 2.0, 3.0) for o in (None, 1.0)]
    picks = set()
    for seed in range(4):
        random.Random(seed).shuffle(versions)
        (row,) = b.dedup_latest(make(spark, *versions)).collect()
        picks.add((row.open, row.close))
    assert picks == {(1.0, 3.0)}


def test_dedup_without_time_drops_only_equal_bars(spark):
    df = make(
        spark,
        bar(None, batch=1, open=7.0),
        bar(None, batch=2, open=7.0),
        bar(None, batch=2, open=8.0),
        bar(None, batch=2, symbol=None),
        bar(None, batch=3, symbol=None),
    )
    rows = b.dedup_latest(df).collect()
    assert sorted((r.symbol or "", r.batch_id, r.open) for r in rows) == [
        ("", 3, 1.0),
        ("A", 2, 7.0),
        ("A", 2, 8.0),
    ]


def test_dedup_cuts_copies_before_the_shuffle(spark):
    lines = plan(b.dedup_latest(make(spark, bar(0)))).splitlines()
    shuffle = next(i for i, line in enumerate(lines) if "Exchange" in line)
    assert any("WindowGroupLimit" in line and "Partial" in line for line in lines[shuffle:])


@pytest.mark.parametrize("block", [1, 16, 8192])
def test_payload_round_trip_in_blocks(spark, block):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    bars = events_to_bars(events).repartition(3)
    payloads = bars_to_payloads(bars, bars_per_payload=block)
    got, rejects = b.normalize_payloads(payloads, 1)
    got = got.withColumn("trade_timestamp", got.trade_timestamp.cast("timestamp_ntz"))
    assert got.exceptAll(bars).isEmpty() and bars.exceptAll(got).isEmpty()
    assert rejects.isEmpty()
    if block == 1:
        assert payloads.count() == bars.count()


def test_block_size_must_be_a_power_of_two(spark):
    with pytest.raises(ValueError):
        bars_to_payloads(make(spark, bar(0)), bars_per_payload=100)
