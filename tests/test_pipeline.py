"""End to end: load, refresh, re-run, policy, and incremental ingest."""

import json
import os
import shutil
import time
from datetime import date

import pytest
from pyspark.errors import StreamingQueryException

import barlake as b
from barlake.__main__ import main
from barlake.plans import pipeline
from barlake.sources import staging, tables
from barlake.streaming import ingest


def bar(open, close, volume=10):
    return {
        "1. open": str(open),
        "2. high": str(max(open, close)),
        "3. low": str(min(open, close)),
        "4. close": str(close),
        "5. volume": str(volume),
    }


def land(folder, name, symbol, series):
    folder.mkdir(parents=True, exist_ok=True)
    payload = {"Meta Data": {"2. Symbol": symbol}, "Time Series (1min)": series}
    (folder / name).write_text(json.dumps(payload, indent=1))


def two_days(shift=0.0):
    return {
        "2024-01-02 09:31:00": bar(2 + shift, 3),
        "2024-01-02 09:30:00": bar(1 + shift, 2),
        "2024-01-03 09:30:00": bar(5 + shift, 4, 7),
    }


def silver(spark, warehouse):
    rows = b.read_table(spark, b.DAILY_TRADES, warehouse).collect()
    return sorted(
        (str(r.trade_date), r.symbol, r.daily_open, r.daily_close, r.daily_volume) for r in rows
    )


TWO = [
    ("2024-01-02", "A", 1.0, 3.0, 20),
    ("2024-01-02", "B", 1.5, 3.0, 20),
    ("2024-01-03", "A", 5.0, 4.0, 7),
    ("2024-01-03", "B", 5.5, 4.0, 7),
]


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    land(folder, "a.json", "A", two_days())
    land(folder, "b.json", "B", two_days(0.5))
    (folder / "bad.json").write_text('{"Information": "rate limit"}')
    return folder


def test_end_to_end(spark, landing, tmp_path):
    w = str(tmp_path / "wh")
    result = b.run_pipeline(spark, str(landing), w, batch_id=42)
    assert silver(spark, w) == TWO
    assert (result.batch_id, result.rejected) == (42, 1)
    assert all(r.passed for r in result.bronze_checks + result.silver_checks)
    rejects = b.read_table(spark, b.REJECTS, w).collect()
    assert [(r.batch_id, r.reason) for r in rejects] == [(42, "no metadata")]


def test_batch_id_is_fixed_when_taken(spark, landing, tmp_path):
    w = str(tmp_path / "wh")
    before = int(time.time())
    result = b.run_pipeline(spark, str(landing), w)
    assert before <= result.batch_id <= int(time.time())
    ids = {r[0] for r in b.read_bars(spark, w).select("batch_id").distinct().collect()}
    assert ids == {result.batch_id}


@pytest.mark.parametrize("recompute", ["all", "touched"])
def test_rerun_changes_nothing(spark, landing, tmp_path, recompute):
    w = str(tmp_path / "wh")
    for batch_id in (1, 2):
        b.run_pipeline(spark, str(landing), w, batch_id=batch_id, recompute=recompute)
        assert silver(spark, w) == TWO
    assert b.read_bars(spark, w).count() == 12


def test_deduplicate_bronze(spark, landing, tmp_path):
    w = str(tmp_path / "wh")
    for batch_id in (1, 2, 3):
        b.load_bronze(b.read_payloads(spark, str(landing)), w, batch_id)
    b.deduplicate_bronze(spark, w, date="2024-01-03")
    counts = dict(b.read_bars(spark, w).groupBy("partition").count().collect())
    assert counts == {"2024-01-02": 12, "2024-01-03": 2}
    main(["dedup", "--warehouse", w])
    bars = b.read_bars(spark, w).collect()
    assert len(bars) == 6 and {r.batch_id for r in bars} == {3}
    b.refresh_silver(spark, w)
    assert silver(spark, w) == TWO


def test_append_mode_doubles_silver(spark, landing, tmp_path):
    w = str(tmp_path / "wh")
    for batch_id in (1, 2):
        b.run_pipeline(spark, str(landing), w, batch_id=batch_id, mode="append")
    assert silver(spark, w) == sorted(TWO + TWO)


def test_date_and_symbol(spark, landing, tmp_path):
    w = str(tmp_path / "wh")
    b.run_pipeline(spark, str(landing), w, batch_id=1, date="2024-01-02", symbol="A")
    assert silver(spark, w) == TWO[:1]
    b.refresh_silver(spark, w, date="2024-01-02")
    assert silver(spark, w) == TWO[:2]
    b.refresh_silver(spark, w, symbol="B")
    assert silver(spark, w) == [*TWO[:2], TWO[3]]
    b.refresh_silver(spark, w)
    assert silver(spark, w) == TWO


def test_one_symbol_corrected(spark, landing, tmp_path):
    w = str(tmp_path / "wh")
    b.run_pipeline(spark, str(landing), w, batch_id=1)
    fix = tmp_path / "fix"
    land(fix, "a.json", "A", {"2024-01-02 09:30:00": bar(9, 2)})
    b.run_pipeline(spark, str(fix), w, batch_id=2, symbol="A", recompute="touched")
    assert silver(spark, w) == [("2024-01-02", "A", 9.0, 3.0, 20), *TWO[1:]]


def test_touched_reads_only_its_days(spark, landing, tmp_path):
    w = str(tmp_path / "wh")
    with pipeline.loaded(b.read_payloads(spark, str(landing)), w, 1) as load:
        assert sorted(r[0] for r in load.days.collect()) == ["2024-01-02", "2024-01-03"]
    b.run_pipeline(spark, str(landing), w, batch_id=2)
    days = spark.createDataFrame([("2024-01-02",), ("",)], "_day string")
    for table, column in ((b.TRADE, "partition"), (b.DAILY_TRADES, "trade_date")):
        with staging.staged(days, "days") as stored:
            rows = tables.on_days(b.read_table(spark, table, w), column, stored)
            assert {str(r[column]) for r in rows.collect()} == {"2024-01-02"}
            text = rows._jdf.queryExecution().executedPlan().toString()
            filters = text.split("PartitionFilters: [")[1].split("PushedFilters")[0]
            assert "dynamicpruning" in filters


def test_touched_with_a_bar_without_time(spark, tmp_path):
    landing, w = tmp_path / "landing", str(tmp_path / "wh")
    land(landing, "a.json", "A", {"bad time": bar(1, 2), "2024-01-02 09:30:00": bar(3, 4)})
    for batch_id in (1, 2):
        b.run_pipeline(spark, str(landing), w, batch_id=batch_id, recompute="touched")
        assert silver(spark, w) == [
            ("2024-01-02", "A", 3.0, 4.0, 10),
            ("None", "A", 1.0, 2.0, 10),
        ]


def test_appended_days_are_stored_once(spark, tmp_path):
    """Two batches of many days each, appended: as rolled up day by day."""
    w = str(tmp_path / "wh")
    expected = []
    for batch_id, month in ((1, "01"), (2, "02")):
        landing = tmp_path / month
        times = [f"2024-{month}-{day:02} 09:30:00" for day in range(1, 29)]
        land(landing, "a.json", "A", {t: bar(i, i + 1, i) for i, t in enumerate(times)})
        b.run_pipeline(spark, str(landing), w, batch_id=batch_id, mode="append")
        expected += [(t[:10], "A", float(i), i + 1.0, i) for i, t in enumerate(times)]
    assert silver(spark, w) == expected


def test_days_without_repeats_keep_their_files(spark, landing, tmp_path):
    w = str(tmp_path / "wh")
    more = tmp_path / "more"
    land(more, "a.json", "A", {"2024-01-03 09:30:00": bar(5, 4, 7)})
    for batch_id, folder in ((1, landing), (2, more)):
        b.load_bronze(b.read_payloads(spark, str(folder)), w, batch_id)
    files = lambda: {f for f in b.read_bars(spark, w).inputFiles()}
    before = files()
    b.deduplicate_bronze(spark, w)
    assert {f for f in before if "2024-01-02" in f} == {f for f in files() if "2024-01-02" in f}
    assert not {f for f in before if "2024-01-03" in f} & files()
    assert b.read_bars(spark, w).count() == 6


def test_rows_survive_a_rewrite_that_fails(spark, landing, tmp_path, monkeypatch):
    w = str(tmp_path / "wh")
    for batch_id in (1, 2):
        b.load_bronze(b.read_payloads(spark, str(landing)), w, batch_id)

    def broken(*args, **kwargs):
        raise RuntimeError("lost")

    monkeypatch.setattr(pipeline, "write_table", broken)
    with pytest.raises(RuntimeError) as caught:
        b.deduplicate_bronze(spark, w)
    (note,) = [n for n in caught.value.__notes__ if "kept in" in n]
    assert spark.read.parquet(note.split("kept in ")[1]).count() == 6


def test_the_later_of_two_loads_in_a_second_wins(spark, tmp_path, monkeypatch):
    w = str(tmp_path / "wh")
    monkeypatch.setattr(pipeline.time, "time", lambda: 1_700_000_000)
    ids = []
    for open_price in (9, 5):
        landing = tmp_path / str(open_price)
        land(landing, "a.json", "A", {"2024-01-02 09:30:00": bar(open_price, 2)})
        ids.append(b.run_pipeline(spark, str(landing), w).batch_id)
    assert ids == [1_700_000_000, 1_700_000_001]
    assert silver(spark, w) == [("2024-01-02", "A", 5.0, 2.0, 10)]
    shutil.rmtree(f"{w}/_last_batch_id")
    assert b.run_pipeline(spark, str(landing), w).batch_id == 1_700_000_002


def test_open_of_bars_without_time_does_not_depend_on_partitioning(spark, tmp_path):
    landing, w = tmp_path / "landing", str(tmp_path / "wh")
    land(landing, "a.json", "A", {f"no time {i}": bar(100 + i, 200 + i) for i in range(40)})
    b.run_pipeline(spark, str(landing), w, batch_id=1)
    assert silver(spark, w) == [("None", "A", 100.0, 239.0, 400)]
    for n in (1, 3, 8):
        rows = b.daily_rollup(b.dedup_latest(b.read_bars(spark, w).repartition(n))).collect()
        assert [(r.daily_open, r.daily_close) for r in rows] == [(100.0, 239.0)]


def test_failed_checks_report_or_raise(spark, tmp_path):
    landing = tmp_path / "landing"
    land(landing, "a.json", "A", {"2024-01-02 09:30:00": bar(-1, 2)})
    reported = b.run_pipeline(spark, str(landing), str(tmp_path / "wh1"), batch_id=1)
    assert [r.column_list for r in reported.silver_checks if not r.passed] == ["daily_open"]
    assert len(silver(spark, str(tmp_path / "wh1"))) == 1

    w = str(tmp_path / "wh2")
    with pytest.raises(b.CheckFailed):
        b.run_pipeline(spark, str(landing), w, batch_id=1, on_fail="raise")
    assert b.read_bars(spark, w).count() == 1  # bronze passed its own checks
    assert not staging.path_exists(spark, f"{w}/daily_trades")


def test_empty_batch_loads_nothing(spark, tmp_path):
    landing, w = tmp_path / "landing", str(tmp_path / "wh")
    landing.mkdir()
    (landing / "bad.json").write_text("nothing")
    result = b.run_pipeline(spark, str(landing), w, batch_id=1)
    assert [r.passed for r in result.bronze_checks] == [False, True]
    assert silver(spark, w) == []
    b.run_pipeline(spark, str(landing), w, batch_id=2, recompute="touched", symbol="A")
    assert silver(spark, w) == []
    with pytest.raises(b.CheckFailed):
        b.run_pipeline(spark, str(landing), str(tmp_path / "wh2"), batch_id=1, on_fail="raise")
    assert not staging.path_exists(spark, str(tmp_path / "wh2"))


@pytest.mark.parametrize("recompute", ["all", "touched"])
def test_catalog_sees_new_days(spark, landing, tmp_path, recompute):
    w, db = str(tmp_path / "wh"), f"test_pipeline_{recompute}"
    b.create_tables(spark, w, db)
    b.create_silver_tables(spark, w, db)
    more = tmp_path / "more"
    land(more, "a.json", "A", {"2024-01-04 09:30:00": bar(1, 2), "2024-01-02 10:00:00": bar(1, 5)})
    undated = tmp_path / "undated"
    land(undated, "a.json", "A", {"no time": bar(1, 2, 1000)})
    volumes = []
    for batch_id, folder in enumerate((landing, landing, more, undated)):
        b.run_pipeline(
            spark, str(folder), w, batch_id=batch_id, database=db, recompute=recompute
        )
        bars = spark.table(f"{db}.trade").count()
        volume = spark.sql(f"SELECT sum(daily_volume) FROM {db}.daily_trades").first()[0]
        volumes.append((bars, volume))
    assert volumes == [(6, 54), (12, 54), (14, 74), (15, 1074)]
    b.drop_tables(spark, db)


def test_unknown_modes_are_refused(spark, landing, tmp_path):
    with pytest.raises(ValueError):
        b.run_pipeline(spark, str(landing), str(tmp_path / "wh"), recompute="some")
    with pytest.raises(ValueError):
        b.refresh_silver(spark, str(tmp_path / "wh"), mode="merge")


def test_stream_reads_each_file_once(spark, tmp_path):
    landing, w, state = tmp_path / "landing", str(tmp_path / "wh"), str(tmp_path / "state")
    land(landing, "a.json", "A", two_days())
    b.ingest_stream(spark, str(landing), w, state).awaitTermination()
    assert silver(spark, w) == [r for r in TWO if r[1] == "A"]
    land(landing, "b.json", "B", two_days(0.5))
    b.ingest_stream(spark, str(landing), w, state).awaitTermination()
    assert silver(spark, w) == TWO
    assert b.read_bars(spark, w).count() == 6
    # Nothing new: nothing is loaded.
    b.ingest_stream(spark, str(landing), w, state).awaitTermination()
    assert b.read_bars(spark, w).count() == 6


def test_stream_in_small_batches_with_late_bar(spark, tmp_path):
    landing, w, state = tmp_path / "landing", str(tmp_path / "wh"), str(tmp_path / "state")
    land(landing, "1.json", "A", {"2024-01-02 09:31:00": bar(2, 3)})
    land(landing, "2.json", "A", {"2024-01-03 09:30:00": bar(5, 4, 7)})
    land(landing, "3.json", "A", {"2024-01-02 09:30:00": bar(1, 2)})
    b.ingest_stream(spark, str(landing), w, state, max_files_per_trigger=1).awaitTermination()
    assert silver(spark, w) == [r for r in TWO if r[1] == "A"]
    dates = {r.trade_date for r in b.read_bars(spark, w).collect()}
    assert dates == {date(2024, 1, 2), date(2024, 1, 3)}


def test_stream_correction_wins_over_an_earlier_micro_batch(spark, tmp_path):
    landing, w, state = tmp_path / "landing", str(tmp_path / "wh"), str(tmp_path / "state")
    for age, (name, open_price) in enumerate((("c.json", 9), ("b.json", 5), ("a.json", 7))):
        land(landing, name, "A", {"2024-01-02 09:30:00": bar(open_price, 2)})
        os.utime(landing / name, (1_700_000_000 + age,) * 2)
    b.ingest_stream(spark, str(landing), w, state, max_files_per_trigger=1).awaitTermination()
    assert silver(spark, w) == [("2024-01-02", "A", 7.0, 2.0, 10)]
    assert b.read_bars(spark, w).select("batch_id").distinct().count() == 3


def test_stream_repeats_a_failed_micro_batch(spark, tmp_path, monkeypatch):
    """A failure between the two tables: the bars are in both once."""
    landing, w, state = tmp_path / "landing", str(tmp_path / "wh"), str(tmp_path / "state")
    land(landing, "a.json", "A", two_days())

    def broken(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(ingest, "refresh_silver", broken)
        with pytest.raises(StreamingQueryException):
            b.ingest_stream(spark, str(landing), w, state).awaitTermination()
    assert not staging.path_exists(spark, f"{w}/daily_trades")
    assert b.read_bars(spark, w).count() == 3
    b.ingest_stream(spark, str(landing), w, state).awaitTermination()
    assert b.read_bars(spark, w).count() == 3
    assert b.read_bars(spark, w).select("batch_id").distinct().count() == 1
    assert silver(spark, w) == [r for r in TWO if r[1] == "A"]


def test_jobs(spark, landing, tmp_path, capsys):
    w, db = str(tmp_path / "wh"), "test_jobs"
    common = ["--landing", str(landing), "--warehouse", w]
    main(["ddl", "--warehouse", w, "--database", db])
    main(["run", *common, "--database", db, "--date", "2024-01-02", "--symbol", "A"])
    assert silver(spark, w) == TWO[:1]
    assert "1 payloads rejected" in capsys.readouterr().out
    main(["run", *common, "--database", db, "--recompute", "touched"])
    assert silver(spark, w) == TWO
    assert spark.table(f"{db}.daily_trades").count() == 4
    b.drop_tables(spark, db)
    w = str(tmp_path / "wh2")
    common = ["--landing", str(landing), "--warehouse", w]
    main(["stream", *common, "--checkpoint", str(tmp_path / "state"), "--max-files", "1"])
    assert silver(spark, w) == TWO
    main(["csv", "--landing", str(landing), "--folder", str(tmp_path / "csv")])
    path = capsys.readouterr().out.split()[-1]
    assert spark.read.option("header", True).csv(path).count() == 6
