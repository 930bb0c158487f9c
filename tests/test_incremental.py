"""Repeated polls, failed runs, interrupted replacements, diverted batches, one writer."""

import json
import threading
import time

import pytest
from pyspark.errors import StreamingQueryException

import barlake as b
from barlake.__main__ import main
from barlake.operators.changes import changed_bars
from barlake.plans import pending, pipeline, recovery
from barlake.sources import files, lease, staging, tables
from tests.test_pipeline import TWO, bar, land, silver, two_days


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    land(folder, "a.json", "A", two_days())
    land(folder, "b.json", "B", two_days(0.5))
    return folder


def bars_of(spark, rows):
    return spark.createDataFrame(
        [(r[0], *r[1:], "d") for r in rows],
        "batch_id long, trade_timestamp timestamp, symbol string, open double, high double,"
        " low double, close double, volume int, partition string",
    )


def load_changed(spark, folder, warehouse, batch_id, **how):
    return b.run_pipeline(spark, str(folder), warehouse, batch_id=batch_id, store="changed", **how)


# --- only what is new ---------------------------------------------------------


def test_an_equal_poll_stores_nothing_and_touches_no_day(spark, landing, tmp_path):
    w = str(tmp_path / "wh")
    load_changed(spark, landing, w, 1)
    files_before = set(b.read_bars(spark, w).inputFiles())
    silver_before = set(b.read_table(spark, b.DAILY_TRADES, w).inputFiles())
    load_changed(spark, landing, w, 2, on_fail="raise")
    assert set(b.read_bars(spark, w).inputFiles()) == files_before
    assert set(b.read_table(spark, b.DAILY_TRADES, w).inputFiles()) == silver_before
    assert silver(spark, w) == TWO and pending.records(spark, w) == []


def test_a_corrected_bar_touches_its_day_only(spark, landing, tmp_path):
    w = str(tmp_path / "wh")
    load_changed(spark, landing, w, 1)
    kept = {f for f in b.read_table(spark, b.DAILY_TRADES, w).inputFiles() if "01-03" in f}
    series = two_days()
    series["2024-01-02 09:30:00"] = bar(9, 2)
    land(landing, "a.json", "A", series)
    load_changed(spark, landing, w, 2)
    assert b.read_bars(spark, w).filter("batch_id = 2").count() == 1
    assert silver(spark, w) == [("2024-01-02", "A", 9.0, 3.0, 20), *TWO[1:]]
    assert kept == {f for f in b.read_table(spark, b.DAILY_TRADES, w).inputFiles() if "01-03" in f}
    # Back to the first value: that is a change again.
    land(landing, "a.json", "A", two_days())
    load_changed(spark, landing, w, 3)
    assert b.read_bars(spark, w).filter("batch_id = 3").count() == 1
    assert silver(spark, w) == TWO


def test_changed_bars_against_a_model(spark):
    """Nulls, bars without a time, several versions on both sides."""
    t = [None, "2024-01-02 09:30:00", "2024-01-02 09:31:00"]
    times = [None if x is None else __import__("datetime").datetime.fromisoformat(x) for x in t]
    rng = __import__("random").Random(4)

    def made(n, batches):
        return [
            (
                rng.choice(batches), rng.choice(times), rng.choice(["A", "B", None]),
                *[rng.choice([1.0, 2.0, None]) for _ in range(4)], rng.choice([1, None]),
            )
            for _ in range(n)
        ]

    low = lambda v: (v is not None, v or 0)
    identity = lambda r: (r[2], r[1], r[3:] if r[1] is None else None)
    for _ in range(3):
        stored, sent = made(25, [1, 2]), made(25, [3])
        newest, want = {}, {}
        for r in stored:
            key = (low(r[0]), *map(low, r[3:]))
            if identity(r) not in newest or key > newest[identity(r)][0]:
                newest[identity(r)] = (key, r)
        for r in sent:
            key = tuple(map(low, r[3:]))
            if identity(r) not in want or key > want[identity(r)][0]:
                want[identity(r)] = (key, r)
        fresh = {
            r for i, (_, r) in want.items() if i not in newest or newest[i][1][3:] != r[3:]
        }
        got = changed_bars(bars_of(spark, sent), bars_of(spark, stored)).drop("partition").collect()
        assert len(got) == len(fresh) and {tuple(r) for r in got} == fresh


def test_change_detection_reads_only_the_days_sent_and_joins_nothing(spark, landing, tmp_path):
    w = str(tmp_path / "wh")
    b.load_bronze(b.read_payloads(spark, str(landing)), w, 1)
    days = spark.createDataFrame([("2024-01-02",)], "_day string")
    with staging.staged(days, "days") as sent:
        stored = tables.on_days(b.read_table(spark, b.TRADE, w), "partition", sent)
        one = stored.filter("symbol = 'A'")
        plan = changed_bars(one, stored)
        assert plan.collect() == []
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "dynamicpruning" in text
        assert text.count("Join") == text.count("LeftSemi")  # those that prune the days


def test_a_micro_batch_that_is_repeated_stores_its_changes_once(spark, landing, tmp_path, monkeypatch):
    w, state = str(tmp_path / "wh"), str(tmp_path / "state")
    load_changed(spark, landing, w, 1)
    later = tmp_path / "later"
    series = two_days()
    series["2024-01-03 09:30:00"] = bar(6, 4, 7)
    land(later, "a.json", "A", series)

    def broken(*args, **kwargs):
        raise RuntimeError("lost")

    from barlake.streaming import ingest

    stream = lambda: b.ingest_stream(spark, str(later), w, state, store="changed")
    with monkeypatch.context() as patch:
        patch.setattr(ingest, "refresh_silver", broken)
        with pytest.raises(StreamingQueryException):
            stream().awaitTermination()
    assert b.read_bars(spark, w).count() == 7
    stream().awaitTermination()
    assert b.read_bars(spark, w).count() == 7
    assert silver(spark, w)[2] == ("2024-01-03", "A", 6.0, 4.0, 7)


# --- days that still need silver ----------------------------------------------


@pytest.mark.parametrize("store", ["all", "changed"])
def test_the_run_after_a_failed_one_publishes_both_days(spark, tmp_path, monkeypatch, store):
    w = str(tmp_path / "wh")
    for day in ("02", "03"):
        land(tmp_path / day, "a.json", "A", {f"2024-01-{day} 09:30:00": bar(1, 2)})

    def broken(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(pipeline, "_publish", broken)
        with pytest.raises(RuntimeError):
            b.run_pipeline(spark, str(tmp_path / "02"), w, batch_id=1, store=store)
    assert len(pending.records(spark, w)) == 1
    b.run_pipeline(spark, str(tmp_path / "03"), w, batch_id=2, store=store)
    assert [r[0] for r in silver(spark, w)] == ["2024-01-02", "2024-01-03"]
    assert pending.records(spark, w) == []


def test_an_equal_poll_publishes_what_is_pending(spark, landing, tmp_path):
    w = str(tmp_path / "wh")
    b.load_bronze(b.read_payloads(spark, str(landing)), w, 1)
    load_changed(spark, landing, w, 2)
    assert silver(spark, w) == TWO and b.read_bars(spark, w).count() == 6
    b.load_bronze(b.read_payloads(spark, str(landing)), w, 3)
    b.refresh_silver(spark, w, date="2024-01-02")
    assert len(pending.records(spark, w)) == 1  # one day of two was looked at
    b.refresh_silver(spark, w)
    assert pending.records(spark, w) == []


def test_records_are_put_together(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(pending, "_TOGETHER", 2)
    w = str(tmp_path / "wh")
    for day in ("a", "b", "", "a", "c"):
        pending.mark(spark.createDataFrame([(day,)], "_day string"), w)
        assert len(pending.records(spark, w)) <= 3
    days = pending.days_of(spark, pending.records(spark, w)).collect()
    assert sorted(r[0] for r in days) == ["", "a", "b", "c"]


# --- interrupted replacements -------------------------------------------------


def half_written(spark, warehouse, lost_day):
    """A table write that replaces some days and then fails with the others gone."""
    real = tables.write_table

    def write(df, table, w, mode="append", fmt="parquet"):
        if mode != "overwrite_days":
            return real(df, table, w, mode, fmt)
        done = df.filter(df[table.partition].cast("string") != lost_day)
        real(done, table, w, mode, fmt)
        files.remove(spark, f"{table.path(w)}/{table.partition}={lost_day}")
        raise RuntimeError("lost between two days")

    return write


@pytest.mark.parametrize("entry", ["recover", "dedup", "run", "job"])
def test_rows_are_back_after_recover(spark, landing, tmp_path, monkeypatch, entry):
    w = str(tmp_path / "wh")
    for batch_id in (1, 2):
        b.load_bronze(b.read_payloads(spark, str(landing)), w, batch_id)
    with monkeypatch.context() as patch:
        patch.setattr(pipeline, "write_table", half_written(spark, w, "2024-01-03"))
        with pytest.raises(RuntimeError):
            b.deduplicate_bronze(spark, w)
    assert b.read_bars(spark, w).count() == 4
    if entry == "recover":
        assert b.recover(spark, w) == 1
        assert b.recover(spark, w) == 0
    elif entry == "dedup":
        b.deduplicate_bronze(spark, w)
    elif entry == "run":
        load_changed(spark, landing, w, 3)
    else:
        main(["recover", "--warehouse", w])
    assert b.read_bars(spark, w).count() == 6
    b.refresh_silver(spark, w)
    assert silver(spark, w) == TWO
    assert files.names_in(spark, staging.intents_dir(w)) == []


def test_recovery_that_is_interrupted_itself(spark, landing, tmp_path, monkeypatch):
    w = str(tmp_path / "wh")
    b.run_pipeline(spark, str(landing), w, batch_id=1)
    new = b.daily_rollup(b.read_bars(spark, w, symbol="A")).withColumn(
        "daily_open", __import__("pyspark").sql.functions.lit(7.0)
    )
    with monkeypatch.context() as patch:
        patch.setattr(tables, "write_table", half_written(spark, w, "2024-01-02"))
        with pytest.raises(RuntimeError):
            b.replace_days(new, w, symbol="A")
    with monkeypatch.context() as patch:
        patch.setattr(recovery, "write_table", half_written(spark, w, "2024-01-03"))
        with pytest.raises(RuntimeError):
            b.recover(spark, w)
    assert b.recover(spark, w) == 1
    assert [r[2] for r in silver(spark, w)] == [7.0, 1.5, 7.0, 5.5]


def test_a_missing_copy_is_an_error(spark, tmp_path):
    w = str(tmp_path / "wh")
    staging._declare(spark, w, b.TRADE, f"{w}/nowhere", "parquet")
    with pytest.raises(b.CopyMissing, match="nowhere"):
        b.recover(spark, w)


# --- diverted batches and days ------------------------------------------------


def test_a_stream_diverts_a_bad_file_and_goes_on(spark, tmp_path):
    landing, w, state = tmp_path / "landing", str(tmp_path / "wh"), str(tmp_path / "state")
    for i, name in enumerate(["good", "bad", "fine"]):
        if name == "bad":
            (landing / f"{i}.json").write_text("no payload at all")
        else:
            land(landing, f"{i}.json", name, two_days())
        time.sleep(0.02)  # files go in the order of their times
    stream = b.ingest_stream(
        spark, str(landing), w, state, on_fail="divert", max_files_per_trigger=1
    )
    stream.awaitTermination()
    assert {r.symbol for r in b.read_bars(spark, w).collect()} == {"good", "fine"}
    (row,) = b.read_table(spark, b.QUARANTINE, w).collect()
    assert row.value == "no payload at all" and row.failed == ["trade: row_count > 0 (value 0)"]
    assert len(silver(spark, w)) == 4 and not files.path_exists(spark, b.REJECTS.path(w))


def test_failing_days_are_held_back_until_mended(spark, tmp_path):
    landing, w = tmp_path / "landing", str(tmp_path / "wh")
    land(landing, "a.json", "A", two_days())
    b.run_pipeline(spark, str(landing), w, batch_id=1)
    land(landing, "a.json", "A", two_days() | {
        "2024-01-02 09:30:00": bar(-5, 2), "2024-01-04 09:30:00": bar(3, 4), "bad": bar(1, 1),
    })
    result = load_changed(spark, landing, w, 2, on_fail="divert")
    assert not result.diverted and not all(r.passed for r in result.silver_checks)
    published = [r for r in TWO if r[1] == "A"]  # the first day as it was
    assert silver(spark, w) == [*published, ("2024-01-04", "A", 3.0, 4.0, 10)]
    days = pending.days_of(spark, pending.records(spark, w)).collect()
    assert sorted(r[0] for r in days) == ["", "2024-01-02"]
    land(landing, "a.json", "A", two_days() | {"2024-01-02 09:30:00": bar(8, 2)})
    load_changed(spark, landing, w, 3, on_fail="divert")
    assert silver(spark, w)[0] == ("2024-01-02", "A", 8.0, 3.0, 20)


def test_a_diverted_first_batch(spark, tmp_path):
    landing, w = tmp_path / "landing", str(tmp_path / "wh")
    landing.mkdir()
    (landing / "bad.json").write_text("nothing")
    for recompute in ("touched", "all"):
        result = b.run_pipeline(spark, str(landing), w, on_fail="divert", recompute=recompute)
        assert result.diverted and result.silver_checks == []
    assert b.read_table(spark, b.QUARANTINE, w).count() == 2


# --- bars without a readable time ---------------------------------------------


def test_untimed_bars_are_rejected_if_asked_for(spark, tmp_path):
    landing, w = tmp_path / "landing", str(tmp_path / "wh")
    land(landing, "a.json", "A", {"bad time": bar(1, 2), "2024-01-02 09:30:00": bar(3, 4)})
    result = b.run_pipeline(spark, str(landing), w, batch_id=1, untimed="reject")
    assert result.rejected == 1
    assert [(r.symbol, r.partition) for r in b.read_bars(spark, w).collect()] == [("A", "2024-01-02")]
    (row,) = b.read_table(spark, b.REJECTS, w).collect()
    assert row.reason == "unreadable time"
    assert json.loads(row.value) == {
        "trade_timestamp": "bad time", "symbol": "A", "open": "1", "high": "2", "low": "1",
        "close": "2", "volume": "10",
    }
    with pytest.raises(ValueError):
        b.normalize_payloads(b.read_payloads(spark, str(landing)), 1, untimed="drop")


# --- one writer ---------------------------------------------------------------


def test_the_second_writer_fails_at_once(spark, landing, tmp_path):
    w, seen = str(tmp_path / "wh"), []

    def second():
        try:
            b.run_pipeline(spark, str(landing), w, batch_id=2)
        except b.WriterBusy as error:
            seen.append(str(error))

    with b.writer(spark, w):
        b.run_pipeline(spark, str(landing), w, batch_id=1)  # the same thread: it has the lease
        thread = threading.Thread(target=second)
        thread.start()
        thread.join()
    assert len(seen) == 1 and "is writing" in seen[0]
    assert silver(spark, w) == TWO and not files.path_exists(spark, lease.lease_path(w))
    second()
    assert len(seen) == 1


def test_an_expired_lease_is_taken_over(spark, tmp_path):
    w = str(tmp_path / "wh")
    path = lease.lease_path(w)
    gone = {"token": "x", "owner": "gone:1", "until": time.time() - 1}
    files.create_file(spark, path, json.dumps(gone))
    with b.writer(spark, w):
        assert json.loads(files.read_file(spark, path))["token"] != "x"
    assert files.names_in(spark, w) == []
    files.create_file(spark, path, json.dumps(gone | {"until": time.time() + 60}))
    with pytest.raises(b.WriterBusy, match="gone:1"), b.writer(spark, w):
        pass


def test_a_held_lease_is_renewed(spark, tmp_path):
    w = str(tmp_path / "wh")
    with b.writer(spark, w, seconds=0.6):
        first = json.loads(files.read_file(spark, lease.lease_path(w)))["until"]
        time.sleep(1)
        assert json.loads(files.read_file(spark, lease.lease_path(w)))["until"] > first


def test_batch_ids_never_fall(spark, landing, tmp_path):
    w = str(tmp_path / "wh")
    raw = b.read_payloads(spark, str(landing))
    for batch_id in (10**10, 7):
        b.load_bronze(raw, w, batch_id)
    assert pipeline.new_batch_id(spark, w) == 10**10 + 1
