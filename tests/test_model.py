"""Random payloads and day replacements against plain Python models."""

import json
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

import barlake as b

T0 = datetime(2024, 3, 1)


def random_payload(rng):
    """A payload (or something like one) as a Python object, built from rare faults."""
    rare = lambda: rng.random() < 0.08
    number = lambda: rng.choice([str(rng.randrange(100)), f"{rng.randrange(1000) / 8}", "x", None])
    series = {}
    for _ in range(0 if rare() else rng.randrange(1, 6)):
        bar = {
            key: number()
            for key in ("1. open", "2. high", "3. low", "4. close", "5. volume")
            if not rare()
        }
        if rare():
            bar["symbol"] = rng.choice(["ZZ", None])
        if rare():
            bar["trade_timestamp"] = rng.choice([str(T0), "never", None])
        key = "bad time" if rare() else str(T0 + timedelta(minutes=rng.randrange(5000)))
        series[key] = "text" if rng.random() < 0.03 else bar
    meta = {} if rare() else {"1. Information": "x", "2. Symbol": rng.choice(["A", "B", None])}
    payload = {"Meta Data": "text" if rare() else meta, "Series": series}
    if rare():
        del payload["Meta Data"]
    if rare():
        del payload["Series"]
    if rare():
        payload["Note"] = "text"
    text = json.dumps(payload, indent=rng.choice([None, 2]))
    return text[: len(text) // 2] if rare() else text


def as_number(text, kind):
    try:
        return kind(float(text))
    except (TypeError, ValueError):
        return None


def as_time(text):
    try:
        return datetime.fromisoformat(text)
    except (TypeError, ValueError):
        return None


def model(text):
    """(bars, reason) of a payload, following the documented rules."""
    try:
        payload = json.loads(text)
    except ValueError:
        return [], "malformed json"
    meta = payload.get("Meta Data")
    if not isinstance(meta, dict):
        return [], "no metadata"
    series = list(payload.values())[1] if len(payload) > 1 else None
    if not isinstance(series, dict) or not all(isinstance(r, dict) for r in series.values()):
        return [], "no series"
    if not series:
        return [], "empty series"
    bars = []
    for key, bar in series.items():
        time = as_time(bar.get("trade_timestamp", key))
        bars.append(
            (
                3,
                time,
                bar.get("symbol", meta.get("2. Symbol", "N/A")),
                *[
                    as_number(bar.get(k), float)
                    for k in ("1. open", "2. high", "3. low", "4. close")
                ],
                as_number(bar.get("5. volume"), int),
                None if time is None else str(time.date()),
            )
        )
    return bars, None


@pytest.mark.parametrize("seed", range(4))
def test_payloads_match_the_model(spark, seed):
    rng = random.Random(seed)
    texts = [random_payload(rng) for _ in range(300)]
    want_bars, want_rejects = [], []
    for text in texts:
        bars, reason = model(text)
        want_bars += bars
        want_rejects += [(3, reason, text)] if reason else []
    raw = spark.createDataFrame([(t,) for t in texts], "value string")
    bars, rejects = b.normalize_payloads(raw, 3)
    assert sorted(map(repr, map(tuple, bars.collect()))) == sorted(map(repr, want_bars))
    assert sorted(map(repr, map(tuple, rejects.collect()))) == sorted(map(repr, want_rejects))
    assert {r for _, r, _ in want_rejects} == {
        "malformed json",
        "no metadata",
        "no series",
        "empty series",
    }


@pytest.mark.parametrize("seed", range(3))
def test_replacing_days_matches_the_model(spark, tmp_path, seed):
    rng = random.Random(seed)
    warehouse = str(tmp_path)
    days = [None, date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)]
    symbols = [None, "A", "B", "C"]
    state = {}
    for step in range(4):
        whole = rng.random() < 0.4
        keys = {(rng.choice(days), rng.choice(symbols)) for _ in range(rng.randrange(1, 6))}
        new = {key: float(step) for key in keys}
        df = spark.createDataFrame(
            [(day, symbol, open) for (day, symbol), open in new.items()],
            "trade_date date, symbol string, daily_open double",
        ).withColumns(
            {"daily_volume": F.lit(1)}
            | {c: F.lit(1.0) for c in ("daily_high", "daily_low", "daily_close")}
        )
        b.replace_days(df, warehouse, whole_days=whole)
        if whole:
            touched = {day for day, _ in keys}
            state = {key: v for key, v in state.items() if key[0] not in touched}
        state.update(new)
        stored = b.read_table(spark, b.DAILY_TRADES, warehouse).collect()
        assert len(stored) == len(state)
        assert {(r.trade_date, r.symbol): r.daily_open for r in stored} == state


@pytest.mark.parametrize("seed", range(3))
def test_dedup_matches_the_model(spark, seed):
    rng = random.Random(seed)
    rows = [
        (
            rng.randrange(3),
            rng.choice([None, T0, T0 + timedelta(minutes=1)]),
            rng.choice([None, "A", "B"]),
            rng.choice([None, 1.0, 2.0]),
            1.0,
            1.0,
            rng.choice([1.0, 2.0]),
            rng.choice([None, 1]),
        )
        for _ in range(200)
    ]
    best = {}
    for row in rows:
        key = (row[2], row[1], row[3:] if row[1] is None else None)
        order = [(value is not None, value or 0) for value in (row[0], *row[3:])]
        if key not in best or order > best[key][0]:
            best[key] = (order, row)
    df = spark.createDataFrame(
        rows,
        "batch_id long, trade_timestamp timestamp, symbol string, open double, high double,"
        " low double, close double, volume int",
    )
    got = sorted(repr(tuple(r)) for r in b.dedup_latest(df).collect())
    assert got == sorted(repr(row) for _, row in best.values())


class Model:
    """Bronze as a list of bars, silver as a dict, following the documented rules."""

    def __init__(self):
        self.bronze = []
        self.silver = {}

    def run(self, batch_id, bars, date=None, symbol=None, recompute="all"):
        self.bronze += [(batch_id, *bar) for bar in bars]
        touched = {str(time.date()) for _, time, *_ in bars}
        latest = {}
        for batch, name, time, open, close, volume in self.bronze:
            day = str(time.date())
            if recompute == "touched" and day not in touched:
                continue
            if day != (date or day) or name != (symbol or name):
                continue
            rank = (batch, open, max(open, close), min(open, close), close, volume)
            key = (name, time)
            latest[key] = max(latest.get(key, rank), rank)
        groups = {}
        for (name, time), (_, open, high, low, close, volume) in sorted(latest.items()):
            group = groups.setdefault((str(time.date()), name), [])
            group.append((open, high, low, close, volume))
        if symbol is None:
            days = {day for day, _ in groups}
            self.silver = {k: v for k, v in self.silver.items() if k[0] not in days}
        for key, group in groups.items():
            self.silver[key] = (
                group[0][0],
                group[-1][3],
                max(bar[1] for bar in group),
                min(bar[2] for bar in group),
                sum(bar[4] for bar in group),
            )


@pytest.mark.parametrize("seed", range(2))
def test_runs_match_the_model(spark, tmp_path, seed):
    rng = random.Random(seed)
    warehouse, expected = str(tmp_path / "wh"), Model()
    for batch_id in range(1, 8):
        bars = [
            (
                rng.choice("ABC"),
                T0 + timedelta(days=rng.randrange(3), minutes=rng.randrange(4)),
                float(rng.randrange(1, 9)),
                float(rng.randrange(1, 9)),
                rng.randrange(50),
            )
            for _ in range(rng.randrange(1, 12))
        ]
        folder = tmp_path / f"landing-{batch_id}"
        folder.mkdir()
        for i, (name, time, open, close, volume) in enumerate(bars):
            bar = {
                "1. open": str(open),
                "2. high": str(max(open, close)),
                "3. low": str(min(open, close)),
                "4. close": str(close),
                "5. volume": str(volume),
            }
            payload = {"Meta Data": {"2. Symbol": name}, "S": {str(time): bar}}
            (folder / f"{i}.json").write_text(json.dumps(payload))
        how = {"recompute": rng.choice(["all", "touched"])}
        if rng.random() < 0.4:
            how["symbol"] = rng.choice("ABC")
        if rng.random() < 0.3:
            how["date"] = str((T0 + timedelta(days=rng.randrange(3))).date())
        b.run_pipeline(spark, str(folder), warehouse, batch_id=batch_id, **how)
        expected.run(batch_id, bars, **how)
        stored = b.read_table(spark, b.DAILY_TRADES, warehouse).collect()
        got = {
            (str(r.trade_date), r.symbol): (
                r.daily_open,
                r.daily_close,
                r.daily_high,
                r.daily_low,
                r.daily_volume,
            )
            for r in stored
        }
        assert len(stored) == len(got)
        assert got == expected.silver, how
