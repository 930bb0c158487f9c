"""Payload parsing: defaults, overrides, lenient values and rejects."""

import csv
import json
from datetime import datetime
from pathlib import Path

import pytest

import barlake as b
from barlake.operators.normalize import parse_payloads

BAR = {"1. open": "1.5", "2. high": "2", "3. low": "1", "4. close": "1.7", "5. volume": "10"}


def raw(spark, *payloads):
    texts = [p if p is None or isinstance(p, str) else json.dumps(p) for p in payloads]
    return spark.createDataFrame([(t,) for t in texts], "value string")


def payload(series, meta=None):
    return {"Meta Data": {"2. Symbol": "IBM"} if meta is None else meta, "Series (1min)": series}


def bars_of(spark, *payloads):
    return b.normalize_payloads(raw(spark, *payloads), 7)[0].collect()


def test_bar_columns_types_and_values(spark):
    bars, rejects = b.normalize_payloads(raw(spark, payload({"2024-12-16 19:59:00": BAR})), 7)
    assert {f.name: f.dataType for f in bars.schema} == {
        f.name: f.dataType for f in b.BAR_SCHEMA
    }
    assert [tuple(r) for r in bars.collect()] == [
        (7, datetime(2024, 12, 16, 19, 59), "IBM", 1.5, 2.0, 1.0, 1.7, 10, "2024-12-16")
    ]
    assert rejects.count() == 0


def test_bad_number_and_timestamp_are_null(spark):
    (row,) = bars_of(spark, payload({"bad": {**BAR, "1. open": "abc"}}))
    assert (row.open, row.trade_timestamp, row.partition) == (None, None, None)
    assert row.close == 1.7


def test_series_is_found_by_position_and_numbers_may_be_unquoted(spark):
    text = (
        '{"Meta Data": {"2. Symbol": "A"}, "x": {"2024-01-01 00:00:00":'
        ' {"1. open": 1.50, "5. volume": 12}}, "later": 5}'
    )
    (row,) = bars_of(spark, text)
    assert (row.symbol, row.open, row.volume, row.low) == ("A", 1.5, 12, None)


def test_symbol_defaults_and_overrides(spark):
    time = "2024-01-01 00:00:00"
    rows = bars_of(
        spark,
        payload({time: {**BAR, "symbol": "ZZ"}}),
        payload({time: BAR}, meta={}),
        payload({time: {**BAR, "symbol": None}}),
        payload({time: BAR}, meta={"2. Symbol": None}),
        payload({"x": {**BAR, "trade_timestamp": "2024-02-03 04:05:06"}}),
    )
    assert [r.symbol for r in rows] == ["ZZ", "N/A", None, None, "IBM"]
    assert rows[-1].trade_timestamp == datetime(2024, 2, 3, 4, 5, 6)


def test_of_repeated_times_the_last_counts(spark):
    bars = ", ".join(f'"2024-11-03 01:{m}:00": {{"1. open": "{o}"}}' for m, o in REPEATED)
    text = f'{{"Meta Data": {{"2. Symbol": "A"}}, "s": {{{bars}}}}}'
    rows = bars_of(spark, text, text)
    last = dict(REPEATED)
    assert sorted((r.trade_timestamp.minute, r.open) for r in rows) == sorted(
        [(int(m), float(o)) for m, o in last.items()] * 2
    )


REPEATED = [("30", 1), ("31", 2), ("30", 3), ("32", 4), ("30", 5), ("31", 6), ("59", 7)]


def test_null_bar_loses_nothing(spark):
    rows = bars_of(spark, payload({"2024-01-01 00:00:00": None, "2024-01-01 00:01:00": BAR}))
    assert sorted((r.trade_timestamp.minute, r.symbol, r.open) for r in rows) == [
        (0, "IBM", None),
        (1, "IBM", 1.5),
    ]


def test_missing_price_is_null(spark):
    (row,) = bars_of(spark, payload({"2024-01-01 00:00:00": {"1. open": "1"}}))
    assert (row.low, row.volume) == (None, None)


REJECTED = [
    ("not json", "malformed json"),
    ("", "malformed json"),
    (None, "malformed json"),
    ("[]", "malformed json"),
    ("null", "malformed json"),
    ('{"Meta Data": {}, "s": {"2024-01-01 00:00:00": {"1. open"', "malformed json"),
    ('{"Meta Data": {}, "s": {"t": {}}} {"Meta Data": {}, "s": {"t": {}}}', "malformed json"),
    ('{"Meta Data": {}, "s": {"t": {}}}, {"Meta Data": {}, "s": {"t": {}}}', "malformed json"),
    ('{"Information": "rate limit"}', "no metadata"),
    ('{"Meta Data": "x", "s": {"t": {}}}', "no metadata"),
    ('{"Meta Data": {"2. Symbol": "A"}}', "no series"),
    ('{"Meta Data": {}, "s": "text"}', "no series"),
    ('{"Meta Data": {}, "s": {"t": "text"}}', "no series"),
    ('{"Meta Data": {}, "s": {}}', "empty series"),
]


@pytest.mark.parametrize("text,reason", REJECTED)
def test_rejects_keep_the_whole_text(spark, text, reason):
    bars, rejects = b.normalize_payloads(raw(spark, text), 7)
    assert bars.count() == 0
    assert [tuple(r) for r in rejects.collect()] == [(7, reason, text)]


def test_a_bad_payload_does_not_stop_the_others(spark):
    good = payload({f"2024-01-01 00:00:{s:02d}": BAR for s in range(30)})
    df = raw(spark, "not json", good, '{"Information": "x"}', good)
    bars, rejects = b.normalize_payloads(df, 7)
    assert (bars.count(), rejects.count()) == (60, 2)


def test_payload_text_is_not_copied_next_to_bars(spark):
    """The explode must not carry the payload text of good payloads."""
    plan = parse_payloads(raw(spark, payload({"t": BAR})), 7)
    optimized = plan._jdf.queryExecution().optimizedPlan().toString()
    lines = optimized.splitlines()
    generate = next(i for i, line in enumerate(lines) if "Generate" in line)
    # The step below the explode has already cleared the text of good payloads.
    assert "CASE WHEN isnotnull(reason" in lines[generate + 1]


def test_json_is_parsed_once_by_either_result(spark):
    for df in b.normalize_payloads(raw(spark, payload({"t": BAR})), 7):
        optimized = df._jdf.queryExecution().optimizedPlan().toString()
        assert optimized.count("from_json(ArrayType") == 1
        assert optimized.count("from_json(MapType(StringType,MapType") == 1


def test_layouts(spark, tmp_path):
    pretty = json.dumps(payload({"2024-01-01 00:00:00": BAR, "2024-01-01 00:01:00": BAR}), indent=1)
    files = tmp_path / "files" / "2024" / "01"
    files.mkdir(parents=True)
    (files / "a.json").write_text(pretty)
    (files / "b.json").write_text(pretty.replace("IBM", "AAPL"))
    bars, rejects = b.normalize_payloads(b.read_payloads(spark, str(tmp_path / "files")), 1)
    assert (bars.count(), rejects.count()) == (4, 0)
    assert {r.symbol for r in bars.collect()} == {"IBM", "AAPL"}

    lines = tmp_path / "lines"
    lines.mkdir()
    one_line = json.dumps(json.loads(pretty))
    (lines / "a.json").write_text(one_line + "\n" + one_line + "\n")
    bars, rejects = b.normalize_payloads(b.read_payloads(spark, str(lines), "lines"), 1)
    assert (bars.count(), rejects.count()) == (4, 0)
    # Read in the wrong layout, nothing is lost silently: the file is rejected.
    bars, rejects = b.normalize_payloads(b.read_payloads(spark, str(lines)), 1)
    assert (bars.count(), rejects.count()) == (0, 1)

    with pytest.raises(ValueError):
        b.read_payloads(spark, str(lines), "rows")


def test_csv_keeps_the_text(spark, tmp_path):
    values = ["1.500", " 2 ", "", None, 'say "x", y', "back\\slash", "two\nlines", "é", "'", "#"]
    series = {f"2024-12-16 19:59:{i:02d}": {**BAR, "1. open": v} for i, v in enumerate(values)}
    events = raw(spark, payload(series)).coalesce(1)
    path = b.export_bars_csv(events, str(tmp_path))
    assert Path(path).name.startswith("trade_2")
    (part,) = Path(path).glob("*.csv")
    with open(part, newline="", encoding="utf-8") as handle:
        header, *rows = list(csv.reader(handle))
    assert header == ["trade_timestamp", "symbol", "open", "high", "low", "close", "volume"]
    assert rows == [
        [time, "IBM", value or "", "2", "1", "1.7", "10"]
        for time, value in zip(series, values)
    ]
