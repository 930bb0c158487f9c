"""Payload text to typed bars.

A payload is one JSON object: a metadata object first, then a series object
(found by position, its name varies) that maps a timestamp to a bar. One plan
parses every payload of a batch on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.functions.casts import text_to_double, text_to_int, text_to_timestamp
from barlake.schemas import BAR_SCHEMA, CSV_COLUMNS, REJECT_SCHEMA

# The payload format.
META_KEY = "Meta Data"
SYMBOL_KEY = "2. Symbol"
NO_SYMBOL = "N/A"
BAR_KEYS = {
    "open": "1. open",
    "high": "2. high",
    "low": "3. low",
    "close": "4. close",
    "volume": "5. volume",
}

# Why a payload is rejected, in the order they are looked for.
MALFORMED = "malformed json"
NO_METADATA = "no metadata"
NO_SERIES = "no series"
EMPTY_SERIES = "empty series"
# Why a single bar is, where that is asked for.
UNREADABLE_TIME = "unreadable time"

# Strict JSON only; single quotes are accepted by default.
_JSON = {"allowSingleQuotes": "false"}


def _given_or(bar: Column, key: str, default: Column) -> Column:
    """``bar[key]`` if the key is there (even when its value is null), else ``default``."""
    return F.when(F.map_contains_key(bar, key), bar[key]).otherwise(default)


def _last_of_repeated(entries: Column) -> Column:
    """A map without repeated keys: of equal ones the last counts, as in JSON readers.

    Only maps that have some are put in order, such as those of the hour that wall
    clocks show twice: keys are sorted with their places, each is set beside the one
    after it, and those followed by an equal key go.
    """
    keys, values = F.map_keys(entries), F.map_values(entries)
    placed = F.array_sort(F.transform(keys, lambda key, i: F.struct(key.alias("k"), i.alias("i"))))
    beside = F.arrays_zip(placed.alias("a"), F.slice(placed, 2, F.size(keys)).alias("b"))
    last = F.filter(beside, lambda pair: ~pair["a"]["k"].eqNullSafe(pair["b"]["k"]))
    kept = F.transform(
        last, lambda pair: F.struct(pair["a"]["k"], F.element_at(values, pair["a"]["i"] + 1))
    )
    repeated = F.size(F.array_distinct(keys)) < F.size(keys)
    return F.when(repeated, F.map_from_entries(kept)).otherwise(entries)


def _events(raw: DataFrame) -> DataFrame:
    """One row per bar as text, or one row per rejected payload.

    Columns: ``is_bar``, then ``reason`` and ``value`` (set for rejects only),
    then the seven text columns (set for bars only).

    Notes on the plan:

    * The text is parsed inside ``[...]``. As an array the parser must consume
      all of it, so two objects run together in one payload are seen as
      malformed; parsed as an object the second would be silently ignored.
    * ``value`` is dropped from good payloads in a step of its own before the
      explode, which would otherwise copy the whole payload next to each bar.
    * ``explode_outer`` keeps rejects in the same pass.
    * ``is_bar`` comes out of the explode, so a filter on it stays above the
      explode. One on ``reason`` would be pushed down to the payloads with a copy
      of every parse it depends on.
    """
    docs = F.from_json(
        F.concat(F.lit("["), F.col("value"), F.lit("]")), "array<map<string,string>>", _JSON
    )
    series_text = F.try_element_at(F.map_values("top"), F.lit(2))
    meta, series = F.col("meta"), F.col("series")
    reason = (
        F.when(F.col("top").isNull(), MALFORMED)
        .when(meta.isNull(), NO_METADATA)
        .when(series.isNull(), NO_SERIES)
        .when(F.size(series) == 0, EMPTY_SERIES)
    )
    payloads = (
        raw.select("value", docs.alias("docs"))
        .select("value", F.when(F.size("docs") == 1, F.col("docs")[0]).alias("top"))
        .select(
            "value",
            "top",
            F.from_json(F.col("top")[META_KEY], "map<string,string>", _JSON).alias("meta"),
            F.from_json(series_text, "map<string,map<string,string>>", _JSON).alias("series"),
        )
        .select("value", "meta", "series", reason.alias("reason"))
    )
    good = F.col("reason").isNull()
    exploded = payloads.select(
        "reason",
        F.when(~good, F.col("value")).alias("value"),
        _given_or(meta, SYMBOL_KEY, F.lit(NO_SYMBOL)).alias("meta_symbol"),
        F.when(good, _last_of_repeated(series)).alias("series"),
    ).select("reason", "value", "meta_symbol", F.explode_outer("series").alias("key", "bar"))
    bar = F.col("bar")
    return exploded.select(
        F.col("key").isNotNull().alias("is_bar"),
        "reason",
        "value",
        _given_or(bar, "trade_timestamp", F.col("key")).alias("trade_timestamp"),
        F.when(F.col("key").isNotNull(), _given_or(bar, "symbol", F.col("meta_symbol"))).alias(
            "symbol"
        ),
        *[bar[key].alias(name) for name, key in BAR_KEYS.items()],
    )


def payload_events(raw: DataFrame) -> DataFrame:
    """Bars of the good payloads as untouched text, in CSV column order."""
    return _events(raw).filter("is_bar").select(*CSV_COLUMNS)


def parse_payloads(raw: DataFrame, batch_id: int, untimed: str = "store") -> DataFrame:
    """Bars and rejects of a batch in one DataFrame, JSON parsed once.

    Rejects carry ``reason`` and ``value``, bars the bronze columns. Write this
    once and use :func:`split_parsed` on what was written.

    With ``untimed="reject"`` a bar whose time cannot be read is a reject too, its text as a JSON
    object; ``"store"`` keeps it, with a NULL time and day.
    """
    if untimed not in ("store", "reject"):
        raise ValueError(f"untimed must be 'store' or 'reject', not {untimed!r}")
    events = _events(raw)
    if untimed == "reject":
        # Not decided by a filter, which would be pushed below the explode with the parsing.
        bad = F.col("is_bar") & text_to_timestamp(F.col("trade_timestamp")).isNull()
        text = F.to_json(F.struct(*CSV_COLUMNS))
        events = events.withColumns(
            {
                "reason": F.when(bad, F.lit(UNREADABLE_TIME)).otherwise(F.col("reason")),
                "value": F.when(bad, text).otherwise(F.col("value")),
                "is_bar": F.col("is_bar") & ~bad,
            }
        )
    day = F.to_date("trade_timestamp").cast("string")
    return events.select(
        F.lit(batch_id).cast("long").alias("batch_id"),
        "is_bar",
        "reason",
        "value",
        text_to_timestamp(F.col("trade_timestamp")).alias("trade_timestamp"),
        "symbol",
        *[text_to_double(F.col(c)).alias(c) for c in ("open", "high", "low", "close")],
        text_to_int(F.col("volume")).alias("volume"),
    ).withColumn("partition", day)


def split_parsed(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(bars, rejects)`` out of :func:`parse_payloads`."""
    bars = parsed.filter("is_bar").select(*BAR_SCHEMA.fieldNames())
    rejects = parsed.filter("NOT is_bar").select(*REJECT_SCHEMA.fieldNames())
    return bars, rejects


def normalize_payloads(
    raw: DataFrame, batch_id: int, untimed: str = "store"
) -> tuple[DataFrame, DataFrame]:
    """Payloads (column ``value``) to ``(bars, rejects)``.

    ``batch_id`` is stamped as a literal, so the id that is checked is the id
    that is stored. Each result parses the payloads once; to use both, stage
    :func:`parse_payloads` as the pipeline does.
    """
    return split_parsed(parse_payloads(raw, batch_id, untimed))
