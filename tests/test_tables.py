"""Tables: schema, pruning, save modes, day replacement, catalog."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

import barlake as b
from barlake.sources import staging

D1, D2 = date(2024, 1, 2), date(2024, 1, 3)
DAILY = "trade_date date, symbol string, daily_open double, daily_volume long"


def bars(spark, *rows):
    """(batch_id, day, symbol, open) rows as bars at 09:30."""
    data = [
        (batch, None if day is None else datetime.combine(day, datetime.min.time()), s, o, 1)
        for batch, day, s, o in rows
    ]
    df = spark.createDataFrame(
        data, "batch_id long, trade_timestamp timestamp, symbol string, open double, volume int"
    )
    prices = {c: F.col("open") for c in ("high", "low", "close")}
    return df.withColumns({**prices, "partition": F.to_date("trade_timestamp").cast("string")})


def daily(spark, *rows):
    df = spark.createDataFrame([(*r, 1) for r in rows], DAILY)
    return df.withColumns({c: F.lit(1.0) for c in ("daily_high", "daily_low", "daily_close")})


def stored(spark, warehouse):
    rows = b.read_table(spark, b.DAILY_TRADES, warehouse).collect()
    return sorted(((r.trade_date, r.symbol, r.daily_open) for r in rows), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_types_and_order_survive(spark, tmp_path):
    df = bars(spark, (1, D1, "A", 1.0), (1, None, "A", 2.0))
    b.write_table(df, b.TRADE, str(tmp_path))
    read = b.read_table(spark, b.TRADE, str(tmp_path))
    assert [(f.name, f.dataType) for f in read.schema] == [
        (f.name, f.dataType) for f in b.BAR_SCHEMA
    ]
    assert {r.partition for r in read.collect()} == {"2024-01-02", None}


def test_date_and_symbol_prune(spark, tmp_path):
    b.write_table(bars(spark, (1, D1, "A", 1.0), (1, D2, "B", 2.0)), b.TRADE, str(tmp_path))
    df = b.read_bars(spark, str(tmp_path), date="2024-01-02", symbol="A")
    text = plan(df)
    assert "(partition" in text.split("PartitionFilters: [")[1].split("]")[0]
    assert "EqualTo(symbol,A)" in text
    assert [(r.symbol, r.trade_date) for r in df.collect()] == [("A", D1)]


def test_trade_date_filter_prunes_folders(spark, tmp_path):
    b.write_table(bars(spark, (1, D1, "A", 1.0), (1, D2, "B", 2.0)), b.TRADE, str(tmp_path))
    df = b.read_bars(spark, str(tmp_path)).filter(F.col("trade_date") == F.lit(D2))
    assert "partition" in plan(df).split("PartitionFilters: [")[1].split("DataFilters")[0]
    assert [r.symbol for r in df.collect()] == ["B"]


def test_trade_date_does_not_depend_on_the_zone(spark, tmp_path):
    late = spark.createDataFrame(
        [(1, datetime(2024, 1, 2, 23, 30), "A", 1.0, 1)],
        "batch_id long, trade_timestamp timestamp, symbol string, open double, volume int",
    ).withColumns({c: F.lit(1.0) for c in ("high", "low", "close")})
    late = late.withColumn("partition", F.to_date("trade_timestamp").cast("string"))
    b.write_table(late, b.TRADE, str(tmp_path))
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        (row,) = b.daily_rollup(b.read_bars(spark, str(tmp_path))).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert row.trade_date == D1


def test_symbol_with_quote_is_just_a_value(spark, tmp_path):
    b.write_table(bars(spark, (1, D1, "A'B", 1.0)), b.TRADE, str(tmp_path))
    assert b.read_bars(spark, str(tmp_path), symbol="A'B").count() == 1
    assert b.read_bars(spark, str(tmp_path), symbol="x' OR '1'='1").count() == 0
    assert b.read_bars(spark, str(tmp_path), date=D1).count() == 1


def test_save_modes(spark, tmp_path):
    w = str(tmp_path)
    b.write_table(daily(spark, (D1, "A", 1.0), (D2, "A", 1.0)), b.DAILY_TRADES, w)
    b.write_table(daily(spark, (D1, "A", 2.0)), b.DAILY_TRADES, w, "append")
    assert stored(spark, w) == [(D1, "A", 1.0), (D1, "A", 2.0), (D2, "A", 1.0)]
    b.write_table(daily(spark, (D1, "A", 3.0)), b.DAILY_TRADES, w, "overwrite_days")
    assert stored(spark, w) == [(D1, "A", 3.0), (D2, "A", 1.0)]
    b.write_table(daily(spark, (D1, "A", 4.0)), b.DAILY_TRADES, w, "overwrite")
    assert stored(spark, w) == [(D1, "A", 4.0)]


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_formats(spark, tmp_path, fmt):
    w = str(tmp_path)
    b.write_table(bars(spark, (1, D1, "A", 1.0), (1, D2, None, 2.0)), b.TRADE, w, fmt=fmt)
    read = b.read_bars(spark, w, date="2024-01-02", symbol="A", fmt=fmt)
    assert [(r.open, r.trade_date) for r in read.collect()] == [(1.0, D1)]
    daily_rows = b.daily_rollup(b.read_bars(spark, w, fmt=fmt))
    b.replace_days(daily_rows, w, fmt=fmt)
    b.replace_days(daily_rows.filter("symbol IS NULL"), w, fmt=fmt)
    assert b.read_table(spark, b.DAILY_TRADES, w, fmt=fmt).count() == 2


def test_replace_days_first_write(spark, tmp_path):
    b.replace_days(daily(spark, (D1, "A", 1.0)), str(tmp_path))
    assert stored(spark, str(tmp_path)) == [(D1, "A", 1.0)]


def test_replace_keeps_other_symbols_and_days(spark, tmp_path):
    w = str(tmp_path)
    first = [(D1, "A", 1.0), (D1, "B", 1.0), (D1, None, 1.0), (D2, "A", 1.0), (None, "A", 1.0)]
    b.write_table(daily(spark, *first), b.DAILY_TRADES, w)
    for _ in range(2):
        b.replace_days(daily(spark, (D1, "A", 9.0), (D1, None, 8.0), (None, "A", 7.0)), w)
        assert stored(spark, w) == sorted(
            [(D1, "A", 9.0), (D1, "B", 1.0), (D1, None, 8.0), (D2, "A", 1.0), (None, "A", 7.0)],
            key=repr,
        )


def test_replace_one_symbol_by_filter(spark, tmp_path):
    w = str(tmp_path)
    first = [(D1, "A", 1.0), (D1, "B", 1.0), (D1, None, 1.0), (D2, "A", 1.0), (None, "A", 1.0)]
    b.write_table(daily(spark, *first), b.DAILY_TRADES, w)
    b.replace_days(daily(spark, (D1, "A", 9.0), (None, "A", 7.0)), w, symbol="A")
    assert stored(spark, w) == sorted(
        [(D1, "A", 9.0), (D1, "B", 1.0), (D1, None, 1.0), (D2, "A", 1.0), (None, "A", 7.0)],
        key=repr,
    )


def test_replace_whole_days_drops_vanished_symbols(spark, tmp_path):
    w = str(tmp_path)
    b.write_table(daily(spark, (D1, "A", 1.0), (D1, "B", 1.0), (D2, "A", 1.0)), b.DAILY_TRADES, w)
    b.replace_days(daily(spark, (D1, "A", 2.0)), w, whole_days=True)
    assert stored(spark, w) == [(D1, "A", 2.0), (D2, "A", 1.0)]


def test_replace_heals_repeats_left_by_append(spark, tmp_path):
    w = str(tmp_path)
    for _ in range(2):
        b.write_table(daily(spark, (D1, "A", 1.0), (D1, "B", 1.0)), b.DAILY_TRADES, w)
    b.replace_days(daily(spark, (D1, "A", 2.0)), w)
    assert stored(spark, w) == [(D1, "A", 2.0), (D1, "B", 1.0), (D1, "B", 1.0)]


def test_replace_with_nothing_changes_nothing(spark, tmp_path):
    w = str(tmp_path)
    b.write_table(daily(spark, (D1, "A", 1.0)), b.DAILY_TRADES, w)
    nothing = daily(spark, (D1, "A", 9.0)).limit(0)
    b.replace_days(nothing, w)
    b.replace_days(nothing, w, whole_days=True)
    assert stored(spark, w) == [(D1, "A", 1.0)]


def test_catalog_create_insert_drop(spark, tmp_path):
    w, db = str(tmp_path / "it's here"), "test_catalog"
    b.write_table(bars(spark, (1, D1, "A", 1.0)), b.TRADE, w)
    b.create_tables(spark, w, db)
    b.create_silver_tables(spark, w, db)
    # Days written before the table was made are seen; later ones after a sync.
    assert spark.table(f"{db}.trade").count() == 1
    b.insert_table(bars(spark, (2, D2, "B", 2.0)), b.TRADE, db)
    assert spark.sql(f"SELECT sum(open) FROM {db}.trade").first()[0] == 3.0
    b.write_table(bars(spark, (3, date(2024, 1, 4), "C", 3.0)), b.TRADE, w)
    b.sync_partitions(spark, b.TRADE, db)
    assert spark.table(f"{db}.trade").filter("partition = '2024-01-04'").count() == 1
    assert dict(spark.table(f"{db}.trade").dtypes)["partition"] == "string"
    # Bootstrap again: the table is made anew over the same files.
    b.create_tables(spark, w, db)
    assert spark.table(f"{db}.trade").count() == 3
    b.drop_silver_tables(spark, db)
    assert not spark.catalog.tableExists(f"{db}.daily_trades")
    b.drop_tables(spark, db)
    assert not spark.catalog.databaseExists(db)
    b.drop_tables(spark, db)
    assert b.read_table(spark, b.TRADE, w).count() == 3


def test_staging_is_in_the_shared_folder_and_removed(spark):
    root = staging.staging_root(spark)
    assert root == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    with staging.staged(spark.range(3).toDF("id"), "probe") as df:
        (path,) = [f for f in df.inputFiles()][:1]
        assert root in path
        assert df.count() == 3
    assert not staging.path_exists(spark, path)


def test_staging_is_removed_after_a_failure(spark):
    with pytest.raises(RuntimeError):
        with staging.staged(spark.range(3).toDF("id"), "probe") as df:
            path = df.inputFiles()[0]
            raise RuntimeError
    assert not staging.path_exists(spark, path)


def test_staging_that_guards_an_overwrite_is_kept(spark):
    with pytest.raises(RuntimeError) as caught:
        with staging.staged(spark.range(3).toDF("id"), "probe", guards=True):
            raise RuntimeError
    path = caught.value.__notes__[0].split("kept in ")[1]
    assert spark.read.parquet(path).count() == 3
    staging.remove(spark, path)


class FakeSession:
    """Just what the choice of the staging folder looks at."""

    def __init__(self, master, root=None, checkpoint_dir=None):
        self.sparkContext = self
        self.getCheckpointDir = lambda: checkpoint_dir
        self.master = master
        self.conf = self
        self.settings = {"spark.checkpoint.dir": root} if root else {}

    def get(self, key, default=None):
        return self.settings.get(key, default)

    def set(self, key, value):
        self.settings[key] = value


def test_staging_folder_is_shared():
    assert staging.staging_root(FakeSession("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    assert staging.staging_root(FakeSession("yarn", None, "hdfs:///set")) == "hdfs:///set"
    unset = FakeSession("yarn")
    unset.settings["spark.sql.warehouse.dir"] = "hdfs:///warehouse"
    assert staging.staging_root(unset, "s3a://lake/") == "s3a://lake/_staging"
    assert staging.staging_root(unset) == "hdfs:///warehouse/_staging"
    assert "spark.checkpoint.dir" not in unset.settings
