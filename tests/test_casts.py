"""Text casts against the plain cast with ANSI off."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import barlake as b

KNOWN = {
    "100": 100,
    "100.7": 100,
    " 100 ": 100,
    "1e3": None,
    "1,234": None,
    "": None,
    None: None,
    "3000000000": None,
    "3000000000.5": None,
    "-2147483648": -2147483648,
    "-2147483649.9": None,
    "abc": None,
}
ODD = [
    ".5", ".", "-.5", "+", "-", "1.", "+1.2", "1.a", "\t5\n", "\x015", "00012", "1_000", "+-1",
    "- 1", "1 2", "1.2.3", "..", "+.", "-.", " 5", "٣", "1.5 ", "\x1f7\x1f", "\x7f7.2",
    "1.5\x7f", "7. ", "NaN", "2147483647.999", "2147483648",
]


def test_known_values(spark):
    df = spark.createDataFrame([(t,) for t in KNOWN], "t string")
    got = {r.t: r.i for r in df.select("t", b.text_to_int(F.col("t")).alias("i")).collect()}
    assert got == KNOWN


def plain_casts(spark, texts, target):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
        return dict(df.select("i", F.col("t").cast(target)).collect())
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def ours(spark, texts, cast):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return dict(df.select("i", cast(F.col("t"))).collect())


def test_odd_integers_match_plain_cast(spark):
    assert ours(spark, ODD, b.text_to_int) == plain_casts(spark, ODD, "int")


@settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    texts=st.lists(
        st.one_of(
            st.text(alphabet="0123456789.+- \t\x00\x1f\x7f e", max_size=14),
            st.decimals(allow_nan=False, min_value=-3e9, max_value=3e9, places=3).map(str),
        ),
        min_size=50,
        max_size=200,
    )
)
def test_fuzzed_integers_match_plain_cast(spark, texts):
    assert ours(spark, texts, b.text_to_int) == plain_casts(spark, texts, "int")


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_text_is_null_under_either_setting(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([("abc",)], "t string")
        t = F.col("t")
        row = df.select(b.text_to_int(t), b.text_to_double(t), b.text_to_timestamp(t)).first()
        assert tuple(row) == (None, None, None)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
