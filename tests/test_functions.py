"""Coercion and name rules against the payload fixture cases."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.functions import names
from tidemark.functions.coerce import to_datetime_fixed, to_datetime_inferred, to_double
from tidemark.functions.zorder import interleave_bits

NUMBER_CASES = [
    ("abc", None), ("", None), ("1,000", None), ("1d", None), ("1f", None),
    (" 5 ", 5.0), ("1e3", 1000.0), ("+7", 7.0), (".5", 0.5), ("5.", 5.0),
    ("112906.75", 112906.75), ("-1", -1.0), ("0", 0.0), ("nan", None), (None, None),
]


def test_to_double_fixture_cases(spark):
    df = spark.createDataFrame([(s,) for s, _ in NUMBER_CASES], "s string")
    got = [r[0] for r in df.select(to_double("s")).collect()]
    assert got == [e for _, e in NUMBER_CASES]


def test_to_double_matches_pandas_on_fixture_cases(spark):
    # differential: pandas' lenient parse, NaN read as missing
    texts = [s for s, _ in NUMBER_CASES if s not in ("1d", "1f")]
    expect = pd.to_numeric(pd.Series(texts, dtype=object), errors="coerce")
    df = spark.createDataFrame([(s,) for s in texts], "s string")
    got = [r[0] for r in df.select(to_double("s")).collect()]
    for g, e in zip(got, expect):
        assert (g is None and pd.isna(e)) or g == e


def test_inf_words_are_numbers(spark):
    df = spark.createDataFrame([("inf",), ("-Infinity",)], "s string")
    got = [r[0] for r in df.select(to_double("s")).collect()]
    assert got == [float("inf"), float("-inf")]


def test_fixed_datetime(spark):
    df = spark.createDataFrame([("2025-10-29",), ("2024-02-30",), ("bad",), ("2024-01-05 10:00",)], "s string")
    got = [r[0] for r in df.select(to_datetime_fixed("s")).collect()]
    assert got == [dt.datetime(2025, 10, 29), None, None, None]
    assert dict(df.select(to_datetime_fixed("s").alias("x")).dtypes)["x"] == "timestamp_ntz"


def test_inferred_datetime(spark):
    df = spark.createDataFrame([("2025-12-07 02:45:58",), ("2025-12-07",), ("07/12/2025",), ("x",)], "s string")
    got = [r[0] for r in df.select(to_datetime_inferred("s")).collect()]
    assert got == [dt.datetime(2025, 12, 7, 2, 45, 58), dt.datetime(2025, 12, 7), dt.datetime(2025, 7, 12), None]


@pytest.mark.parametrize("raw,expect", [
    ("1. open", "open"), ("4b. close (EUR)", "close"), ("4a. close (USD)", "close"),
    ("5. volume", "volume"), ("plain", "plain"), ("", ""),
])
def test_series_field_name(spark, raw, expect):
    got = spark.createDataFrame([(raw,)], "k string").select(names.series_field_expr(F.col("k"))).first()[0]
    assert got == expect


@pytest.mark.parametrize("raw,expect", [
    ("6. Last Refreshed", "last_refreshed"), ("1. From_Currency Code", "from_currency_code"),
    ("5. Exchange Rate", "exchange_rate"), ("single", ""),
])
def test_quote_field_name(spark, raw, expect):
    got = spark.createDataFrame([(raw,)], "k string").select(names.quote_field_expr(F.col("k"))).first()[0]
    assert got == expect


def test_suffix_rules(spark):
    lists = [["close", "close", "open", "close"], ["x", "x", "x_1"], ["x_1", "x", "x", "x"], []]
    want = [["close", "close_1", "open", "close_2"], ["x", "x_1", "x_1_1"], ["x_1", "x", "x_2", "x_3"], []]
    assert [names.free_names(n, lambda x, i: f"{x}_{i}") for n in lists] == want
    got = spark.createDataFrame([(n,) for n in lists], "n array<string>").select(names.free_names_expr(F.col("n"))).collect()
    assert [r[0] for r in got] == want
    many = spark.createDataFrame([(1, 2, 3, 4)], "a int, b int, c int, d int").toDF("a", "a", "a", "b")
    assert names.rename_duplicates(many).columns == ["a", "a_dup", "a_dup2", "b"]
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int").toDF("x", "y", "x")
    assert names.rename_duplicates(df).columns == ["x", "y", "x_dup"]
    kept = names.drop_repeated_columns(df)
    assert kept.columns == ["x", "y"] and tuple(kept.first()) == (1, 2)


def test_normalize_and_pick(spark):
    assert names.normalize_columns(spark.createDataFrame([(1,)], "a int").toDF("  Close Price ")).columns == ["close_price"]
    cols = ["datetime", "open", "close_fx", "symbol", "volume"]
    assert names.columns_with(cols, names.NUMERIC_FIELD_WORDS) == ["open", "close_fx", "volume"]
    assert names.columns_with(["from_currency_code", "exchange_rate", "bid_price"], names.FX_FIELD_WORDS) == ["exchange_rate"]


def test_interleave_bits(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (0, 1), (3, 3), (65535, 0)], "a long, b long")
    got = [r[0] for r in df.select(interleave_bits(["a", "b"], 16)).collect()]

    def z(a, b):
        return sum((((a >> i) & 1) << (2 * i)) | (((b >> i) & 1) << (2 * i + 1)) for i in range(16))
    assert got == [z(0, 0), z(1, 0), z(0, 1), z(3, 3), z(65535, 0)]
    wide = spark.createDataFrame([(1, 1), (65537, 65537)], "a long, b long")
    assert len({r[0] for r in wide.select(interleave_bits(["a", "b"])).collect()}) == 2
    with pytest.raises(Exception, match="outside"):
        wide.select(interleave_bits(["a", "b"], 16)).collect()


def test_strict_datetime_fails_on_bad_value(spark):
    from pyspark.errors import PySparkException
    from py4j.protocol import Py4JJavaError
    from tidemark.functions.coerce import to_datetime_strict
    ok = spark.createDataFrame([("2025-10-29",)], "s string").select(to_datetime_strict("s")).first()[0]
    assert ok == dt.datetime(2025, 10, 29)
    bad = spark.createDataFrame([("2025-13-45",)], "s string").select(to_datetime_strict("s"))
    with pytest.raises((PySparkException, Py4JJavaError)):
        bad.collect()


def test_datetime_shape_guard_changes_no_result(spark):
    # the guarded parse must equal the bare parse on valid, odd and bad text
    texts = ["2025-10-29", "2024-02-30", "2025-1-5", "2025-10-29x", "x", "", "20250-01-01",
             "2025-12-07 02:45:58", "2025-12-07 02:45:58.5", "2025-12-07 02:45:58.123456",
             "2025-12-07T02:45:58", "12/07/2025", "2025/12/07", " 2025-10-29"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    from tidemark.functions.coerce import INFERRED_DATETIME_FORMATS
    bare = F.coalesce(*[F.try_to_timestamp("s", F.lit(f)) for f in INFERRED_DATETIME_FORMATS]).cast("timestamp_ntz")
    rows = df.select(to_datetime_inferred("s").alias("a"), bare.alias("b"),
                     to_datetime_fixed("s").alias("c"),
                     F.try_to_timestamp("s", F.lit("yyyy-MM-dd")).cast("timestamp_ntz").alias("d")).collect()
    assert all(r.a == r.b and r.c == r.d for r in rows)
