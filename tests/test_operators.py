"""Operators against brute-force / pandas forms on small frames."""

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import dedup, enrich, fill, incremental, quality, rollup, upsert, versions
from tests.conftest import SF_SMALL


def _series(n=400, keys=3, seed=1, null_share=0.3):
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        k = f"k{rnd.randrange(keys)}" if keys else "k0"
        ts = base + dt.timedelta(minutes=rnd.randrange(60 * 24 * 20))
        v = None if rnd.random() < null_share else round(rnd.uniform(-5, 100), 2)
        rows.append((i, k, ts, v))
    return rows


@pytest.mark.parametrize("bucket", ["hour", "day", "month", "range"])
@pytest.mark.parametrize("keys", [["k"], []])
def test_two_phase_fill_equals_pandas_ffill_bfill(spark, bucket, keys):
    rows = _series()
    df = spark.createDataFrame(rows, "id long, k string, ts timestamp_ntz, v double")
    got = {r.id: r.v for r in fill.fill_gaps(df, ["v"], ["ts", "id"], keys=keys, bucket=bucket).collect()}
    pdf = pd.DataFrame(rows, columns=["id", "k", "ts", "v"]).sort_values(["ts", "id"])
    if keys:
        pdf["f"] = pdf.groupby("k")["v"].transform(lambda s: s.ffill().bfill())
    else:
        pdf["f"] = pdf["v"].ffill().bfill()
    expect = dict(zip(pdf["id"], pdf["f"]))
    assert got == {k: (None if pd.isna(v) else v) for k, v in expect.items()}


def test_fill_all_null_key_stays_null(spark):
    df = spark.createDataFrame([(1, "a", dt.datetime(2024, 1, 1), None), (2, "b", dt.datetime(2024, 1, 2), 3.0)],
                               "id long, k string, ts timestamp_ntz, v double")
    got = {r.id: r.v for r in fill.fill_gaps(df, ["v"], ["ts", "id"], keys=["k"]).collect()}
    assert got == {1: None, 2: 3.0}


def test_keep_last_equals_pandas_drop_duplicates(spark):
    rows = _series(n=300, keys=5, seed=3, null_share=0.1)
    df = spark.createDataFrame(rows, "id long, k string, ts timestamp_ntz, v double")
    got = sorted(tuple(r) for r in dedup.keep_last(df, ["k"], ["ts", "id"], columns=["id", "v"]).collect())
    pdf = pd.DataFrame(rows, columns=["id", "k", "ts", "v"]).sort_values(["ts", "id"])
    exp = pdf.drop_duplicates(subset=["k"], keep="last")
    expect = sorted((r.k, r.id, None if pd.isna(r.v) else r.v) for r in exp.itertuples())
    assert got == expect


def test_keep_last_plan_aggregates_before_shuffle(spark):
    df = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    plan = dedup.keep_last(df, ["o_custkey"], ["o_orderdate", "o_orderkey"])._jdf.queryExecution() \
        .executedPlan().toString()
    assert "partial_max" in plan


def test_merge_with_metrics(spark):
    t = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 3.0)], "k long, v double")
    s = spark.createDataFrame([(2, 2.0), (3, 30.0), (4, 4.0)], "k long, v double")
    merged, m = upsert.merge_with_metrics(t, s, ["k"], compare=["v"])
    assert sorted(tuple(r) for r in merged.collect()) == [(1, 1.0), (2, 2.0), (3, 30.0), (4, 4.0)]
    assert m.first().asDict() == {"inserted": 1, "updated": 2, "kept": 1, "unchanged": 1}
    assert sorted(tuple(r) for r in upsert.merge(t, s, ["k"]).collect()) == \
        sorted(tuple(r) for r in merged.collect())


def test_merge_twice_is_merge_once(spark):
    t = spark.createDataFrame([(1, 1.0), (2, 2.0)], "k long, v double")
    s = spark.createDataFrame([(2, 5.0), (3, 3.0)], "k long, v double")
    once = upsert.merge(t, s, ["k"])
    twice = upsert.merge(once, s, ["k"])
    assert sorted(once.collect()) == sorted(twice.collect())


def test_duplicate_source_key_fails(spark):
    s = spark.createDataFrame([(1, 1.0), (1, 2.0)], "k long, v double")
    with pytest.raises(upsert.DuplicateKeyError):
        upsert.assert_unique_keys(s, ["k"])


def test_high_water_empty_target_loads_everything(spark):
    src = spark.createDataFrame([(1, dt.datetime(2024, 1, 1))], "id long, ts timestamp_ntz")
    empty = src.limit(0)
    assert incremental.after_high_water(src, empty, "ts").count() == 1
    assert incremental.after_high_water(src, src, "ts").count() == 0


def test_scalar_enrichment_all_null_rate(spark):
    df = spark.createDataFrame([(1, 2.0)], "id long, close double")
    rates = spark.createDataFrame([(dt.datetime(2024, 1, 1), None)], "ts timestamp_ntz, r double")
    out = enrich.enrich_scalar(df, enrich.last_non_null(rates, "r", ["ts"]), "r")
    assert out.first().close_fx is None and "close_fx" in out.columns


def test_check_report_and_quarantine(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 0.0), (3, None), (4, float("nan"))], "id long, close double")
    rep = {r.rule: r.violations for r in quality.check_report(df, {"positive_close": "close > 0"}).collect()}
    assert rep == {"positive_close": 2} or rep == {"positive_close": 3}
    good, bad = quality.split_by_checks(df, {"positive_close": "close > 0"})
    assert {r.id for r in good.collect()} | {r.id for r in bad.collect()} == {1, 2, 3, 4}
    with pytest.raises(quality.CheckViolation):
        quality.enforce_checks(df, {"positive_close": "close > 0"})
    assert [r.id for r in quality.keep_positive(df, "close").collect()] == [1]


def test_monthly_summary_drops_null_month(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1), 1.0), (dt.datetime(2024, 1, 9), 3.0), (None, 7.0)],
                               "datetime timestamp_ntz, close double")
    got = [tuple(r) for r in rollup.monthly_summary(df).collect()]
    assert got == [("2024-01", 2.0, 3.0, 1.0)]


def _changelog(spark):
    d = dt.datetime
    rows = [  # key, value, version, ts, op
        ("a", 1.0, 0, d(2024, 1, 1), "upsert"), ("b", 2.0, 0, d(2024, 1, 1), "upsert"),
        ("a", 10.0, 1, d(2024, 1, 5), "upsert"), ("b", None, 2, d(2024, 1, 9), "delete"),
        ("c", 3.0, 3, d(2024, 1, 20), "overwrite"), ("a", 11.0, 4, d(2024, 1, 21), "upsert"),
    ]
    return spark.createDataFrame(rows, "k string, v double, _version long, _ts timestamp_ntz, _op string")


def test_as_of_versions(spark):
    log = _changelog(spark)
    snap = lambda v: sorted(tuple(r) for r in versions.as_of(log, ["k"], v).collect())
    assert snap(0) == [("a", 1.0), ("b", 2.0)]
    assert snap(1) == [("a", 10.0), ("b", 2.0)]
    assert snap(2) == [("a", 10.0)]
    assert snap(3) == [("c", 3.0)]
    assert snap(None) == [("a", 11.0), ("c", 3.0)]
    assert versions.current_version(log).first()[0] == 4
    h = versions.history(log, 2).collect()
    assert [(r._version, r._op, r.rows) for r in h] == [(4, "upsert", 1), (3, "overwrite", 1)]


def test_vacuum_rule_equals_lead_window(spark):
    from pyspark.sql import Window
    rows = _series(n=500, keys=7, seed=5, null_share=0)
    log = spark.createDataFrame(rows, "id long, k string, _ts timestamp_ntz, v double")
    now = dt.datetime(2024, 1, 21)
    got = sorted(r.id for r in versions.vacuum_rows(log, ["k"], now, 24 * 7, order=["_ts", "id"]).collect())
    w = Window.partitionBy("k").orderBy("_ts", "id")
    nx = log.withColumn("nx", F.lead("_ts").over(w))
    limit = now - dt.timedelta(hours=168)
    expect = sorted(r.id for r in nx.filter(F.col("nx").isNull() | (F.col("nx") >= F.lit(limit))).collect())
    assert got == expect
    with pytest.raises(versions.RetentionError):
        versions.vacuum_rows(log, ["k"], now, 1)


def test_fill_null_key_is_its_own_series(spark):
    d = dt.datetime
    rows = [(1, None, d(2024, 1, 1), 1.0), (2, None, d(2024, 1, 2), None),
            (3, "a", d(2024, 1, 1), None), (4, "a", d(2024, 1, 3), 5.0), (5, "a", d(2024, 1, 4), None)]
    df = spark.createDataFrame(rows, "id long, k string, ts timestamp_ntz, v double")
    got = {r.id: r.v for r in fill.fill_gaps(df, ["v"], ["ts", "id"], keys=["k"]).collect()}
    assert got == {1: 1.0, 2: 1.0, 3: 5.0, 4: 5.0, 5: 5.0}


def test_enrich_by_key_per_pair_rates(spark):
    df = spark.createDataFrame([("USD", 10.0), ("GBP", 20.0), ("JPY", 30.0)], "ccy string, close double")
    rates = spark.createDataFrame([("USD", 0.5), ("GBP", 2.0)], "ccy string, r double")
    got = {r.ccy: r.close_fx for r in enrich.enrich_by_key(df, rates, ["ccy"], "r").collect()}
    assert got == {"USD": 5.0, "GBP": 40.0, "JPY": None}


def test_keep_first_and_top_n(spark):
    rows = _series(n=200, keys=4, seed=9, null_share=0)
    df = spark.createDataFrame(rows, "id long, k string, ts timestamp_ntz, v double")
    got = sorted(tuple(r) for r in dedup.keep_first(df, ["k"], ["ts", "id"], columns=["id"]).collect())
    pdf = pd.DataFrame(rows, columns=["id", "k", "ts", "v"]).sort_values(["ts", "id"])
    expect = sorted((r.k, r.id) for r in pdf.drop_duplicates(subset=["k"], keep="first").itertuples())
    assert got == expect
    top = [r.id for r in rollup.latest_row(df, ["ts", "id"], n=3).collect()]
    assert top == list(pdf.sort_values(["ts", "id"], ascending=False)["id"][:3])
    first = [r.id for r in rollup.preview(df, 4, ["ts", "id"]).collect()]
    assert first == list(pdf["id"][:4])


def test_history_without_limit_and_row_counts(spark):
    log = _changelog(spark)
    h = versions.history(log).collect()
    assert [r._version for r in h] == [4, 3, 2, 1, 0]
    counts = {r.table: r.n for r in rollup.row_counts({"log": log, "two": log.limit(2)}).collect()}
    assert counts == {"log": 6, "two": 2}


def test_check_report_rule_names_with_quotes(spark):
    df = spark.createDataFrame([(1, -1.0)], "id long, close double")
    rep = quality.check_report(df, {"close's sign": "close > 0", "back\\slash": "id > 0"}).collect()
    assert {r.rule: r.violations for r in rep} == {"close's sign": 1, "back\\slash": 0}
