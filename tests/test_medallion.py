"""Both medallion flows end to end on documents derived from events."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from tidemark.plans.medallion import Lake, run_incremental, run_strict
from tests import landing
from tests.conftest import SF_SMALL


def _land_quotes(folder):
    os.makedirs(folder, exist_ok=True)
    for i, (rate, ts) in enumerate([("0.81250000", "2024-03-05 06:07:08"), ("0.79000000", "2024-03-04 06:07:08")]):
        doc = {"Realtime Currency Exchange Rate": {
            "1. From_Currency Code": "USD", "2. From_Currency Name": "United States Dollar",
            "3. To_Currency Code": "EUR", "4. To_Currency Name": "Euro", "5. Exchange Rate": rate,
            "6. Last Refreshed": ts, "7. Time Zone": "UTC", "8. Bid Price": "0.81240000",
            "9. Ask Price": "0.81250000"}}
        with open(os.path.join(folder, f"q{i}.json"), "w") as fh:
            json.dump(doc, fh)


def _snapshot(spark, path):
    return sorted(tuple(r) for r in spark.read.option("mergeSchema", "true").parquet(path).collect())


def test_incremental_flow_twice_equals_once(spark, tmp_root):
    prices = landing.daily_prices(spark, SF_SMALL)
    # blank some closes to exercise the fill
    prices = prices.withColumn("close", F.when(F.dayofmonth("day") % 6 == 0, F.lit(None)).otherwise(F.col("close")))
    land_dir = os.path.join(tmp_root, "series")
    q_dir = os.path.join(tmp_root, "quotes")
    landing.land(landing.series_docs(spark, prices), land_dir)
    _land_quotes(q_dir)
    lake = Lake(os.path.join(tmp_root, "lake"))
    run_ts = dt.datetime(2024, 3, 5, 7, 0, 0)
    out1 = run_incremental(spark, lake, land_dir, q_dir, run_ts)
    tables = [lake.table("silver", "digital_currency_daily"), lake.table("gold", "crypto_monthly_summary"),
              lake.table("gold", "currency_exchange_rate_latest")]
    snap1 = [_snapshot(spark, t) for t in tables]
    silver = spark.read.parquet(tables[0])
    assert silver.filter(F.col("close").isNull()).count() == 0
    assert silver.filter("close_fx is null").count() == 0
    r = silver.select(F.round(F.col("close_fx") / F.col("close"), 9).alias("r")).distinct().collect()
    assert [x.r for x in r] == [0.8125]
    gold = spark.read.parquet(tables[1])
    assert gold.filter("not (min_close <= avg_close and avg_close <= max_close)").count() == 0
    assert gold.groupBy("symbol", "market", "month").count().filter("count > 1").count() == 0
    latest = spark.read.parquet(tables[2]).collect()
    assert len(latest) == 1 and latest[0].exchange_rate == "0.81250000"
    assert out1["bronze"]["created"]

    out2 = run_incremental(spark, lake, land_dir, q_dir, run_ts)
    assert out2["bronze"]["inserted"] == 0
    assert [_snapshot(spark, t) for t in tables] == snap1


def test_strict_flow(spark, tmp_root):
    prices = landing.daily_prices(spark, SF_SMALL)
    land_dir = os.path.join(tmp_root, "series")
    q_dir = os.path.join(tmp_root, "quotes")
    landing.land(landing.series_docs(spark, prices), land_dir)
    # a rate-limit notice and a document with a bad date land as well
    with open(os.path.join(land_dir, "notice.json"), "w") as fh:
        json.dump({"Information": "rate limit reached"}, fh)
    with open(os.path.join(land_dir, "bad-date.json"), "w") as fh:
        json.dump({"Meta Data": {"2. Digital Currency Code": "BTC", "4. Market Code": "USD"},
                   "Time Series (Digital Currency Daily)": {"2024-02-30": {"4. close": "1"}}}, fh)
    _land_quotes(q_dir)
    lake = Lake(os.path.join(tmp_root, "lake"))
    run_strict(spark, lake, land_dir, q_dir)
    run_strict(spark, lake, land_dir, q_dir)
    silver = spark.read.parquet(lake.table("silver", "crypto_daily_clean"))
    assert silver.count() == prices.count()
    gold = spark.read.parquet(lake.table("gold", "crypto_monthly_summary"))
    assert gold.count() == prices.select("symbol", F.date_format("day", "yyyy-MM")).distinct().count()
    fx = spark.read.parquet(lake.table("gold", "exchange_rate_latest")).collect()
    assert len(fx) == 1 and fx[0].last_refreshed == "2024-03-05 06:07:08"
    # both bad inputs are quarantined, once though the flow ran twice; none loaded
    notices = spark.read.parquet(lake.table("quarantine", "series_payloads")).collect()
    assert {r.reason for r in notices} == {"no_time_series"} and len(notices) == 1
    bad = spark.read.parquet(lake.table("quarantine", "crypto_daily")).collect()
    assert len(bad) == 1 and bad[0].datetime is None


def test_late_rows_and_corrections_reach_silver_and_gold(spark, tmp_root):
    from tidemark.plans.medallion import ingest, transform
    prices = landing.daily_prices(spark, SF_SMALL)
    prices = prices.withColumn("close", F.when(F.dayofmonth("day") % 6 == 0, F.lit(None)).otherwise(F.col("close")))
    # gaps in ``open`` survive bronze and are filled in silver, also across
    # the two runs and around the late rows
    prices = prices.withColumn("open", F.when(F.dayofmonth("day").isin(1, 14, 15, 20, 21), F.lit(None))
                                        .otherwise(F.col("open")))
    first = prices.filter(F.col("day") < F.lit("2024-01-20").cast("timestamp_ntz"))
    second = prices.filter(F.col("day") >= F.lit("2024-01-15").cast("timestamp_ntz")) \
                   .withColumn("close", F.col("close") + 1)
    d1, d2 = os.path.join(tmp_root, "d1"), os.path.join(tmp_root, "d2")
    landing.land(landing.series_docs(spark, first), d1)
    landing.land(landing.series_docs(spark, second), d2)
    t1, t2 = dt.datetime(2024, 2, 1), dt.datetime(2024, 2, 2)

    inc = Lake(os.path.join(tmp_root, "inc"))
    ingest(spark, inc, d1, None, t1)
    transform(spark, inc)
    ingest(spark, inc, d2, None, t2)
    out = transform(spark, inc)
    assert out["silver"]["updated"] > 0          # corrections merged, not dropped

    once = Lake(os.path.join(tmp_root, "once"))
    ingest(spark, once, d1, None, t1, max_files_per_batch=2)   # several micro-batches
    ingest(spark, once, d2, None, t2)
    transform(spark, once)

    for tier, name in (("silver", "digital_currency_daily"), ("gold", "crypto_monthly_summary")):
        a = _snapshot(spark, inc.table(tier, name))
        b = _snapshot(spark, once.table(tier, name))
        assert a == b, (tier, len(a), len(b))
    silver = spark.read.parquet(inc.table("silver", "digital_currency_daily"))
    # bronze of this flow drops rows without a close (Q3), silver keeps the rest
    assert silver.count() == prices.filter(F.col("close").isNotNull()).count()
    assert silver.filter(F.col("close").isNull() | F.col("open").isNull()).count() == 0


def test_jobs_cli_and_table_discovery(spark, tmp_root):
    from tidemark import jobs
    from tidemark.plans import maintenance
    prices = landing.daily_prices(spark, SF_SMALL)
    land_dir = os.path.join(tmp_root, "series")
    landing.land(landing.series_docs(spark, prices), land_dir)
    lake = os.path.join(tmp_root, "lake")
    jobs.main(["--master", "local[2]", "strict", "--lake", lake, "--series", land_dir])
    found = [t.split("/lake/")[-1] for t in maintenance.find_tables(spark, lake)]
    assert "bronze/crypto_daily" in found and "gold/crypto_monthly_summary" in found
    assert "silver/crypto_daily_clean" in found
    res = jobs.main(["--master", "local[2]", "compact", "--lake", lake, "--file-mb", "1"])
    assert all("error" not in r for r in res.values()), res
    lake2 = os.path.join(tmp_root, "lake2")
    out = jobs.main(["--master", "local[2]", "incremental", "--lake", lake2, "--series", land_dir,
                     "--run-ts", "2024-02-01T00:00:00"])
    assert out["bronze"]["inserted"] == prices.count() and out["silver"]["inserted"] == prices.count()


def test_late_correction_refills_later_rows(spark, tmp_root):
    from tidemark.plans.medallion import ingest, transform
    prices = landing.daily_prices(spark, SF_SMALL)
    # day 14 has no open: it is filled from day 13
    prices = prices.withColumn("open", F.when(F.dayofmonth("day") == 14, F.lit(None)).otherwise(F.col("open")))
    first = prices.filter(F.col("day") < F.lit("2024-01-20").cast("timestamp_ntz"))
    # a later delivery corrects day 13 only
    fix = prices.filter(F.dayofmonth("day") == 13).withColumn("open", F.col("open") + 100)
    d1, d2 = os.path.join(tmp_root, "d1"), os.path.join(tmp_root, "d2")
    landing.land(landing.series_docs(spark, first), d1)
    landing.land(landing.series_docs(spark, fix), d2)
    t1, t2 = dt.datetime(2024, 2, 1), dt.datetime(2024, 2, 2)

    inc = Lake(os.path.join(tmp_root, "inc"))
    ingest(spark, inc, d1, None, t1)
    transform(spark, inc)
    ingest(spark, inc, d2, None, t2)
    transform(spark, inc)
    once = Lake(os.path.join(tmp_root, "once"))
    ingest(spark, once, d1, None, t1)
    ingest(spark, once, d2, None, t2)
    transform(spark, once)

    silver = lambda lk: spark.read.parquet(lk.table("silver", "digital_currency_daily"))
    day14 = {r.symbol: r.open for r in silver(inc).filter(F.dayofmonth("datetime") == 14).collect()}
    day13 = {r.symbol: r.open for r in silver(inc).filter(F.dayofmonth("datetime") == 13).collect()}
    assert day14 == day13                     # refilled from the corrected day 13
    for tier, name in (("silver", "digital_currency_daily"), ("gold", "crypto_monthly_summary")):
        assert _snapshot(spark, inc.table(tier, name)) == _snapshot(spark, once.table(tier, name))


def test_new_payload_field_becomes_a_column(spark, tmp_root):
    prices = landing.daily_prices(spark, SF_SMALL)
    d1, d2 = os.path.join(tmp_root, "d1"), os.path.join(tmp_root, "d2")
    first = prices.filter(F.col("day") < F.lit("2024-01-20").cast("timestamp_ntz"))
    later = prices.filter(F.col("day") >= F.lit("2024-01-20").cast("timestamp_ntz")) \
                  .withColumn("cap", F.col("close") * 10)
    landing.land(landing.series_docs(spark, first), d1)
    fields = dict(landing.FIELDS, **{"6. market cap (USD)": "cap"})
    from tidemark.sources.payload import to_series_documents
    landing.land(to_series_documents(later, "symbol", "day", fields, market="market"), d2)
    lake = Lake(os.path.join(tmp_root, "lake"))
    run_incremental(spark, lake, d1, None, dt.datetime(2024, 2, 1))
    run_incremental(spark, lake, d2, None, dt.datetime(2024, 2, 2))
    silver = spark.read.option("mergeSchema", "true").parquet(lake.table("silver", "digital_currency_daily"))
    assert "market_cap" in silver.columns
    assert silver.filter("market_cap is not null").count() == later.count()
    assert silver.count() == prices.count()


def test_runs_without_or_with_earlier_stamps_lose_nothing(spark, tmp_root):
    lake = Lake(os.path.join(tmp_root, "lake"))
    land_dir = os.path.join(tmp_root, "series")
    prices = landing.daily_prices(spark, SF_SMALL)
    first, rest = prices.filter(F.dayofmonth("day") <= 10), prices.filter(F.dayofmonth("day") > 10)
    landing.land(landing.series_docs(spark, first), land_dir)
    run_incremental(spark, lake, land_dir)
    landing.land(landing.series_docs(spark, rest), land_dir, prefix="more")
    run_incremental(spark, lake, land_dir, run_ts=dt.datetime(2001, 1, 1))
    bronze = spark.read.parquet(lake.table("bronze", "digital_currency_daily"))
    silver = spark.read.parquet(lake.table("silver", "digital_currency_daily"))
    assert bronze.count() == silver.count() == prices.select("symbol", "day").distinct().count()


def test_quote_delivery_with_a_notice_only_keeps_the_quotes(spark, tmp_root):
    lake = Lake(os.path.join(tmp_root, "lake"))
    land_dir, q_dir, notice = (os.path.join(tmp_root, n) for n in ("series", "quotes", "notice"))
    landing.land(landing.series_docs(spark, landing.daily_prices(spark, SF_SMALL)), land_dir)
    _land_quotes(q_dir)
    run_incremental(spark, lake, land_dir, q_dir)
    from tidemark.plans.medallion import INCREMENTAL_TABLES
    path = lake.table(*INCREMENTAL_TABLES["bronze_quotes"])
    before = spark.read.parquet(path).count()
    os.makedirs(notice)
    with open(os.path.join(notice, "n.json"), "w") as fh:
        fh.write('{"Note": "rate limit"}')
    run_incremental(spark, lake, land_dir, notice)
    assert spark.read.parquet(path).count() == before > 0


def _doc(days, symbol="AAA"):
    return {"Meta Data": {"2. Digital Currency Code": symbol, "4. Market Code": "USD"},
            "Time Series (Digital Currency Daily)": {
                d: {"1. open": "1", "2. high": "9", "3. low": "1", "4. close": str(c), "5. volume": "5"}
                for d, c in days.items()}}


def _land(folder, name, doc, mtime=None):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as fh:
        json.dump(doc, fh)
    if mtime:
        os.utime(path, (mtime, mtime))


def test_the_later_delivery_of_a_day_wins(spark, tmp_root):
    land_dir = os.path.join(tmp_root, "series")
    _land(land_dir, "b.json", _doc({"2024-01-01": 100, "2024-01-02": 50}), 1_700_000_000)
    _land(land_dir, "a.json", _doc({"2024-01-01": 90}), 1_700_000_500)
    for run, table in ((run_incremental, "digital_currency_daily"), (run_strict, "crypto_daily")):
        lake = Lake(os.path.join(tmp_root, table))
        run(spark, lake, land_dir)
        rows = spark.read.parquet(lake.table("bronze", table)).collect()
        assert {r.date: r.close for r in rows} == {"2024-01-01": 90.0, "2024-01-02": 50.0}
        assert not {"_delivered_at", "_delivered_as"} & set(rows[0].asDict())


def test_redelivered_history_leaves_unchanged_rows_and_months(spark, tmp_root):
    land_dir = os.path.join(tmp_root, "series")
    start = dt.date(2023, 6, 1)
    days = {str(start + dt.timedelta(days=i)): 100 + i for i in range(300)}
    lake = Lake(os.path.join(tmp_root, "lake"))
    _land(land_dir, "first.json", _doc(days))
    run_incremental(spark, lake, land_dir)

    def months(tier):
        root = lake.table(tier, "digital_currency_daily")
        return {m: sorted(os.listdir(os.path.join(root, m))) for m in os.listdir(root) if m.startswith("month=")}
    bronze, silver = months("bronze"), months("silver")
    _land(land_dir, "again.json", _doc({**days, str(start + dt.timedelta(days=300)): 7}))
    out = run_incremental(spark, lake, land_dir)
    assert (out["bronze"]["inserted"], out["bronze"]["updated"], out["bronze"]["unchanged"]) == (1, 0, 300)
    assert (out["silver"]["inserted"], out["silver"]["updated"]) == (1, 0)
    for before, after in ((bronze, months("bronze")), (silver, months("silver"))):
        assert [m for m in after if after[m] != before.get(m)] == ["month=2024-03"]


def test_a_first_delivery_of_notices_only_does_not_stop_the_flow(spark, tmp_root):
    land_dir, q_dir = os.path.join(tmp_root, "series"), os.path.join(tmp_root, "quotes")
    _land(land_dir, "n.json", {"Information": "rate limit"})
    _land(q_dir, "n.json", {"Information": "rate limit"})
    inc, strict = Lake(os.path.join(tmp_root, "inc")), Lake(os.path.join(tmp_root, "strict"))
    for _ in range(2):
        assert run_incremental(spark, inc, land_dir, q_dir)["bronze"]["inserted"] == 0
        assert run_strict(spark, strict, land_dir, q_dir)["bronze"]["inserted"] == 0
    for lake in (inc, strict):
        for name in ("series_payloads", "quote_payloads"):
            assert spark.read.parquet(lake.table("quarantine", name)).count() == 1
    _land(land_dir, "d.json", _doc({"2024-01-01": 3}))
    _land(q_dir, "q.json", {"Realtime Currency Exchange Rate": {
        "1. From_Currency Code": "USD", "3. To_Currency Code": "EUR", "5. Exchange Rate": "0.5",
        "6. Last Refreshed": "2024-01-01 00:00:00", "10. Spread": "0.1"}})
    run_incremental(spark, inc, land_dir, q_dir)
    run_strict(spark, strict, land_dir, q_dir)
    row = spark.read.parquet(inc.table("silver", "digital_currency_daily")).first()
    assert (row.close, row.close_fx) == (3.0, 1.5)
    assert spark.read.parquet(inc.table("gold", "currency_exchange_rate_latest")).first().spread == "0.1"
    assert spark.read.parquet(strict.table("gold", "exchange_rate_latest")).first().spread == "0.1"
    assert spark.read.parquet(strict.table("gold", "crypto_monthly_summary")).first().avg_close == 3.0


def test_a_run_with_the_stamp_of_an_earlier_one_passes_its_rows_on(spark, tmp_root):
    land_dir, ts = os.path.join(tmp_root, "series"), dt.datetime(2024, 5, 1)
    lake = Lake(os.path.join(tmp_root, "lake"))
    for i in (1, 2):
        _land(land_dir, f"{i}.json", _doc({f"2024-01-0{i}": i}))
        run_incremental(spark, lake, land_dir, run_ts=ts)
    assert spark.read.parquet(lake.table("silver", "digital_currency_daily")).count() == 2
