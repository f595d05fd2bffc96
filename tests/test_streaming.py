"""Incremental load as a stream: each file once, late rows merged, re-run safe."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

from tidemark.streaming.incremental import (dedup_into, dedup_within_watermark, first_or_late, incremental_upsert,
                                            landed_series_stream, parquet_stream)
from tests import landing
from tests.conftest import SF_SMALL


def test_available_now_incremental_upsert(spark, tmp_root):
    prices = landing.daily_prices(spark, SF_SMALL)
    first = prices.filter(F.col("day") < F.lit("2024-01-20").cast("timestamp_ntz"))
    later = prices.filter(F.col("day") >= F.lit("2024-01-15").cast("timestamp_ntz")) \
                  .withColumn("close", F.col("close") + 1)
    land_dir = os.path.join(tmp_root, "landing")
    target = os.path.join(tmp_root, "bronze")
    ckpt = os.path.join(tmp_root, "ckpt")
    keys = ["symbol", "market", "datetime"]
    landing.land(landing.series_docs(spark, first), land_dir, "a")
    stream = landed_series_stream(spark, land_dir, meta={"symbol": "digital_currency_code", "market": "market_code"})
    m1 = incremental_upsert(spark, stream, target, keys, ts_col="datetime", checkpoint=ckpt)
    assert sum(m.get("inserted", 0) for m in m1) == first.count()

    # second delivery overlaps the first (corrections) and adds new days
    landing.land(landing.series_docs(spark, later), land_dir, "b")
    stream = landed_series_stream(spark, land_dir, meta={"symbol": "digital_currency_code", "market": "market_code"})
    m2 = incremental_upsert(spark, stream, target, keys, ts_col="datetime", checkpoint=ckpt)
    assert sum(m["updated"] for m in m2) == later.filter(F.col("day") < F.lit("2024-01-20").cast("timestamp_ntz")).count()
    got = spark.read.parquet(target)
    assert got.count() == prices.count()
    assert got.groupBy(*keys).count().filter("count > 1").count() == 0
    expect = first.join(later.select("symbol", "day"), ["symbol", "day"], "left_anti").unionByName(later)
    g = sorted((r.symbol, r.datetime, r.close) for r in got.collect())
    e = sorted((r.symbol, r.day, float(r.close)) for r in expect.collect())
    assert g == e

    # nothing new landed: no batch runs, table unchanged
    stream = landed_series_stream(spark, land_dir, meta={"symbol": "digital_currency_code", "market": "market_code"})
    m3 = incremental_upsert(spark, stream, target, keys, ts_col="datetime", checkpoint=ckpt)
    assert m3 == [] or all(m.get("inserted", 0) == 0 for m in m3)
    assert spark.read.parquet(target).count() == prices.count()


def test_dedup_within_watermark(spark, tmp_root):
    src = os.path.join(tmp_root, "src")
    e = spark.read.parquet(f"{SF_SMALL}/events.parquet").select("event_id", "ts", "value")
    e.unionByName(e).write.parquet(src)
    s = spark.readStream.schema(e.schema).parquet(src)
    d = dedup_within_watermark(s, ["event_id"], "ts", "1 day")
    q = d.writeStream.format("memory").queryName("dedup_wm").outputMode("append") \
         .option("checkpointLocation", os.path.join(tmp_root, "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("dedup_wm").count() == e.count()


DAY = 86_400


def _run(spark, root, schema, rows=None, hold="1 hour"):
    """Lands one delivery of (k, at, n) rows and runs the stream over it."""
    landing_dir = os.path.join(root, "landing")
    if rows is not None:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landing_dir)
    stream = parquet_stream(spark, landing_dir, spark.createDataFrame([], schema).schema)
    return dedup_into(spark, stream, os.path.join(root, "out"), ["k"], "at", "1 day", hold=hold, order=["n"],
                      checkpoint=os.path.join(root, "ckpt"))


def _rows(spark, root):
    return sorted((r.k or "", int(r.at.timestamp()) // DAY if r.at else -1, -1 if r.n is None else r.n, r._outcome)
                  for r in spark.read.parquet(os.path.join(root, "out")).collect())


def _at(day):
    return datetime.datetime.fromtimestamp(day * DAY)


def test_five_deliveries_lose_nothing_silently(spark, tmp_root):
    """One file a trigger: copies go whatever their delay, late rows are kept apart and counted."""
    schema, big = "k string, at timestamp, n long", 2 ** 60 + 1
    deliveries = [
        [("a", _at(10), big), ("a", _at(10), big), ("b", _at(10), 2), ("b", _at(10), 1), (None, _at(10), 7)],
        [("c", _at(12), None), ("a", _at(11), 5), (None, _at(12), 8)],
        [("d", _at(9), 3), ("d", _at(9), 3), ("a", _at(10), big), ("e", None, 4)],
        [("f", _at(20), 1), ("c", _at(12), None)],
        [("g", _at(18), 1), ("g", _at(20), 2), ("f", _at(20), 1)]]
    counts = [m for rows in deliveries for m in _run(spark, tmp_root, schema, rows)]
    assert [(m["kept"], m["late"]) for m in counts] == [(3, 0), (1, 0), (0, 3), (1, 0), (1, 1)]
    assert _rows(spark, tmp_root) == sorted([
        ("a", 10, big, "kept"), ("b", 10, 1, "kept"), ("", 10, 7, "kept"), ("c", 12, -1, "kept"), ("d", 9, 3, "late"),
        ("d", 9, 3, "late"), ("e", -1, 4, "late"), ("f", 20, 1, "kept"), ("g", 18, 1, "late"), ("g", 20, 2, "kept")])
    assert _run(spark, tmp_root, schema) == []      # nothing new: no batch


def test_expired_keys_leave_the_state(spark, tmp_root):
    """A key past the watermark and its delay is forgotten; its next copy is late, not lost."""
    schema = "k string, at timestamp, n long"
    for rows in ([("a", _at(10), 1)], [("b", _at(30), 1)], [("c", _at(30), 1)], [("a", _at(10), 1)]):
        _run(spark, tmp_root, schema, rows, hold="1 ms")
    assert _rows(spark, tmp_root) == [("a", 10, 1, "kept"), ("a", 10, 1, "late"), ("b", 30, 1, "kept"), ("c", 30, 1, "kept")]


def test_first_or_late_is_joins_and_aggregations(spark, capsys):
    """Keys are decided in joins and aggregations, no Python call a key; a hot key and NaN pass whole."""
    day = F.timestamp_seconds(F.lit(10 * DAY))
    hot = spark.range(50_000).select(F.lit(-1).cast("long").alias("k"), day.alias("at"), F.col("id").cast("double").alias("v"))
    batch = hot.unionAll(spark.range(1000).select("id", day - F.expr("make_interval(0, 0, 0, id % 2)"), F.lit(float("nan"))))
    mark = 10 * DAY * 1000
    state = "k long, __newest long, __check long"
    held = spark.createDataFrame([(0, mark, 99), (1, mark - DAY * 1000, 5), (3000, mark, 5), (3001, 1, 5), (3002, 1, 99), (None, mark, 99)], state)
    late, after = first_or_late(batch, held, ["k"], "at", mark, 50, "1 day", "1 hour", ["v"])
    for df in (late, after):
        df.explain()
        plan = capsys.readouterr().out
        assert "Join" in plan and not any(n in plan for n in ("Python", "Pandas", "Arrow"))
    assert sorted(r.k for r in late.collect()) == list(range(3, 1000, 2))       # 1 is held, so its row is a copy
    rows = {r.k: r for r in after.collect()}
    assert set(rows) == {-1, *range(0, 1000, 2), 1, 3000, 3002, None}             # 3001 has expired, 3002 is not due
    assert rows[-1]["__first"].v == 0 and rows[2]["__first"].v != rows[2]["__first"].v
    assert rows[0]["__first"] is None and rows[1]["__newest"] == mark - DAY * 1000 and rows[1]["__check"] == 50 + 3_600_000
    assert (rows[3000]["__check"], rows[3002]["__check"], rows[None]["__check"]) == (50 + 3_600_000, 99, 99)


def test_replayed_batch_starts_from_the_keys_before_it(spark, tmp_root):
    schema = "k string, at timestamp, n long"
    _run(spark, tmp_root, schema, [("a", _at(10), 1)])
    for rows in ([("b", _at(12), 1), ("a", _at(10), 2), ("c", _at(1), 1)], [("d", _at(12), 1), ("b", _at(12), 3), ("e", _at(3), 1)]):
        _run(spark, tmp_root, schema, rows)
    whole = _rows(spark, tmp_root)
    assert [r for r in whole if r[3] == "late"] == [("c", 1, 1, "late"), ("e", 3, 1, "late")]
    assert sorted(os.listdir(os.path.join(tmp_root, "ckpt", "held"))) == ["1", "2"]
    for name in ("2", ".2.crc"):                    # the driver died before the commit
        os.remove(os.path.join(tmp_root, "ckpt", "commits", name))
    assert [(m["batch"], m["kept"], m["late"]) for m in _run(spark, tmp_root, schema)] == [(2, 1, 1)]
    assert _rows(spark, tmp_root) == whole


def test_checkpoint_without_its_keys_is_refused(spark, tmp_root):
    schema = "k string, at timestamp, n long"
    _run(spark, tmp_root, schema, [("a", _at(10), 1)])
    os.rename(os.path.join(tmp_root, "ckpt", "held"), os.path.join(tmp_root, "elsewhere"))
    with pytest.raises(Exception, match="does not hold the keys of batch 0"):
        _run(spark, tmp_root, schema, [("a", _at(10), 1)])
