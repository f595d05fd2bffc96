"""Write paths and maintenance jobs on real folders (K1-K7, M1-M3)."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tidemark.plans import maintenance
from tidemark.sinks import tables as sink
from tidemark.sources.tables import read_first, read_table
from tests.conftest import SF_SMALL


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _orders(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    return o.select("o_orderkey", F.col("o_orderdate").alias("datetime"), "o_totalprice")


def test_overwrite_of_table_being_read(spark, tmp_root):
    p = os.path.join(tmp_root, "t")
    sink.overwrite(spark.range(10).withColumn("x", F.col("id") * 2), p)
    t = spark.read.parquet(p)
    sink.overwrite(t.withColumn("x", F.col("x") + 1), p)
    assert _rows(spark.read.parquet(p)) == [(i, 2 * i + 1) for i in range(10)]


def test_append_and_schema_merge(spark, tmp_root):
    p = os.path.join(tmp_root, "t")
    sink.append(spark.range(3), p)
    sink.append(spark.range(3, 5), p)
    assert spark.read.parquet(p).count() == 5
    sink.overwrite_merge_schema(spark.range(2).withColumn("extra", F.lit("e")), p)
    # old rows are replaced, the new column is visible, no column lost
    df = read_table(spark, p)
    assert set(df.columns) == {"id", "extra"} and df.count() == 2


def test_read_first_fallback(spark, tmp_root):
    p = os.path.join(tmp_root, "t")
    assert read_first(spark, [os.path.join(tmp_root, "missing")]) is None
    empty = read_first(spark, [os.path.join(tmp_root, "missing")], schema="id long")
    assert empty.count() == 0 and empty.columns == ["id"]
    sink.append(spark.range(2), p)
    assert read_first(spark, [os.path.join(tmp_root, "missing"), p]).count() == 2


def test_upsert_table_touched_partitions_and_rerun(spark, tmp_root):
    p = os.path.join(tmp_root, "orders")
    o = _orders(spark)
    old = o.filter(F.col("datetime") < F.lit("2000-01-01").cast("timestamp_ntz"))
    m0 = sink.upsert_table(spark, p, old, ["o_orderkey"])
    assert m0["created"] and m0["inserted"] == old.count()
    new = o.filter(F.col("datetime") >= F.lit("1999-06-01").cast("timestamp_ntz")) \
           .withColumn("o_totalprice", F.col("o_totalprice") + 1)
    months_before = {r[0] for r in spark.read.parquet(p).select("month").distinct().collect()}
    m1 = sink.upsert_table(spark, p, new, ["o_orderkey"])
    n_upd = new.filter(F.col("datetime") < F.lit("2000-01-01").cast("timestamp_ntz")).count()
    assert m1["updated"] == n_upd and m1["inserted"] == new.count() - n_upd
    got = spark.read.parquet(p)
    assert got.count() == o.count()
    assert got.groupBy("o_orderkey").count().filter("count > 1").count() == 0
    expect = old.join(new.select("o_orderkey"), "o_orderkey", "left_anti").unionByName(new)
    assert _rows(got.select("o_orderkey", "o_totalprice")) == _rows(expect.select("o_orderkey", "o_totalprice"))
    # untouched partitions keep their files; re-running changes nothing
    assert months_before <= {r[0] for r in got.select("month").distinct().collect()}
    m2 = sink.upsert_table(spark, p, new, ["o_orderkey"])
    assert m2["inserted"] == 0
    assert _rows(spark.read.parquet(p).select("o_orderkey", "o_totalprice")) == \
        _rows(expect.select("o_orderkey", "o_totalprice"))


def test_upsert_keep_last_source_and_null_keys(spark, tmp_root):
    p = os.path.join(tmp_root, "t")
    d = dt.datetime(2024, 1, 1)
    src = spark.createDataFrame([(1, d, 1.0, 1), (1, d, 2.0, 2), (None, d, 9.0, 1)],
                                "k long, datetime timestamp_ntz, v double, seq int")
    q = os.path.join(tmp_root, "rejects")
    m = sink.upsert_table(spark, p, src, ["k"], order=["seq"], rejects_path=q)
    assert _rows(spark.read.parquet(p).select("k", "v")) == [(1, 2.0)]
    # the null-key row is quarantined, not loaded and not silently lost
    assert m["rejected"] == 1 and _rows(spark.read.parquet(q).select("k", "v")) == [(None, 9.0)]


def test_publish_by_key_idempotent(spark, tmp_root):
    p = os.path.join(tmp_root, "gold")
    g = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "k string, v double")
    sink.publish_by_key(spark, p, g, ["k"])
    sink.publish_by_key(spark, p, g, ["k"])
    assert _rows(spark.read.parquet(p)) == [("a", 1.0), ("b", 2.0)]
    sink.publish_by_key(spark, p, spark.createDataFrame([("b", 5.0)], "k string, v double"), ["k"])
    assert _rows(spark.read.parquet(p)) == [("a", 1.0), ("b", 5.0)]


def test_changelog_versions(spark, tmp_root):
    from tidemark.operators import versions
    p = os.path.join(tmp_root, "log")
    a = spark.createDataFrame([("x", 1.0), ("y", 2.0)], "k string, v double")
    b = spark.createDataFrame([("x", 3.0)], "k string, v double")
    assert sink.append_version(spark, p, a, dt.datetime(2024, 1, 1)) == 0
    assert sink.append_version(spark, p, b, dt.datetime(2024, 1, 2)) == 1
    log = spark.read.parquet(p)
    assert set(log.columns) == {"k", "v", "_version", "_ts", "_op"}
    assert _rows(versions.history(log).select("_version", "_op", "rows")) == [(0, "upsert", 2), (1, "upsert", 1)]
    assert all(not n.startswith("_") or n == "_SUCCESS" for n in os.listdir(p))
    assert _rows(versions.as_of(log, ["k"], 0)) == [("x", 1.0), ("y", 2.0)]
    assert _rows(versions.as_of(log, ["k"])) == [("x", 3.0), ("y", 2.0)]


def test_compaction_preserves_rows_and_reduces_files(spark, tmp_root):
    p = os.path.join(tmp_root, "small")
    o = _orders(spark).withColumn("month", F.date_format("datetime", "yyyy-MM"))
    for i in range(4):
        o.repartition(4).write.mode("append").partitionBy("month").parquet(p)
    before = _rows(spark.read.parquet(p))
    res = maintenance.compact(spark, p)
    assert res["files_after"] < res["files_before"]
    assert _rows(spark.read.parquet(p)) == before
    # a second run finds nothing fragmented and rewrites no partition
    again = maintenance.compact(spark, p)
    assert again["partitions_rewritten"] == 0 and again["files_after"] == res["files_after"]
    # fragment one month only: only that month is rewritten
    month = sorted(r[0] for r in spark.read.parquet(p).select("month").distinct().collect())[0]
    one = o.filter(F.col("month") == month)
    one.repartition(3).write.mode("append").partitionBy("month").parquet(p)
    part = maintenance.compact(spark, p)
    assert part["partitions_rewritten"] == 1
    assert spark.read.parquet(p).count() == len(before) + one.count()


def test_compaction_keeps_a_clustered_order(spark, tmp_root):
    p = os.path.join(tmp_root, "clustered")
    spark.range(8000).withColumn("x", F.col("id") * 7 % 8000).repartitionByRange(8, "x").sortWithinPartitions("x").write.parquet(p)
    size = maintenance.table_bytes(spark, p)
    res = maintenance.compact(spark, p, target_file_bytes=size // 2 + 1)
    assert res["files_after"] < res["files_before"] == 8
    files = spark.read.parquet(p).groupBy("_metadata.file_name").agg(F.min("x").alias("a"), F.max("x").alias("b"), F.count("*").alias("n"))
    assert all(r.b - r.a + 1 == r.n for r in files.collect())          # each file holds one unbroken range
    assert spark.read.parquet(p).count() == 8000
    files_before = sorted(os.listdir(p))
    maintenance.compact(spark, p, target_file_bytes=size // 2 + 1)
    assert sorted(os.listdir(p)) == files_before                       # nothing left to do
    assert [n for n in os.listdir(tmp_root) if n.startswith("clustered.")] == []


def test_compaction_of_escaped_and_null_partitions(spark, tmp_root):
    p = os.path.join(tmp_root, "escaped")
    rows = spark.range(40).withColumn("k", F.element_at(F.array(F.lit("a:b"), F.lit("c d%"), F.lit(None)), (F.col("id") % 3 + 1).cast("int")))
    for _ in range(3):
        rows.coalesce(1).write.mode("append").partitionBy("k").parquet(p)
    before = _rows(spark.read.parquet(p))
    res = maintenance.compact(spark, p)
    assert (res["files_before"], res["files_after"], res["partitions_rewritten"]) == (9, 3, 3)
    assert _rows(spark.read.parquet(p)) == before


def test_zorder_preserves_rows(spark, tmp_root):
    p = os.path.join(tmp_root, "li")
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select("l_orderkey", "l_partkey", "l_suppkey")
    li.write.parquet(p)
    before = _rows(spark.read.parquet(p))
    maintenance.zorder(spark, p, ["l_partkey", "l_suppkey"], buckets=64)
    assert _rows(spark.read.parquet(p)) == before


def test_vacuum_job_and_run_all(spark, tmp_root):
    p = os.path.join(tmp_root, "log")
    d = dt.datetime
    for v, ts in ((1.0, d(2024, 1, 1)), (2.0, d(2024, 1, 2)), (3.0, d(2024, 1, 30))):
        sink.append_version(spark, p, spark.createDataFrame([("a", v)], "k string, v double"), ts)
    res = maintenance.run_all(spark, [p, os.path.join(tmp_root, "nope")], maintenance.vacuum,
                              keys=["k"], now=d(2024, 1, 31))
    assert res[p] == {"rows_before": 3, "rows_after": 2, "min_readable_version": 1, "files_rewritten": 1}
    assert res[os.path.join(tmp_root, "nope")] == {"error": "missing"}
    from tidemark.operators.versions import history
    log = read_table(spark, p)
    assert sorted(r.v for r in log.where("_op <> 'vacuum'").collect()) == [2.0, 3.0]
    # the vacuum is a version of its own
    assert [(r._version, r._op) for r in history(log).collect()] == [(3, "vacuum"), (2, "upsert"), (1, "upsert")]
    assert sink.next_version(spark, p) == 4
    # as-of reads: exact from the horizon on, refused before it
    assert [r.v for r in sink.read_as_of(spark, p, ["k"], 1).collect()] == [2.0]
    assert [r.v for r in sink.read_as_of(spark, p, ["k"]).collect()] == [3.0]
    with pytest.raises(sink.VersionVacuumedError):
        sink.read_as_of(spark, p, ["k"], 0)
    bad = maintenance.run_all(spark, [p], maintenance.vacuum, keys=["k"], now=d(2024, 1, 31), retention_hours=1)
    assert "RetentionError" in bad[p]["error"]


def _mean_file_range(spark, path, col):
    df = spark.read.parquet(path).select(col, F.col("_metadata.file_path").alias("f"))
    per = df.groupBy("f").agg((F.max(col) - F.min(col)).alias("r"))
    total = df.agg((F.max(col) - F.min(col)).alias("t")).first().t
    return per.agg(F.avg("r")).first()[0] / total


def test_zorder_narrows_file_ranges(spark, tmp_root):
    from tests.conftest import SF_MID
    p = os.path.join(tmp_root, "li")
    li = spark.read.parquet(f"{SF_MID}/lineitem.parquet").select("l_orderkey", "l_partkey", "l_suppkey")
    li.repartition(8).write.parquet(p)
    before = [_mean_file_range(spark, p, c) for c in ("l_partkey", "l_suppkey")]
    res = maintenance.zorder(spark, p, ["l_partkey", "l_suppkey"], target_file_bytes=16 * 1024, buckets=256)
    assert res["files"] >= 16
    after = [_mean_file_range(spark, p, c) for c in ("l_partkey", "l_suppkey")]
    assert all(b > 0.9 for b in before)
    # each file now covers a fraction of both key ranges: a filter on either
    # column skips most files by their min/max statistics
    assert all(a < 0.45 for a in after), after
    assert spark.read.parquet(p).count() == li.count()


def test_upsert_with_a_new_column(spark, tmp_root):
    p = os.path.join(tmp_root, "t")
    d = dt.datetime
    old = spark.createDataFrame([(1, d(2024, 1, 1), 1.0), (2, d(2024, 2, 1), 2.0)],
                                "k long, datetime timestamp_ntz, v double")
    sink.upsert_table(spark, p, old, ["k"])
    new = spark.createDataFrame([(2, d(2024, 2, 1), 20.0, "x"), (3, d(2024, 2, 2), 3.0, "y")],
                                "k long, datetime timestamp_ntz, v double, extra string")
    m = sink.upsert_table(spark, p, new, ["k"])
    assert (m["inserted"], m["updated"]) == (1, 1)
    got = sorted(tuple(r) for r in read_table(spark, p).select("k", "v", "extra").collect())
    assert got == [(1, 1.0, None), (2, 20.0, "x"), (3, 3.0, "y")]


def test_failed_swap_leaves_live_table(spark, tmp_root, monkeypatch):
    p = os.path.join(tmp_root, "t")
    sink.overwrite(spark.range(5), p)

    def boom(*a, **k):
        raise OSError("lost the driver between stage and swap")
    monkeypatch.setattr(sink, "swap_in", boom)
    with pytest.raises(OSError):
        sink.overwrite(spark.range(100), p)
    assert spark.read.parquet(p).count() == 5
