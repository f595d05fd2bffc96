"""Jobs that rewrite tables lose no rows: layouts, overwrites, tombstones, null keys."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators.versions import as_of, vacuum_rows
from tidemark.plans import maintenance
from tidemark.sinks import tables as sink


def monthly(spark, n=600):
    return spark.range(n).select(
        F.col("id"), F.concat(F.lit("s"), (F.col("id") % 7).cast("string")).alias("symbol"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(id % 90 as int))").alias("datetime"),
        F.concat(F.lit("2024-0"), (F.col("id") % 3 + 1).cast("string")).alias("month"))


def test_zorder_then_upsert_keeps_the_whole_table(spark, tmp_root):
    path = f"{tmp_root}/t"
    sink.append(monthly(spark), path, ["month"])
    maintenance.zorder(spark, path, ["symbol", "datetime"])
    assert spark.read.parquet(path).count() == 600
    new = monthly(spark, 601).filter("id IN (5, 600)")
    sink.upsert_table(spark, path, new, ["id"], partition_col="month", ts_col=None)
    assert spark.read.parquet(path).count() == 601


def test_vacuum_then_as_of_over_overwrite_and_delete(spark):
    t = [dt.datetime(2024, 1, d) for d in (1, 2, 3, 4)]
    log = spark.createDataFrame([
        ("a", 1, 0, t[0], "upsert"), ("b", 1, 0, t[0], "upsert"), ("a", 2, 1, t[1], "overwrite"), ("c", 2, 1, t[1], "overwrite"),
        ("a", 3, 2, t[2], "upsert"), ("c", 3, 3, t[3], "delete")], "k string, x long, _version long, _ts timestamp_ntz, _op string")
    kept = vacuum_rows(log, ["k"], dt.datetime(2024, 3, 1), 168)
    assert sorted(map(tuple, kept.select("k", "x", "_version").collect())) == [("a", 3, 2)]
    assert as_of(kept, ["k"]).select("k", "x").collect() == as_of(log, ["k"]).select("k", "x").collect()


def test_upsert_into_a_null_partition_keeps_its_rows(spark, tmp_root):
    path = f"{tmp_root}/t"
    schema = "id long, month string, x long"
    sink.upsert_table(spark, path, spark.createDataFrame([(1, None, 1), (2, None, 1), (3, "a", 1)], schema), ["id"],
                      partition_col="month", ts_col=None)
    sink.upsert_table(spark, path, spark.createDataFrame([(4, None, 2), (5, "a", 2)], schema), ["id"], partition_col="month", ts_col=None)
    assert spark.read.parquet(path).count() == 5


def test_publish_replaces_null_keys(spark, tmp_root):
    path = f"{tmp_root}/t"
    row = spark.createDataFrame([("a", None, 1)], "k string, at string, x long")
    for _ in range(3):
        sink.publish_by_key(spark, path, row, ["k", "at"])
    assert spark.read.parquet(path).count() == 1


def test_tables_at_any_depth_are_found(spark, tmp_root):
    path = f"{tmp_root}/a/b/c/d/e/f"
    sink.append(spark.range(1), path)
    assert [p.split(":")[-1].replace("//", "/") for p in maintenance.find_tables(spark, tmp_root)] == [path]
