"""One key holding a third of all rows: work is pre-aggregated or split."""

from pyspark.sql import functions as F

from tidemark.operators import dedup, fill
from tests.conftest import SF_MID


def _hot_lineitem(spark):
    li = spark.read.parquet(f"{SF_MID}/lineitem.parquet").repartition(8)
    key = F.when(F.col("l_orderkey") % 3 == 0, F.lit(0)).otherwise(F.col("l_orderkey"))
    return li.withColumn("k", key)


def _shuffle_records(df) -> int:
    """Rows written to shuffle files by the executed plan (after an action)."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    total = 0
    stack = [plan]
    while stack:
        node = stack.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            stack.append(node.executedPlan())
            continue
        if node.nodeName() in ("ShuffleQueryStage",):
            stack.append(node.plan())
            continue
        metrics = node.metrics()
        if node.nodeName() == "Exchange" and metrics.contains("shuffleRecordsWritten"):
            total += metrics.apply("shuffleRecordsWritten").value()
        children = node.children()
        for i in range(children.size()):
            stack.append(children.apply(i))
    return total


def test_keep_last_pre_aggregates_a_hot_key(spark):
    li = _hot_lineitem(spark)
    n = li.count()
    hot = li.filter("k = 0").count()
    assert hot > n / 4
    out = dedup.keep_last(li, ["k"], ["l_linenumber", "l_partkey", "l_suppkey", "l_orderkey"],
                          columns=["l_orderkey"])
    written = _shuffle_records(out)
    # the hot key leaves each map task as one row: far fewer rows move
    # than the input holds, and no task receives the hot key's rows
    assert written < n - hot + 100, (written, n, hot)
    assert out.count() == li.select("k").distinct().count()


def test_fill_spreads_a_hot_key_over_tasks(spark):
    e = spark.read.parquet(f"{SF_MID}/events.parquet")
    hot = e.withColumn("k", F.when(F.col("event_id") % 3 == 0, F.lit("hot")).otherwise(F.col("event_type"))) \
           .withColumn("v", F.when(F.col("event_id") % 7 == 0, F.lit(None)).otherwise(F.col("value")))
    # coalescing would fold this tiny test shuffle into one partition
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = fill.fill_gaps(hot, ["v"], ["ts", "event_id"], keys=["k"], bucket="day")
        per_task = out.filter("k = 'hot'").rdd.mapPartitionsWithIndex(
            lambda i, rows: [(i, sum(1 for _ in rows))]).collect()
        parts = sum(1 for _, n in per_task if n)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    # the hot key's buckets land in several tasks instead of one
    assert parts > 1
    assert out.filter(F.col("v").isNull()).count() == 0


def test_fill_ranges_follow_the_shuffle_partitions(spark):
    # all rows lie in one day and a third of them in one key: calendar buckets would make few tasks
    df = spark.range(20_000).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('k', id % 5) END AS k",
        "timestamp_micros(1704067200000000 + id * 1000) AS ts", "CASE WHEN id % 7 > 0 THEN double(id) END AS v")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    used, most = {}, {}
    try:
        for n in (4, 16):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            filled = fill.fill_gaps(df, ["v"], ["ts", "id"])
            sizes = [r["n"] for r in filled.groupBy(F.spark_partition_id()).agg(F.count("v").alias("n")).collect()]
            used[n], most[n] = len(sizes), max(sizes)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert used[4] == 4 and used[16] > 12
    assert most[16] < most[4] < 20_000
