"""Physical-plan properties the design relies on."""

import pytest

import __spark_entry__ as E
from tidemark.plans import catalog as C
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_and_columns_reach_the_scan(spark):
    df = C.monthly_summary(spark, SF_SMALL)
    plan = df._jdf.queryExecution().optimizedPlan().toString() + _plan(df)
    assert "GreaterThan(o_totalprice,0.0)" in plan
    assert "ReadSchema: struct<o_totalprice:double,o_orderdate:timestamp_ntz>" in plan \
        or "ReadSchema: struct<o_orderdate:timestamp_ntz,o_totalprice:double>" in plan


@pytest.mark.parametrize("name", sorted(n for n in E.queries() if n != "stream_latest_daily"))
def test_no_python_in_plans(spark, name):
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_global_fill_partitions_rows_by_bucket(spark):
    plan = _plan(C.fill_global(spark, SF_SMALL))
    assert "hashpartitioning(__gb" in plan
    # the only single-partition exchange is the one over the bucket summaries,
    # which sits above their aggregation
    single = plan.split("SinglePartition")
    assert len(single) <= 2


def test_dedup_and_vacuum_pre_aggregate(spark):
    for q in ("dedup_keep_last", "vacuum_changelog", "asof_version", "latest_per_key"):
        assert "partial_max" in _plan(C.QUERIES[q](spark, SF_SMALL)), q


def test_single_values_without_joins(spark):
    for q in ("fx_scalar_enrich", "high_water", "asof_version", "vacuum_changelog"):
        plan = _plan(C.QUERIES[q](spark, SF_SMALL))
        assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan, q
    assert "Subquery" in _plan(C.QUERIES["fx_scalar_enrich"](spark, SF_SMALL))


def test_high_water_and_retention_filters_reach_the_scan(spark):
    # fetched single values become literals, which Parquet can use
    hw = _plan(C.QUERIES["high_water"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts," in hw
    vac = _plan(C.QUERIES["vacuum_changelog"](spark, SF_SMALL))
    assert "GreaterThanOrEqual(o_orderdate," in vac and "LessThan(o_orderdate," in vac


def test_fill_shuffles_rows_once_without_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(C.fill_by_key(spark, SF_SMALL))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the sort-merge join back reuses the window's partitioning on the struct
    # key; a null-safe join on raw columns would re-shuffle the rows
    assert "SortMergeJoin" in plan
    assert "hashpartitioning(coalesce(" not in plan


def test_touched_months_prune_partitions(spark, tmp_root):
    # gold recomputation reads silver joined (semi) with the increment's
    # months: dynamic partition pruning limits the scan to those months
    from pyspark.sql import functions as F
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    o.write.partitionBy("month").parquet(f"{tmp_root}/t")
    s = spark.read.parquet(f"{tmp_root}/t")
    inc = o.filter(F.col("o_orderdate") >= F.lit("2001-06-01").cast("timestamp_ntz"))
    touched = s.join(inc.select("month").distinct(), on="month", how="left_semi")
    assert "dynamicpruningexpression" in _plan(touched.groupBy("month").count())
