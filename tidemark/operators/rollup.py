"""Gold-layer rollups and snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import month_str


def monthly_summary(df: DataFrame, ts: str = "datetime", value: str = "close",
                    keys: list[str] = ()) -> DataFrame:
    """A1: ``avg``, ``max``, ``min`` of ``value`` per (keys, month).

    Rows without a month are dropped (a null group is not a month).
    """
    base = df if ts == "month" else df.withColumn("month", month_str(ts))
    v = F.col(value)
    return (base.filter(F.col("month").isNotNull())
                .groupBy(*keys, "month")
                .agg(F.avg(v).alias("avg_close"), F.max(v).alias("max_close"), F.min(v).alias("min_close")))


def latest_row(df: DataFrame, order: list[str], n: int = 1) -> DataFrame:
    """O2 / O3: the ``n`` newest rows by ``order`` (nulls last) - a top-k
    (per-task top-n, then one merge of n rows per task)."""
    return df.orderBy(*[F.col(c).desc_nulls_last() for c in order]).limit(n)


def latest_per_key(df: DataFrame, keys: list[str], order: list[str],
                   values: list[str], order_alias: str | None = None) -> DataFrame:
    """O2 per key: newest ``order`` and the ``values`` of that row."""
    s = F.max(F.struct(*[F.col(o).alias(f"__o{i}") for i, o in enumerate(order)],
                       *[F.col(v).alias(f"__v{i}") for i, v in enumerate(values)])).alias("__m")
    cols = [F.col("__m.__o0").alias(order_alias or order[0])]
    cols += [F.col(f"__m.__v{i}").alias(v) for i, v in enumerate(values)]
    return df.groupBy(*keys).agg(s).select(*keys, *cols)


def preview(df: DataFrame, n: int = 5, order: list[str] | None = None) -> DataFrame:
    """The first ``n`` rows, as a DataFrame (the limit is the feature).

    With ``order`` the rows are the first in that order (a top-k: each task
    keeps its first ``n``, one merge), so the preview is reproducible.
    """
    if order:
        return df.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(n)
    return df.limit(n)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """A3: one row per named frame with its row count (one aggregation job
    per frame, each partially counted per task)."""
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table"), "n")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
