"""Gap filling: forward fill then backward fill of leading nulls.

The one-window form (``last(ignorenulls)`` over an unbounded frame per key)
puts a whole key - or, with no key, the whole table - into one task. The form
used here is two-phase and keeps every task bounded by a range of the order:

0. the order is cut at its quantiles into a few ranges per shuffle partition, so
   a range holds its share of all rows whatever their dates are and however many
   of them one key has; a date that very many rows share is cut by the order
   columns after it (a calendar unit can be asked for instead);
1. inside each (keys, bucket) a running window (growing frame, linear
   time) carries the last non-null value forward;
2. a per-bucket summary (last and first non-null value, aggregated on the
   window's own partitioning - no second exchange of the rows) is carried
   across buckets by a window over the summaries, which have one row per
   (keys, bucket) - not per input row;
   leading nulls of a key take the key's first non-null value;
3. the carried values are joined back on (keys, bucket); AQE broadcasts the
   summary side when its measured size is small, else it is a sort-merge join
   on the partitioning the window already produced.

The result is identical to the one-window form for any bucket width.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ranges import with_range

_UNITS = ("year", "month", "week", "day", "hour", "minute")


def _bucketed(df: DataFrame, order: list[str], bucket, out: str) -> DataFrame:
    if isinstance(bucket, Column):
        return df.withColumn(out, bucket)
    if bucket == "range":
        return with_range(df, order, out)
    if bucket in _UNITS:
        return df.withColumn(out, F.date_trunc(bucket, F.col(order[0])))
    raise ValueError(f"bucket must be 'range', a Column or one of {_UNITS}")


def fill_single_window(df: DataFrame, cols: list[str], order: list[str],
                       keys: list[str]) -> DataFrame:
    """W1 + W2 with one window per key (fine when no key is large)."""
    o = [F.col(c).asc_nulls_last() for c in order]
    w = Window.partitionBy(*keys).orderBy(*o)
    pre = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    out = df
    for c in cols:
        # after the forward fill only leading nulls remain; their next
        # non-null value is the first non-null of the key (whole frame,
        # computed once per key - no per-row "following" frame)
        out = out.withColumn(c, F.coalesce(F.last(c, True).over(pre), F.first(c, True).over(whole)))
    return out


def fill_gaps(df: DataFrame, cols: list[str], order: list[str],
              keys: list[str] = (), bucket="range") -> DataFrame:
    """W1 + W2 (+ W4): fill nulls of ``cols`` from the previous non-null value
    in ``order`` within ``keys``; leading nulls take the next non-null value.

    ``order`` must be unique within a key and non-null, and ``order[0]`` must be
    the time or number that ``bucket`` is derived from: "range" (quantile ranges,
    sized by the data), a calendar unit, or a Column monotone in the order.
    """
    keys = list(keys)
    cols = list(cols)
    if bucket is None:
        if not keys:
            raise ValueError("a global fill needs a bucket")
        return fill_single_window(df, cols, order, keys)

    # One struct column (keys, bucket) is the partition key of the row window,
    # the grouping key of the summaries and the join key back: struct
    # equality treats null fields as equal, so null keys form their own
    # series, and the join is a plain equi-join that reuses the window's hash
    # partitioning instead of shuffling the rows a second time.
    gb = "__gb"
    key_struct = F.struct(*[F.col(k).alias(f"k{j}") for j, k in enumerate(keys)]) if keys else F.lit(0)
    src = _bucketed(df, order, bucket, "__b").withColumn(gb, F.struct(key_struct.alias("g"), F.col("__b").alias("b"))).drop("__b")
    o = [F.col(c).asc_nulls_last() for c in order]

    # Phase 1: forward fill inside each bucket (growing frame: O(rows)).
    w = Window.partitionBy(gb).orderBy(*o)
    pre = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inner = src
    for i, c in enumerate(cols):
        inner = inner.withColumn(f"__ff{i}", F.last(c, True).over(pre))

    # Phase 2: per-bucket last / first non-null value, aggregated from the
    # window's output: the rows are already hash-partitioned by the bucket
    # key there, so this aggregate needs no exchange and the input (and
    # whatever lineage produced it) is not evaluated a second time.
    # The bucket's last non-null value is the forward fill of its last row
    # (``__ff``); using it keeps the aggregate on top of the window, which
    # Catalyst would otherwise prune away and re-read the input instead.
    ostruct = [F.col(c).alias(f"__o{j}") for j, c in enumerate(order)]
    aggs = []
    for i, c in enumerate(cols):
        last = F.struct(*ostruct, F.col(f"__ff{i}").alias("v"))
        first = F.struct(*ostruct, F.col(c).alias("v"))
        aggs.append(F.max(last).getField("v").alias(f"__last{i}"))
        aggs.append(F.min(F.when(F.col(c).isNotNull(), first)).getField("v").alias(f"__first{i}"))
    summary = inner.groupBy(gb).agg(*aggs)

    # Carry across buckets: one row per (keys, bucket), so this window is
    # small. ``__cf`` is the last value of earlier buckets; ``__hd`` the
    # first non-null value of the whole key - after the forward fill only
    # leading nulls are left, and that is their backward-fill value.
    wb = (Window.partitionBy(F.col(gb).getField("g")) if keys else Window).orderBy(F.col(gb).getField("b"))
    before = wb.rowsBetween(Window.unboundedPreceding, -1)
    whole = wb.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carry = summary.select(
        F.col(gb).alias("__kgb"),
        *[F.last(f"__last{i}", True).over(before).alias(f"__cf{i}") for i in range(len(cols))],
        *[F.first(f"__first{i}", True).over(whole).alias(f"__hd{i}") for i in range(len(cols))])

    joined = inner.join(carry, on=F.col(gb) == F.col("__kgb"), how="left")
    out_cols = []
    for c in df.columns:
        if c in cols:
            i = cols.index(c)
            out_cols.append(F.coalesce(F.col(f"__ff{i}"), F.col(f"__cf{i}"), F.col(f"__hd{i}")).alias(c))
        else:
            out_cols.append(F.col(c))
    return joined.select(*out_cols)
