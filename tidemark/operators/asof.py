"""As-of join: each row with the last row of another table at or before its time.

Both sides are joined by a union, not by comparing pairs: in the order of time, a row takes the last
value seen. The order is cut into ranges (``operators.ranges``), so neither a key that
holds a third of the rows nor an instant that very many rows share lies in one task. What a range
ends with is carried to the next ones of its key by a window over one row per key and range.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.dedup import keep_last
from tidemark.operators.ranges import with_range


def asof_join(left: DataFrame, right: DataFrame, keys: list[str], left_time: str, right_time: str, values: list[str],
              order: list[str] = ()) -> DataFrame:
    """The rows of ``left`` with ``values`` of the last row of ``right`` of the same ``keys`` at or before their time.

    Of right rows at one time the last by ``order`` (then by value) counts; rows of either side with a
    null key or time match nothing, and a left row without a match keeps null values. Every left
    row is returned once. ``values`` must not be column names of ``left``.
    """
    clash = set(values) & set(left.columns)
    if clash:
        raise ValueError(f"values are columns of the left side: {sorted(clash)}")
    known = [F.col(k).isNotNull() for k in keys]
    kind = left.schema[left_time].dataType
    names = [f"k{i}" for i in range(len(keys))]
    timed = right.where(reduce(and_, known, F.col(right_time).isNotNull()))
    timed = timed.withColumn("__t", F.col(right_time).cast(kind))
    last = keep_last(timed, [*keys, "__t"], [*order, *values], columns=list(values))
    v = F.struct(*values)
    r = last.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], "__t", F.lit(-(1 << 63)).cast("long").alias("__tie"),
                    F.lit(None).cast(left.schema).alias("__l"), v.alias("__v"))
    whole = F.struct(*left.columns)
    joinable = reduce(and_, known, F.col(left_time).isNotNull())
    # rows of one key and instant are told apart by a hash, after the right row of that instant
    tie = F.greatest(F.xxhash64(*left.columns), F.lit(-(1 << 63) + 1))
    lr = left.where(joinable).select(*[F.col(k).cast(last.schema[k].dataType).alias(n) for k, n in zip(keys, names)],
                                     F.col(left_time).alias("__t"), tie.alias("__tie"), whole.alias("__l"),
                                     F.lit(None).cast(last.select(v.alias("v")).schema["v"].dataType).alias("__v"))
    both = with_range(lr.unionByName(r), ["__t", "__tie"], "__b")
    both = both.withColumn("__g", F.struct(F.struct(*names).alias("k"), F.col("__b").alias("b")))
    w = Window.partitionBy("__g").orderBy("__t", "__tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inner = both.withColumn("__f", F.last("__v", True).over(w))
    # the last value of a range is what its last row holds; aggregated where the window left the rows
    ends = inner.groupBy("__g").agg(F.max(F.struct("__t", "__tie", "__f")).getField("__f").alias("end"))
    before = Window.partitionBy(F.col("__g.k")).orderBy(F.col("__g.b")).rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(F.col("__g").alias("__cg"), F.last("end", True).over(before).alias("__c"))
    joined = inner.where("__l IS NOT NULL").join(carried, F.col("__g") == F.col("__cg"), "left")
    got = F.coalesce("__f", "__c")
    out = joined.select("__l.*", *[got.getField(c).alias(c) for c in values])
    rest = left.where(~F.coalesce(joinable, F.lit(False)))
    return out.unionByName(rest, allowMissingColumns=True)
