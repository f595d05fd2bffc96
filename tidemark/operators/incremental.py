"""High-water incremental selection.

The high-water mark is ``max(ts)`` of what is already loaded - a global (or
per-key) aggregate with a bounded output (one value, or one row per key). The
global value is fetched first and compared as a literal, so the filter is
pushed into the source scan and older row groups are skipped - no join. The
per-key case is a left join that AQE broadcasts from the measured size.

Rows at or below the mark are *not* selected: late rows and corrections need
``tidemark.sinks.tables.upsert_table`` on touched partitions instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import literal_of


def high_water(target: DataFrame, ts: str, keys: list[str] = ()) -> DataFrame:
    """A2: ``max(ts)`` of the target, globally or per key."""
    m = F.max(ts).alias("__hw")
    return target.groupBy(*keys).agg(m) if keys else target.agg(m)


def after_high_water(source: DataFrame, target: DataFrame, ts: str,
                     keys: list[str] = ()) -> DataFrame:
    """Source rows newer than the target's high-water mark.

    An empty target (or a key missing from it) selects everything - unlike a
    plain comparison with a null maximum, which would select nothing.
    """
    if not keys:
        hw = literal_of(high_water(target, ts))
        return source if hw is None else source.filter(F.col(ts) > hw)
    j = source.join(high_water(target, ts, keys), on=list(keys), how="left")
    return j.filter(F.col("__hw").isNull() | (F.col(ts) > F.col("__hw"))).drop("__hw")
