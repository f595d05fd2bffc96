"""Duplicate removal.

Keep-last is an aggregation, not a window: ``max(struct(order..., row...))``
per key is computed partially inside every map task before the shuffle, so a
key that holds a third of all rows is reduced to one row per task before it
moves, instead of being shuffled and sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_last(df: DataFrame, keys: list[str], order: list[str],
              columns: list[str] | None = None) -> DataFrame:
    """One row per ``keys``: the row with the greatest ``order`` tuple.

    ``order`` must make rows unique within a key (add a tiebreak column);
    null order values rank lowest, matching ``ORDER BY ... DESC NULLS LAST``.
    Output columns are ``keys`` + ``columns`` (default: all other columns).
    """
    keys = list(keys)
    order = list(order)
    if columns is None:
        columns = [c for c in df.columns if c not in keys]
    payload = [c for c in columns if c not in keys]
    fields = [F.col(o).alias(f"__o{i}") for i, o in enumerate(order)]
    fields += [F.col(c).alias(f"__p{i}") for i, c in enumerate(payload)]
    agg = df.groupBy(*keys).agg(F.max(F.struct(*fields)).alias("__last"))
    return agg.select(*keys, *[F.col(f"__last.__p{i}").alias(c) for i, c in enumerate(payload)])


def keep_first(df: DataFrame, keys: list[str], order: list[str],
               columns: list[str] | None = None) -> DataFrame:
    """Mirror of ``keep_last``: the row with the smallest ``order`` tuple."""
    keys = list(keys)
    if columns is None:
        columns = [c for c in df.columns if c not in keys]
    payload = [c for c in columns if c not in keys]
    fields = [F.col(o).alias(f"__o{i}") for i, o in enumerate(order)]
    fields += [F.col(c).alias(f"__p{i}") for i, c in enumerate(payload)]
    agg = df.groupBy(*keys).agg(F.min(F.struct(*fields)).alias("__first"))
    return agg.select(*keys, *[F.col(f"__first.__p{i}").alias(c) for i, c in enumerate(payload)])


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole-row distinct (hash aggregate with map-side combine)."""
    return df.distinct()
