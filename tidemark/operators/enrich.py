"""Reference-rate enrichment.

The rate is one value (or one per currency pair), computed by an aggregate
whose output has a proven bound: exactly one row, or one row per pair. The
one-value case is a scalar subquery (evaluated once, used like a literal;
more than one row is an error, so the bound is enforced); the per-pair case
is a join that AQE broadcasts from the measured size of the small side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.asof import asof_join


def last_non_null(df: DataFrame, value: str, order: list[str],
                  keys: list[str] = (), alias: str | None = None) -> DataFrame:
    """The last non-null ``value`` in ``order`` (per ``keys``); all-null -> null.

    ``max`` of a struct over non-null rows only: partially aggregated, no sort.
    """
    v = F.struct(*[F.col(o).alias(f"__o{i}") for i, o in enumerate(order)], F.col(value).alias("v"))
    picked = F.max(F.when(F.col(value).isNotNull(), v)).getField("v").alias(alias or value)
    return df.groupBy(*keys).agg(picked) if keys else df.agg(picked)


def enrich_scalar(df: DataFrame, rate_row: DataFrame, rate_col: str,
                  value_col: str = "close", out_col: str = "close_fx") -> DataFrame:
    """J2 + P12: ``out_col = value_col * rate`` with a one-row ``rate_row``.

    ``rate_row`` must be a global aggregate (exactly one row); it becomes a
    scalar subquery, so the big side never moves. A null rate gives a null
    ``out_col`` - the column always exists, so the schema does not depend on
    whether a rate was found.
    """
    rate = rate_row.select(F.col(rate_col)).scalar()
    return df.withColumn(out_col, F.col(value_col) * rate)


def enrich_by_key(df: DataFrame, rates: DataFrame, keys: list[str], rate_col: str,
                  value_col: str = "close", out_col: str = "close_fx") -> DataFrame:
    """J2 per currency pair: left join on the pair keys (one rate row per pair)."""
    r = rates.select(*keys, F.col(rate_col).alias("__rate"))
    return (df.join(r, on=list(keys), how="left")
              .withColumn(out_col, F.col(value_col) * F.col("__rate"))
              .drop("__rate"))


def enrich_as_of(df: DataFrame, rates: DataFrame, keys: list[str], time: str, rate_time: str, rate_col: str,
                 order: list[str] = (), value_col: str = "close", out_col: str = "close_fx") -> DataFrame:
    """J2 by the rate in force: each row is priced by the last non-null rate of its ``keys`` at or before its ``time``.

    Rows before the first rate of their pair, and rows without a pair or time, get a null ``out_col``.
    """
    known = rates.where(F.col(rate_col).isNotNull()).select(*keys, rate_time, *order, F.col(rate_col).alias("__rate"))
    priced = asof_join(df, known, keys, time, rate_time, ["__rate"], order)
    return priced.withColumn(out_col, F.col(value_col) * F.col("__rate")).drop("__rate")
