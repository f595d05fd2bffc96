"""Key merge (J1, K6, K7) and its metrics (A3, A4).

``MERGE INTO`` needs a table format Spark does not ship; on Parquet the merge
is the relational identity

    merged = (target LEFT ANTI JOIN source ON keys) UNION ALL source

which shuffles both sides once on the keys (sort-merge or shuffled-hash
join; AQE broadcasts the source when its measured size is small). At table
level the target is first cut down to the partitions the source touches
(see ``tidemark.sinks.tables.upsert_table``), so cost follows the increment,
not the table.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class DuplicateKeyError(ValueError):
    """A merge source holds the same key more than once."""


def assert_unique_keys(source: DataFrame, keys: list[str]) -> None:
    """Fail if ``source`` repeats a key (one aggregation job, bounded output)."""
    dup = source.groupBy(*keys).count().filter("count > 1").limit(1).collect()
    if dup:
        raise DuplicateKeyError(f"merge source repeats key {dup[0].asDict()}")


def merge(target: DataFrame, source: DataFrame, keys: list[str],
          allow_new_columns: bool = True) -> DataFrame:
    """Update-all on match, insert-all otherwise, keep the rest.

    ``source`` must hold each key at most once. Columns only on one side are
    null-filled on the other (schema merge) when ``allow_new_columns``.
    """
    kept = target.join(source.select(*keys), on=list(keys), how="left_anti")
    return kept.unionByName(source, allowMissingColumns=allow_new_columns)


def replace_by_key(target: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Publish ``new`` over ``target`` without duplicating a key."""
    return merge(target, new, keys)


def flagged_merge(target: DataFrame, source: DataFrame, keys: list[str],
                  compare: list[str] | None = None) -> DataFrame:
    """J1 as one full outer join on ``keys``: merged rows plus ``__kind``
    (``inserted`` | ``updated`` | ``unchanged`` | ``kept``).

    ``unchanged`` is only produced when ``compare`` columns are given: a row
    whose compared values all equal the target's (a column that one side lacks
    is null there). It stays as the target has it.
    """
    keys = list(keys)
    t = target.select(*[F.col(c).alias(f"t__{c}") for c in target.columns]).withColumn("__in_t", F.lit(True))
    s = source.select(*[F.col(c).alias(f"s__{c}") for c in source.columns]).withColumn("__in_s", F.lit(True))
    cond = [F.col(f"t__{k}") == F.col(f"s__{k}") for k in keys]
    j = t.join(s, on=cond, how="full_outer")
    in_t = F.coalesce(F.col("__in_t"), F.lit(False))
    in_s = F.coalesce(F.col("__in_s"), F.lit(False))
    cols = list(dict.fromkeys(list(target.columns) + list(source.columns)))
    sv = {c: F.col(f"s__{c}") if c in source.columns else F.lit(None) for c in cols}
    tv = {c: F.col(f"t__{c}") if c in target.columns else F.lit(None) for c in cols}
    kind = F.when(in_s & ~in_t, F.lit("inserted"))
    take = in_s
    if compare is not None:
        same = reduce(and_, (tv[c].eqNullSafe(sv[c]) for c in compare), in_t & in_s)
        kind = kind.when(same, F.lit("unchanged"))
        take = in_s & ~same
    kind = kind.when(in_s, F.lit("updated")).otherwise(F.lit("kept"))
    out = [F.when(take, sv[c]).otherwise(tv[c]).alias(c) for c in cols]
    return j.select(*out, kind.alias("__kind"))


def kind_counts(compare: bool = False) -> list:
    """Aggregates turning ``__kind`` into the A4 metrics columns."""
    k = F.col("__kind")
    aggs = [F.count_if(k == "inserted").alias("inserted"),
            F.count_if(k.isin("updated", "unchanged")).alias("updated"),
            F.count_if(k == "kept").alias("kept")]
    if compare:
        aggs.append(F.count_if(k == "unchanged").alias("unchanged"))
    return aggs


def merge_with_metrics(target: DataFrame, source: DataFrame, keys: list[str],
                       compare: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """J1 + A4 from one full outer join: (merged rows, one-row metrics).

    Metrics are real counts, not a difference of table sizes: ``inserted``
    (key new to the target), ``updated`` (key in both), ``kept`` (target key
    the source does not touch) and, when ``compare`` columns are given,
    ``unchanged`` (updated rows whose compared values are all equal).
    """
    j = flagged_merge(target, source, keys, compare)
    return j.drop("__kind"), j.agg(*kind_counts(bool(compare)))
