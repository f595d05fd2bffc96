"""Table versions on plain Parquet: an append-only changelog (V1-V3, M3 rule).

A changelog row is a data row plus ``_version`` (long, one per write),
``_ts`` (commit time, non-decreasing in ``_version``) and ``_op``
(``upsert`` | ``overwrite`` | ``delete``). A vacuum is a version of its own: one
row of ``_op`` ``vacuum`` without data, whose ``_floor`` is the oldest version that as-of
reads can still reproduce. Every read is an aggregation:

* current / as-of: keep the last row per key over ``_version`` (a partially
  aggregated ``max(struct)``, safe for hot keys), after dropping versions
  older than the newest ``overwrite`` at or below the requested version;
* history: group by version;
* vacuum: rows superseded before the retention limit go away.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import literal_of
from tidemark.operators.dedup import keep_last

META = ("_version", "_ts", "_op", "_floor")
VACUUM = "vacuum"

# The default retention and the floor below which vacuum
# refuses to run unless forced (hours).
DEFAULT_RETENTION_HOURS = 168


class RetentionError(ValueError):
    """Vacuum asked to keep less history than the enforced floor."""


def with_version(df: DataFrame, version: int, ts, op: str = "upsert") -> DataFrame:
    """Tag a batch as one changelog version."""
    return (df.withColumn("_version", F.lit(int(version)).cast("long"))
              .withColumn("_ts", F.lit(ts).cast("timestamp_ntz"))
              .withColumn("_op", F.lit(op)))


def current_version(changelog: DataFrame) -> DataFrame:
    """V1: the newest version number (one row)."""
    return changelog.agg(F.max("_version").alias("version"))


def data_rows(changelog: DataFrame) -> DataFrame:
    """The rows that are data: all but those that record a vacuum."""
    return changelog.filter(~F.col("_op").eqNullSafe(VACUUM)) if "_op" in changelog.columns else changelog


def oldest_readable(changelog: DataFrame) -> int | None:
    """V3: the oldest version an as-of read can still reproduce exactly (None: all), from the rows that record a vacuum."""
    if "_floor" not in changelog.columns:
        return None
    v = changelog.filter(F.col("_op") == VACUUM).agg(F.max("_floor")).first()[0]
    return None if v is None else int(v)


def history(changelog: DataFrame, n: int | None = None) -> DataFrame:
    """One row per version - operation, time, rows written - newest
    first, optionally only the last ``n`` versions (a top-k)."""
    h = (changelog.groupBy("_version", "_op")
                  .agg(F.max("_ts").alias("_ts"), F.count(F.lit(1)).alias("rows"))
                  .orderBy(F.col("_version").desc()))
    return h.limit(n) if n else h


def as_of(changelog: DataFrame, keys: list[str], version: int | None = None,
          tiebreak: list[str] = (), columns: list[str] | None = None) -> DataFrame:
    """V3: table content as of ``version`` (default: newest).

    Rows of versions older than the newest ``overwrite`` at or below
    ``version`` are dead; of the rest the last row per key wins; a winning
    ``delete`` removes the key.
    """
    log = data_rows(changelog)
    log = log if version is None else log.filter(F.col("_version") <= F.lit(version))
    # one value, fetched first: as a literal the filter reaches the scan
    barrier = literal_of(log.filter(F.col("_op") == "overwrite").agg(F.max("_version")))
    live = log if barrier is None else log.filter(F.col("_version") >= barrier)
    data_cols = columns or [c for c in changelog.columns if c not in keys and c not in META]
    last = keep_last(live, keys, ["_version", *tiebreak], columns=[*data_cols, "_op"])
    return last.filter(F.col("_op") != "delete").drop("_op")


def version_changes(changelog: DataFrame, keys: list[str], tiebreak: list[str] = ()) -> DataFrame:
    """V2: what each version changed against the one before: ``_version``, ``_op``, ``inserted``, ``updated``, ``deleted``,
    ``unchanged`` (keys written again with equal values).

    Rows are compared by a hash of their data. Keys are followed through their own writes, in one shuffle of hashes for
    all versions; a key holds one row a version at most. An ``overwrite`` deletes the keys it does not hold: a key's write
    is ended by the next one of that key or by the first overwrite after it, whichever comes first (the overwrites are
    a column of one array, as many as the log has of them).
    """
    data = [c for c in changelog.columns if c not in keys and c not in META]
    log = data_rows(changelog)
    row = F.sha2(F.to_json(F.struct(*data)), 256) if data else F.lit("")
    log = log.select(F.struct(*keys).alias("k"), "_version", "_op", *tiebreak, row.alias("row"))
    writes = keep_last(log, ["k", "_version"], [*tiebreak, "row"], columns=["_op", "row"])
    ops = log.groupBy("_version").agg(F.max("_op").alias("_op"))
    over = sorted(r[0] for r in ops.filter(F.col("_op") == "overwrite").collect())
    w = Window.partitionBy("k").orderBy("_version")
    live = F.col("_op") != "delete"
    writes = writes.withColumns({"was": F.lag(F.when(live, F.col("row"))).over(w), "at": F.lag("_version").over(w),
                                 "to": F.lead("_version").over(w)})
    # an overwrite between two writes of a key ended the first; one at the second write itself replaces it there
    overs = F.array(*map(F.lit, over)).cast("array<bigint>")
    ended = F.array_min(F.filter(overs, lambda v: (v > F.col("_version")) & (F.col("to").isNull() | (v < F.col("to")))))
    cut = F.exists(overs, lambda v: (v > F.col("at")) & (v < F.col("_version")))
    before = F.when(~F.coalesce(cut, F.lit(False)), F.col("was"))
    kind = (F.when(live & before.isNull(), "inserted").when(live & (before == F.col("row")), "unchanged").when(live, "updated")
            .when(before.isNotNull(), "deleted"))
    changes = writes.select("_version", kind.alias("kind")).unionAll(
        writes.filter(live).select(ended.alias("_version"), F.lit("deleted").alias("kind")).filter("_version IS NOT NULL"))
    kinds = ("inserted", "updated", "deleted", "unchanged")
    counts = changes.groupBy("_version").agg(*[F.count_if(F.col("kind") == n).alias(n) for n in kinds])
    return ops.join(counts, "_version").select("_version", "_op", *kinds)


def vacuum_rows(changelog: DataFrame, keys: list[str], now, retention_hours: float,
                order: list[str] = ("_version",), ts: str = "_ts",
                enforce: bool = True) -> DataFrame:
    """M3 rule: drop a row only when the row that superseded it is older than
    ``now - retention``; as-of reads inside the retention window stay exact.

    Because ``ts`` grows with ``order`` inside a key, the rows older than the
    limit form a prefix of each key's history; every row of that prefix but
    its last is superseded by a row that is also older than the limit. So the
    result is "rows at or after the limit" plus "last row per key before it":
    a filter and a partially aggregated keep-last - no window over a key. Old rows
    of versions before an old overwrite go, and so do old tombstones.
    """
    if enforce and retention_hours < DEFAULT_RETENTION_HOURS:
        raise RetentionError(
            f"retention {retention_hours} h is below the {DEFAULT_RETENTION_HOURS} h floor")
    if isinstance(now, DataFrame):
        # a data-derived "now" (a one-row aggregate), fetched as a literal so
        # the retention filters are pushed into the scans
        now = literal_of(now.select(F.col(now.columns[0])))
        if now is None:
            return changelog
    elif not hasattr(now, "_jc"):
        now = F.lit(now).cast("timestamp_ntz")
    limit = now - F.expr(f"make_dt_interval(0, 0, 0, {float(retention_hours) * 3600.0})")
    cols = list(changelog.columns)
    log = data_rows(changelog)
    recent = log.filter(F.col(ts) >= limit)
    old = log.filter(F.col(ts) < limit)
    if "_op" in cols:
        # an overwrite older than the limit has superseded all versions before it
        barrier = literal_of(old.filter(F.col("_op") == "overwrite").agg(F.max("_version")))
        if barrier is not None:
            old = old.filter(F.col("_version") >= barrier)
    last_old = keep_last(old, keys, list(order), columns=[c for c in cols if c not in keys])
    if "_op" in cols:
        # nothing is left for an old tombstone to remove
        last_old = last_old.filter(~F.col("_op").eqNullSafe("delete"))
    return recent.unionByName(last_old.select(*cols))
