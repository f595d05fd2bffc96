"""Incremental bronze -> silver loads with Structured Streaming.

The file source remembers which input files were processed (checkpoint in
the shared folder), ``trigger(availableNow=True)`` processes what has landed
and stops, and ``foreachBatch`` merges each micro-batch by key. A batch that
is replayed after a failure merges the same rows again, which changes
nothing - so the job is safe to re-run and to lose executors mid-batch.
"""

from __future__ import annotations

import time
from functools import reduce
from operator import and_

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import path_exists, remove_path, scratch_path
from tidemark.sinks.tables import upsert_table
from tidemark.sources.payload import series_rows


def landed_series_stream(spark: SparkSession, landing_dir: str, meta: dict | None = None,
                         max_files_per_trigger: int | None = None) -> DataFrame:
    """S1 over a stream of landed documents (one file = one document)."""
    r = spark.readStream.option("wholetext", "true")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    raw = r.text(landing_dir).select(F.col("value").alias("raw"))
    return series_rows(raw, meta=meta)


def dedup_within_watermark(df: DataFrame, keys: list[str], ts: str, delay: str = "1 day") -> DataFrame:
    """T2 for exact repeats in a stream: the first copy inside the watermark
    delay wins (state is dropped once the watermark passes). The watermark
    needs a zoned TIMESTAMP column, so a timestamp_ntz column is cast."""
    wm = f"__wm_{ts}"
    return (df.withColumn(wm, F.col(ts).cast("timestamp"))
              .withWatermark(wm, delay)
              .dropDuplicatesWithinWatermark([*keys])
              .drop(wm))


def first_or_late(batch: DataFrame, held: DataFrame, keys: list[str], ts: str, mark: int, now: int, delay: str = "1 day",
                  hold: str = "1 hour", order: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """T2 across micro-batches: (late rows of ``batch``, the keys held after it).

    ``held`` has a row per key: ``__newest`` (its newest time, ms), ``__check`` (when to look whether it expired, ms of
    processing time) and ``__first`` (the key's first row if this batch brought it, else null). A key is held
    from its first row until the watermark ``mark`` is ``delay`` past its newest one; a row of a held key is a copy,
    however late. A row of a key that is not held and whose time is null or before the watermark is late; all of those
    are returned. Of the rows that a key's first batch brings, the smallest by (ts, order) is its first, nulls last.
    A key without new rows is looked at every ``hold`` of processing time. Null keys are a key.

    Joins and aggregations by key alone: a hot key is reduced in each task before it moves, and none is held in memory whole.
    """
    delay_ms, hold_ms = _ms(delay), _ms(hold)
    fields = batch.columns
    at = F.unix_millis(F.col(ts).cast("timestamp"))
    in_time = F.coalesce(at >= F.lit(mark), F.lit(False))
    by = [at.alias("at"), F.col(ts).alias("ts")]
    for i, c in enumerate(order or []):
        by += [F.col(c).isNull().alias(f"n{i}"), F.col(c).alias(f"o{i}")]
    seen = batch.groupBy(*keys).agg(F.max(F.when(in_time, at)).alias("__at"),
                                    F.min_by(F.struct(*fields), F.when(in_time, F.struct(*by))).alias("__row"))

    def same_key(a: str, b: str) -> Column:
        return reduce(and_, [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys])
    late = batch.where(~in_time).alias("b").join(held.alias("h"), same_key("b", "h"), "left_anti")
    old, new = F.col("h.__newest").isNotNull(), F.col("s.__in").isNotNull()
    due = F.col("h.__check") < F.lit(now)
    expired = ~new & due & (F.col("h.__newest") + F.lit(delay_ms) < F.lit(mark))
    both = held.alias("h").join(seen.withColumn("__in", F.lit(True)).alias("s"), same_key("h", "s"), "full_outer")
    after = both.where((old | F.col("s.__at").isNotNull()) & ~F.coalesce(expired, F.lit(False))).select(
        *[F.when(old, F.col(f"h.{k}")).otherwise(F.col(f"s.{k}")).alias(k) for k in keys],
        F.greatest("h.__newest", "s.__at").alias("__newest"),
        F.when(new | due, F.lit(now + hold_ms)).otherwise(F.col("h.__check")).alias("__check"),
        F.when(~old, F.col("s.__row")).alias("__first"))
    return late, after


def _ms(span: str) -> int:
    return int(pd.Timedelta(span).total_seconds() * 1000)


def dedup_into(spark: SparkSession, stream: DataFrame, path: str, keys: list[str], ts: str, delay: str = "1 day",
               hold: str = "1 hour", order: list[str] | None = None, checkpoint: str | None = None) -> list[dict]:
    """Write each key's first row and the late rows (:func:`first_or_late`) of what has landed to ``path``, partitioned by
    ``_outcome`` ('kept', 'late') and ``_batch``; the counts of both for each batch.

    The keys held after a batch are a table in the checkpoint's folder ``held``, one folder a batch; the watermark of the
    next batch is the newest time there less ``delay`` (a key with the newest time never expires). The last two are
    there, so a replayed batch starts from the keys before it and overwrites its own folder and partitions.
    """
    counts: list[dict] = []
    ckpt = checkpoint or scratch_path(spark, "dedup-ckpt")
    fields = stream.schema
    state = T.StructType([*[fields[k] for k in keys], T.StructField("__newest", T.LongType()),
                          T.StructField("__check", T.LongType()), T.StructField("__first", fields)])

    def write(batch: DataFrame, epoch: int) -> None:
        s = batch.sparkSession
        # a stream's session has it off; what follows are plain batch jobs
        s.conf.set("spark.sql.adaptive.enabled", "true")
        at = f"{ckpt}/held/{epoch}"
        if epoch and not path_exists(s, f"{ckpt}/held/{epoch - 1}"):
            raise RuntimeError(f"{ckpt} does not hold the keys of batch {epoch - 1}; start with a new checkpoint")
        held = s.read.schema(state).parquet(f"{ckpt}/held/{epoch - 1}") if epoch else s.createDataFrame([], state)
        held = held.drop("__first")
        newest = held.agg(F.max("__newest")).first()[0]
        mark = max(0, newest - _ms(delay)) if newest is not None else 0
        late, after = first_or_late(batch, held, keys, ts, mark, int(time.time() * 1000), delay, hold, order)
        after.write.mode("overwrite").parquet(at)
        kept = s.read.schema(state).parquet(at).where("__first IS NOT NULL").select("__first.*")
        out = kept.withColumn("_outcome", F.lit("kept")).unionByName(late.withColumn("_outcome", F.lit("late")))
        seen = Observation()
        kinds = [F.count_if(F.col("_outcome") == k).alias(k) for k in ("kept", "late")]
        (out.observe(seen, *kinds).withColumn("_batch", F.lit(epoch)).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy("_outcome", "_batch").parquet(path))
        remove_path(s, f"{ckpt}/held/{epoch - 2}")
        counts.append({"batch": epoch, **seen.get})

    q = stream.writeStream.foreachBatch(write).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    q.awaitTermination()
    return counts


def incremental_upsert(spark: SparkSession, stream: DataFrame, target_path: str, keys: list[str],
                       order: list[str] | None = None, ts_col: str = "datetime",
                       partition_col: str = "month", checkpoint: str | None = None,
                       available_now: bool = True) -> list[dict]:
    """T1 + T2: merge every micro-batch into ``target_path`` by ``keys``.

    Inside a batch the last row per key by ``order`` wins (keep-last, as a
    partially aggregated max - T2); rows that arrive late or correct earlier
    ones are merged into their partition rather than dropped. Returns the
    per-batch merge metrics.
    """
    ckpt = checkpoint or scratch_path(spark, "stream-ckpt")
    metrics: list[dict] = []

    def merge_batch(batch: DataFrame, epoch_id: int) -> None:
        # keep-last inside the batch happens in the upsert
        m = upsert_table(batch.sparkSession, target_path, batch, keys, partition_col=partition_col,
                         order=order, ts_col=ts_col)
        m["batch"] = epoch_id
        metrics.append(m)

    w = stream.writeStream.foreachBatch(merge_batch).option("checkpointLocation", ckpt)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    q = w.start()
    q.awaitTermination()
    return metrics


def parquet_stream(spark: SparkSession, path: str, schema: T.StructType,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """A Parquet landing folder as a stream (schema must be declared)."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.parquet(path)
