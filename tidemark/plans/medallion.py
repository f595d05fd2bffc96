"""The two medallion flows, composed from the operators.

* ``run_strict`` - full rebuild: bronze upsert of the series, bronze quote
  overwrite, strict silver (no nulls, positive close), monthly gold and the
  latest quote, each written with schema merge.
* ``run_incremental`` - bronze ingestion with lineage timestamp, quality
  filter and an enforced ``close > 0`` check; silver from the bronze rows
  ingested since the last run (late dates and corrections included),
  de-duplicated, gap-filled (carrying the previous silver value in), priced
  in the reference currency; gold recomputed for the touched months only.
  Every write is an upsert or replace-by-key, so running the flow twice
  leaves every table as after one run.

Paths are given by a ``Lake`` (root folder); all keys are (symbol, market).
"""

from __future__ import annotations

import datetime as _dt
import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.coerce import coerce_columns, to_double
from tidemark.functions.dates import date_str, month_str
from tidemark.functions.names import (FX_FIELD_WORDS, NUMERIC_FIELD_WORDS, columns_with, drop_repeated_columns,
                                      normalize_columns)
from tidemark.operators import dedup, enrich, fill, incremental, quality, rollup
from tidemark.sinks import tables as sink
from tidemark.sources import payload
from tidemark.sources.tables import read_first, read_table
from tidemark.session import path_exists

KEYS = ["symbol", "market"]
QUOTE_KEYS = ["from_currency_code", "to_currency_code", "last_refreshed"]
#: order of deliveries: time and name of the landed file
DELIVERY = ["_delivered_at", "_delivered_as"]
SERIES_META = {"symbol": "digital_currency_code", "market": "market_code"}

# The price check constraint, and the (tier, table) names of the
# two flows as the pipeline names them. Quarantine and state tables are this
# library's own.
PRICE_RULES = {"positive_close": "close > 0"}
STRICT_TABLES = {
    "bronze_series": ("bronze", "crypto_daily"),
    "bronze_quotes": ("bronze", "exchange_rate"),
    "silver_series": ("silver", "crypto_daily_clean"),
    "silver_quotes": ("silver", "exchange_rate_clean"),
    "gold_monthly": ("gold", "crypto_monthly_summary"),
    "gold_quotes": ("gold", "exchange_rate_latest"),
}
INCREMENTAL_TABLES = {
    "bronze_series": ("bronze", "digital_currency_daily"),
    "bronze_quotes": ("bronze", "currency_exchange_rate"),
    "silver_series": ("silver", "digital_currency_daily"),
    "silver_quotes": ("silver", "currency_exchange_rate"),
    "gold_monthly": ("gold", "crypto_monthly_summary"),
    "gold_quotes": ("gold", "currency_exchange_rate_latest"),
}


@dataclass
class Lake:
    root: str

    def table(self, tier: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{tier}/{name}"


def _series(spark: SparkSession, lake: Lake, landing: str) -> DataFrame:
    """All landed documents of a folder as series rows (full rebuild)."""
    return _series_rows(lake, payload.read_landed(spark, landing))


def _quote_rows(lake: Lake, docs: DataFrame) -> DataFrame:
    """Quotes of landed documents with all their fields; other documents go to the quarantine."""
    sink.append_new(payload.quote_rejects(docs, passthrough=["file"]), lake.table("quarantine", "quote_payloads"))
    return payload.quote_rows(docs, fields="discover")


# ------------------------------------------------------------ variant A
def run_strict(spark: SparkSession, lake: Lake, series_landing: str, quote_landing: str | None = None) -> dict:
    out: dict = {}
    bronze = lake.table(*STRICT_TABLES["bronze_series"])
    rows = _series(spark, lake, series_landing)
    out["bronze"] = sink.upsert_table(spark, bronze, rows, KEYS + ["datetime"], order=DELIVERY, transient=DELIVERY,
                                      rejects_path=lake.table("quarantine", "crypto_daily"),
                                      sort_by=KEYS + ["datetime"], volatile=[])

    if path_exists(spark, bronze):  # nothing but notices so far: no table yet
        silver = lake.table(*STRICT_TABLES["silver_series"])
        b = read_table(spark, bronze)
        clean = quality.keep_positive(quality.drop_any_null(b), "close")
        if not clean.isEmpty():  # a partitioned write of no rows leaves no file to read
            sink.overwrite_merge_schema(clean, silver, ["month"], sort_by=KEYS + ["datetime"])
            gold = lake.table(*STRICT_TABLES["gold_monthly"])
            s = read_table(spark, silver)
            sink.overwrite_merge_schema(rollup.monthly_summary(s, ts="month", keys=KEYS), gold)

    fx_b = lake.table(*STRICT_TABLES["bronze_quotes"])
    if quote_landing:
        fx = _quote_rows(lake, payload.read_landed(spark, quote_landing))
        # a delivery without any quote (a notice) leaves the quotes of the last one
        if not fx.isEmpty():
            sink.overwrite(fx, fx_b)
    if quote_landing and path_exists(spark, fx_b):
        fx_s = lake.table(*STRICT_TABLES["silver_quotes"])
        sink.overwrite_merge_schema(drop_repeated_columns(read_table(spark, fx_b)), fx_s)
        fx_g = lake.table(*STRICT_TABLES["gold_quotes"])
        q = read_table(spark, fx_s).withColumn(
            "__ts", F.try_to_timestamp("last_refreshed", F.lit("yyyy-MM-dd HH:mm:ss")))
        latest = rollup.latest_per_key(q, ["from_currency_code", "to_currency_code"],
                                       ["__ts", "last_refreshed"],
                                       [c for c in q.columns if c not in
                                        ("from_currency_code", "to_currency_code", "__ts")],
                                       order_alias="__ts").drop("__ts")
        sink.overwrite_merge_schema(latest, fx_g)
    return out


# ------------------------------------------------------------ variant B
def _series_rows(lake: Lake, docs: DataFrame) -> DataFrame:
    """Series rows of landed documents (``file``, ``raw``); documents that are
    not series (empty, not JSON, a rate-limit notice) go to the quarantine (S4).
    The rows carry ``DELIVERY``, by which a later delivery of a day wins."""
    sink.append_new(payload.series_rejects(docs, passthrough=["file"]), lake.table("quarantine", "series_payloads"))
    # every field the documents carry becomes a column, as landed; a new field
    # reaches the tables through their schema-merging writes
    docs = docs.withColumnsRenamed({"modified": DELIVERY[0], "file": DELIVERY[1]})
    rows = payload.series_rows(docs, fields="discover", meta=SERIES_META, passthrough=DELIVERY)
    return rows.withColumn("month", month_str("datetime"))


def _fresh_stamp(spark: SparkSession, lake: Lake, bronze: str, run_ts: _dt.datetime) -> _dt.datetime:
    """The stamp of a run, moved past the one of the last run if it is not later, so that the strict ingestion
    watermark of the transformation skips no row. The last stamp is a one-row state table, written before any row
    carries it; bronze is only read where that table does not exist yet."""
    state = lake.table("state", "bronze_stamp")
    last = read_first(spark, [state])
    if last is None and path_exists(spark, bronze):
        last = spark.read.parquet(bronze).select(F.col("ingestion_timestamp").alias("stamp"))
    newest = None if last is None else last.agg(F.max("stamp")).first()[0]
    stamp = run_ts if newest is None or run_ts > newest else newest + _dt.timedelta(microseconds=1)
    sink.overwrite(spark.range(1).select(F.lit(stamp).cast("timestamp_ntz").alias("stamp")), state)
    return stamp


def _each_landed(spark: SparkSession, lake: Lake, landing: str, whole_files: bool, max_files_per_batch: int | None, batch) -> None:
    """Call ``batch`` with the documents (``file``, ``modified``, ``raw``) that landed since the last run, each file once."""
    tag = hashlib.sha1(landing.rstrip("/").encode()).hexdigest()[:16]
    reader = spark.readStream.option("wholetext", "true" if whole_files else "false")
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_batch))
    stream = reader.text(landing).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_modification_time").alias("modified"), F.col("value").alias("raw"))
    q = (stream.writeStream.foreachBatch(lambda docs, epoch_id: batch(docs)).option("checkpointLocation", lake.table("state", f"_ingest-{tag}"))
               .trigger(availableNow=True).start())
    q.awaitTermination()


def ingest(spark: SparkSession, lake: Lake, series_landing: str, quote_landing: str | None,
           run_ts: _dt.datetime, whole_files: bool = True, max_files_per_batch: int | None = None) -> dict:
    """Bronze step of the incremental flow.

    The landing folder is read as a stream with ``availableNow``: every
    landed file is processed once (the file source's checkpoint, one per
    landing folder, lives in the lake's state area), so a run's cost follows
    what landed since the last run, not the folder's history. Each
    micro-batch is parsed, checked and merged into bronze by key;
    ``max_files_per_batch`` bounds a batch when a large backlog has landed
    (``availableNow`` still processes all of it, in several batches).
    """
    bronze = lake.table(*INCREMENTAL_TABLES["bronze_series"])
    totals = {"inserted": 0, "updated": 0, "unchanged": 0, "kept": 0, "rejected": 0, "created": False, "batches": 0}
    stamp = _fresh_stamp(spark, lake, bronze, run_ts)
    # the price rule stays with the table: whoever writes to it is held to it
    for rule, expression in PRICE_RULES.items():
        sink.add_check(spark, bronze, rule, expression)

    def merge_batch(docs: DataFrame) -> None:
        rows = _series_rows(lake, docs).withColumn("ingestion_timestamp", F.lit(stamp).cast("timestamp_ntz"))
        rows = quality.keep_positive(quality.drop_null_subset(rows, ["close"]), "close")
        # rows without a date or series key are quarantined by the upsert
        # and a day delivered again without a change keeps its row and stamp
        m = sink.upsert_table(docs.sparkSession, bronze, rows, KEYS + ["datetime"], order=DELIVERY, transient=DELIVERY,
                              rejects_path=lake.table("quarantine", "digital_currency_daily"),
                              sort_by=KEYS + ["datetime"], volatile=["ingestion_timestamp"])
        for k in ("inserted", "updated", "unchanged", "kept", "rejected"):
            totals[k] += m.get(k, 0)
        totals["created"] = totals["created"] or m.get("created", False)
        totals["batches"] += 1

    def merge_quotes(docs: DataFrame) -> None:
        # a quote replaces the one of its pair and time; a delivery without any (a notice) changes nothing
        fx = _quote_rows(lake, docs.drop("modified")).withColumn("ingestion_timestamp", F.lit(stamp).cast("timestamp_ntz"))
        fx = dedup.keep_last(fx, QUOTE_KEYS, ["exchange_rate", *[c for c in fx.columns if c not in QUOTE_KEYS and c != "exchange_rate"]])
        path = lake.table(*INCREMENTAL_TABLES["bronze_quotes"])
        if not fx.isEmpty():
            sink.publish_by_key(docs.sparkSession, path, fx, QUOTE_KEYS)

    _each_landed(spark, lake, series_landing, whole_files, max_files_per_batch, merge_batch)
    if quote_landing:
        _each_landed(spark, lake, quote_landing, whole_files, max_files_per_batch, merge_quotes)
    return {"bronze": totals}


def _rated_quotes(spark: SparkSession, lake: Lake) -> DataFrame | None:
    """Quotes with ``__rate``, the first rate-like column (P8), and their time ``__ts``; None without any."""
    fx = read_first(spark, [lake.table(*INCREMENTAL_TABLES["bronze_quotes"])])
    if fx is None:
        return None
    fx = normalize_columns(fx)
    cands = columns_with(fx.columns, FX_FIELD_WORDS)
    return fx.withColumn("__rate", to_double(cands[0])).withColumn(
        "__ts", F.try_to_timestamp("last_refreshed", F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")) if cands else None


def _priced(spark: SparkSession, lake: Lake, rows: DataFrame, pricing: str) -> DataFrame:
    """``close_fx`` of every row. ``latest``: the last non-null rate of all quotes (A7) prices every series.
    ``in_force``: a row takes the last rate at or before its time of the pair whose from-currency is its market."""
    if pricing not in ("latest", "in_force"):
        raise ValueError(f"pricing must be 'latest' or 'in_force', not {pricing!r}")
    fx = _rated_quotes(spark, lake)
    if fx is None:
        return rows.withColumn("close_fx", F.lit(None).cast("double"))
    if pricing == "latest":
        return enrich.enrich_scalar(rows, enrich.last_non_null(fx, "__rate", ["__ts", "ingestion_timestamp"], alias="rate"), "rate",
                                    value_col="close", out_col="close_fx")
    rates = fx.select(F.col("from_currency_code").alias("market"), "__ts", "ingestion_timestamp", F.col("__rate").alias("rate"))
    return enrich.enrich_as_of(rows, rates, ["market"], "datetime", "__ts", "rate", order=["ingestion_timestamp"])


def _stage(spark: SparkSession, df: DataFrame, name: str, staged: list[str]) -> DataFrame:
    """Write an intermediate result to the shared folder and read it back:
    later passes read files instead of recomputing the lineage."""
    p = sink.staging_path(spark, name)
    df.write.parquet(p)
    staged.append(p)
    return spark.read.parquet(p)


def _fill_seeds(spark: SparkSession, inc: DataFrame, silver_path: str, last_path: str,
                cols: list[str]) -> DataFrame | None:
    """For each key of the increment, the silver row just before its first
    new date - the value a forward fill carries in.

    In-order keys (the common case) take it from the last-row state table,
    one row per key. Keys that received late rows look back into silver,
    restricted to those keys and to the months up to their first late date.
    """
    last = read_first(spark, [last_path])
    if last is None:
        return None
    first_new = inc.groupBy(*KEYS).agg(F.min("datetime").alias("__from"))
    j = first_new.join(last, on=KEYS, how="inner")
    in_order = j.filter(F.col("datetime") < F.col("__from")).select(*KEYS, "datetime", *cols)
    late = j.filter(F.col("datetime") >= F.col("__from")).select(*KEYS, "__from")
    upto = late.agg(F.max("__from")).first()[0]
    if upto is None:
        return in_order
    silver = read_table(spark, silver_path).filter(F.col("month") <= F.lit(upto.strftime("%Y-%m")))
    back = silver.join(late, on=KEYS, how="inner").filter(F.col("datetime") < F.col("__from"))
    return in_order.unionByName(dedup.keep_last(back, KEYS, ["datetime"], columns=["datetime", *cols]))


def transform(spark: SparkSession, lake: Lake, pricing: str = "latest") -> dict:
    """Silver + gold step of the incremental flow; ``pricing``: see ``_priced``.

    The increment is every bronze row ingested after the last processed run
    (an ingestion watermark in a one-row state table), so late dates and
    corrections reach silver - they are merged by key, not dropped. The fill
    is seeded from a last-row-per-key state table, so a run reads the
    increment and small state, not the whole silver table.
    """
    out: dict = {}
    staged: list[str] = []
    bronze_path = lake.table(*INCREMENTAL_TABLES["bronze_series"])
    if path_exists(spark, bronze_path):
        out.update(_transform_series(spark, lake, read_table(spark, bronze_path), staged, pricing))
    else:  # nothing but notices so far
        out["silver"] = {"inserted": 0, "updated": 0, "unchanged": 0, "kept": 0, "created": False}

    fx_b = read_first(spark, [lake.table(*INCREMENTAL_TABLES["bronze_quotes"])])
    if fx_b is not None:
        fx = normalize_columns(fx_b)
        fx = dedup.keep_last(fx, ["from_currency_code", "to_currency_code", "last_refreshed"],
                             ["ingestion_timestamp"])
        sink.publish_by_key(spark, lake.table(*INCREMENTAL_TABLES["silver_quotes"]), fx,
                            ["from_currency_code", "to_currency_code", "last_refreshed"])
        latest = dedup.keep_last(fx, ["from_currency_code", "to_currency_code"],
                                 ["last_refreshed", "ingestion_timestamp"])
        sink.publish_by_key(spark, lake.table(*INCREMENTAL_TABLES["gold_quotes"]), latest,
                            ["from_currency_code", "to_currency_code"])
    sink.drop_staged(spark, *staged)
    return out


def _transform_series(spark: SparkSession, lake: Lake, bronze: DataFrame, staged: list[str], pricing: str) -> dict:
    """Silver prices and monthly gold of the bronze rows past the watermark."""
    out: dict = {}
    silver_path = lake.table(*INCREMENTAL_TABLES["silver_series"])
    wm_path = lake.table("state", "silver_watermark")
    last_path = lake.table("state", "silver_last_row")

    wm = read_first(spark, [wm_path])
    inc = bronze if wm is None else incremental.after_high_water(
        bronze, wm.select(F.col("ingested_upto").alias("ingestion_timestamp")), "ingestion_timestamp")
    last = read_first(spark, [last_path])
    if last is not None:
        # a key that got rows at or before its last silver date is "late":
        # its bronze rows from the first late date on are processed again,
        # so rows that were filled from older values are filled anew
        first_new = inc.groupBy(*KEYS).agg(F.min("datetime").alias("__from"))
        late = (first_new.join(last.select(*KEYS, F.col("datetime").alias("__last")), on=KEYS, how="inner")
                         .filter(F.col("__from") <= F.col("__last")).select(*KEYS, "__from"))
        earliest = late.agg(F.min("__from")).first()[0]
        if earliest is not None:
            # only bronze months from the earliest late date on are read
            recent = bronze.filter(F.col("month") >= F.lit(earliest.strftime("%Y-%m")))
            suffix = (recent.join(late, on=KEYS, how="inner")
                            .filter(F.col("datetime") >= F.col("__from")).drop("__from"))
            inc = inc.unionByName(suffix)
    inc = normalize_columns(inc)
    nums = [c for c in columns_with(inc.columns, NUMERIC_FIELD_WORDS) if c not in KEYS]
    inc = coerce_columns(inc, numeric=nums, datetime={"datetime": None})
    inc = dedup.keep_last(inc, KEYS + ["datetime"], ["ingestion_timestamp"])
    inc = _stage(spark, quality.drop_null_subset(inc, ["datetime"]), "silver-increment", staged)

    if not inc.isEmpty():
        seeds = _fill_seeds(spark, inc, silver_path, last_path, nums)
        rows = inc.withColumn("__seed", F.lit(False))
        if seeds is not None:
            rows = rows.unionByName(seeds.withColumn("__seed", F.lit(True)), allowMissingColumns=True)
        rows = fill.fill_gaps(rows, nums, order=["datetime", "__seed"], keys=KEYS)
        rows = rows.filter(~F.col("__seed")).drop("__seed")
        rows = quality.keep_positive(rows, "close")
        rows = rows.withColumn("date", date_str("datetime")).withColumn("month", month_str("datetime"))
        rows = _priced(spark, lake, rows, pricing)
        rows = _stage(spark, rows, "silver-rows", staged)
        out["silver"] = sink.upsert_table(spark, silver_path, rows, KEYS + ["datetime"], partition_col="month",
                                          sort_by=KEYS + ["datetime"], volatile=[])

        # state: last silver row per key, then the watermark (written last:
        # a failure before it makes the next run redo this increment, which
        # the key merge makes harmless)
        new_last = rows.select(*KEYS, "datetime", *nums).withColumn("__n", F.lit(1))
        old_last = read_first(spark, [last_path])
        if old_last is not None:
            new_last = old_last.withColumn("__n", F.lit(0)).unionByName(new_last)
        sink.overwrite(dedup.keep_last(new_last, KEYS, ["datetime", "__n"], columns=["datetime", *nums]), last_path)
        upto = inc.agg(F.max("ingestion_timestamp").alias("ingested_upto"))
        if wm is not None:
            upto = upto.unionByName(wm.select("ingested_upto")).agg(F.max("ingested_upto").alias("ingested_upto"))
        sink.overwrite(upto, wm_path)

        # gold: recompute only the months this run touched
        s = read_table(spark, silver_path)
        touched = s.join(rows.select("month").distinct(), on="month", how="left_semi")
        gold = rollup.monthly_summary(touched, ts="month", keys=KEYS)
        out["gold"] = sink.upsert_table(spark, lake.table(*INCREMENTAL_TABLES["gold_monthly"]), gold,
                                        KEYS + ["month"], partition_col="month", volatile=[])
    else:
        out["silver"] = {"inserted": 0, "updated": 0, "unchanged": 0, "kept": 0, "created": False}
    return out


def run_incremental(spark: SparkSession, lake: Lake, series_landing: str,
                    quote_landing: str | None = None, run_ts: _dt.datetime | None = None, pricing: str = "latest") -> dict:
    """Both steps, stamped ``run_ts`` (default the time of the run, UTC)."""
    run_ts = run_ts or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    out = ingest(spark, lake, series_landing, quote_landing, run_ts)
    out.update(transform(spark, lake, pricing))
    return out
