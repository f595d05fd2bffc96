"""Queries that write: sinks, merges, maintenance and the incremental flow.

Each builds a table of the whole test table in the shared scratch folder, runs the job
on it, and returns what a reader of the table sees. The scratch tables go when the
driver ends.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.coerce import to_datetime_strict
from tidemark.functions.dates import date_str
from tidemark.functions.names import FX_FIELD_WORDS, NUMERIC_FIELD_WORDS, columns_with, rename_duplicates
from tidemark.operators import enrich, versions
from tidemark.operators.quality import CheckViolation
from tidemark.plans import maintenance
from tidemark.plans.medallion import INCREMENTAL_TABLES, Lake, ingest, transform
from tidemark.session import scratch_table
from tidemark.sinks import tables as sink
from tidemark.sources import payload
from tidemark.sources.tables import read_first, read_table


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return read_table(spark, f"{d}/{name}.parquet")


def _orders(spark, d) -> DataFrame:
    return _t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_totalprice",
                                         F.date_format("o_orderdate", "yyyy").alias("year"))


def _before_2000(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz"))


def _corrected_from_1999(orders: DataFrame) -> DataFrame:
    """Overlaps ``_before_2000`` in 1999; prices of orders that are not final are corrected."""
    late = orders.filter(F.col("o_orderdate") >= F.lit("1999-01-01").cast("timestamp_ntz"))
    return late.withColumn("o_totalprice", F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))
                           .otherwise(F.col("o_totalprice") + 1))


def _upsert(spark, path: str, rows: DataFrame) -> dict:
    return sink.upsert_table(spark, path, rows, ["o_orderkey"], partition_col="year", ts_col=None, volatile=[])


def _prices(spark, path: str) -> DataFrame:
    return read_table(spark, path).select("o_orderkey", "o_totalprice", "year")


# ------------------------------------------------------------------- sinks
def table_upsert(spark, d):
    """K5, K6: a table made by one batch, then merged with one that overlaps it, twice."""
    path, o = scratch_table(spark, "table-upsert"), _orders(spark, d)
    for batch in (_before_2000(o), _corrected_from_1999(o), _corrected_from_1999(o)):
        _upsert(spark, path, batch)
    return _prices(spark, path)


def schema_merge(spark, d):
    """A second batch with a further column is appended to a table."""
    path, c = scratch_table(spark, "schema-merge"), _t(spark, d, "customer")
    early = F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING")
    sink.append(c.filter(early).select("c_custkey", "c_name"), path)
    sink.append(c.filter(~early).select("c_custkey", "c_name", F.col("c_acctbal").alias("extra")), path)
    return read_table(spark, path).select("c_custkey", "c_name", "extra")


def overwrite_schema_merge(spark, d):
    """K1, K4: an overwrite keeps the columns that only the replaced table had."""
    path, c = scratch_table(spark, "overwrite-merge"), _t(spark, d, "customer")
    sink.overwrite(c.select("c_custkey", "c_name", "c_acctbal"), path)
    sink.overwrite_merge_schema(c.select("c_custkey", "c_name", F.upper("c_mktsegment").alias("segment")), path)
    return read_table(spark, path).select("c_custkey", "c_name", "c_acctbal", "segment")


def sorted_partitions(spark, d):
    """K3, O1: an overwrite by partitions, rows in order within their files."""
    path = scratch_table(spark, "sorted")
    sink.overwrite(_orders(spark, d), path, ["year"], sort_by=["o_custkey", "o_orderkey"])
    return _prices(spark, path)


def publish_prices(spark, d):
    """K7: open orders are published over all orders, twice; a key stays one row."""
    path, o = scratch_table(spark, "publish"), _orders(spark, d).select("o_orderkey", "o_totalprice", "o_orderstatus")
    fresh = o.filter("o_orderstatus = 'O'").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    for rows in (o, fresh, fresh):
        sink.publish_by_key(spark, path, rows, ["o_orderkey"])
    return read_table(spark, path).select("o_orderkey", "o_totalprice")


def fallback_scan(spark, d):
    """The second location is read where the first does not exist."""
    nations = read_first(spark, [f"{d}/missing.parquet", f"{d}/nation.parquet"])
    return nations.select("n_nationkey", "n_name", "n_regionkey")


# ----------------------------------------------------------- names and dates
def picked_columns(spark, d):
    """Repeated names made unique, then price and rate columns picked by name."""
    e = rename_duplicates(_t(spark, d, "events").select(
        "event_id", F.col("value").alias("close"), F.col("value").alias("close"), F.col("user_id").alias("other"),
        (F.col("value") * 2).alias("exchange_rate")))
    return e.select("event_id", *columns_with(e.columns, NUMERIC_FIELD_WORDS), *columns_with(e.columns, FX_FIELD_WORDS))


def strict_dates(spark, d):
    """Q9: dates that must parse."""
    o = _t(spark, d, "orders").select("o_orderkey", date_str("o_orderdate").alias("txt"))
    return o.select("o_orderkey", to_datetime_strict("txt").alias("day"))


# -------------------------------------------------------------- maintenance
def compacted_table(spark, d):
    """M1: a table appended in pieces, compacted."""
    path, o = scratch_table(spark, "compact"), _orders(spark, d)
    for status in ("F", "O", "P"):
        sink.append(o.filter(F.col("o_orderstatus") == status), path, ["year"])
    maintenance.compact(spark, path)
    return _prices(spark, path)


def zorder_then_upsert(spark, d):
    """M2, K6: a partitioned table clustered on a number, a time and a text, then merged with a batch."""
    path, o = scratch_table(spark, "zorder"), _orders(spark, d)
    _upsert(spark, path, _before_2000(o))
    maintenance.zorder(spark, path, ["o_custkey", "o_orderdate", "o_orderstatus"])
    _upsert(spark, path, _corrected_from_1999(o))
    return _prices(spark, path)


def _changelog(spark, d) -> str:
    """Orders: all upserted, those not open written over them, final urgent ones deleted, pending ones upserted."""
    path, o = scratch_table(spark, "changelog"), _t(spark, d, "orders")

    def priced(rows: DataFrame, add: int) -> DataFrame:
        return rows.select("o_orderkey", (F.col("o_totalprice") + add).alias("o_totalprice"))
    final_urgent = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")
    sink.append_version(spark, path, priced(o, 0), dt.datetime(2024, 1, 1))
    sink.append_version(spark, path, priced(o.filter("o_orderstatus <> 'O'"), 1), dt.datetime(2024, 1, 2), "overwrite")
    sink.append_version(spark, path, priced(o.filter(final_urgent), 1), dt.datetime(2024, 1, 3), "delete")
    sink.append_version(spark, path, priced(o.filter("o_orderstatus = 'P'"), 2), dt.datetime(2024, 3, 1))
    return path


def vacuum_then_as_of(spark, d):
    """M3, V3: the newest state of a log with an overwrite and a delete, after vacuum."""
    path = _changelog(spark, d)
    maintenance.vacuum(spark, path, ["o_orderkey"], dt.datetime(2024, 3, 2))
    return sink.read_as_of(spark, path, ["o_orderkey"]).select("o_orderkey", "o_totalprice")


def as_of_after_delete(spark, d):
    """V3: the state just after the delete, before the last upsert."""
    return sink.read_as_of(spark, _changelog(spark, d), ["o_orderkey"], version=2).select("o_orderkey", "o_totalprice")


def current_version(spark, d):
    """V1: the newest version of the changelog."""
    return versions.current_version(read_table(spark, _changelog(spark, d)))


def version_changes(spark, d):
    """V2: what each version of the changelog inserted, updated and deleted."""
    return versions.version_changes(read_table(spark, _changelog(spark, d)), ["o_orderkey"])


def overlap_depth(spark, d):
    """M2: how many orders of a status are under way at once, from order to last shipment."""
    last = _t(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_shipdate").alias("shipped"))
    spans = _t(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate").join(last, "o_orderkey")
    out = maintenance.overlap_depth(spans, "o_orderstatus", "o_orderdate", "shipped")
    return out.select("o_orderstatus", "intervals", F.round("avg_depth", 6).alias("avg_depth"), "max_depth")


def clustering_depth(spark, d):
    """M2: whether files overlap less in every column after clustering, in a flat and in a partitioned table."""
    o, cols = _orders(spark, d).drop("year"), ["o_custkey", "o_orderdate", "o_totalprice"]
    out = None
    for layout, parts in (("flat", []), ("partitioned", ["o_orderstatus"])):
        path = scratch_table(spark, f"depth-{layout}")
        w = o.repartition(16).write
        (w.partitionBy(*parts) if parts else w).parquet(path)
        size = maintenance.table_bytes(spark, path)
        before = maintenance.clustering_depth(spark, path, cols).select("column", (F.col("avg_depth") * 16 / F.col("files")).alias("was"))
        maintenance.zorder(spark, path, cols, target_file_bytes=max(size // 24, 1))
        after = maintenance.clustering_depth(spark, path, cols).join(before, "column")
        # a share of the files of a folder: there are more files now
        fell = F.col("avg_depth") * 16 / F.col("files") < F.col("was")
        rows = after.select(F.lit(layout).alias("layout"), "column", "rows", fell.alias("fell"))
        out = rows if out is None else out.unionAll(rows)
    return out


# ------------------------------------------------------------- rules and types
def check_blocks_write(spark, d):
    """Q4: a rule that stays with the table: a batch that breaks it fails as a whole, a sound one is appended."""
    path, o = scratch_table(spark, "checked"), _orders(spark, d)
    sink.append(o.filter("o_orderstatus = 'F'"), path, ["year"])
    sink.add_check(spark, path, "positive_price", "o_totalprice > 0")
    broken = o.filter("o_orderstatus <> 'F'").withColumn("o_totalprice", F.when(
        F.col("o_orderstatus") == "P", -F.col("o_totalprice")).otherwise(F.col("o_totalprice")))
    try:
        sink.append(broken, path, ["year"])
    except CheckViolation:
        sink.append(broken.filter("o_totalprice > 0"), path, ["year"])
    return _prices(spark, path)


def widened_types(spark, d):
    """K4: whole numbers, then fractions, and days, then times, under the same names; both are kept."""
    path, o = scratch_table(spark, "widened"), _t(spark, d, "orders")
    closed = o.filter("o_orderstatus = 'F'").select("o_orderkey", F.col("o_totalprice").cast("long").alias("price"), F.to_date("o_orderdate").alias("at"))
    rest = o.filter("o_orderstatus <> 'F'").select("o_orderkey", F.col("o_totalprice").alias("price"), F.col("o_orderdate").alias("at"))
    sink.append(closed, path)
    sink.append_merge_schema(rest, path)
    return read_table(spark, path).select("o_orderkey", "price", "at")


def moved_rows(spark, d):
    """K6: a merge whose rows move to other partitions: open orders of before 1997 become pending."""
    path, o = scratch_table(spark, "moved"), _orders(spark, d).drop("year")
    sink.append(o, path, ["o_orderstatus"])
    old = (F.col("o_orderstatus") == "O") & (F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp_ntz"))
    sink.upsert_table(spark, path, o.filter(old).withColumn("o_orderstatus", F.lit("P")), ["o_orderkey"], partition_col="o_orderstatus",
                      ts_col=None, volatile=[], partition_follows_key=False)
    return read_table(spark, path).select("o_orderkey", "o_totalprice", "o_orderstatus")


# ------------------------------------------------------------------------ rates
def asof_rates(spark, d):
    """Every event priced by the last daily close of its type in force at its time, known from the next day on."""
    e = _t(spark, d, "events")
    day = F.date_trunc("day", "ts").cast("timestamp_ntz")
    closes = e.groupBy("event_type", (day + F.expr("INTERVAL 1 DAY")).alias("since")).agg(F.max("value").alias("rate"))
    rows = e.select("event_id", "event_type", "ts", F.col("value").alias("close"))
    return enrich.enrich_as_of(rows, closes, ["event_type"], "ts", "since", "rate").select("event_id", "event_type", "close", "close_fx")


# ------------------------------------------------------------ landed documents
def document_outcomes(spark, d):
    """Each event lands as a quote or as one of four broken documents; each gives a row or a reject."""
    kind = F.col("event_type")
    quote = F.create_map(F.lit(payload.QUOTE_WIRE_NAMES[0]), kind, F.lit(payload.QUOTE_WIRE_NAMES[4]), F.col("value").cast("string"),
                         F.lit("10. Seen By"), F.col("user_id").cast("string"))
    raw = (F.when(kind == "purchase", F.to_json(F.create_map(F.lit(payload.QUOTE_KEY), quote)))
            .when(kind == "error", F.lit('{"Information": "limit"}')).when(kind == "click", F.lit("[1]"))
            .when(kind == "view", F.lit(f'{{"{payload.QUOTE_KEY}": {{}}}}')).otherwise(F.lit("{}")))
    docs = _t(spark, d, "events").select("event_id", raw.alias("raw"))
    rows = payload.quote_rows(docs, fields="discover", passthrough=["event_id"])
    rejects = payload.quote_rejects(docs, passthrough=["event_id"])
    none = F.lit(None).cast("string")
    return rows.select("event_id", "exchange_rate", "seen_by", none.alias("reason")).unionAll(
        rejects.select("event_id", none, none, "reason"))


def ingest_overlapping(spark, d):
    """T1, K6 and the silver step: a history is landed, then all of it again, longer and with
    lower closes from the 15th on; the later delivery of a day wins."""
    lake, landing = Lake(scratch_table(spark, "lake")), scratch_table(spark, "landing")
    e = _t(spark, d, "events")
    days = (e.groupBy(F.col("event_type").alias("symbol"), F.lit("USD").alias("market"),
                      F.date_trunc("day", "ts").alias("day"))
             .agg(F.max_by("value", "ts").alias("close"), F.max("value").alias("high")))
    late = F.dayofmonth("day") >= 15
    deliveries = [days.filter(F.dayofmonth("day") < 20),
                  days.withColumn("close", F.when(late, F.col("close") / 2).otherwise(F.col("close")))]
    for rows in deliveries:
        docs = payload.to_series_documents(rows, "symbol", "day", {"2. high": "high", "4. close": "close"}, market="market")
        docs.select("raw").write.mode("append").text(landing)
    for stamp in (dt.datetime(2024, 6, 1), dt.datetime(2024, 6, 2)):  # nothing is left for the second run
        ingest(spark, lake, landing, None, stamp, whole_files=False)
        transform(spark, lake)
    silver = read_table(spark, lake.table(*INCREMENTAL_TABLES["silver_series"]))
    return silver.select("symbol", "market", "date", "month", "high", "close")


TABLE_QUERIES = {f.__name__: f for f in (
    table_upsert, schema_merge, overwrite_schema_merge, sorted_partitions, publish_prices, fallback_scan, picked_columns,
    strict_dates, compacted_table, zorder_then_upsert, vacuum_then_as_of, as_of_after_delete, current_version,
    document_outcomes, ingest_overlapping, version_changes, overlap_depth, clustering_depth, check_blocks_write, widened_types,
    moved_rows, asof_rates)}
