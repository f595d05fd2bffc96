"""Landed JSON payloads -> rows.

A landed file holds one JSON document. Files are read as whole texts
(``wholetext``), one row per file, so the work spreads over files; the
document is parsed JVM-side with ``from_json`` into maps so that unknown
fields survive until they are projected to declared columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.coerce import to_datetime_fixed, to_double
from tidemark.functions.dates import date_str
from tidemark.functions.names import free_names_expr, quote_field_expr, series_field_expr

# Payload keys and field sets of the two document kinds.
SERIES_KEY_PREFIX = "Time Series"
QUOTE_KEY = "Realtime Currency Exchange Rate"
META_KEY = "Meta Data"
SERIES_FIELDS = ("open", "high", "low", "close", "volume")
QUOTE_FIELDS = ("from_currency_code", "from_currency_name", "to_currency_code",
                "to_currency_name", "exchange_rate", "last_refreshed", "time_zone",
                "bid_price", "ask_price")

# The names that fields have in landed documents.
QUOTE_WIRE_NAMES = ("1. From_Currency Code", "2. From_Currency Name", "3. To_Currency Code", "4. To_Currency Name",
                    "5. Exchange Rate", "6. Last Refreshed", "7. Time Zone", "8. Bid Price", "9. Ask Price")

#: distinct field names that become columns; more is an error, never a cut
MAX_FIELDS = 2000


def read_landed(spark: SparkSession, path: str, whole_files: bool = True) -> DataFrame:
    """Landed documents as rows (``file``, ``modified``, ``raw``); the file's time and
    name are the order of deliveries.

    ``whole_files``: one document per file (pretty-printed JSON allowed).
    Otherwise one document per line (JSON lines): large landing files are
    then split into many tasks, and millions of small documents do not need
    millions of files.
    """
    df = spark.read.text(path, wholetext=whole_files)
    return df.select(F.col("_metadata.file_path").alias("file"),
                     F.col("_metadata.file_modification_time").alias("modified"), F.col("value").alias("raw"))


def json_field(raw, path: str) -> Column:
    """S3: pick a sub-object / value by JSON path (``$.a.b``)."""
    return F.get_json_object(F.col(raw) if isinstance(raw, str) else raw, path)


def _with_renamed_map(df: DataFrame, col: str, rule, out: str) -> DataFrame:
    """Apply a key rule to the map<string,string> column ``col``; a repeat of a name
    ``x`` takes the first free of ``x_1``, ``x_2`` (P3). Two projections, so that names
    are computed once per key."""
    names = f"{out}__names"
    df = df.withColumn(names, F.transform(F.map_keys(F.col(col)), rule))
    n = F.col(names)
    # numbered forms only where a name repeats (rare); the check is codegen'd
    has_repeats = F.size(F.array_distinct(n)) < F.size(n)
    unique = F.when(has_repeats, free_names_expr(n)).otherwise(n)
    df = df.withColumn(out, F.map_from_arrays(unique, F.map_values(F.col(col))))
    return df.drop(names)


def _top(raw: Column) -> Column:
    return F.from_json(raw, "map<string,string>")


def _first_series(top: Column) -> Column:
    """Text of the first ``Time Series*`` child."""
    return F.try_element_at(
        F.map_values(F.map_filter(top, lambda k, v: k.startswith(SERIES_KEY_PREFIX))), F.lit(1))


def _reject_reason(raw: Column, top: Column, has: Column, child: Column, kind: str) -> Column:
    """Null for a document that yields rows, else why it yields none."""
    return (F.when(raw.isNull() | F.trim(raw).isin("", "null"), F.lit("empty"))
             .when(top.isNull(), F.lit("not_a_json_object"))
             .when(F.size(top) == 0, F.lit("empty"))
             .when(~has, F.lit(f"no_{kind}"))
             .when(child.isNull() | (F.size(child) == 0), F.lit(f"malformed_{kind}")))


def classify_series(df: DataFrame, raw: str = "raw") -> DataFrame:
    """S4 for series documents: adds ``_reject`` (null = accepted) and the
    top-level keys found, so a rate-limit notice is reported, not loaded.
    A series that is no object or has no entry is ``malformed_time_series``."""
    df = df.withColumn("_top", _top(F.col(raw)))
    top = F.col("_top")
    has = F.exists(F.map_keys(top), lambda k: k.startswith(SERIES_KEY_PREFIX))
    child = F.from_json(_first_series(top), "map<string,string>")
    reason = _reject_reason(F.col(raw), top, has, child, "time_series")
    return df.withColumn("_reject", reason).withColumn("_keys_found", F.map_keys(top))


def _discovered(names: DataFrame, column: str, first: tuple[str, ...]) -> list[str]:
    """``first`` and then the other map keys of ``column``, by name. The distinct keys
    are column names of the plan; more than ``MAX_FIELDS`` of them is an error."""
    found = [r[0] for r in names.select(F.explode(F.map_keys(column))).distinct().limit(MAX_FIELDS + 1).collect()]
    if len(found) > MAX_FIELDS:
        raise ValueError(f"more than {MAX_FIELDS} distinct field names in the landed documents")
    return [*first, *sorted(set(found) - set(first))]


def series_rows(df: DataFrame, raw: str = "raw", fields=SERIES_FIELDS,
                meta: dict[str, str] | None = None, keep_extra: bool = False,
                passthrough: list[str] = ()) -> DataFrame:
    """S1 + P1 + P3 + Q6 + Q7 + P10: one row per (document, date).

    ``fields``: the cleaned field names to project as numbers, or
    ``"discover"`` for the usual price fields and then every other field the
    documents carry, by name (one aggregation collects the distinct names,
    at most ``MAX_FIELDS``).
    ``meta`` maps output column -> cleaned ``Meta Data`` field name (e.g.
    ``{"symbol": "digital_currency_code"}``) to carry series keys onto rows.
    A document yields rows or one reject (``series_rejects``), never neither;
    an entry that is no object is a row without values.
    """
    keep = list(passthrough)
    d = df.select(*keep, _top(F.col(raw)).alias("_top"))
    text = _first_series(F.col("_top"))
    # one parse; a series with an entry that is no object fails it and is parsed entry by entry
    series = F.coalesce(F.from_json(text, "map<string,map<string,string>>"),
                        F.transform_values(F.from_json(text, "map<string,string>"),
                                           lambda k, v: F.from_json(v, "map<string,string>")))
    d = d.select(*keep, series.alias("_series"),
                 F.from_json(F.element_at(F.col("_top"), META_KEY), "map<string,string>").alias("_meta"))
    meta_cols: list[str] = []
    if meta:
        d = _with_renamed_map(d, "_meta", quote_field_expr, "_meta_n")
        d = d.select(*keep, "_series", *[F.element_at(F.col("_meta_n"), src).alias(o) for o, src in meta.items()])
        meta_cols = list(meta)
    # explode_outer + a filter on its output: a plain explode makes Spark
    # infer size(_series) > 0 and push it below the projection, parsing the
    # series text twice
    exploded = d.select(*keep, *meta_cols, F.explode_outer(F.col("_series")).alias("_date_key", "_raw_fields")) \
                .filter(F.col("_date_key").isNotNull())
    named = _with_renamed_map(exploded, "_raw_fields", series_field_expr, "_fields")
    if fields == "discover":
        fields = _discovered(named, "_fields", SERIES_FIELDS)
    out = [F.col(p) for p in keep + meta_cols]
    out.append(to_datetime_fixed("_date_key", "yyyy-MM-dd").alias("datetime"))
    out += [to_double(F.element_at(F.col("_fields"), f)).alias(f) for f in fields]
    if keep_extra:
        out.append(F.map_filter(F.col("_fields"), lambda k, v: ~k.isin(*fields)).alias("extra"))
    rows = named.select(*out)
    return rows.withColumn("date", date_str("datetime"))


def series_rejects(df: DataFrame, raw: str = "raw", passthrough: list[str] = ()) -> DataFrame:
    """Rejected documents with the reason and the keys that were found."""
    c = classify_series(df, raw).filter(F.col("_reject").isNotNull())
    return c.select(*passthrough, F.col("_reject").alias("reason"), F.col("_keys_found").alias("keys_found"))


def quote_rows(df: DataFrame, raw: str = "raw", fields=QUOTE_FIELDS,
               passthrough: list[str] = ()) -> DataFrame:
    """S2 + P2 + P3: one row per quote document; values stay text (as landed).
    ``fields="discover"`` takes the usual fields and then every other one, by name.
    A document yields a row or one reject (``quote_rejects``)."""
    keep = list(passthrough)
    d = df.select(*keep, F.element_at(_top(F.col(raw)), QUOTE_KEY).alias("_obj"))
    d = d.select(*keep, F.from_json(F.col("_obj"), "map<string,string>").alias("_m"))
    # zero or one quote per document; the filter sits above the generator,
    # so it is not pushed into (and does not repeat) the parsing
    d = d.select(*keep, F.explode_outer(F.array(F.col("_m"))).alias("_m")).filter(F.size("_m") > 0)
    d = _with_renamed_map(d, "_m", quote_field_expr, "_q")
    if fields == "discover":
        fields = [f for f in _discovered(d, "_q", QUOTE_FIELDS) if f]
    return d.select(*keep, *[F.element_at(F.col("_q"), f).alias(f) for f in fields])


def quote_rejects(df: DataFrame, raw: str = "raw", passthrough: list[str] = ()) -> DataFrame:
    """S4 for quote documents."""
    d = df.select(*passthrough, F.col(raw).alias("_raw"), _top(F.col(raw)).alias("_top"))
    top = F.col("_top")
    child = F.from_json(F.element_at(top, QUOTE_KEY), "map<string,string>")
    reason = _reject_reason(F.col("_raw"), top, F.map_contains_key(top, QUOTE_KEY), child, "quote")
    return d.select(*passthrough, reason.alias("reason"), F.map_keys(top).alias("keys_found")) \
            .filter(F.col("reason").isNotNull())


def to_series_documents(df: DataFrame, symbol: str, ts: str, fields: dict[str, str],
                        market: str | None = None, series_name: str = "Time Series (Digital Currency Daily)",
                        group: str = "month") -> DataFrame:
    """Inverse of ``series_rows``: one document per (symbol, market, month),
    ``fields`` maps payload field names (``"4. close"``) to numeric columns.
    Rows must be one per (symbol, day). A document holds at most one month of
    days, so no document grows with the history."""
    day = date_str(ts)
    per = "yyyy-MM" if group == "month" else "yyyy"
    fm = F.create_map(*[x for k, c in fields.items() for x in (F.lit(k), F.col(c).cast("string"))])
    keys = [symbol] + ([market] if market else [])
    docs = (df.groupBy(*keys, F.date_format(ts, per).alias("__grp"))
              .agg(F.map_from_entries(F.collect_list(F.struct(day, fm))).alias("__series")))
    meta = [F.lit("1. Information"), F.lit("Daily Prices"),
            F.lit("2. Digital Currency Code"), F.col(symbol).cast("string")]
    if market:
        meta += [F.lit("4. Market Code"), F.col(market).cast("string")]
    raw = F.to_json(F.struct(F.create_map(*meta).alias(META_KEY), F.col("__series").alias(series_name)))
    return docs.select(*keys, F.col("__grp").alias("period"), raw.alias("raw"))
