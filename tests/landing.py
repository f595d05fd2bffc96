"""Test helper: land series documents derived from the events table."""

import os

from pyspark.sql import functions as F

from tidemark.sources.payload import to_series_documents

FIELDS = {"1. open": "open", "2. high": "high", "3. low": "low", "4. close": "close", "5. volume": "volume"}


def daily_prices(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    day = F.date_trunc("day", "ts")
    return (e.groupBy(F.col("event_type").alias("symbol"), F.lit("USD").alias("market"), day.alias("day"))
             .agg(F.min_by("value", "ts").alias("open"), F.max("value").alias("high"),
                  F.min("value").alias("low"), F.max_by("value", "ts").alias("close"),
                  F.count(F.lit(1)).cast("double").alias("volume")))


def land(df_docs, folder, prefix="doc"):
    """Write every document as its own file (tiny fixtures only)."""
    os.makedirs(folder, exist_ok=True)
    for i, r in enumerate(df_docs.collect()):
        with open(os.path.join(folder, f"{prefix}-{i}.json"), "w") as fh:
            fh.write(r["raw"])


def series_docs(spark, prices):
    return to_series_documents(prices, "symbol", "day", FIELDS, market="market")
