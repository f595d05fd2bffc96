"""Lake table readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.session import path_exists


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
               merge_schema: bool = True) -> DataFrame:
    """A Parquet table directory. ``merge_schema`` makes columns added by
    a later write visible (Spark reads one footer's schema otherwise)."""
    r = spark.read.option("mergeSchema", "true" if merge_schema else "false")
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def read_first(spark: SparkSession, paths: list[str], schema: T.StructType | None = None,
               merge_schema: bool = True) -> DataFrame | None:
    """Read the first existing location; if none exists return an empty
    DataFrame with ``schema`` (or ``None`` when no schema is given)."""
    for p in paths:
        if p and path_exists(spark, p):
            return read_table(spark, p, schema, merge_schema)
    if schema is None:
        return None
    return spark.createDataFrame([], schema)
