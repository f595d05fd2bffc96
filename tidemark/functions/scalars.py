"""Single values computed by Spark and used as literals in later plans.

A filter against a literal is pushed into the Parquet scan (row groups and
files whose min/max exclude it are skipped; a partition column is pruned). A
scalar subquery is not a literal when the scan is planned, so a high-water or
retention filter written with one reads every row group. Fetching the one
value first costs a small job and returns exactly one value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def literal_of(one_value: DataFrame) -> Column | None:
    """The single value of a one-row, one-column DataFrame (an aggregate) as a
    typed literal, or None when it is null. Timestamps travel as text and are
    cast back, so no time zone conversion touches them."""
    field = one_value.schema.fields[0]
    col = F.col(field.name)
    if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
        v = one_value.select(F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0]
    else:
        v = one_value.first()[0]
    return None if v is None else F.lit(v).cast(field.dataType)
