"""Derived calendar columns."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_str(ts) -> Column:
    """``yyyy-MM-dd`` text of a timestamp; null stays null (P10)."""
    return F.date_format(F.col(ts) if isinstance(ts, str) else ts, "yyyy-MM-dd")


def month_str(ts) -> Column:
    """``yyyy-MM`` text of a timestamp; null stays null."""
    return F.date_format(F.col(ts) if isinstance(ts, str) else ts, "yyyy-MM")
