"""tidemark: medallion-style time-series tables on Spark.

Landed JSON payloads are normalized into bronze tables, cleaned, de-duplicated,
gap-filled and enriched into silver, and rolled up into gold. Every operator is
a DataFrame transformation that takes ``keys=[...]`` so that the work spreads
over many series instead of one.
"""

__version__ = "0.1.0"
