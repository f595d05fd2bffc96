"""Repeated lines (operator 6), DataFrame functions only.

Lines are exploded and normalised, keys are hashed to 128 bits, distinct documents are
counted per hash, and lines over the threshold are dropped everywhere but in the largest
document that holds them; texts are put together again by position. Only hashes, ids and
positions are shuffled: texts move once, for the final join, and stay where they are if no
line of the table repeats enough to need a shuffle join. Distinct (hash, document) pairs
are counted in two steps, the second pre-aggregated, so a line that stands in a third of
all documents is a few rows a task; the join of lines to dropped hashes has two plain
shuffled sides, which adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged

# The white space of the line rule, and ASCII capitals.
WHITE = "\x20\x09\x0a\x0b\x0c\x0d"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(WHITE)), UPPER, LOWER)


def dedup_lines(df: DataFrame, *, min_chars: int = 20, min_docs: int = 3, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """The input with ``kept_text``, ``n_lines`` and ``n_dropped`` added, all columns kept.

    Keys of at least ``min_chars`` code points found in at least ``min_docs`` distinct ids
    lose all their lines except in the largest id that holds them (there all stay). A null
    or empty text is one empty line. Rows of one id are one document for the counts; each
    row gets its own result. Null ids are one document that comes before all others. Added
    columns replace columns of the same names, all others may have any name; an empty table gives an empty one.
    """
    known = [c for c in df.columns if c not in ("kept_text", "n_lines", "n_dropped")]
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = df.select(F.col(id_col).alias("_id"), F.xxhash64(text).alias("_th"), text.alias("_text"))
    lines = (rows.select("_id", "_th", F.posexplode(F.split("_text", "\n", -1)).alias("_pos", "_line"))
             .select("_id", "_th", "_pos", line_key(F.col("_line")).alias("_key"))
             .where(F.char_length("_key") >= min_chars)
             .select("_id", "_th", "_pos", F.xxhash64("_key").alias("_h1"), F.xxhash64(F.lit(1), "_key").alias("_h2")))
    lines = staged(lines, "lines")
    known_id = F.struct(F.col("_id").isNotNull().alias("known"), F.col("_id").alias("id"))
    repeated = staged(
        lines.groupBy("_h1", "_h2", "_id").agg(F.lit(1).alias("one"))
        .groupBy("_h1", "_h2").agg(F.count("one").alias("n"), F.max(known_id).alias("last"))
        .where(F.col("n") >= min_docs).select("_h1", "_h2", F.col("last.id").alias("_last")), "repeated")
    dropped = (lines.join(repeated, ["_h1", "_h2"]).where(~F.col("_id").eqNullSafe(F.col("_last")))
               .groupBy("_id", "_th").agg(F.collect_set("_pos").alias("_gone"))
               .select(F.struct("_id", "_th").alias("_row"), "_gone"))
    out = df.select(F.struct(*known).alias("_in"), F.split(text, "\n", -1).alias("_lines"),
                    F.struct(F.col(id_col).alias("_id"), F.xxhash64(text).alias("_th")).alias("_row"))
    out = out.join(dropped, "_row", "left")
    kept = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_gone"))
    return (out.withColumn("_kept", F.when(F.col("_gone").isNull(), F.col("_lines"))
                           .otherwise(F.transform(kept, lambda i: F.col("_lines")[i])))
            .select(*[F.col("_in")[c].alias(c) for c in known], F.array_join("_kept", "\n").alias("kept_text"),
                    F.size("_lines").cast("long").alias("n_lines"),
                    F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_dropped")))
