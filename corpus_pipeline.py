"""Corpus pipeline: quality classifier, line dedup, SimHash near-dedup, secret scan, packing.

Every stage takes what the one before kept, as columns of ``documents`` (doc_id, text, lang,
source, n_chars), and works on all of it; the last returns packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import line_dedup, packing, quality_nbsvm, secret_scan, simhash
from tidemark.llm.common import staged
from tidemark.llm.queries import TOKENIZER, held_out
from tidemark.sources.tables import read_table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    labels = read_table(spark, f"{sf_dir}/labels.parquet")
    scored = quality_nbsvm.score(docs.select(*COLUMNS), labels, train_on=~held_out(), cutoff=0.3)
    return scored.where("predicted = 1").select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that repeat across documents."""
    kept = line_dedup.dedup_lines(docs.select(*COLUMNS))
    return (kept.withColumn("text", F.when(F.col("n_dropped") > 0, F.col("kept_text")).otherwise(F.col("text")))
            .withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars")))
            .select(*COLUMNS))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group of near-duplicates: the smallest by doc_id, nulls last, then by hashes of text and columns."""
    key = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", F.xxhash64("text").alias("text"),
                   F.xxhash64(F.lit(1), F.col("text").isNull(), *COLUMNS[1:]).alias("columns"))
    keyed = docs.select(*COLUMNS, key.alias("row_key"))
    groups = simhash.near_duplicates(keyed, shingle=3, radius=2, id_col="row_key")
    first = groups.where("row_key = component_id").select("row_key").distinct()
    return keyed.join(first, "row_key", "left_semi").dropDuplicates(["row_key"]).select(*COLUMNS)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark."""
    out = secret_scan.redact(docs.select(*COLUMNS))
    return out.withColumn("n_chars", F.coalesce(F.char_length("text").cast("long"), F.col("n_chars"))).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 1024 tokens."""
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("SimHash near-dedup", near_duplicates),
    ("secret scan", secrets),
    ("packing", pack),
]

#: the classifier and the packing cannot be stated in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each staged as Parquet before the next reads it."""
    docs = read_table(spark, f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = staged(docs, name.replace(" ", "-").lower())
    return docs
