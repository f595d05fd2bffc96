"""The registered queries: each operator on its whole table, digests taken from its output."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (bpe, embed_dedup, hard_negatives, html_extract, language_id, line_dedup, packing, quality_nbsvm,
                          quality_rules, secret_scan, simhash, token_counts, whitening)
from tidemark.sources.tables import read_table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def held_out() -> Column:
    """Label rows that the classifier never learns from."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents packed into sequences of at most 1024 tokens."""
    pieces = packing.pack(_table(spark, sf_dir, "documents"), TOKENIZER)
    return pieces.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("length"),
                         F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every text's ids and of their decoding."""
    out = bpe.encode(_table(spark, sf_dir, "documents"), TOKENIZER)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings within labels."""
    return embed_dedup.link_vectors(_table(spark, sf_dir, "embeddings"), cosine=0.98)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a model of the labels that are not held out."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = quality_nbsvm.score(docs, _table(spark, sf_dir, "labels"), train_on=~held_out(), cutoff=0.3)
    return out.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and their components within two bits."""
    out = simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, radius=2)
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of every text without its repeated lines."""
    out = line_dedup.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdicts for all documents."""
    return quality_rules.judge(_table(spark, sf_dir, "documents"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    out = html_extract.extract(_table(spark, sf_dir, "pages"))
    return out.withColumn("n_chars", F.char_length("text").cast("long"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document."""
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), TOKENIZER, section="line")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of all documents: base counts and digest, and all spans."""
    out = secret_scan.scan(_table(spark, sf_dir, "documents"))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def n(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["rule"] < len(secret_scan.BASE))
    return out.select("doc_id", *(n(r.kind) for r in secret_scan.BASE), F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
                      joined(F.col("spans")).alias("spans"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first four whitened components of all embeddings."""
    return whitening.whiten(_table(spark, sf_dir, "embeddings"), components=4, scale=256)


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents by a model of those that are not held out; ``rejected`` marks uncertain ones."""
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False))
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = language_id.identify(docs.select("doc_id", "text"), docs.where(F.col("doc_id").isNotNull() & ~held))
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score", "rejected")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor and positive among all embeddings."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding", label.alias("label"))
    return hard_negatives.mine(rows, F.col("vec_id") % 50 == 0, positives=5, negatives=3, least=50, most=95, scale=256)


QUERIES = {f.__name__: f for f in (
    op1_packing, op2_bpe, op3_embedding_dedup, op4_quality_classifier, op5_simhash_dedup, op6_line_dedup, op7_quality_rules,
    op8_html_extraction, op9_token_counts, op10_secret_scan, op11_embedding_whitening, op12_language_id, op13_hard_negatives)}
