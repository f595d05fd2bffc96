"""SimHash near-duplicates by meet-in-the-middle ball hashing (operator 5).

A fingerprint has a bit set where over half of the hashes of the document's word shingles
have it. Two fingerprints within ``radius`` bits have a third one within half the radius of
both, so every distinct fingerprint emits all its variants within half the radius (65 for a
radius of 2), the variants are shuffled, and fingerprints that meet in a variant are
verified by their bit distance. Equal fingerprints are collapsed before that, so a group of
copies of any size is one row there, and a variant holds at most as many fingerprints as
the ball has points. Links are joined to components on the executors.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import by_bytes, components, staged, unstage

SEED = 42
_AT_ONCE = 1 << 16


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit fingerprint of a text, as a signed number (as Spark's bigint holds it).

    ASCII capitals are lowered, words are runs of anything but ASCII white space, shingles
    are ``shingle`` words joined by spaces, each occurrence counted. A text of fewer words
    is one shingle; one without words has fingerprint 0.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        words, shingle = [b" ".join(words)], 1
    n = len(words) - shingle + 1
    counts = np.zeros(64, np.int64)
    for start in range(0, n, _AT_ONCE):
        part = words[start:start + _AT_ONCE + shingle - 1]
        joined = map(b" ".join, zip(*(part[k:] for k in range(shingle)))) if shingle > 1 else part
        hashes = np.array([xxhash.xxh64_intdigest(s, SEED) for s in joined], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<i8")[0])


def fingerprints(df: DataFrame, *, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp long) of every row; null texts count as empty."""
    source = df.select(F.col(id_col), F.col(text_col).cast("string").alias(text_col))
    schema = T.StructType([source.schema[id_col], T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch, text_col):
                fps = [fingerprint(t, shingle) for t in part.column(text_col).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(id_col), pa.array(fps, pa.int64())], names=schema.names)
    return source.mapInArrow(run, schema)


def ball(radius: int) -> list[int]:
    """Masks of at most ``radius`` set bits out of 64, as signed numbers."""
    masks = [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(64), r)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def distance(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def links(distinct: DataFrame, radius: int) -> DataFrame:
    """Verified links (a, b) that join what lies within ``radius`` bits, from distinct ``fp``.

    For an even radius all fingerprints that share a variant are within the radius, so each
    is linked to the next one there; these chains connect the same groups as all pairs do.
    For an odd radius all pairs of a variant are compared; a variant's ball bounds them.
    """
    half = (radius + 1) // 2
    variants = distinct.select("fp", F.explode(F.array(*map(F.lit, ball(half)))).alias("mask")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("variant"))
    if radius % 2 == 0:
        order = Window.partitionBy("variant").orderBy("fp")
        met = variants.select(F.lag("fp").over(order).alias("a"), F.col("fp").alias("b")).where("a IS NOT NULL")
    else:
        met = variants.selectExpr("fp AS a", "variant").join(variants.selectExpr("fp AS b", "variant"), "variant").where("a < b")
    return met.select("a", "b").where(distance("a", "b") <= radius).distinct()


def near_duplicates(df: DataFrame, *, shingle: int = 3, radius: int = 2, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``fp``, ``component_id`` (smallest id reachable by links).

    Texts without words have fingerprint 0 and are linked like any other. A null id keeps
    its fingerprint, links others through it, and is never a component's id unless no
    member has another (then null). Repeated rows are repeated. Other columns are not read;
    an empty table gives an empty one.
    """
    if not 0 <= radius <= 6:
        raise ValueError("radius must be 0 to 6: the ball of half the radius is emitted")
    docs = staged(fingerprints(df, shingle=shingle, id_col=id_col, text_col=text_col), "fingerprints")
    distinct = staged(docs.groupBy("fp").agg(F.min(id_col).alias("first")), "distinct")
    roots = components(links(distinct, radius)) if radius else None
    if roots is None:
        groups = distinct.select("fp", F.col("first").alias("component_id"))
    else:
        linked = staged(distinct.join(roots.withColumnRenamed("v", "fp"), "fp", "left")
                        .select("fp", "first", F.coalesce("root", "fp").alias("root")), "roots")
        firsts = staged(linked.groupBy("root").agg(F.min("first").alias("component_id")), "firsts")
        groups = staged(linked.join(firsts, "root").select("fp", "component_id"), "groups")
        for t in (linked, firsts, distinct):
            unstage(t.staged_path)
    return docs.join(groups, "fp").select(id_col, "fp", "component_id")
