"""Helpers shared by the operators: staged tables, Arrow slices, connected components."""

from __future__ import annotations

import atexit
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path

#: text bytes that a Python task handles at once; a longer text is handled alone
SLICE_BYTES = 6 << 20

_STAGED: dict[str, SparkSession] = {}


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage: a lost executor costs the tasks it was running, not the table. The
    files go with ``unstage`` or when the driver ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    if not _STAGED:
        atexit.register(lambda: [unstage(p) for p in list(_STAGED)])
    _STAGED[path] = spark
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


def unstage(path: str) -> None:
    """Remove a staged table that nothing reads any more."""
    spark = _STAGED.pop(path, None)
    if spark is None or spark.sparkContext._jsc is None:
        return
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def by_bytes(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``limit`` bytes of one column, a row at least."""
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if held and held + n > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a, b): one row (v, root) per vertex that has a link.

    ``root`` is the smallest vertex of the component. Each round maps every vertex to the
    neighbour (or itself) that a hash of this round ranks first and contracts the graph
    along that map. A vertex survives only if it ranks before all its neighbours, so the
    graph shrinks by a constant factor a round however long its paths are; about as many
    rounds as the logarithm of the longest path. Rounds are staged tables; links and labels
    stay on the executors. Joins on hub vertices read plain shuffled tables, which adaptive
    execution splits; minima are taken before the shuffle.
    """
    edges = staged(edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b").distinct(), "edges")
    steps: list[DataFrame] = []
    while not edges.isEmpty():
        rank = F.xxhash64(F.lit(len(steps)), "w")
        near = edges.selectExpr("a AS v", "b AS w").unionAll(edges.selectExpr("b AS v", "a AS w"))
        best = near.withColumn("r", F.struct(rank.alias("h"), "w")).groupBy("v").agg(F.min("r").alias("r"))
        own = F.struct(F.xxhash64(F.lit(len(steps)), "v").alias("h"), F.col("v").alias("w"))
        to = staged(best.select("v", F.least("r", own)["w"].alias("to")), "step")
        moved = (edges.join(to.selectExpr("v AS a", "to AS a2"), "a")
                 .join(to.selectExpr("v AS b", "to AS b2"), "b")
                 .select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b"))
                 .where("a <> b").distinct())
        moved = staged(moved, "edges")
        unstage(edges.staged_path)
        steps.append(to)
        edges = moved
    unstage(edges.staged_path)
    if not steps:
        return edges.sparkSession.createDataFrame([], "v long, root long")
    # the vertices of a round are what the rounds before it mapped to, so maps compose
    top = steps[0]
    for i, to in enumerate(steps[1:], 1):
        joined = staged(top.alias("t").join(to.alias("n"), F.col("t.to") == F.col("n.v"), "left")
                        .select("t.v", F.coalesce("n.to", "t.to").alias("to")), "top")
        unstage(top.staged_path)
        unstage(to.staged_path)
        top = joined
    first = staged(top.groupBy("to").agg(F.min("v").alias("root")), "first")
    return top.join(first, "to").select("v", "root")
