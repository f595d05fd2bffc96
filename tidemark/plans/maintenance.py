"""Table maintenance jobs (M1 compaction, M2 clustering and its depth, M3 vacuum).

Files are listed by Spark (``binaryFile`` without content, so listing spreads over the executors), and
jobs write only the files they change: new files are appended, then the old ones go. ``run_all``
applies a job to many tables and collects failures instead of stopping at the first one.
"""

from __future__ import annotations

import datetime as _dt
import math
from urllib.parse import unquote

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.zorder import interleave_bits
from tidemark.operators.ranges import as_number, with_range
from tidemark.operators.versions import DEFAULT_RETENTION_HOURS, VACUUM, data_rows, vacuum_rows
from tidemark.sinks.tables import append, drop_staged, in_files, next_version, overwrite, remove_files, staging_path
from tidemark.session import path_exists

DEFAULT_FILE_BYTES = 128 * 1024 * 1024
#: bytes of rows, unpacked, that one task of a clustering sorts
DEFAULT_SORT_BYTES = 256 * 1024 * 1024
#: small files of a partition that one packing task takes
_PACK_AT_ONCE = 10_000


def data_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, bytes, folder) of every data file under ``path``; ``file`` is as in ``_metadata.file_path``."""
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path))
    return listed.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes")).withColumn(
        "folder", F.regexp_replace("file", "/[^/]*$", ""))


def table_size(spark: SparkSession, path: str) -> tuple[int, int]:
    """(data files, bytes) under ``path``, no data read."""
    row = data_files(spark, path).agg(F.count("*").alias("n"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("b")).first()
    return row["n"], row["b"]


def table_bytes(spark: SparkSession, path: str) -> int:
    return table_size(spark, path)[1]


def data_file_count(spark: SparkSession, path: str) -> int:
    return table_size(spark, path)[0]


def _partition_cols(spark: SparkSession, path: str) -> list[str]:
    """Partition columns by the names of the folders down to one data file."""
    row = data_files(spark, path).select("folder").limit(1).collect()
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    root = root.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(root).toUri().getRawPath()
    below = row[0]["folder"].split(root.rstrip("/"), 1)[-1] if row else ""
    return [unquote(part.split("=", 1)[0]) for part in below.split("/") if "=" in part]


class FirstFit:
    """Bins of one capacity in the order they were opened; finds the first with room by a tree of the largest rooms."""

    def __init__(self, most: int, capacity: int):
        self.width = 1 << max(0, (most - 1).bit_length())
        self.room = [capacity] * (2 * self.width)

    def place(self, size: int) -> int:
        i = 1
        while i < self.width:
            i = 2 * i if self.room[2 * i] >= size else 2 * i + 1
        self.room[i] -= size
        out = i - self.width
        while i > 1:
            i //= 2
            self.room[i] = max(self.room[2 * i], self.room[2 * i + 1])
        return out


def pack_files(files: pd.DataFrame, target: int, in_order: bool) -> pd.DataFrame:
    """``files`` (file, bytes) with ``bin``: first fit by falling size, or next fit along their names if they must stay in order."""
    if in_order:
        files, bins, at, room = files.sort_values("file"), [], -1, -1
        for b in files["bytes"]:
            if b > room:
                at, room = at + 1, target
            room -= b
            bins.append(at)
        return files.assign(bin=bins)
    files = files.sort_values(["bytes", "file"], ascending=[False, True])
    fit = FirstFit(max(len(files), 1), target)
    return files.assign(bin=[fit.place(int(b)) for b in files["bytes"]])


def compact(spark: SparkSession, path: str, target_file_bytes: int = DEFAULT_FILE_BYTES) -> dict:
    """M1: pack the files below ``target_file_bytes`` into as few files of at most that size.

    Files of that size keep their names. The small ones of each folder are packed on the executors: first fit by falling size
    in the folders of a partitioned table, next fit in stored order in a flat one, so that clustered files stay ranges. A
    bin of several files becomes one file, rows in stored order: only those files are read and written, then removed. Joined
    files can be smaller than their parts together, so passes go on until none joins any. Cost
    follows the small files, not the table; another run finds nothing to join.
    """
    before, size = table_size(spark, path)
    parts = _partition_cols(spark, path)
    folders: set[str] = set()
    joined = 0
    while len(held := _small_files(spark, path, parts, before, target_file_bytes)):
        _join_files(spark, path, parts, held)
        folders |= set(held["folder"])
        joined += len(held)
    return {"files_before": before, "files_after": data_file_count(spark, path) if joined else before, "bytes": size,
            "partitions_rewritten": len(folders), "files_joined": joined}


def _small_files(spark: SparkSession, path: str, parts: list[str], n_files: int, target_file_bytes: int) -> pd.DataFrame:
    """(file, folder, id) of the files to join, those of one ``id`` into one; one row a file that will be rewritten."""
    small = data_files(spark, path).where(F.col("bytes") < target_file_bytes)
    if parts:
        chunks = small.groupBy("folder").agg(F.ceil(F.count("*") / _PACK_AT_ONCE).cast("int").alias("chunks"))
        small = small.join(chunks, "folder").withColumn("chunk", F.pmod(F.xxhash64("file"), F.col("chunks")).cast("int"))
    elif n_files > _PACK_AT_ONCE:        # runs of the names, by the task number in them
        number = F.coalesce(F.regexp_extract("file", r"/part-(\d{1,9})[^/]*$", 1).try_cast("double"), F.lit(0.0))
        small = with_range(small.withColumn("__n", number), ["__n"], "__run", math.ceil(n_files / _PACK_AT_ONCE))
        small = small.withColumn("chunk", F.col("__run").cast("int"))
    else:
        small = small.withColumn("chunk", F.lit(0))

    def pack(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        out = pack_files(group[["file", "bytes"]], target_file_bytes, not parts)
        out["folder"], out["chunk"] = key
        return out
    held = (small.select("file", "bytes", "folder", "chunk").groupBy("folder", "chunk")
            .applyInPandas(pack, "file string, bytes long, bin int, folder string, chunk int").toPandas())
    bins = held.groupby(["folder", "chunk", "bin"])
    held = held[bins["file"].transform("size") > 1] if len(held) else held
    return held.assign(id=held.groupby(["folder", "chunk", "bin"]).ngroup())


def _join_files(spark: SparkSession, path: str, parts: list[str], held: pd.DataFrame) -> None:
    """Write the files of each ``id`` as one, in stored order, then remove them."""
    bins = spark.createDataFrame(pa.table({"__file": pa.array(held["file"], pa.string()), "__bin": pa.array(held["id"], pa.int32())}))
    rows = spark.read.option("mergeSchema", "true").parquet(path).where(in_files(held["file"].tolist()))
    rows = rows.withColumns({"__file": F.col("_metadata.file_path"), "__row": F.col("_metadata.row_index")}).join(bins, "__file")
    laid = rows.repartitionById(int(held["id"].max()) + 1, "__bin").sortWithinPartitions("__file", "__row").drop("__file", "__row", "__bin")
    w = laid.write.mode("append")
    (w.partitionBy(*parts) if parts else w).parquet(path)
    remove_files(spark, held["file"].tolist())


def _text_rank(df: DataFrame, c: str, buckets: int) -> Column:
    """Bucket of a text among quantiles of the column, by binary search.

    The quantiles come from a uniform sample of about 32 rows a bucket (texts cut at 256 characters), whatever the table's size.
    """
    total = df.count()
    if not total:
        return F.lit(0)
    sample = df.select(F.substring(c, 1, 256).alias("v")).where("v IS NOT NULL").sample(min(1.0, 32 * buckets / total), seed=7)
    found = sorted(r[0] for r in sample.collect())
    bounds = sorted({found[i * len(found) // buckets] for i in range(1, buckets)} - set(found[:1])) if found else []
    if not bounds:
        return F.lit(0)
    held = F.array(*map(F.lit, bounds))
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(bounds).bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda i, s: F.when(
        (i + s <= len(bounds)) & (F.get(held, i + s - 1) <= F.col(c)), i + s).otherwise(i))


def zorder_frame(df: DataFrame, cols: list[str], buckets: int = 1024,
                 rel_error: float = 0.001) -> DataFrame:
    """M2 core: add ``__z``, the interleaved bucket ranks of ``cols``.

    Quantile boundaries of numbers, dates and times come from one ``percentile_approx``
    aggregation (partial sketches per task; the result is at most
    ``buckets - 1`` values per column, a fixed bound, so it is fetched to the
    driver as plan parameters), those of texts from a sample of whole texts, so texts that begin alike
    are told apart. Each value is mapped to its bucket by binary
    search, JVM-side, and the bucket numbers are interleaved
    bit by bit so rows close in every column get close codes.
    """
    from pyspark.ml.feature import Bucketizer

    bits = max(1, math.ceil(math.log2(buckets)))
    top = (1 << bits) - 1
    probs = [i / buckets for i in range(1, buckets)]
    acc = int(1 / rel_error)
    texts = [c for c in cols if as_number(df, c) is None]
    plain = [c for c in cols if c not in texts]
    row = df.agg(*[F.percentile_approx(as_number(df, c), probs, acc).alias(f"b{cols.index(c)}") for c in plain]).first() if plain else None
    out = df
    for i, c in enumerate(cols):
        if c in texts:
            out = out.withColumn(f"__r{i}", F.coalesce(_text_rank(df, c, buckets), F.lit(top)).cast("double"))
            continue
        inner = sorted(set(v for v in (row[f"b{i}"] or []) if v is not None))
        splits = [float("-inf"), *inner, float("inf")]
        if len(splits) < 3:
            splits = [float("-inf"), 0.0, float("inf")]
        out = out.withColumn(f"__x{i}", as_number(df, c))
        out = Bucketizer(splits=splits, inputCol=f"__x{i}", outputCol=f"__r{i}",
                         handleInvalid="keep").transform(out)
    # null / NaN land in the extra "invalid" bucket; clamp it to the last rank
    # so every rank uses exactly ``bits`` bits (no wasted top bit)
    z = interleave_bits([F.least(F.col(f"__r{i}").cast("bigint"), F.lit(top)) for i in range(len(cols))], bits)
    drop = [f"__x{i}" for i in range(len(cols))] + [f"__r{i}" for i in range(len(cols))]
    return out.withColumn("__z", z).drop(*drop)


def _row_bytes(df: DataFrame) -> int:
    """About how many bytes the rows take in a sort: 8 a column and 32 a row, and those of texts and nested values."""
    wide = [F.octet_length(c) for c, t in ((f.name, f.dataType) for f in df.schema) if isinstance(t, (T.StringType, T.BinaryType))]
    wide += [F.octet_length(F.to_json(F.struct(f.name))) for f in df.schema if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))]
    row = df.agg(F.count("*").alias("n"), *[F.coalesce(F.sum(c), F.lit(0)).alias(f"w{i}") for i, c in enumerate(wide)]).first()
    return row["n"] * (8 * len(df.columns) + 32) + sum(row[f"w{i}"] for i in range(len(wide)))


def zorder(spark: SparkSession, path: str, cols: list[str], target_file_bytes: int = DEFAULT_FILE_BYTES,
           buckets: int = 1024, sort_bytes: int = DEFAULT_SORT_BYTES) -> dict:
    """M2: cluster a table on ``cols`` by Z-order: range-partition by the code
    (sampled boundaries, no global sort in one task), sort inside each
    partition, staged write. Min/max statistics per file and row group then
    let filters on any of ``cols`` skip data. A task writes about ``target_file_bytes`` and sorts
    about ``sort_bytes`` of rows, whichever is less: a file that Parquet packs well is many times
    larger in a sort. Returns the files there are then."""
    before, size = table_size(spark, path)
    df = spark.read.option("mergeSchema", "true").parquet(path)
    n = max(1, math.ceil(size / target_file_bytes), math.ceil(_row_bytes(df) / sort_bytes))
    z = zorder_frame(df, cols, buckets)
    # a deterministic per-row tiebreak lets range partitioning split a code
    # shared by very many rows (a hot value) over several files; it is a hash
    # of the row, not rand(), so a retried task sends every row to the same
    # partition again
    z = z.withColumn("__t", F.xxhash64(*[F.col(c) for c in df.columns]))
    # a partitioned table stays partitioned: ranges follow the folders, then the code; the writer deals nothing anew
    parts = _partition_cols(spark, path)
    out = z.repartitionByRange(n, *parts, "__z", "__t").sortWithinPartitions(*parts, "__z").drop("__z", "__t")
    overwrite(out, path, parts or None, laid_out=True)
    return {"files_before": before, "files": data_file_count(spark, path), "bytes": size}


def _text_place(c: str) -> Column:
    """A text's first six bytes as a number: coarse, but in its order."""
    return F.conv(F.rpad(F.substring(F.hex(F.encode(c, "UTF-8")), 1, 12), 12, "0"), 16, 10).cast("double")


def overlap_depth(intervals: DataFrame, group: str, lo: str, hi: str) -> DataFrame:
    """How far intervals overlap: one row per ``group`` with ``intervals``, ``avg_depth`` (how many intervals, itself included, an
    interval has a point in common with, on average) and ``max_depth`` (the most at one point).

    A sweep: an interval meets those that start at or before its end, less those that end before its start. So counts of
    starts and ends along the order are enough, and no two intervals are compared. The sweep is cut into ranges of the order, each
    counted on its own, with the counts of the ranges before carried in, so a group of any size spans many tasks. Intervals
    with a null end are left out.
    """
    known = intervals.where(F.col(lo).isNotNull() & F.col(hi).isNotNull()).select(F.col(group).alias("g"), lo, hi)
    points = known.select("g", F.col(lo).alias("at"), F.lit(0).alias("is_end")).unionAll(known.select("g", F.col(hi), F.lit(1)))
    place = as_number(points, "at")
    if isinstance(points.schema["at"].dataType, T.StructType):      # a number, then a text
        place = F.coalesce(F.col("at.number"), _text_place("at.text"))
    elif place is None:
        place = _text_place("at")
    points = with_range(points.withColumn("place", place), ["place"], "r")
    points = points.withColumn("part", F.struct(F.struct("g").alias("k"), F.col("r").alias("b")))
    w = Window.partitionBy("part").orderBy("at", "is_end").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    inner = points.withColumns({"starts": F.sum(1 - F.col("is_end")).over(w), "ends": F.sum("is_end").over(w)})
    # a range's counts are what its last row holds; aggregated where the window left the rows
    sums = inner.groupBy("part").agg(F.max(F.struct("at", "is_end", "starts", "ends")).alias("last"))
    before = Window.partitionBy(F.col("part.k")).orderBy(F.col("part.b")).rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select(F.col("part").alias("at_part"), *[F.coalesce(F.sum(F.col(f"last.{c}")).over(before), F.lit(0)).alias(f"{c}_before")
                                                            for c in ("starts", "ends")])
    at = inner.join(carried, F.col("part") == F.col("at_part"))
    started, ended = F.col("starts") + F.col("starts_before"), F.col("ends") + F.col("ends_before")
    met = F.sum(F.when(F.col("is_end") == 1, started).otherwise(-ended))
    n = F.sum("is_end")
    return at.groupBy(F.col("g").alias(group)).agg(n.alias("intervals"), (met / n).alias("avg_depth"), F.max(started - ended).alias("max_depth"))


def clustering_depth(spark: SparkSession, path: str, cols: list[str]) -> DataFrame:
    """M2: per column, how far the value ranges of the files of a folder overlap: ``column``, ``files``, ``rows``, ``avg_depth``,
    ``max_depth``. Depth 1 is perfect; a filter as wide as a file's range opens ``avg_depth`` files of a folder on average.

    Ranges are minima and maxima per file (one aggregation over ``cols`` alone), numbers, dates and times as doubles; a file without
    a value in a column has none there.
    """
    df = spark.read.option("mergeSchema", "true").parquet(path)
    numbers = [as_number(df, c) for c in cols]
    none_n, none_t = F.lit(None).cast("double"), F.lit(None).cast("string")
    values = [(F.col(c).cast("string") if n is None else n).alias(f"v{i}") for i, (c, n) in enumerate(zip(cols, numbers))]
    per_file = df.select(F.col("_metadata.file_path").alias("file"), *values).groupBy("file").agg(
        F.count("*").alias("rows"), *[f(f"v{i}").alias(f"{n}{i}") for i in range(len(cols)) for n, f in (("lo", F.min), ("hi", F.max))])

    def end(name: str, i: int) -> Column:
        number, text = (none_n, F.col(f"{name}{i}")) if numbers[i] is None else (F.col(f"{name}{i}"), none_t)
        return F.when(F.col(f"{name}{i}").isNotNull(), F.struct(number.alias("number"), text.alias("text")))
    # one sweep for all columns: a file is a row per column, its ends a number or a text
    spans = per_file.select("rows", F.regexp_replace("file", "/[^/]*$", "").alias("folder"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), end("lo", i).alias("lo"), end("hi", i).alias("hi")) for i, c in enumerate(cols)])).alias("s"))
    spans = spans.select(F.struct("folder", "s.column").alias("at_column"), "rows", "s.lo", "s.hi")
    # a row a file and column, and as few as those: kept, so the table is read once
    path_of_spans = staging_path(spark, "depth")
    spans.write.parquet(path_of_spans)
    spans = spark.read.parquet(path_of_spans)
    depth = overlap_depth(spans, "at_column", "lo", "hi")
    found = depth.groupBy(F.col("at_column.column").alias("column")).agg(
        F.sum("intervals").alias("files"), (F.sum(F.col("avg_depth") * F.col("intervals")) / F.sum("intervals")).alias("avg_depth"),
        F.max("max_depth").alias("max_depth"))
    rows = spans.groupBy(F.col("at_column.column").alias("column")).agg(F.sum("rows").alias("rows"))
    out = found.join(rows, "column").select("column", "files", "rows", "avg_depth", "max_depth")
    out = spark.createDataFrame(out.toArrow())      # a row a column
    drop_staged(spark, path_of_spans)
    return out


def vacuum(spark: SparkSession, path: str, keys: list[str], now, retention_hours: float = DEFAULT_RETENTION_HOURS,
           enforce: bool = True, partition_by: list[str] | None = None) -> dict:
    """M3: drop changelog rows superseded before ``now - retention``.

    Only files that hold such rows are written again (their other rows are appended, then the files go). Afterwards the newest version
    committed before the limit is the oldest one an as-of read can still reproduce; a row of ``_op`` ``vacuum``, a version of its own,
    records it, and ``sinks.tables.read_as_of`` refuses older versions.
    """
    log = spark.read.option("mergeSchema", "true").parquet(path)
    if "_version" not in log.columns:
        raise ValueError(f"{path} is no changelog: it has no _version")
    missing = [k for k in keys if k not in log.columns]
    if missing:
        raise ValueError(f"{path} has no key columns {missing}")
    parts = partition_by or _partition_cols(spark, path)
    now = now if isinstance(now, _dt.datetime) else _dt.datetime.fromisoformat(str(now))
    limit = F.lit(now - _dt.timedelta(hours=retention_hours)).cast("timestamp_ntz")
    placed = data_rows(log.withColumn("__file", F.col("_metadata.file_path")))
    kept = vacuum_rows(placed, keys, now, retention_hours, enforce=enforce)
    # rows of each file, and how many of them stay: keys and versions only are read for it
    has = placed.groupBy("__file").agg(F.count("*").alias("rows"), F.max(F.when(F.col("_ts") < limit, F.col("_version"))).alias("floor"))
    stays = kept.groupBy("__file").agg(F.count("*").alias("stay"))
    both = has.join(stays, "__file", "left").select("__file", "rows", F.coalesce("stay", F.lit(0)).alias("stay"), "floor")
    per_file = both.collect()           # a row a file
    files = [r["__file"] for r in per_file if r["stay"] < r["rows"]]
    floor = max((r["floor"] for r in per_file if r["floor"] is not None), default=None)
    version = next_version(spark, path)
    if files:
        again = kept.where(F.col("__file").isin(files)) if len(files) < 1000 else kept.join(
            spark.createDataFrame(pa.table({"__file": files})), "__file", "left_semi")
        append(again.drop("__file"), path, parts or None)
        remove_files(spark, files)
    if floor is not None and files:
        marks = {"_version": F.lit(version).cast("long"), "_ts": F.lit(now).cast("timestamp_ntz"), "_op": F.lit(VACUUM),
                 "_floor": F.lit(int(floor)).cast("long")}
        fields = {f.name: f.dataType for f in log.schema if f.name not in marks}
        mark = spark.range(1).select(*[F.lit(None).cast(t).alias(c) for c, t in fields.items()], *[v.alias(c) for c, v in marks.items()])
        w = mark.write.mode("append")           # no data, so the table's rules are not about it
        (w.partitionBy(*parts) if parts else w).parquet(path)
    return {"rows_before": sum(r["rows"] for r in per_file), "rows_after": sum(r["stay"] for r in per_file),
            "min_readable_version": floor if files else None, "files_rewritten": len(files)}


def vacuum_lake(spark: SparkSession, root: str, keys: list[str], now, retention_hours: float = DEFAULT_RETENTION_HOURS,
                table_keys: dict[str, list[str]] | None = None) -> dict:
    """M3 over all tables under ``root``: changelogs are vacuumed by ``keys`` (``table_keys``: others, by the end of a table's path), folders
    that broken writes left beside tables before the limit are removed, other tables hold no old versions. One failure does
    not stop the rest: {path: result or {"error": text}}."""
    def one(s: SparkSession, path: str) -> dict:
        if "_version" not in s.read.parquet(path).columns:
            return {"changelog": False}
        own = next((k for name, k in (table_keys or {}).items() if path.rstrip("/").endswith(name)), keys)
        return vacuum(s, path, own, now, retention_hours)
    out = run_all(spark, find_tables(spark, root), one)
    out["leftovers"] = remove_leftovers(spark, root, now - _dt.timedelta(hours=retention_hours))
    return out


def _walk(spark: SparkSession, root: str, visit) -> None:
    """Folders under ``root`` by one listing each, until ``visit(folder, entries)`` returns False."""
    top = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())

    def walk(p) -> None:
        entries = fs.listStatus(p)
        if visit(p, entries) is False:
            return
        for e in entries:
            if e.isDirectory() and not _left_over(e.getPath().getName()):
                walk(e.getPath())
    if fs.exists(top):
        walk(top)


def _is_table(entries) -> bool:
    return any((n := e.getPath().getName()).endswith(".parquet") or (e.isDirectory() and "=" in n and not n.startswith(".")) for e in entries)


def _left_over(name: str) -> bool:
    return ".__old-" in name or ".__stage-" in name


def remove_leftovers(spark: SparkSession, root: str, before: _dt.datetime) -> list[str]:
    """Remove staging folders of writes that broke off before a time (UTC); returns them."""
    limit = int(before.replace(tzinfo=_dt.timezone.utc).timestamp() * 1000)
    gone: list[str] = []

    def visit(p, entries):
        fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
        for e in entries:
            if e.isDirectory() and _left_over(e.getPath().getName()) and e.getModificationTime() < limit:
                gone.append(e.getPath().toString())
                fs.delete(e.getPath(), True)
        return not _is_table(entries)
    _walk(spark, root, visit)
    return gone


def find_tables(spark: SparkSession, root: str) -> list[str]:
    """Table folders under ``root`` (file-system listing, no data read): a
    folder is a table when it holds Parquet files or ``col=value`` folders
    directly. Hidden folders (``_``/``.``), staging leftovers and the rules beside a table are skipped."""
    found: list[str] = []

    def visit(p, entries):
        name = p.getName()
        if name.startswith(("_", ".")) or name.endswith(".checks"):
            return False
        if _is_table(entries):
            found.append(p.toString())
            return False
    _walk(spark, root, visit)
    return sorted(found)


def run_all(spark: SparkSession, paths: list[str], job, **kwargs) -> dict:
    """Apply ``job(spark, path, **kwargs)`` to each table; one failure does
    not stop the rest. Returns {path: result or {"error": text}}."""
    out = {}
    for p in paths:
        if not path_exists(spark, p):
            out[p] = {"error": "missing"}
            continue
        try:
            out[p] = job(spark, p, **kwargs)
        except Exception as ex:  # noqa: BLE001 - reported per table
            out[p] = {"error": f"{type(ex).__name__}: {ex}"}
    return out
