"""Table writes on Parquet (K1-K7, V1 appends).

* Whole rewrites are staged beside the table and swapped in, so a lost executor or failed
  job leaves the live table untouched, and a plan that reads the table it replaces never
  reads half-written files.
* Merges rewrite only the files that hold a changed key (``merge_files``); all other files
  keep their names. Changed rows are appended first, then the old files go: a driver that
  dies in between leaves both, and running the same merge again mends that.
* Partitioned writes use the REBALANCE hint on the partition column: AQE splits a hot
  partition value into several files of the advisory size instead of sending it through
  one task. Rows that are laid out already (``laid_out``) are written where they are.
* Rules that a table carries (``add_check``) are tested in the tasks of every write; a row
  that breaks one fails the write, and nothing of it becomes visible.
* Counts come from the write itself (``DataFrame.observe`` in its last stage, which counts
  a task once even if it runs again), not from jobs of their own.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from operator import and_, or_

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.dates import month_str
from tidemark.operators.dedup import keep_last
from tidemark.operators.quality import CheckViolation, check_report, violation
from tidemark.operators.upsert import assert_unique_keys
from tidemark.operators.versions import as_of, oldest_readable, with_version
from tidemark.session import checkpoint_root, path_exists


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _laid_out(df: DataFrame, partition_by: list[str] | None, sort_by: list[str] | None, laid_out: bool) -> DataFrame:
    """Partitioned writes rebalance on the partition columns, unless the rows are ``laid_out`` as they
    shall be stored; ``sort_by`` (O1) orders rows inside each written file, which tightens the
    min/max statistics of its row groups for later filters."""
    if partition_by and not laid_out:
        df = df.hint("rebalance", *partition_by)
    return df.sortWithinPartitions(*sort_by) if sort_by else df


def _write(df: DataFrame, path: str, table: str, mode: str, partition_by: list[str] | None) -> None:
    """Write rows that shall become part of ``table``, testing its rules."""
    with _violations():
        w = _guarded(df, table).write.mode(mode)
        (w.partitionBy(*partition_by) if partition_by else w).parquet(path)


# ------------------------------------------------------------ rules of a table
_BROKEN = "table check violated: "


def checks_path(path: str) -> str:
    """Where a table's rules are kept: a small table beside it, so rewrites of the table leave them alone."""
    return f"{path.rstrip('/')}.checks"


def table_checks(spark: SparkSession, path: str) -> dict[str, str]:
    """Q4: the rules of the table at ``path`` by name."""
    where = checks_path(path)
    if not path_exists(spark, where):
        return {}
    return {r["rule"]: r["expression"] for r in spark.read.parquet(where).orderBy("rule").collect()}


def add_check(spark: SparkSession, path: str, rule: str, expression: str) -> None:
    """Q4: a named rule (a Boolean SQL expression over the columns) that stays with the table: every later write through
    this module fails with ``CheckViolation`` if a row breaks it. A rule that stored rows break is refused. The same
    rule again changes nothing, another expression of its name replaces it."""
    rules = table_checks(spark, path)
    if rules.get(rule) == expression:
        return
    if path_exists(spark, path):
        broken = check_report(spark.read.option("mergeSchema", "true").parquet(path), {rule: expression}).first()["violations"]
        if broken:
            raise CheckViolation(f"{broken} stored rows of {path} break {rule}: {expression}")
    rows = [(k, v) for k, v in {**rules, rule: expression}.items()]
    staged = staging_beside(checks_path(path))
    spark.createDataFrame(rows, "rule string, expression string").coalesce(1).write.parquet(staged)
    swap_in(spark, staged, checks_path(path))


def _guarded(df: DataFrame, path: str) -> DataFrame:
    """Rows that raise in the task that writes them if they break a rule of the table; no pass of its own."""
    for rule, expression in table_checks(df.sparkSession, path).items():
        message = F.lit(f"{_BROKEN}{rule}: {expression}")
        df = df.where(F.when(violation(expression), F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
    return df


@contextmanager
def _violations() -> Iterator[None]:
    try:
        yield
    except PySparkException as ex:
        text = str(ex)
        if _BROKEN not in text:
            raise
        raise CheckViolation(text[text.index(_BROKEN):].splitlines()[0]) from ex


# ----------------------------------------------------------------- whole tables
def swap_in(spark: SparkSession, staged: str, path: str) -> None:
    """Replace ``path`` by the fully written ``staged`` folder.

    Two renames on the file system (atomic per rename on HDFS and local
    disks). Object stores without rename should publish a pointer instead.
    """
    fs, target = _fs(spark, path)
    _, src = _fs(spark, staged)
    old = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}.__old-{uuid.uuid4().hex[:8]}")
    if fs.exists(target) and not fs.rename(target, old):
        raise OSError(f"could not move {path} aside")
    parent = target.getParent()
    if parent is not None and not fs.exists(parent):
        fs.mkdirs(parent)
    if not fs.rename(src, target):
        if fs.exists(old):
            fs.rename(old, target)
        raise OSError(f"could not publish {staged} as {path}")
    if fs.exists(old):
        fs.delete(old, True)


def staging_path(spark: SparkSession, name: str = "stage") -> str:
    return f"{checkpoint_root(spark)}/tidemark-stage/{name}-{uuid.uuid4().hex[:12]}"


def staging_beside(path: str) -> str:
    """A staging folder next to a table, so that publishing it is a rename on one file system."""
    return f"{path.rstrip('/')}.__stage-{uuid.uuid4().hex[:12]}"


def drop_staged(spark: SparkSession, *paths: str) -> None:
    """Remove staging folders once the write that read them has finished
    (only folders this library created under the staging root)."""
    root = f"{checkpoint_root(spark)}/tidemark-stage/"
    for p in paths:
        if p and p.startswith(root):
            fs, hp = _fs(spark, p)
            if fs.exists(hp):
                fs.delete(hp, True)


def overwrite(df: DataFrame, path: str, partition_by: list[str] | None = None,
              sort_by: list[str] | None = None, laid_out: bool = False) -> None:
    """K1 (+K3): replace the whole table; safe when ``df`` reads ``path``."""
    spark = df.sparkSession
    staged = staging_beside(path)
    try:
        _write(_laid_out(df, partition_by, sort_by, laid_out), staged, path, "overwrite", partition_by)
        swap_in(spark, staged, path)
    except BaseException:
        fs, left = _fs(spark, staged)
        fs.delete(left, True)
        raise


def append(df: DataFrame, path: str, partition_by: list[str] | None = None,
           sort_by: list[str] | None = None) -> None:
    """K2 / U1 (+K3): add rows (UNION ALL into the table)."""
    _write(_laid_out(df, partition_by, sort_by, False), path, path, "append", partition_by)


#: characters of a row's hash that name its partition of a quarantine table
_PREFIX = "row_prefix"


def append_new(df: DataFrame, path: str, ignore: list[str] = (), prefixes: int = 2) -> None:
    """K2 for quarantine tables: add the rows the table does not hold yet, so a replayed
    batch adds none. Rows are compared by a hash of all columns but ``ignore``, over their
    non-null fields, so a column that one side lacks is as null there.

    The table is partitioned by the hash's first characters (``row_prefix``) and keeps the hash (``_row``):
    a batch reads only the partitions its own rows fall in, and of those only hashes.
    """
    spark = df.sparkSession
    cols = sorted(set(df.columns) - {*ignore, "_row", _PREFIX})
    row = F.sha2(F.to_json(F.struct(*cols)), 256) if cols else F.sha2(F.lit(""), 256)
    new = df.withColumn("_row", row).withColumn(_PREFIX, F.substring("_row", 1, prefixes))
    if path_exists(spark, path):
        staged = staging_path(spark, "quarantine")
        new.write.parquet(staged)
        new = spark.read.parquet(staged)
        known = known_rows(spark, path, [r[0] for r in new.select(_PREFIX).distinct().collect()])
        append(new.join(known, "_row", "left_anti"), path, [_PREFIX])
        drop_staged(spark, staged)
    else:
        append(new, path, [_PREFIX])


def known_rows(spark: SparkSession, path: str, prefixes: list[str]) -> DataFrame:
    """Hashes that a quarantine table holds in the partitions of ``prefixes`` (at most one a value of a hash's start)."""
    held = spark.read.schema(f"_row string, {_PREFIX} string").parquet(path)
    return held.where(F.col(_PREFIX).isin(prefixes)).select("_row").distinct()


def _in_partitions(col: str, values: list):
    """Rows of the listed partitions; null is a partition like any other, and isin never matches it."""
    listed = F.col(col).isin([v for v in values if v is not None])
    return listed | F.col(col).isNull() if None in values else listed


_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type of the lattice that holds values of both: whole numbers widen to long, any numbers else to
    double, a date with a time to that time, the null type to the other; what has nothing in common is text."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, _WHOLE) and isinstance(b, _WHOLE):
        return max(a, b, key=lambda t: [k for k, w in enumerate(_WHOLE) if isinstance(t, w)][0])
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        digits = max(a.precision - a.scale, b.precision - b.scale) + scale
        return T.DecimalType(digits, scale) if digits <= 38 else T.DoubleType()
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        return T.DoubleType()
    times = (T.TimestampType, T.TimestampNTZType)
    for day, time in ((a, b), (b, a)):
        if isinstance(day, T.DateType) and isinstance(time, times):
            return time
    if isinstance(a, times) and isinstance(b, times):
        return T.TimestampNTZType()
    return T.StringType()


def _as_type(c: str, old: T.DataType, new: T.DataType) -> Column:
    if old == new:
        return F.col(c)
    if isinstance(new, T.StringType) and isinstance(old, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(c).alias(c)
    return F.col(c).cast(new).alias(c)


def to_common_types(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the columns of ``schema`` it lacks, as null, and each common column in the type that holds both."""
    own = {f.name: f.dataType for f in df.schema}
    out = [_as_type(c, t, common_type(next((f.dataType for f in schema if f.name == c), t), t)) for c, t in own.items()]
    return df.select(*out, *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema if f.name not in own])


def overwrite_merge_schema(df: DataFrame, path: str, partition_by: list[str] | None = None,
                           sort_by: list[str] | None = None) -> None:
    """K4: overwrite, keeping columns the table had that ``df`` lacks (null). A column whose type differs takes the
    type that holds the old and the new values (``common_type``)."""
    spark = df.sparkSession
    if path_exists(spark, path):
        old = spark.read.option("mergeSchema", "true").parquet(path).schema
        known = [c for c in old.names if c in df.columns]
        df = to_common_types(df, old).select(*old.names, *[c for c in df.columns if c not in known])
    overwrite(df, path, partition_by, sort_by)


def append_merge_schema(df: DataFrame, path: str, partition_by: list[str] | None = None,
                        sort_by: list[str] | None = None) -> None:
    """K2 + K4: append, new columns included. Where a column's type must widen for the new rows, the stored rows
    are rewritten once in the wider type (Parquet files of one table must agree); else only new files are written."""
    spark = df.sparkSession
    if path_exists(spark, path):
        stored = spark.read.option("mergeSchema", "true").parquet(path)
        df = to_common_types(df, stored.schema)
        kinds = {f.name: f.dataType for f in df.schema}
        if any(kinds[f.name] != f.dataType for f in stored.schema):
            overwrite(to_common_types(stored, df.schema).unionByName(df), path, partition_by, sort_by)
            return
    append(df, path, partition_by, sort_by)


def overwrite_partitions(df: DataFrame, path: str, partition_by: list[str],
                         sort_by: list[str] | None = None) -> None:
    """Replace only the partitions present in ``df`` (dynamic overwrite)."""
    spark = df.sparkSession
    prev = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        _write(_laid_out(df, partition_by, sort_by, False), path, path, "overwrite", partition_by)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", prev)


# ------------------------------------------------------------- files of a table
def in_files(files: list[str]) -> Column:
    """Rows of the listed files (``_metadata.file_path``); the scan opens no other. One expression, however many."""
    listed = ", ".join("'" + f.replace("\\", "\\\\").replace("'", "\\'") + "'" for f in files)
    return F.expr(f"_metadata.file_path IN ({listed})") if files else F.lit(False)


def remove_files(spark: SparkSession, files: list[str]) -> None:
    """Delete data files by their ``_metadata.file_path`` (a URI, so escaped names are decoded)."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    for f in files:
        p = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f))
        p.getFileSystem(conf).delete(p, False)


def _near_keys(source: DataFrame, target: DataFrame, keys: list[str], partition_col: str | None) -> Column:
    """A filter of the target that no key of ``source`` fails: partitions of the source, and ranges of its keys as literals,
    so that partitions, files and row groups are skipped by their statistics."""
    plain = [k for k in keys if k in target.columns and isinstance(target.schema[k].dataType, T.AtomicType)
             and not isinstance(target.schema[k].dataType, (T.BinaryType, T.BooleanType))]
    asked = [f(k).alias(f"{n}{i}") for i, k in enumerate(plain) for n, f in (("lo", F.min), ("hi", F.max))]
    if partition_col:
        # as many values as the source has partitions; collect_set leaves out null, which is counted
        asked += [F.collect_set(partition_col).alias("parts"), F.count_if(F.col(partition_col).isNull()).alias("no_part")]
    row = source.agg(*asked).first() if asked else None
    out = F.lit(True)
    for i, k in enumerate(plain):
        if row[f"lo{i}"] is not None:
            kind = source.schema[k].dataType
            out = out & (F.col(k) >= F.lit(row[f"lo{i}"]).cast(kind)) & (F.col(k) <= F.lit(row[f"hi{i}"]).cast(kind))
    if partition_col:
        out = out & _in_partitions(partition_col, [*row["parts"], *([None] if row["no_part"] else [])])
    return out


def merge_files(spark: SparkSession, path: str, source: DataFrame, keys: list[str], partition_by: list[str] = (), *,
                partition_follows_key: bool = True, volatile: list[str] | None = None, sort_by: list[str] | None = None,
                null_safe: bool = False) -> dict:
    """K6 / K7 at file level: rows of ``source`` (each key once) replace those of their keys in the table at ``path``.

    The files that hold a key with a changed row are found by ``_metadata.file_path`` from key columns alone (and the compared ones,
    with ``volatile``); only these are read whole and written again, without the replaced rows. Everything else keeps its
    file. With ``partition_follows_key`` only partitions of the source are searched; else a row may move to another one.
    ``null_safe``: null keys match null keys. Returns ``inserted``, ``updated``, ``unchanged``, ``kept`` (rows written
    again as they were) and ``files_rewritten``.
    """
    target = spark.read.option("mergeSchema", "true").parquet(path)
    source = to_common_types(source, T.StructType([f for f in target.schema if f.name in source.columns])) \
        if any(f.name in source.columns and source.schema[f.name].dataType != f.dataType for f in target.schema) else source
    parts = list(partition_by)
    near = F.lit(True) if null_safe else _near_keys(source, target, keys, parts[0] if parts and partition_follows_key else None)
    compare = []
    if volatile is not None:
        fixed = {*keys, *volatile, *(parts if partition_follows_key else ())}
        compare = [c for c in dict.fromkeys([*target.columns, *source.columns]) if c not in fixed]
    k = [f"k{i}" for i in range(len(keys))]

    def side(df: DataFrame, p: str) -> list[Column]:
        return [(F.col(c) if c in df.columns else F.lit(None)).alias(f"{p}{i}") for i, c in enumerate(compare)]

    def matching(a: str, b: str) -> Column:
        return reduce(and_, [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) if null_safe else F.col(f"{a}.{c}") == F.col(f"{b}.{c}") for c in k])
    named = [F.col(c).alias(n) for c, n in zip(keys, k)]
    t = target.where(near).select(*named, *side(target, "t"), F.col("_metadata.file_path").alias("file"))
    s = source.select(*named, *side(source, "s"))
    same = reduce(and_, [F.col(f"t{i}").eqNullSafe(F.col(f"s{i}")) for i in range(len(compare))], F.lit(volatile is not None))
    found_path = staging_path(spark, "merge-found")
    t.alias("t").join(s.alias("s"), matching("t", "s")).select(*[F.col(f"s.{c}").alias(c) for c in k], "file", same.alias("same")).write.parquet(found_path)
    found = spark.read.parquet(found_path)
    files = [r[0] for r in found.where("NOT same").select("file").distinct().collect()]
    # a key that a broken merge left twice is replaced in every file
    known = found.groupBy(*k).agg(F.min("same").alias("__same"))
    tagged = source.select("*", *named).alias("s").join(known.alias("f"), matching("s", "f"), "left").select(
        *[F.col(f"s.{c}") for c in source.columns],
        F.when(F.col("f.__same").isNull(), F.lit("inserted")).when(F.col("f.__same"), F.lit("unchanged")).otherwise(F.lit("updated")).alias("__kind"))
    new = tagged.where("__kind <> 'unchanged'")
    counts = {"inserted": 0, "updated": 0, "unchanged": 0, "kept": 0, "files_rewritten": len(files)}
    if volatile is not None:
        counts["unchanged"] = known.where("__same").count()
    if files or not new.isEmpty():
        if files:
            gone = found.where("NOT same").select(*k).distinct()
            kept = target.where(in_files(files)).select("*", *named).alias("s").join(gone.alias("f"), matching("s", "f"), "left_anti").drop(*k)
            new = kept.withColumn("__kind", F.lit("kept")).unionByName(new, allowMissingColumns=True)
        out = new.hint("rebalance", *parts)
        out = out.sortWithinPartitions(*sort_by) if sort_by else out
        seen = Observation()
        out = out.observe(seen, *[F.count_if(F.col("__kind") == n).alias(n) for n in ("inserted", "updated", "kept")])
        _write(out.drop("__kind"), path, path, "append", parts)
        counts.update(seen.get)
        remove_files(spark, files)
    drop_staged(spark, found_path)
    return counts


def upsert_table(spark: SparkSession, path: str, source: DataFrame, keys: list[str],
                 partition_col: str = "month", order: list[str] | None = None,
                 ts_col: str | None = "datetime", rejects_path: str | None = None,
                 sort_by: list[str] | None = None, transient: list[str] = (),
                 volatile: list[str] | None = None, partition_follows_key: bool = True) -> dict:
    """K5 + K6 + A4: merge ``source`` into the table at ``path`` by ``keys``.

    * rows with a null key never match (N8) and would be inserted again on
      every run: they are kept out, counted as ``rejected`` and, with
      ``rejects_path``, appended there (quarantine, N4);
    * a repeated source key keeps its last row by ``order``, or fails if no
      order is given; ``transient`` columns only serve that order and are not stored;
    * with ``volatile`` (a list, maybe empty) a matched row whose other columns all equal
      the stored ones is ``unchanged``: it stays as stored, in its file;
    * only files that hold a changed key are written again (``merge_files``); with
      ``partition_follows_key`` only the partitions present in the source (``partition_col``,
      default ``month`` of ``ts_col``) are searched for them, else the whole table's keys are;
    * ``sort_by`` orders rows inside each written file (O1), keeping row-group
      statistics tight for later filters on those columns.

    The increment is written once (staged, so that the passes over it do not repeat its lineage and survive lost
    executors), and the changed files once. Returns real counts: ``inserted``, ``updated``, ``unchanged``, ``kept`` (rows
    written again as they were), ``rejected``, ``created``. Without any row a missing table is not created: a folder
    without a data file has no schema.
    """
    keys = list(keys)
    src = source
    if partition_col not in src.columns:
        src = src.withColumn(partition_col, month_str(ts_col))
    bad_key = reduce(or_, [F.col(k).isNull() for k in keys])
    raw_path = staging_path(spark, "upsert-raw")
    seen = Observation()
    src.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(bad_key).alias("rejected")).write.parquet(raw_path)
    raw, n = spark.read.parquet(raw_path), seen.get
    if n["rejected"] and rejects_path:
        append_new(raw.filter(bad_key).drop(*transient), rejects_path, ignore=volatile or ())
    zero = {"inserted": 0, "updated": 0, "unchanged": 0, "kept": 0, "files_rewritten": 0}
    out = {**zero, "created": False}
    if n["rows"] > n["rejected"]:
        src = raw.filter(~bad_key)
        if order:
            src = keep_last(src, keys, order)
        else:
            assert_unique_keys(src, keys)
        src = src.drop(*transient)
        if path_exists(spark, path):
            out.update(merge_files(spark, path, src, keys, [partition_col], partition_follows_key=partition_follows_key,
                                   volatile=volatile, sort_by=sort_by))
        else:
            made = Observation()
            laid = _laid_out(src, [partition_col], sort_by, False).observe(made, F.count(F.lit(1)).alias("rows"))
            _write(laid, path, path, "append", [partition_col])
            out.update(inserted=made.get["rows"], created=True)
    drop_staged(spark, raw_path)
    return {**out, "rejected": n["rejected"]}


def publish_by_key(spark: SparkSession, path: str, new: DataFrame, keys: list[str],
                   partition_col: str | None = None) -> dict:
    """K7: replace-by-key publish for gold tables; re-running with the same
    ``new`` leaves the table unchanged (idempotent, unlike a blind append).

    Only the files that hold a replaced key are written again; rows equal to the stored ones replace nothing. A null
    key replaces the null key of an earlier publish.
    """
    if partition_col:
        return upsert_table(spark, path, new, keys, partition_col=partition_col, ts_col=None)
    staged = staging_path(spark, "publish")
    new.write.parquet(staged)
    fresh = spark.read.parquet(staged)
    if path_exists(spark, path):
        out = {**merge_files(spark, path, fresh, keys, volatile=[], null_safe=True), "created": False}
    else:
        overwrite(fresh, path)
        out = {"created": True}
    drop_staged(spark, staged)
    return out


# --------------------------------------------------------------- changelog
def next_version(spark: SparkSession, path: str) -> int:
    """V1: next version number of a changelog table, from its rows (one partial aggregate over one column)."""
    if not path_exists(spark, path):
        return 0
    newest = spark.read.schema("_version long").parquet(path).agg(F.max("_version")).first()[0]
    return 0 if newest is None else int(newest) + 1


def append_version(spark: SparkSession, path: str, df: DataFrame, ts, op: str = "upsert",
                   partition_by: list[str] | None = None) -> int:
    """Write ``df`` as a new changelog version; returns the version number. The version, its time and its
    operation are columns of the rows; a write without rows leaves no version."""
    v = next_version(spark, path)
    append(with_version(df, v, ts, op), path, partition_by)
    return v


class VersionVacuumedError(ValueError):
    """An as-of read asked for a version whose rows vacuum has removed."""


def read_as_of(spark: SparkSession, path: str, keys: list[str], version: int | None = None,
               tiebreak: list[str] = ()) -> DataFrame:
    """V3 on a changelog table, refusing versions older than the vacuum horizon."""
    log = spark.read.option("mergeSchema", "true").parquet(path)
    floor = oldest_readable(log)
    if version is not None and floor is not None and version < floor:
        raise VersionVacuumedError(f"version {version} of {path} was vacuumed; oldest readable is {floor}")
    return as_of(log, keys, version, tiebreak)
