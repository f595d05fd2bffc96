"""Jobs that work file by file: merges, packing, clustering and its depth, vacuum, rules that stay with a table."""

import datetime as dt
import os
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators.versions import history, version_changes
from tidemark.plans import maintenance
from tidemark.operators.quality import CheckViolation
from tidemark.sinks import tables as sink
from tidemark.sources.tables import read_table


def _files(path):
    return {os.path.join(d, n) for d, _, names in os.walk(path) for n in names if n.endswith(".parquet")}


def _months(spark, n=3000, files=4):
    rows = spark.range(n).select("id", (F.col("id") * 7919 % n).alias("x"), F.concat(F.lit("2024-0"), (F.col("id") % 2 + 1).cast("string")).alias("month"))
    return rows.repartitionByRange(files, "id")


def test_one_corrected_row_rewrites_one_file_of_a_month(spark, tmp_root):
    p = f"{tmp_root}/t"
    _months(spark).write.partitionBy("month").parquet(p)
    before = _files(p)
    assert len(before) == 8
    fix = spark.createDataFrame([(11, -1, "2024-02")], "id long, x long, month string")
    m = sink.upsert_table(spark, p, fix, ["id"], ts_col=None)
    assert (m["inserted"], m["updated"], m["files_rewritten"]) == (0, 1, 1) and m["kept"] > 300
    assert len(before - _files(p)) == 1
    got = read_table(spark, p)
    assert got.count() == 3000 and got.where("id = 11").select("x", "month").collect() == [(-1, "2024-02")]
    # the same again is unchanged: no file goes
    after = _files(p)
    m = sink.upsert_table(spark, p, fix, ["id"], ts_col=None, volatile=[])
    assert (m["updated"], m["unchanged"], m["files_rewritten"]) == (0, 1, 0) and _files(p) == after


def test_a_row_may_move_to_another_partition(spark, tmp_root):
    p = f"{tmp_root}/t"
    _months(spark).write.partitionBy("month").parquet(p)
    moved = spark.createDataFrame([(11, 5, "2024-09"), (5000, 6, None)], "id long, x long, month string")
    m = sink.upsert_table(spark, p, moved, ["id"], ts_col=None, partition_follows_key=False)
    assert (m["inserted"], m["updated"]) == (1, 1)
    got = read_table(spark, p)
    assert got.count() == 3001 and got.groupBy("id").count().where("count > 1").count() == 0
    assert got.where("id = 11").first().month == "2024-09" and got.where("id = 5000").first().month is None


def test_a_merge_that_broke_before_the_old_files_went_is_mended(spark, tmp_root, monkeypatch):
    p = f"{tmp_root}/t"
    _months(spark).write.partitionBy("month").parquet(p)
    fix = spark.createDataFrame([(11, -1, "2024-02")], "id long, x long, month string")

    def boom(*a):
        raise OSError("lost the driver")
    with monkeypatch.context() as m:
        m.setattr(sink, "remove_files", boom)
        with pytest.raises(OSError):
            sink.upsert_table(spark, p, fix, ["id"], ts_col=None)
    sink.upsert_table(spark, p, fix, ["id"], ts_col=None)
    assert [r.x for r in read_table(spark, p).where("id = 11").collect()] == [-1]


def test_publish_rewrites_only_files_with_replaced_keys(spark, tmp_root):
    p = f"{tmp_root}/gold"
    spark.range(1000).selectExpr("id AS k", "id AS v").repartitionByRange(5, "k").write.parquet(p)
    before = _files(p)
    m = sink.publish_by_key(spark, p, spark.createDataFrame([(7, 7), (8, 80), (None, 1)], "k long, v long"), ["k"])
    assert (m["inserted"], m["updated"], m["unchanged"], m["files_rewritten"]) == (1, 1, 1, 1)
    assert len(before & _files(p)) == 4
    assert read_table(spark, p).where("k = 8 OR k IS NULL").orderBy("v").collect() == [(None, 1), (8, 80)]


def test_packing_of_files_is_first_fit_decreasing():
    rnd = random.Random(3)
    sizes = [rnd.randint(1, 100) for _ in range(500)]
    files = pd.DataFrame({"file": [f"f{i:04d}" for i in range(500)], "bytes": sizes})
    got = maintenance.pack_files(files, 100, False)
    # the same by the plain rule
    rooms, want = [], {}
    for b, f in sorted(zip(sizes, files["file"]), key=lambda t: (-t[0], t[1])):
        k = next((i for i, r in enumerate(rooms) if r >= b), None)
        if k is None:
            k = len(rooms)
            rooms.append(100)
        rooms[k] -= b
        want[f] = k
    assert dict(zip(got["file"], got["bin"])) == want
    flat = maintenance.pack_files(files, 100, True)
    assert flat["bin"].is_monotonic_increasing and (flat.groupby("bin")["bytes"].sum() <= 100).all()


def test_compaction_leaves_full_files_and_other_folders(spark, tmp_root):
    p = f"{tmp_root}/t"
    _months(spark, 40_000, 1).write.partitionBy("month").parquet(p)
    full = _files(p)
    target = min(os.path.getsize(f) for f in full)
    _months(spark, 300, 3).where("month = '2024-01'").write.mode("append").partitionBy("month").parquet(p)
    rows = sorted(map(tuple, read_table(spark, p).collect()))
    out = maintenance.compact(spark, p, target_file_bytes=target)
    assert full <= _files(p) and (out["partitions_rewritten"], out["files_joined"], out["files_after"]) == (1, 3, 3)
    assert sorted(map(tuple, read_table(spark, p).collect())) == rows


@pytest.mark.parametrize("parts", [None, ["p"]])
def test_clustering_shows_in_the_files(spark, tmp_root, parts):
    p = f"{tmp_root}/t"
    rows = spark.range(120_000).selectExpr("id % 2 AS p", "id * 7919 % 100003 AS a", "id * 104729 % 100019 AS b",
                                           "concat('https://example.org/item/', lpad(id * 31 % 99991, 6, '0')) AS url")
    sink.overwrite(rows, p, parts)
    cols = ["a", "b", "url"]
    target = maintenance.table_bytes(spark, p) // 48
    rows.repartition(12).write.mode("overwrite").partitionBy(*(parts or [])).parquet(p)
    before = {r["column"]: r for r in maintenance.clustering_depth(spark, p, cols).collect()}
    out = maintenance.zorder(spark, p, cols, target_file_bytes=target)
    after = {r["column"]: r for r in maintenance.clustering_depth(spark, p, cols).collect()}
    assert out["files"] == len(_files(p)) >= 40
    for c in cols:
        assert after[c]["rows"] == before[c]["rows"] == 120_000 and after[c]["files"] == out["files"]
        # there are more files per folder, of which one meets a smaller share
        folder = out["files"] / len(parts or "-")
        assert after[c]["avg_depth"] < 0.8 * folder and before[c]["avg_depth"] == 12, (c, before[c], after[c])
    assert read_table(spark, p).count() == 120_000


def test_overlap_depth_equals_brute_force(spark):
    rnd = random.Random(9)
    rows = [(rnd.choice("ab"), lo, lo + rnd.choice([0, 0, 3, 30])) for lo in (rnd.choice([5, rnd.randint(0, 200)]) for _ in range(600))]
    df = spark.createDataFrame([*rows, ("a", None, 3), ("b", 2, None)], "g string, lo int, hi int")
    got = {r.g: (r.intervals, round(r.avg_depth, 9), r.max_depth) for r in maintenance.overlap_depth(df, "g", "lo", "hi").collect()}
    for g in "ab":
        own = [(lo, hi) for k, lo, hi in rows if k == g]
        met = sum(a <= y and x <= b for a, b in own for x, y in own)
        assert got[g] == (len(own), round(met / len(own), 9), max(sum(a <= lo <= b for a, b in own) for lo, _ in own))
    text = df.selectExpr("g", "lpad(lo, 4, '0') AS lo", "lpad(hi, 4, '0') AS hi")
    assert {r.g: r.max_depth for r in maintenance.overlap_depth(text, "g", "lo", "hi").collect()} == {g: v[2] for g, v in got.items()}


def test_a_rule_stays_and_fails_any_writer(spark, tmp_root):
    p = f"{tmp_root}/t"
    good = spark.createDataFrame([(1, 1.0, "a")], "id long, close double, month string")
    bad = spark.createDataFrame([(2, -1.0, "a"), (3, 2.0, "b")], "id long, close double, month string")
    sink.append(good, p, ["month"])
    sink.add_check(spark, p, "positive_close", "close > 0")
    for write in (lambda: sink.append(bad, p, ["month"]), lambda: sink.overwrite(bad, p, ["month"]), lambda: sink.overwrite_merge_schema(bad, p, ["month"]),
                  lambda: sink.overwrite_partitions(bad, p, ["month"]), lambda: sink.upsert_table(spark, p, bad, ["id"], ts_col=None),
                  lambda: sink.append(bad.withColumn("close", F.lit(None).cast("double")), p, ["month"])):
        with pytest.raises(CheckViolation, match="positive_close"):
            write()
        assert read_table(spark, p).select("id").collect() == [(1,)]
    # an overwrite by good rows keeps the rule
    sink.overwrite(good, p, ["month"])
    with pytest.raises(CheckViolation):
        sink.append(bad, p, ["month"])
    with pytest.raises(CheckViolation):
        sink.add_check(spark, p, "large", "close > 5")
    assert sink.table_checks(spark, p) == {"positive_close": "close > 0"}
    assert [os.path.basename(t) for t in maintenance.find_tables(spark, tmp_root)] == ["t"]


def test_vacuum_rewrites_only_files_with_old_rows(spark, tmp_root):
    p = f"{tmp_root}/lake/log"
    d = dt.datetime

    def rows(keys, v):
        return spark.createDataFrame([(k, v) for k in keys], "k string, v double").coalesce(1)
    sink.append_version(spark, p, rows("ab", 1.0), d(2024, 1, 1))
    sink.append_version(spark, p, rows("cd", 1.0), d(2024, 1, 2))
    sink.append_version(spark, p, rows("a", 2.0), d(2024, 1, 3))
    before = _files(p)
    spark.range(1).write.parquet(f"{tmp_root}/lake/plain")
    os.makedirs(f"{tmp_root}/lake/plain.__stage-dead")
    spark.createDataFrame([(1, 2)], "x int, _version long").write.parquet(f"{tmp_root}/lake/other")
    out = maintenance.vacuum_lake(spark, f"{tmp_root}/lake", ["k"], d(2124, 1, 31))
    names = {k.rsplit("/", 1)[-1]: v for k, v in out.items()}
    assert names["log"] == {"rows_before": 5, "rows_after": 4, "min_readable_version": 2, "files_rewritten": 1}
    assert names["plain"] == {"changelog": False} and "error" in names["other"]
    assert len(out["leftovers"]) == 1 and not os.path.exists(f"{tmp_root}/lake/plain.__stage-dead")
    assert len(before & _files(p)) == len(before) - 1
    assert [r.v for r in sink.read_as_of(spark, p, ["k"]).orderBy("k").collect()] == [2.0, 1.0, 1.0, 1.0]
    with pytest.raises(sink.VersionVacuumedError):
        sink.read_as_of(spark, p, ["k"], 1)
    # nothing more to drop: no version is added
    assert maintenance.vacuum(spark, p, ["k"], d(2124, 1, 31))["files_rewritten"] == 0
    assert [r._op for r in history(read_table(spark, p)).collect()] == ["vacuum", "upsert", "upsert", "upsert"]


def test_version_changes_equal_brute_force(spark):
    rnd = random.Random(5)
    rows, state, want = [], {}, []
    for v in range(12):
        op = rnd.choice(["upsert", "upsert", "overwrite", "delete"])
        keys = rnd.sample("abcdefgh", rnd.randint(1, 6))
        batch = {k: rnd.choice([1, 2]) for k in keys}
        before = dict(state)
        if op == "delete":
            for k in keys:
                state.pop(k, None)
        else:
            state = dict(batch) if op == "overwrite" else {**state, **batch}
        rows += [(k, x, v, dt.datetime(2024, 1, 1 + v), op) for k, x in batch.items()]
        same = sum(1 for k in keys if op != "delete" and before.get(k) == batch[k])
        want.append((v, op, len(state.keys() - before.keys()), sum(1 for k in state.keys() & before.keys() if state[k] != before[k]),
                     len(before.keys() - state.keys()), same))
    log = spark.createDataFrame(rows, "k string, x int, _version long, _ts timestamp_ntz, _op string")
    assert sorted(map(tuple, version_changes(log, ["k"]).collect())) == want


def test_types_of_both_sides_are_kept(spark, tmp_root):
    p = f"{tmp_root}/t"
    sink.overwrite(spark.sql("SELECT 1L AS n, date'2024-01-02' AS d, 5 AS i, 1.5BD AS m, 'x' AS only_old, 3 AS t"), p)
    new = spark.sql("SELECT 2.5D AS n, timestamp_ntz'2024-01-03 04:00:00' AS d, 6000000000L AS i, 12.25BD AS m, 'seven' AS t")
    sink.append_merge_schema(new, p)
    got = read_table(spark, p).orderBy("n").collect()
    assert [(r.n, r.d, r.i, float(r.m), r.only_old, r.t) for r in got] == [
        (1.0, dt.datetime(2024, 1, 2), 5, 1.5, "x", "3"), (2.5, dt.datetime(2024, 1, 3, 4), 6_000_000_000, 12.25, None, "seven")]
    sink.overwrite_merge_schema(spark.sql("SELECT 3 AS n, 4 AS t"), p)
    r = read_table(spark, p)
    assert dict(r.dtypes) == {"n": "double", "d": "timestamp_ntz", "i": "bigint", "m": "decimal(4,2)", "only_old": "string", "t": "string"}
    assert r.first().n == 3.0 and r.first().t == "4"


def test_replayed_quarantine_reads_only_its_prefixes(spark, tmp_root):
    p = f"{tmp_root}/q"
    rows = spark.range(300).selectExpr("id", "concat('reason', id % 3) AS reason")
    sink.append_new(rows, p)
    sink.append_new(rows.where("id < 20").unionByName(spark.range(300, 302).selectExpr("id", "'new' AS reason")), p)
    assert read_table(spark, p).count() == 302
    plan = sink.known_rows(spark, p, ["a0", "b1"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [row_prefix" in plan.replace("isnotnull(row_prefix#", "row_prefix#") or "row_prefix" in plan.split("PartitionFilters:")[1].split("]")[0]
    assert "ReadSchema: struct<_row:string>" in plan


def test_clustering_sorts_a_bounded_part_of_well_packed_rows(spark, tmp_root):
    """Parquet packs equal values to almost nothing, a sort does not: tasks are counted by the rows' own size."""
    p = os.path.join(tmp_root, "packed")
    rows = spark.range(40_000).select("id", (F.col("id") % 50).alias("a"), F.repeat(F.lit("x"), 100).alias("pad"))
    rows.coalesce(1).write.parquet(p)
    assert maintenance.zorder(spark, p, ["a", "id"], sort_bytes=1024 * 1024)["files"] >= 5      # 6 MB of rows
    got = spark.read.parquet(p)
    per_file = [r["count"] for r in got.groupBy(F.input_file_name()).count().collect()]
    assert max(per_file) < 20_000 and sum(per_file) == 40_000
    assert got.exceptAll(rows).count() == 0
    nested = rows.select("id", F.struct("pad", "a").alias("s"), F.array("pad").alias("l"), F.create_map("a", "pad").alias("m"))
    assert maintenance._row_bytes(nested) > 40_000 * 300
