"""As-of joins and ranges against brute force; hot keys and hot instants spread over tasks."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import enrich, fill
from tidemark.operators.asof import asof_join
from tidemark.operators.ranges import range_bounds, with_range


def _brute(left, right):
    out = []
    for i, k, t in left:
        seen = [(rt, seq, v) for rk, rt, seq, v in right if k is not None and t is not None and rk == k and rt is not None and rt <= t]
        out.append((i, max(seen)[2] if seen else None))
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_asof_join_equals_brute_force(spark, seed):
    rnd = random.Random(seed)
    day = dt.datetime(2024, 1, 1)

    def at():
        return rnd.choice([None, day, day, day + dt.timedelta(hours=rnd.randint(-50, 50))])
    left = [(i, rnd.choice(["a", "a", "b", "c", None]), at()) for i in range(400)]
    right = [(rnd.choice(["a", "b", "d", None]), at(), s, float(s)) for s in range(60)]
    df = spark.createDataFrame(left, "id long, pair string, t timestamp_ntz")
    rates = spark.createDataFrame(right, "pair string, rt timestamp_ntz, seq int, rate double")
    got = asof_join(df, rates, ["pair"], "t", "rt", ["rate"], order=["seq"])
    assert sorted((r.id, r.rate) for r in got.collect()) == _brute(left, right)
    assert got.columns == ["id", "pair", "t", "rate"]
    assert asof_join(df, rates.where("1 = 0"), ["pair"], "t", "rt", ["rate"]).where("rate IS NOT NULL").count() == 0
    assert asof_join(df.where("1 = 0"), rates, ["pair"], "t", "rt", ["rate"]).count() == 0


def _tasks(df, where, value):
    # the value is read, or the plan would drop the work that makes it
    return [r["n"] for r in df.where(where).groupBy(F.spark_partition_id()).agg(F.count(value).alias("n")).collect()]


@pytest.fixture()
def uncoalesced(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_a_hot_pair_and_a_hot_instant_span_tasks(spark, uncoalesced):
    df = spark.range(30_000).selectExpr(
        "id", "CASE WHEN id % 3 < 2 THEN 'hot' ELSE concat('p', id % 50) END AS pair",
        "CASE WHEN id % 3 = 0 THEN timestamp_ntz'2024-01-02 00:00:00' ELSE timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) END AS t")
    rates = spark.createDataFrame([("hot", dt.datetime(2024, 1, 1), 1.0), ("hot", dt.datetime(2024, 1, 2), 2.0)], "pair string, rt timestamp_ntz, rate double")
    out = asof_join(df, rates, ["pair"], "t", "rt", ["rate"])
    hot = _tasks(out, "pair = 'hot'", "rate")
    assert len(hot) >= 6 and max(hot) < 10_000
    instant = _tasks(out, "t = timestamp_ntz'2024-01-02 00:00:00' AND pair = 'hot'", "rate")
    assert len(instant) >= 3 and max(instant) < 6_000
    assert out.where("pair = 'hot' AND t >= timestamp_ntz'2024-01-02 00:00:00' AND rate <> 2.0").count() == 0
    assert out.count() == 30_000 and out.where("pair = 'hot' AND rate IS NULL").count() == 0


def test_enrich_as_of(spark):
    day = [dt.datetime(2024, 1, d) for d in (1, 2, 3, 4)]
    df = spark.createDataFrame([("x", day[0], 1.0), ("x", day[2], 1.0), ("y", day[3], 1.0)], "m string, t timestamp_ntz, close double")
    rates = spark.createDataFrame([("x", day[1], 2.0), ("x", day[3], 9.0), ("x", day[2], None), ("y", day[3], 3.0)],
                                  "m string, at timestamp_ntz, r double")
    got = enrich.enrich_as_of(df, rates, ["m"], "t", "at", "r")
    assert sorted((r.m, r.t, r.close_fx) for r in got.collect() if r.close_fx) == [("x", day[2], 2.0), ("y", day[3], 3.0)]
    assert got.count() == 3


@pytest.mark.parametrize("order", [["a", "b", "c"], ["a", "b"], ["a"]])
def test_ranges_follow_the_order(spark, order):
    rnd = random.Random(4)
    rows = [(rnd.choice([1, 1, 1, 2, 5]), rnd.choice([0.5, 0.5, rnd.random()]), dt.date(2024, 1, rnd.randint(1, 28))) for _ in range(3000)]
    df = spark.createDataFrame(rows, "a int, b double, c date")
    got = with_range(df, order, "r", 40).collect()
    by_range = {}
    for r in got:
        by_range.setdefault(r.r, []).append(tuple(r[c] for c in order))
    spans = [(min(v), max(v)) for _, v in sorted(by_range.items())]
    assert all(a[1] <= b[0] if len(order) == 1 else a[1] < b[0] for a, b in zip(spans, spans[1:]))
    if len(order) > 1:
        assert len(spans) > 15 and max(map(len, by_range.values())) < (700 if len(order) == 3 else 1300)     # (1, 0.5) is one tuple
    assert range_bounds(df.where("1 = 0"), order, 40) == []


def test_fill_of_one_shared_date_spans_tasks(spark, uncoalesced):
    df = spark.range(24_000).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN date'2024-01-05' ELSE date_add(date'2024-01-01', int(id % 300)) END AS day",
        "CASE WHEN id % 11 = 0 THEN double(id) END AS v")
    out = fill.fill_gaps(df, ["v"], ["day", "id"])
    sizes = _tasks(out, "day = date'2024-01-05'", "v")
    assert len(sizes) >= 4 and max(sizes) < 5_000
    want, last, first = {}, None, None
    rows = sorted((r.day, r.id, r.v) for r in df.collect())
    first = next(v for _, _, v in rows if v is not None)
    for _, i, v in rows:
        last = v if v is not None else last
        want[i] = first if last is None else last
    assert {r.id: r.v for r in out.collect()} == want


def test_large_integers_are_not_cut_where_doubles_collapse(spark):
    big = 1 << 60
    df = spark.range(2000).selectExpr(f"{big} + id % 40 AS a", "id AS b", "CASE WHEN id % 5 = 0 THEN id END AS v")
    got = {r.b: r.v for r in fill.fill_gaps(df, ["v"], ["a", "b"]).collect()}
    rows, last, want = sorted((r.a, r.b, r.v) for r in df.collect()), None, {}
    first = next(v for _, _, v in rows if v is not None)
    for _, b, v in rows:
        last = v if v is not None else last
        want[b] = first if last is None else last
    assert got == want
