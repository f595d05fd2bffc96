"""Whitening and hard-negative mining against brute force."""

import math
from fractions import Fraction

import numpy as np
import pytest

from tidemark.llm import hard_negatives, whitening
from pyspark.sql import functions as F

NAN, INF = float("nan"), float("inf")


def whole(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def as_ints(v):
    return tuple(math.floor(256 * float(x)) for x in v)


def brute_whitening(rows, components=4):
    """Covariance by fractions of centred products, then eigenvectors."""
    xs = [(i, as_ints(v)) for i, v in rows if whole(v)]
    fit = sorted(set(x for _, x in xs))
    n, d = len(fit), len(fit[0])
    s = [sum(x[k] for x in fit) for k in range(d)]
    v = np.array([[float(Fraction(sum((n * x[a] - s[a]) * (n * x[b] - s[b]) for x in fit), n ** 3)) for b in range(d)] for a in range(d)])
    e, axes = np.linalg.eigh(v)
    e, axes = e[::-1][:components], axes[:, ::-1][:, :components]
    out = []
    for i, x in xs:
        c = [n * x[k] - s[k] for k in range(d)]
        w = np.array([k / n for k in c]) @ axes / np.sqrt(e)
        out.append((i, n, sum(k * k for k in c), w, e / np.trace(v)))
    return out


def test_whitening(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(300, 7)) * [3, 2.2, 1.6, 1.1, 0.7, 0.5, 0.3]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(base)]
    rows += [(1000 + i, rows[5][1]) for i in range(150)]            # a third of all rows is one vector
    rows += [(2000, None), (2001, [NAN] + [1.0] * 6), (2002, [None] + [1.0] * 6), (2003, [-INF] * 7), (3, rows[3][1])]
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], "vec_id long, embedding array<double>, n string, x string").repartition(5)
    got = whitening.whiten(df).toPandas()
    want = brute_whitening(rows)
    assert len(got) == 4 * len(want) and set(got["n"]) == {300}
    assert got["identity_error"].nunique() == 1 and got["identity_error"].max() < 1e-9
    by_row = {k: g.sort_values("component") for k, g in got.groupby("vec_id")}
    signs = np.sign(by_row[7]["whitened"].to_numpy() * next(w for i, _, _, w, _ in want if i == 7))
    for i, _, dev, w, share in want:
        g = by_row[i].drop_duplicates()
        assert set(g["deviation"]) == {dev} and g["component"].tolist() == [1, 2, 3, 4]
        assert np.allclose(g["whitened"].to_numpy() * signs, w, rtol=0, atol=1e-9)
        assert np.allclose(g["explained"].to_numpy(), share, rtol=1e-12)
    assert len(by_row[3]) == 8


@pytest.mark.parametrize("big", [1, 1 << 20, 1 << 40, 1 << 58])
def test_squares_are_exact(big):
    rng = np.random.default_rng(big % 97)
    c = rng.integers(-big, big + 1, (50, 5))
    got = whitening.squares(c)
    rows = [list(map(int, r)) for r in c]
    assert got == {(i, j): sum((r[i] if i == j else r[i] + r[j]) ** 2 for r in rows) for i in range(5) for j in range(i, 5)}


def test_whitening_of_little(spark):
    def run(rows):
        return whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert run([]) == [] and run([(1, None), (2, [])]) == []
    one = run([(1, [0.5, 0.25]), (None, [0.5, 0.25])])
    assert [(r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [
        (i, c, 1, 0, None, None, None) for i in (1, None) for c in (1, 2)]
    # two points vary in one direction; lengths are fits of their own
    two = run([(1, [0.0, 0.0, 1.0]), (2, [1.0, 0.0, 1.0]), (3, [4.0])])
    assert [(r.vec_id, r.component, r.n, r.deviation) for r in two] == [
        (1, 1, 2, 65536), (1, 2, 2, 65536), (1, 3, 2, 65536), (2, 1, 2, 65536), (2, 2, 2, 65536), (2, 3, 2, 65536), (3, 1, 1, 0)]
    assert [None if r.whitened is None else abs(r.whitened) for r in two] == [1.0, None, None, 1.0, None, None, None]
    # too large for a long: no deviation, no failure
    large = run([(1, [1e30, 1.0]), (2, [-1e30, 2.0]), (3, [0.0, 3.0])])
    assert {r.deviation for r in large if r.vec_id < 3} == {None} and {r.deviation for r in large if r.vec_id == 3} == {768 ** 2 + 1}
    assert all(r.identity_error < 1e-4 for r in large)


def brute_negatives(rows, every, positives=5, negatives=3):
    good = [(i, lab, as_ints(v)) for i, lab, v in rows if i is not None and lab is not None and whole(v)]
    out = set()
    for i, lab, x in set(r for r in good if r[0] % every == 0):
        score = [(-sum(a * b for a, b in zip(x, y)), j, other) for j, other, y in good if len(y) == len(x)]
        first = sorted((s, j) for s, j, other in score if other == lab and j != i)[:positives]
        for p, pos in first:
            fits = sorted((s, j) for s, j, other in score if other != lab and 50 * -p <= 100 * -s <= 95 * -p)[:negatives]
            out |= {(i, pos, k, j, -p, -s) for k, (s, j) in enumerate(fits, 1)}
    return out


@pytest.mark.parametrize("block_rows, anchor_rows, n_buckets, focus", [(16384, 4096, 8, 4), (16, 3, 3, 1), (200, 7, 1, 6)])
def test_hard_negatives(spark, block_rows, anchor_rows, n_buckets, focus):
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(5, 6))
    rows = []
    for i in range(400):
        v = centres[i % 5] * rng.uniform(0.05, 2) + rng.normal(size=6) * 0.4
        rows.append((i, int(rng.integers(0, 3)), [float(x) for x in np.round(v, 1 if i % 2 else 3)]))
    rows += [(1000 + i, i % 3, [0.5, -0.25, 0.5, 0.0, 0.0, 1.0]) for i in range(200)]         # equal vectors: ties by id
    rows += [(2000, None, [1.0] * 6), (2010, 1, None), (2020, 1, [NAN] * 6), (2030, 1, [None] * 6), (2040, 1, [INF] * 6), (None, 1, [1.0] * 6),
             (2050, 1, [0.0] * 6), (2060, 1, [1.0, 2.0]), (2070, 2, [1.0, 1.5]), (2081, 1, [2.0, 2.0]), (2090, 0, []), (2101, 1, []),
             (2111, 0, []), (10, rows[10][1], rows[10][2]), (15, rows[15][1], rows[15][2])]
    df = spark.createDataFrame([(*r, "b", 3) for r in rows], "vec_id long, label int, embedding array<double>, block string, rank int").repartition(3)
    got = hard_negatives.mine(df, F.col("vec_id") % 10 == 0, block_rows=block_rows, anchor_rows=anchor_rows, n_buckets=n_buckets, focus=focus)
    found = [tuple(r) for r in got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()]
    assert set(found) == brute_negatives(rows, 10)
    assert hard_negatives.mine(df.where("1 = 0"), F.col("vec_id") % 10 == 0).count() == 0


def test_pruning_loses_nothing_and_prunes():
    rng = np.random.default_rng(1)
    x = rng.integers(-100, 101, (3000, 5))
    block = hard_negatives.Block(x)
    read = 0
    for q in x[:40]:
        s = x @ q
        for least in (int(np.sort(s)[-10]), int(0.8 * s.max()), 1):
            mask = block.candidates(q, least, block.focus(q, 3))
            mask = np.ones(len(x), bool) if mask is None else mask
            assert mask[s >= least].all()
            read += mask.sum()
    assert read < 0.6 * 40 * 3 * len(x)
    assert not block.candidates(x[0], 10 ** 9, block.focus(x[0], 3)).any()
    assert block.candidates(x[0], 0, block.focus(x[0], 3)) is None


def test_large_components(spark):
    big = [(0, 1, [1e12, 0.0]), (50, 1, [1e3, 1.0]), (1, 1, [2e3, 0.0]), (2, 2, [1.5e3, 0.0])]
    df = spark.createDataFrame(big[1:], "vec_id long, label int, embedding array<double>")
    rows = hard_negatives.mine(df, F.col("vec_id") % 50 == 0).collect()
    assert [(r.anchor_id, r.positive_id, r.negative_id) for r in rows] == [(50, 1, 2)]
    q, block = np.array([1 << 40, 1]), hard_negatives.Block(np.array([[1 << 40, 0], [3, 5]]))
    with pytest.raises(OverflowError):
        block.scores(q, np.arange(2))
    assert block.scores(q, np.array([1])).tolist() == [(3 << 40) + 5]
