"""Embedding links, components and the pipeline against brute force."""

import random
import sys

import numpy as np
import pytest

from tidemark.llm import embed_dedup
from tidemark.llm.common import components


def brute(rows, cosine):
    good = {}
    for i, v, label in rows:
        if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            u = np.array(v, float)
            good[i] = (label, u / np.sqrt(u @ u))
    near = {i: [j for j in good if j != i and good[i][0] == good[j][0] and len(good[i][1]) == len(good[j][1])
                and good[i][1] @ good[j][1] >= cosine] for i in good}
    label = {i: i for i, _, _ in rows}
    for _ in rows:
        for i in near:
            label[i] = min([label[i], *(label[j] for j in near[i])])
    return {i: (len(near.get(i, ())), label[i]) for i, _, _ in rows}


@pytest.mark.parametrize("strip", [4, 2048])
def test_links(spark, strip):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 16))
    rows = [(i, [float(x) for x in centres[i % 6] + rng.normal(size=16) * (0.12 if i % 3 else 0.0)], i % 2) for i in range(180)]
    rows += [(200, None, 1), (201, [], 1), (202, [0.0] * 16, 1), (203, [float("nan")] * 16, 1), (204, [None] + [1.0] * 15, 1),
             (205, [float("inf")] * 16, 1), (206, rows[0][1], None), (207, [1.0, 2.0], 0), (208, [2.0, 4.0], 0), (209, [1e30] * 16, 0),
             (210, [1e-30] * 16, 0)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "vec_id long, embedding array<double>, label int, cls string, n_links string")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embed_dedup.link_vectors(df, strip=strip).collect()}
    assert got == brute(rows, 0.98)
    assert embed_dedup.link_vectors(df.where("1 = 0")).count() == 0
    twice = embed_dedup.link_vectors(df.where("vec_id < 30").unionAll(df.where("vec_id < 30"))).collect()
    assert len(twice) == 60
    null = df.where("vec_id < 3").selectExpr("CAST(null AS BIGINT) AS vec_id", "embedding", "label")
    assert [(r.n_links, r.component_id, r.kept) for r in embed_dedup.link_vectors(null).collect()] == [(0, None, False)] * 3


def test_pair_tests(spark):
    """On the test vectors fewer than half of all pairs are tested, and no link is lost; nor in dense cells, in one strip or two."""
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("embedding", "label").collect()
    tests = pairs = 0
    for label in {r.label for r in rows}:
        x = np.unique(np.array([r.embedding for r in rows if r.label == label], float), axis=0)
        made = embed_dedup.Pairs(x / np.sqrt((x * x).sum(axis=1, keepdims=True)), None, 8, 4, 0.98, 7)
        list(made.links())
        tests, pairs = tests + made.tests, pairs + len(x) * (len(x) - 1) // 2
    assert pairs > 100_000 and tests < pairs / 2
    rng = np.random.default_rng(3)
    for size, noise in ((64, 0.01), (64, 0.018), (5, 0.05), (1, 0.1)):
        x = np.concatenate([rng.normal(size=size) / size ** 0.5 + rng.normal(size=(400, size)) * noise, rng.normal(size=(150, size))])
        x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
        near = x @ x.T >= 0.98 if size > 1 else x @ x.T > 0
        for left, right in ((x, None), (x[:250], x[250:])):
            found = [(int(a), int(b)) for i, j in embed_dedup.Pairs(left, right, 8, 4, 0.98, 7).links() for a, b in zip(i, j)]
            cut = 0 if right is None else 250
            want = {(a, b) for a, b in zip(*np.nonzero(near)) if a < b} if right is None else {(a, b - 250) for a, b in zip(*np.nonzero(near)) if a < 250 <= b}
            got = {(min(f), max(f)) for f in found} if not cut else set(found)
            assert len(found) == len(got) and got == want, (size, noise)


def test_a_task_takes_whole_vectors_once_for_each_strip_of_their_label(spark):
    rng = np.random.default_rng(9)
    rows = [(i, [float(x) for x in rng.normal(size=8)], i % 2) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    whole = {tuple(r) for r in embed_dedup.link_vectors(df, cosine=0.9).collect()}
    assert whole == {tuple(r) for r in embed_dedup.link_vectors(df, cosine=0.9, strip_bytes=20 * 8 * 8).collect()}
    single = [(i, [float(np.float32(x)) for x in v], label) for i, v, label in rows]
    assert {r[0]: (r[1], r[2]) for r in whole} == brute(single, 0.9)


def test_components_of_paths_stars_and_loops(spark):
    rnd = random.Random(1)
    path = [(i, i + 1) for i in range(100, 180)]
    star = [(5000, i) for i in range(300, 360)]
    loose = [(rnd.randint(400, 440), rnd.randint(400, 440)) for _ in range(25)] + [(7, 7)]
    edges = path + star + loose
    got = {r.v: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    label = {v: v for e in edges for v in e if e[0] != e[1]}
    for _ in label:
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    assert got == label
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.fixture(scope="module")
def pipeline():
    sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])
    import corpus_pipeline
    return corpus_pipeline


def test_stages_in_order(spark, pipeline):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    from tests.llm.test_text_operators import brute_lines
    assert [n for n, _ in pipeline.STAGES] == ["quality classifier", "line dedup", "SimHash near-dedup", "secret scan", "packing"]
    good = pipeline.quality(spark, docs, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    clean = docs.join(labels.where("quality = 1"), "doc_id").count()
    assert good.columns == docs.columns and good.join(labels.where("quality = 1"), "doc_id").count() >= 0.97 * clean
    lined = pipeline.lines(spark, good, sf)
    rows = [(r.doc_id, r.text) for r in good.collect()]
    assert sorted((r.doc_id, r.text) for r in lined.collect()) == sorted((i, t) for i, _, _, t in brute_lines(rows, 20, 3))
    single = pipeline.near_duplicates(spark, lined, sf)
    texts = [r.text for r in single.collect()]
    assert len(set(texts)) == len(texts) and set(texts) == {r.text for r in lined.collect() if r.text in set(texts)}
    safe = pipeline.secrets(spark, single, sf)
    assert safe.count() == len(texts) and safe.columns == docs.columns
    pieces = pipeline.pack(spark, safe, sf)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == {r.doc_id for r in safe.collect()}


def test_stages_take_nulls_and_nothing(spark, pipeline):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (1, None, "en", None, 0), (1, "", None, "s", None)], docs.schema)
    for name, stage in pipeline.STAGES:
        assert stage(spark, odd, sf).count() <= 3, name
        assert stage(spark, odd.where("1 = 0"), sf).count() == 0, name
