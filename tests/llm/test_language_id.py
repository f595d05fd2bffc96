"""Language identification: subwords by brute force, accuracy on held-out rows, edge cases."""

import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_MID
from tidemark.llm import language_id
from tidemark.llm.queries import op12_language_id

BITS = 12


def brute(text):
    """Subwords as strings: 2 to 4 signs of a word with its edges."""
    low = text.lower()
    words, word = [], ""
    for c in low + " ":
        if unicodedata.category(c)[0] in "LM":
            word += c
        elif word:
            words.append(f" {word} ")
            word = ""
    return [w[k:k + n] for w in words for n in (2, 3, 4) for k in range(len(w) - n + 1)]


def bucket(gram):
    signs = np.array([ord(c) for c in gram], np.uint32)
    idx, at = language_id._buckets(signs, len(gram), BITS)
    assert at.tolist() == [0]
    return int(idx[0])


TEXTS = ["", "a", "Ab, cd!", "  Él  niñós--x9y ", "漢字かな", "\ud800 lone", "1234 !!", "x" * 50, "ǅ İstanbul ß", "a\n\nb\tc", "हिन्दी भाषा"]


@pytest.mark.parametrize("at_once", [1 << 20, 3, 17])
def test_sums_over_any_cut(monkeypatch, at_once):
    monkeypatch.setattr(language_id, "_AT_ONCE", at_once)
    table = np.random.default_rng(0).random((1 << BITS, 3)).astype(np.float32)
    total, count = language_id.sums(TEXTS, table, BITS)
    for k, t in enumerate(TEXTS):
        want = [bucket(g) for g in brute(t)]
        assert sorted(language_id.subwords(t, BITS).tolist()) == sorted(want)
        assert count[k] == len(want)
        assert np.allclose(total[k], table[want].astype(float).sum(axis=0) if want else 0)


def test_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    out = op12_language_id(spark, SF_MID)
    got = out.join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert len(got) == docs.count()
    held = got[got.held_out]
    assert (held.lang_pred == held.lang).mean() > 0.97
    assert got.score.between(0, 1).all()
    kept = held[~held.rejected]
    assert len(kept) > 0.9 * len(held) and (kept.lang_pred == kept.lang).mean() >= 0.985


def test_edges(spark):
    rows = [(i, ("der die und nicht " if i % 2 else "the and with that ") * (1 + i % 7), "de" if i % 2 else "en") for i in range(80)]
    learnt = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    docs = spark.createDataFrame(
        [(1, None, "x"), (2, "", "x"), (3, "123 !?", "x"), (4, "the and", "x"), (5, "und nicht", None), (5, "und nicht", None),
         (None, "that with " * 200_000, "x"), (7, "́", "x")], "doc_id long, text string, score string")
    got = {(r.doc_id, r.lang_pred) for r in language_id.identify(docs, learnt).collect()}
    assert got == {(1, "und"), (2, "und"), (3, "und"), (4, "en"), (5, "de"), (None, "en"), (7, "und")}
    assert language_id.identify(docs, learnt).count() == 8
    assert language_id.identify(docs.where("1 = 0"), learnt).count() == 0
    none = language_id.identify(docs, learnt.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score, r.rejected) for r in none} == {("und", 0.0, True)}
    one = language_id.identify(docs, learnt.where("lang = 'de'")).where("doc_id = 4").first()
    assert (one.lang_pred, one.score) == ("de", 1.0)


def test_calibration():
    rng = np.random.default_rng(2)
    y = rng.integers(0, 3, 4000)
    z = rng.normal(size=(4000, 3)) + 2 * np.eye(3)[y]          # true log odds are these
    scale, least = language_id.calibrate(3 * z, y, 0.02)
    assert 0.25 < scale * 3 / 2 < 0.6 * 3
    p = language_id.softmax(3 * z * scale)
    top, right = p.max(axis=1), p.argmax(axis=1) == y
    assert abs(top.mean() - right.mean()) < 0.03
    assert (~right[top >= least]).mean() <= 0.02 and (top >= least).mean() > 0.2


def test_rejects_unknown_language(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    learnt = docs.where("lang IN ('en', 'de')")
    other = docs.where("lang = 'es'").select("doc_id", "text")
    out = language_id.identify(other, learnt, max_error=0.0)
    known = language_id.identify(learnt.select("doc_id", "text"), learnt, max_error=0.0)
    assert out.where("rejected").count() / out.count() > known.where("rejected").count() / known.count()
