"""Language identification by averaged hashed subword embeddings (operator 12).

A text's subwords are the runs of 2 to 4 signs inside its words, lower-cased, with the
mark of a word's edge as a sign; everything that is not a letter only separates words. Each
subword is hashed to a row of an embedding table, a text is the mean of its rows, and a linear
softmax gives the languages. Embeddings and softmax are trained together by stochastic gradient
descent in numpy. Probabilities are calibrated by a temperature fitted on texts the model has
not seen, and the same texts give the score below which predictions are rejected.

The fit takes a bounded sample of labelled rows (``rows`` rows, as many of each
language, and of each ``spans`` spans of at most ``span_chars`` signs from anywhere in the text), in one task whose memory those bounds limit.
Every text is scored whole, where it is: the model is linear in the mean, so long texts are
added up piece by piece.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import by_bytes

_SIZES = (2, 3, 4)
#: signs handled at once; longer texts are added up
_AT_ONCE = 1 << 20
_SLICE_BYTES = 1 << 20
_EDGE = np.uint32(0x20)
_MIX = np.uint32(0x9E3779B1)
_STEP = np.uint32(0x01000193)


class _Kinds:
    """For every code point: whether it is a letter, and whether it belongs to a word (letters and marks)."""

    tables: tuple[np.ndarray, np.ndarray] | None = None

    @classmethod
    def get(cls) -> tuple[np.ndarray, np.ndarray]:
        if cls.tables is None:
            first = np.array([ord(unicodedata.category(chr(c))[0]) for c in range(sys.maxunicode + 1)], np.uint8)
            cls.tables = first == ord("L"), (first == ord("L")) | (first == ord("M"))
        return cls.tables


def _signs(text: str) -> np.ndarray:
    # a lone surrogate is no letter and stays one sign
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def _squeeze(signs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Signs with all that is not part of a word made an edge, runs of edges made one (their last); and where they were."""
    inside = _Kinds.get()[1][signs]
    keep = inside.copy()
    keep[:-1] |= inside[1:]
    keep[-1:] = True
    at = np.flatnonzero(keep)
    return np.where(inside[at], signs[at], _EDGE), at


def _buckets(signs: np.ndarray, size: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the subword of ``size`` signs at each place, and the places that have one."""
    n = len(signs) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = signs == _EDGE
    good = ~(edge[:n] & edge[1:n + 1])          # a sign of a word at least
    h = signs[:n] * _STEP + np.uint32(size)
    for k in range(1, size):
        h = (h ^ (h >> np.uint32(15))) * _MIX + signs[k:n + k]
        if k < size - 1:
            good &= ~edge[k:n + k]          # inside one word
    h = (h ^ (h >> np.uint32(16))) * _MIX
    at = np.flatnonzero(good)
    return (h[at] >> np.uint32(32 - bits)).astype(np.int64), at


def subwords(text: str, bits: int) -> np.ndarray:
    """Buckets of all subwords of a text."""
    signs, _ = _squeeze(_signs(" " + text + " "))
    return np.concatenate([_buckets(signs, size, bits)[0] for size in _SIZES])


def sums(texts: list[str], table: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Per text: the sum of its subwords' rows of ``table``, and how many there are."""
    total, count = np.zeros((len(texts), table.shape[1])), np.zeros(len(texts), np.int64)
    if not texts:
        return total, count
    # every text starts with an edge, so no subword reaches from one into the next
    parts = [_signs(" " + t) for t in texts]
    starts = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    whole = np.concatenate([*parts, [_EDGE]])
    # cut before an edge, so that no subword is cut; a word longer than a cut is read with the next
    begin = 0
    while begin < len(whole) - 1:
        end = min(begin + _AT_ONCE, len(whole))
        inside = _Kinds.get()[1]
        while end < len(whole) and inside[whole[end - 1]]:
            end += 1
        signs, at = _squeeze(whole[begin:end])
        for size in _SIZES:
            idx, places = _buckets(signs, size, bits)
            if not len(idx):
                continue
            # a subword belongs to the text of its first letter; the edge before may stand in the text before
            owner = np.searchsorted(starts, begin + at[places + (signs[places] == _EDGE)], side="right") - 1
            rows = np.take(table, idx, axis=0)
            cut = np.flatnonzero(np.diff(owner, prepend=-1))
            total[owner[cut]] += np.add.reduceat(rows, cut, axis=0, dtype=np.float64)
            count[owner[cut]] += np.diff(cut, append=len(owner))
        begin = end - 1 if end < len(whole) else end
    return total, count


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def spans_of(text: str, spans: int, span_chars: int) -> list[str]:
    """Spans of random place and length, the same for the same text; a text that is short enough is its only one."""
    if len(text) <= 40:
        return [text]
    rng = np.random.default_rng(xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")))
    out = []
    for _ in range(spans):
        n = int(round(20 * (span_chars / 20) ** rng.random()))
        at = int(rng.integers(0, max(len(text) - n, 0) + 1))
        out.append(text[at:at + n])
    return out


def train(examples: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, n_classes: int, bits: int, dim: int, epochs: int, rate: float,
          seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Embeddings, softmax weights and bias by gradient steps on one example at a time; classes weigh the same."""
    rng = np.random.default_rng(seed)
    e = rng.uniform(-1 / dim, 1 / dim, (1 << bits, dim)).astype(np.float32)
    w, b = np.zeros((dim, n_classes), np.float32), np.zeros(n_classes, np.float32)
    per = len(y) / (n_classes * np.maximum(np.bincount(y, minlength=n_classes), 1))
    per = np.minimum(per, 10.0).astype(np.float32)
    steps, done = epochs * len(y), 0
    for _ in range(epochs):
        for k in rng.permutation(len(y)):
            idx, share = examples[k]
            lr = np.float32(rate * (1 - done / steps) * per[y[k]])
            done += 1
            h = share @ e[idx]
            z = h @ w + b
            g = np.exp(z - z.max())
            g /= g.sum()
            g[y[k]] -= 1
            back = w @ g
            w -= lr * np.outer(h, g)
            b -= lr * np.float32(0.1) * g
            e[idx] -= np.outer(share, lr * np.float32(len(idx) ** 0.5) * back)
    return e, w, b


def softmax(z: np.ndarray) -> np.ndarray:
    p = np.exp(z - z.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def calibrate(z: np.ndarray, y: np.ndarray, max_error: float) -> tuple[float, float]:
    """(scale of the logits with the least log loss, score below which predictions are rejected).

    Predictions that are not rejected are wrong in at most ``max_error`` of these texts. Without
    texts the scale is 1 and nothing is rejected.
    """
    if not len(y):
        return 1.0, 0.0
    def loss(s: float) -> float:
        return float(-np.log(np.maximum(softmax(z * s)[np.arange(len(y)), y], 1e-12)).mean())
    grid = np.exp(np.linspace(np.log(0.05), np.log(20), 121))
    scale = float(grid[int(np.argmin([loss(s) for s in grid]))])
    p = softmax(z * scale)
    top, right = p.max(axis=1), p.argmax(axis=1) == y
    order = np.argsort(-top, kind="stable")
    wrong = np.cumsum(~right[order]) / np.arange(1, len(y) + 1)
    fine = np.flatnonzero(wrong <= max_error)
    return scale, float(top[order[fine[-1]]]) if len(fine) else 1.0


def fit(texts: list[list[str]], y: np.ndarray, n_classes: int, *, bits: int, dim: int, epochs: int, rate: float, max_error: float,
        seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """(embeddings, weights, bias, rejection score) with the calibration in weights and bias; a text is a list of spans."""
    held = np.random.default_rng([seed, 1]).random(len(y)) < 0.2
    if held.all() or len(y) < 20:
        held[:] = False

    def examples(rows: np.ndarray) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
        found, of = [], []
        for i in rows:
            for span in texts[i]:
                idx, n = np.unique(subwords(span, bits), return_counts=True)
                if len(idx):
                    found.append((idx.astype(np.int32), (n / n.sum()).astype(np.float32)))
                    of.append(y[i])
        return found, np.array(of, np.int64)
    x, own = examples(np.flatnonzero(~held))
    e, w, b = train(x, own, n_classes, bits, dim, epochs, rate, seed)
    x, own = examples(np.flatnonzero(held))
    z = np.array([(share @ e[idx]) @ w + b for idx, share in x]).reshape(len(x), n_classes)
    scale, least = calibrate(z, own, max_error)
    return e, w * np.float32(scale), b * np.float32(scale), least


def learn(docs: DataFrame, *, rows: int = 4000, spans: int = 3, span_chars: int = 800, bits: int = 15, dim: int = 16,
          epochs: int = 3, rate: float = 0.5, max_error: float = 0.01, seed: int = 5, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang") -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, float]:
    """(languages, embeddings, weights, bias, rejection score) from ``rows`` rows at most, as many of each language (one at least).

    A language's rows are those whose hash of id and text is smallest: a threshold by its count leaves about
    twice as many as are wanted, of which only the spans move on to be ranked. Rows with a null language or
    text are left out.
    """
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"), F.xxhash64(id_col, text_col).alias("h"))
    counts = known.groupBy("lang").agg(F.count("*").alias("n"))
    n_langs = counts.count()
    each = max(rows // max(n_langs, 1), 1)
    share = F.shiftrightunsigned("h", 11) / F.lit(float(1 << 53))       # in [0, 1), uniform
    # one row a language: broadcast if they are counted to be few
    likely = (known.join(F.broadcast(counts) if n_langs <= 10_000 else counts, "lang")
              .where(share * F.col("n") < 2 * each + 200).select("lang", "text", "h"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch, "text"):
                found = [spans_of(t, spans, span_chars) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("lang"), part.column("h"), pa.array(found, pa.list_(pa.string()))],
                                                 names=["lang", "h", "spans"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            table = pa.Table.from_batches(held).sort_by([("lang", "ascending"), ("h", "ascending")])
            langs = sorted(set(table.column("lang").to_pylist()))
            y = np.array([langs.index(v) for v in table.column("lang").to_pylist()])
            e, w, b, least = fit(table.column("spans").to_pylist(), y, len(langs), bits=bits, dim=dim, epochs=epochs, rate=rate,
                                 max_error=max_error, seed=seed)
            yield pa.RecordBatch.from_arrays([pa.array([langs], pa.list_(pa.string())), *(pa.array([m.tobytes()], pa.binary()) for m in (e, w, b)),
                                              pa.array([least])], names=["langs", "e", "w", "b", "least"])
    first = F.row_number().over(Window.partitionBy("lang").orderBy("h", "spans"))
    chosen = likely.mapInArrow(cut, "lang string, h long, spans array<string>").withColumn("place", first).where(F.col("place") <= each)
    model = (chosen.drop("place").repartition(1)
             .mapInArrow(run, "langs array<string>, e binary, w binary, b binary, least double").first())
    if model is None:
        return [], np.zeros((1 << bits, 0), np.float32), np.zeros((0, 0), np.float32), np.zeros(0, np.float32), 1.0
    n = len(model["langs"])
    e, w, b = (np.frombuffer(model[k], np.float32) for k in ("e", "w", "b"))
    return list(model["langs"]), e.reshape(1 << bits, dim), w.reshape(dim, n), b, model["least"]


def identify(docs: DataFrame, labelled: DataFrame, *, text_col: str = "text", bits: int = 15, **options) -> DataFrame:
    """The documents with ``lang_pred``, ``score`` (0 to 1) and ``rejected``.

    ``labelled`` has the rows to learn from (see ``learn`` for its options). ``lang_pred`` is a learned
    language, or ``und`` with score 0, rejected, for a null text, a text without a letter and if nothing could
    be learnt. ``rejected`` is true where the score is below the calibrated one; the prediction stays, so that
    callers decide. Ties go to the language first in order. Repeated rows are each returned. All columns are
    kept, the added ones replace columns of their names; an empty table gives an empty one.
    """
    langs, e, w, b, least = learn(labelled, text_col=text_col, bits=bits, **options)
    known = docs.select(*[c for c in docs.columns if c not in ("lang_pred", "score", "rejected")])
    schema = T.StructType([*known.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                           T.StructField("rejected", T.BooleanType())])
    # the mean is linear: with fewer languages than dimensions, rows of logits are added up instead
    table, after = (e @ w, None) if len(langs) <= e.shape[1] else (e, w)
    model = docs.sparkSession.sparkContext.broadcast((np.ascontiguousarray(table), after, b))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table_, after_, b_ = model.value
        for batch in batches:
            for part in by_bytes(batch, text_col, _SLICE_BYTES):
                texts = [t or "" for t in part.column(text_col).to_pylist()]
                total, count = sums(texts, table_, bits)
                found = np.array([has_letter(t) for t in texts], bool) & bool(langs)
                best, score = np.zeros(len(texts), np.int64), np.zeros(len(texts))
                if found.any():
                    mean = total[found] / np.maximum(count[found], 1)[:, None]
                    p = softmax((mean @ after_ if after_ is not None else mean) + b_)
                    best[found], score[found] = p.argmax(axis=1), p.max(axis=1)
                named = [langs[k] if ok else "und" for k, ok in zip(best.tolist(), found.tolist())]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(named, pa.string()), pa.array(score),
                                                  pa.array(~found | (score < least))], names=schema.names)
    return known.mapInArrow(run, schema)
