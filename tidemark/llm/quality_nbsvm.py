"""Quality classifier: support vectors on naive Bayes features (operator 4).

Features are indicators of hashed word n-grams. Each is scaled by its class log-count ratio
``r = log((p / |p|) / (q / |q|))`` with smoothed counts ``p`` and ``q`` of the texts of either
class that hold it; a linear hinge-loss model is fitted on the scaled indicators by dual
coordinate descent, and its weights are drawn towards their mean magnitude. The margin
becomes a probability by a logistic fit on texts that the model has not seen.

The fit takes a bounded sample of labelled rows (``sample``: the rows whose hashed ids are
smallest, and of these the first whose n-grams number ``sample_features`` at most) and runs
in one task, whose memory those bounds limit. Every text is scored whole,
where it is, with the broadcast weights (their size is fixed by ``bits``).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import by_bytes

_ODD = np.uint64(0x9E3779B97F4A7C15)
_AT_ONCE = 1 << 20


class _Hashes(dict):
    """Word -> hashes of its lower-case form and of its shape, kept for frequent use."""

    def __missing__(self, word: bytes) -> tuple[int, int]:
        shape = _RUN.sub(rb"\1", word.translate(_SHAPE))[:8]
        pair = xxhash.xxh64_intdigest(word.lower()), xxhash.xxh64_intdigest(shape, 1)
        if len(self) >= 100_000:
            self.clear()
        if len(word) <= 40:
            self[word] = pair
        return pair


_HASHES = _Hashes()
# letters, capitals, digits and bytes beyond ASCII as one sign each, runs made single
_SHAPE = bytes(97 if 97 <= c <= 122 or c >= 128 else 65 if 65 <= c <= 90 else 48 if 48 <= c <= 57 else c for c in range(256))
_RUN = re.compile(rb"(.)\1+", re.S)


def features(text: str | None, bits: int = 18) -> np.ndarray:
    """Sorted bucket numbers of the distinct n-grams of a text.

    Words are runs between ASCII white space. The n-grams are words and pairs of words,
    ASCII capitals lowered; shapes and pairs of shapes; and the pair of a word with itself,
    by the share of such pairs. A text without words has no features.
    """
    words = (text or "").encode().split()
    down, out, same = np.uint64(64 - bits), [], 0
    for k in range(0, len(words), _AT_ONCE):
        part = words[k:k + _AT_ONCE + 1]
        both = np.array([_HASHES[w] for w in part], np.uint64)
        for h in both.T:
            pairs = (h[:-1] * _ODD) ^ (h[1:] + (h[:-1] >> np.uint64(7)))
            out.append(np.unique(np.concatenate([h * _ODD >> down, pairs * _ODD >> down])))
        same += int((both[1:, 0] == both[:-1, 0]).sum())
    if not out:
        return np.zeros(0, np.int32)
    share = np.array([10 * same // len(words) + 1 if same else 0], np.uint64)
    out.append((share + np.uint64(1 << 40)) * _ODD >> down)
    return np.unique(np.concatenate(out)).astype(np.int32)


def log_count_ratios(rows: list[np.ndarray], y: np.ndarray, n: int, smooth: float = 1.0) -> np.ndarray:
    counts = np.full((2, n), smooth)
    for x, label in zip(rows, y):
        counts[int(label > 0), x] += 1
    q, p = counts
    r = np.log(p / p.sum()) - np.log(q / q.sum())
    r[(p == smooth) & (q == smooth)] = 0    # n-grams of no labelled text say nothing
    return r


def dual_descent(rows: list[np.ndarray], y: np.ndarray, scale: np.ndarray, cost: np.ndarray, epochs: int, seed: int) -> tuple[np.ndarray, float]:
    """Weights and bias of min |w|^2 / 2 + sum(cost * max(0, 1 - y (w x + b)))."""
    w, b = np.zeros(len(scale)), 0.0
    values = [scale[x] for x in rows]
    q = np.array([v @ v + 1.0 for v in values])
    alpha = np.zeros(len(rows))
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in order.permutation(len(rows)):
            x, v = rows[i], values[i]
            g = y[i] * (w[x] @ v + b) - 1
            new = min(max(alpha[i] - g / q[i], 0.0), cost[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w[x] += step * v
                b += step
                moved = max(moved, abs(new - alpha[i]) * np.sqrt(q[i]))
                alpha[i] = new
        if moved < 1e-3:
            break
    return w, b


def logistic_fit(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(a, b) of P(y = 1) = 1 / (1 + exp(-(a * margin + b))), by damped Newton steps."""
    a, b = 0.0, 0.0
    n1, n0 = (y > 0).sum(), (y <= 0).sum()
    t = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        g = np.array([((p - t) * margin).sum() + 1e-3 * a, (p - t).sum()])
        s = np.maximum(p * (1 - p), 1e-6)
        h = np.array([[(s * margin * margin).sum() + 1e-3, (s * margin).sum()], [(s * margin).sum(), s.sum() + 1e-9]])
        da, db = np.linalg.solve(h, g)
        size = max(1.0, np.hypot(da, db) / 2)
        a, b = a - da / size, b - db / size
        if abs(da) + abs(db) < 1e-9:
            break
    return float(max(a, 0.0)), float(b)


def fit(rows: list[np.ndarray], labels: np.ndarray, bits: int = 18, *, cost: float = 1.0, epochs: int = 12,
        mix: float = 0.25, seed: int = 11) -> tuple[np.ndarray, float]:
    """Weights of the buckets and bias, so that 1 / (1 + exp(-(sum of weights + bias))) is the score.

    Without labels of both classes the weights are zero and the bias gives the smoothed
    share of label 1.
    """
    n = 1 << bits
    y = np.where(labels > 0, 1.0, -1.0)
    n1 = int((y > 0).sum())
    if not 0 < n1 < len(y):
        return np.zeros(n, np.float32), float(np.log((n1 + 1) / (len(y) - n1 + 1)))

    def model(train: np.ndarray) -> tuple[np.ndarray, float]:
        own, own_y = [rows[i] for i in train], y[train]
        r = log_count_ratios(own, own_y, n)
        # both classes weigh the same
        per = np.where(own_y > 0, len(own_y) / (2 * max((own_y > 0).sum(), 1)), len(own_y) / (2 * max((own_y <= 0).sum(), 1)))
        w, b = dual_descent(own, own_y, r, cost * per, epochs, seed)
        return r * (mix * w + (1 - mix) * np.abs(w).sum() / max((r != 0).sum(), 1)), b
    fold = np.random.default_rng(seed).permutation(len(y)) % 4
    margin, ok = np.zeros(len(y)), np.zeros(len(y), bool)
    held = fold == 0
    if 0 < (y[~held] > 0).sum() < (~held).sum():
        w, b = model(np.flatnonzero(~held))
        margin[held] = [w[rows[i]].sum() + b for i in np.flatnonzero(held)]
        ok = held
    w, b = model(np.arange(len(y)))
    if not ok.any():
        ok[:] = True
        margin = np.array([w[x].sum() + b for x in rows])
    a, c = logistic_fit(margin[ok], y[ok])
    return (a * w).astype(np.float32), a * b + c


def train(docs: DataFrame, labels: DataFrame, *, bits: int = 18, sample: int = 6000, sample_features: int = 1 << 25,
          id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> tuple[np.ndarray, float]:
    """Weights and bias from at most ``sample`` labelled texts, those with the smallest hashed ids.

    In the order of hashed ids, texts are taken as long as their distinct n-grams add up to
    ``sample_features`` at most; one text at least. Ids of equal hash go by id.
    Labels over 0 count as 1. Null ids and labels are left out; an id labelled or stored
    twice counts once, with the smaller label and features.
    """
    chosen = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
              .groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).alias("y"))
              .orderBy(F.xxhash64("id"), "id").limit(sample))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    texts = texts.join(F.broadcast(chosen), "id")       # at most ``sample`` rows

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch, "text"):
                rows = [features(t, bits) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("y"), pa.array(rows, pa.list_(pa.int32()))],
                                                 names=["id", "y", "x"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the rows come by hashed id; what is past the bound is read, not held
        tables, held = [], 0
        for b in batches:
            held_by = held + np.cumsum(pa.compute.list_value_length(b.column("x")).to_numpy(zero_copy_only=False))
            n = int(np.searchsorted(held_by, sample_features, side="right"))
            if not held and not n:
                n = min(1, b.num_rows)
            if n:
                tables.append(pa.RecordBatch.from_arrays([pa.concat_arrays([c.slice(0, n)]) for c in b.columns], names=b.schema.names))
            if b.num_rows:
                held = max(int(held_by[-1]), 1) if n == b.num_rows else sample_features + 1
        x, y = [], np.zeros(0)
        if tables:
            table = pa.Table.from_batches(tables).sort_by("id")
            x = [r.values.to_numpy() for chunk in table.column("x").chunks for r in chunk]
            y = table.column("y").to_numpy().astype(float)
        w, b = fit(x, y, bits)
        yield pa.RecordBatch.from_arrays([pa.array([w.tobytes()], pa.binary()), pa.array([b])], names=["w", "b"])
    kinds = {f.name: f.dataType for f in texts.schema}
    schema = T.StructType([T.StructField("id", kinds["id"]), T.StructField("y", kinds["y"]),
                           T.StructField("x", T.ArrayType(T.IntegerType()))])
    counted = texts.mapInArrow(extract, schema).groupBy("id").agg(F.min("y").alias("y"), F.min("x").alias("x"))
    model = counted.repartition(1).sortWithinPartitions(F.xxhash64("id"), "id").mapInArrow(learn, "w binary, b double").first()
    if model is None:
        return fit([], np.zeros(0), bits)
    return np.frombuffer(model["w"], np.float32), model["b"]


def score(docs: DataFrame, labels: DataFrame, *, train_on: Column | None = None, cutoff: float = 0.3, bits: int = 18,
          sample: int = 6000, sample_features: int = 1 << 25, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """The documents with ``score`` (0 to 1) and ``predicted`` (1 if the score is at least ``cutoff``).

    ``train_on`` limits the label rows that are learnt from. Only the text is scored; a null
    or empty one gets the score of a text without any n-gram. All columns are kept, added
    ones replace columns of the same names; an empty table gives an empty one.
    """
    w, b = train(docs, labels if train_on is None else labels.where(train_on), bits=bits, sample=sample,
                 sample_features=sample_features, id_col=id_col, text_col=text_col, label_col=label_col)
    known = docs.select(*[c for c in docs.columns if c not in ("score", "predicted")])
    schema = T.StructType([*known.schema.fields, T.StructField("score", T.DoubleType())])
    weights = docs.sparkSession.sparkContext.broadcast(w)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w_ = weights.value
        for batch in batches:
            margins = [float(w_[features(t, bits)].sum(dtype=np.float64)) + b for t in
                       (x.as_py() for x in batch.column(text_col))]
            scores = 1 / (1 + np.exp(-np.clip(np.array(margins, float), -700, 700)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=schema.names)
    return known.mapInArrow(run, schema).withColumn("predicted", (F.col("score") >= cutoff).cast("int"))
