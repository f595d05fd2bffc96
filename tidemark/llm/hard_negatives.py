"""Hard negatives by coordinate pruning in length buckets (operator 13).

Anchors are searched against all rows by inner product, as LEMP does. Rows are dealt by
length into buckets and those into blocks of a bounded size. A block holds its unit vectors
and, for each coordinate that some anchor asks for, the list of its values in order. For an
anchor and a lower bound ``t`` of the scores wanted, a row of a bucket whose greatest length is
``l`` can reach ``t`` only if its angle to the anchor is at most ``tau = acos(t / (|anchor| l))``.
Then, in every coordinate, its angle to the axis lies within ``tau`` of the anchor's own, which is
a range of values. The ranges of the anchor's largest coordinates (its focus) are looked up in
the ordered lists, the rows in all of them are candidates, and candidates are verified by
their exact integer scores. A block whose ``t`` no length reaches is skipped unread, before
anything is shipped to it where ``t`` is known by then.

In a block the rows nearest in the first focus coordinate are verified first; the scores found
raise ``t`` for the rest. Pruning never loses a row: bounds are widened by more than the
rounding, and a bound that prunes nothing (``t`` of zero or below) reads the whole block.

The first search finds each anchor's best rows of its own label, the second the best rows of
other labels within the band that each of those sets. Blocks return at most as many rows as are
wanted, and lists are merged by (score, id). Anchors are a stated share of the rows, so the number
of scores grows with the square of the table, in blocks of bounded memory.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import staged, unstage
from tidemark.llm.vectors import finite, integers, peak

#: widens every bound by more than doubles lose
_SLACK = 1e-9
#: rows of a block that are verified before its lists are read
_WARM = 64


def _matrix(table: pa.Table, name: str) -> np.ndarray:
    flat = table.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(table.num_rows, len(flat) // max(table.num_rows, 1))


class Block:
    """Rows of one length bucket: unit vectors, ordered coordinate lists, exact scores."""

    def __init__(self, x: np.ndarray):
        self.x, self.lists = x, {}
        self.peak = peak(x)
        self.floats = x.astype(float)
        lengths = np.sqrt((self.floats * self.floats).sum(axis=1))
        self.longest = float(lengths.max(initial=0.0))
        self.unit = self.floats / np.where(lengths > 0, lengths, 1.0)[:, None]

    def ordered(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        """Values of a coordinate in order, and whose they are."""
        if f not in self.lists:
            at = np.argsort(self.unit[:, f], kind="stable").astype(np.int32)
            self.lists[f] = self.unit[at, f], at
        return self.lists[f]

    def scores(self, q: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Exact inner products."""
        bound = peak(q) * self.peak * max(len(q), 1)
        if bound < 1 << 53:
            return np.rint(self.floats[at] @ q.astype(float)).astype(np.int64)
        if bound < 1 << 63:
            return self.x[at] @ q
        out = self.x[at].astype(object) @ q.astype(object)
        if len(out) and max(map(abs, out.tolist())) >= 1 << 63:
            raise OverflowError("an inner product does not fit into a long")
        return out.astype(np.int64)

    def focus(self, q: np.ndarray, size: int) -> np.ndarray:
        """The coordinates in which the anchor is largest."""
        return np.argsort(-np.abs(q), kind="stable")[:size]

    def ranges(self, u: np.ndarray, cosine: float, focus: np.ndarray) -> list[tuple[int, int]]:
        """Where in the ordered lists the values lie that a row within the angle can have."""
        tau = np.arccos(min(max(cosine, -1.0), 1.0)) + _SLACK
        own = np.arccos(np.clip(u[focus], -1.0, 1.0))
        low, high = np.cos(np.minimum(own + tau, np.pi)) - _SLACK, np.cos(np.maximum(own - tau, 0.0)) + _SLACK
        return [tuple(np.searchsorted(self.ordered(f)[0], (a, b), side="left")) for f, a, b in zip(focus.tolist(), low, high)]

    def nearest(self, u: np.ndarray, f: int) -> np.ndarray:
        """Rows around the anchor's place in a coordinate list."""
        values, at = self.ordered(f)
        k = int(np.searchsorted(values, u[f]))
        start = max(min(k - _WARM // 2, len(at) - _WARM), 0)
        return at[start:start + _WARM]

    def candidates(self, q: np.ndarray, least: int, focus: np.ndarray) -> np.ndarray | None:
        """Rows that may score ``least``: a mask, or None for every row."""
        length = float(np.sqrt((q.astype(float) ** 2).sum()))
        if least <= 0:
            return None
        reach = length * self.longest
        if reach * (1 + _SLACK) < least:
            return np.zeros(len(self.x), bool)
        u = q / length
        hits, n = np.zeros(len(self.x), np.uint8), 0
        for f, (a, b) in zip(focus.tolist(), self.ranges(u, least / reach, focus)):
            if b - a < len(self.x):
                hits[self.ordered(f)[1][a:b]] += 1
                n += 1
        return hits == n if n else None


def search(block: Block, ids: np.ndarray, labels: np.ndarray, q: np.ndarray, own_id: int, own_label: int, low: np.ndarray, high: np.ndarray,
           wanted: int, same: bool, focus_size: int) -> list[tuple[int, int, int]]:
    """(band, row, score) of the best ``wanted`` rows of every band ``low <= score <= high``, by score, then id.

    ``same`` asks for rows of the anchor's label under another id, else rows of other labels.
    """
    if not len(ids):
        return []
    allowed = (labels == own_label) & (ids != own_id) if same else labels != own_label
    focus = block.focus(q, focus_size)
    kept: list[list[tuple[int, int, int]]] = [[] for _ in low]
    tested = np.zeros(len(ids), bool)

    def verify(at: np.ndarray) -> None:
        tested[at] = True
        at = at[allowed[at]]
        s = block.scores(q, at)
        for b, best in enumerate(kept):
            fits = (s >= low[b]) & (s <= high[b])
            if len(best) == wanted:
                fits &= s >= -best[-1][0]
            found, score = at[fits], s[fits]
            if len(found) > wanted:         # ids settle ties, so all rows of the last score stay
                cut = np.partition(score, -wanted)[-wanted]
                found, score = found[score >= cut], score[score >= cut]
                order = np.lexsort((ids[found], -score))[:wanted]
                found, score = found[order], score[order]
            best += [(-int(v), int(ids[r]), int(r)) for r, v in zip(found, score)]
            best.sort()
            del best[wanted:]

    if len(focus):
        length = float(np.sqrt((q.astype(float) ** 2).sum()))
        verify(block.nearest(q / length if length else q.astype(float), int(focus[0])))
    least = min(max(int(a), -best[-1][0]) if len(best) == wanted else int(a) for a, best in zip(low, kept))
    rest = block.candidates(q, least, focus)
    verify(np.flatnonzero(~tested if rest is None else rest & ~tested))
    return [(b, r, -s) for b, best in enumerate(kept) for s, _, r in best]


def _blocks(rows: DataFrame, key: list[str], block_rows: int, n_buckets: int) -> tuple[DataFrame, DataFrame]:
    """Rows with their length bucket and block, and one row a bucket: key, bucket, longest squared length, blocks."""
    cuts = rows.agg(F.percentile_approx("norm2", [i / n_buckets for i in range(1, n_buckets)], 1000).alias("cuts")).first()["cuts"]
    cuts = sorted(set(cuts or []))
    bucket = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c < F.col("norm2"))) if cuts else F.lit(0)
    dealt = rows.withColumn("bucket", bucket.cast("int"))
    sizes = staged(dealt.groupBy(*key, "bucket").agg(F.max("norm2").alias("longest2"), F.ceil(F.count("*") / block_rows).cast("int").alias("blocks")), "buckets")
    spread = F.pmod(F.xxhash64("id", "x"), F.col("blocks")).cast("int")
    return dealt.join(sizes.drop("longest2"), [*key, "bucket"]).withColumn("block", spread).drop("blocks"), sizes


def _find(rows: DataFrame, anchors: DataFrame, key: list[str], *, wanted: int, same: bool, focus: int, block_rows: int,
          anchor_rows: int, n_buckets: int, least: Column) -> DataFrame:
    """(id, x, label, band, found, score): what every block found for its anchors, staged.

    ``anchors`` has ``low`` and ``high``, the bands of each; ``least``: the smallest score that an
    anchor asks for, null if there is none.
    """
    dealt, sizes = _blocks(rows, key, block_rows, n_buckets)
    # anchors too come in blocks of a bounded size; rows are sent once to each of those
    n_anchors = anchors.count()
    parts = max(1, -(-n_anchors // anchor_rows))
    to_rows = dealt.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    reach2 = F.col("norm2") * F.col("longest2") * (1 + 4 * _SLACK)
    near = least.isNull() | (least <= 0) | (reach2 >= least.cast("double") * least)
    to_anchors = (anchors.join(sizes, key).where(near)
                  .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                  .withColumn("part", F.pmod(F.xxhash64("id", "x"), F.lit(parts)).cast("int")))
    place = F.struct(*key, "bucket", "block", "part").alias("place")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int, int]] = []
        if left.num_rows and right.num_rows:
            # rows in a fixed order, so a task that runs again returns the same
            left = left.sort_by("id")
            block = Block(_matrix(left, "x"))
            coded = left.column("label").combine_chunks().dictionary_encode()
            ids, labels = left.column("id").to_numpy(), coded.indices.to_numpy()
            code = {v: c for c, v in enumerate(coded.dictionary.to_pylist())}
            queries = _matrix(right, "x")
            own_ids, own_labels = right.column("id").to_numpy(), [code.get(v, -1) for v in right.column("label").to_pylist()]
            lows, highs = right.column("low").to_pylist(), right.column("high").to_pylist()
            for k in range(right.num_rows):
                for b, r, s in search(block, ids, labels, queries[k], own_ids[k], own_labels[k], np.array(lows[k], np.int64),
                                      np.array(highs[k], np.int64), wanted, same, focus):
                    out.append((k, b, int(ids[r]), s))
        k, b, r, s = (np.array(c, np.int64) for c in zip(*out)) if out else (np.zeros(0, np.int64),) * 4
        got = right.select(["id", "x", "label"]).take(pa.array(k))
        for name, values in (("band", b.astype(np.int32)), ("found", r), ("score", s)):
            got = got.append_column(name, pa.array(values))
        return got
    found = to_rows.select(place, "id", "x", "label").groupBy("place").cogroup(
        to_anchors.select(place, "id", "x", "label", "low", "high").groupBy("place")).applyInArrow(
        run, "id long, x array<long>, label string, band int, found long, score long")
    out = staged(found, "found")
    unstage(sizes.staged_path)
    return out


def _first(found: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows of every anchor and band, with their ``rank``; a group holds a few rows a block."""
    w = Window.partitionBy("id", "x", "label", "band").orderBy(F.desc("score"), "found")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def mine(df: DataFrame, is_anchor: Column, *, positives: int = 5, negatives: int = 3, least: int = 50, most: int = 95, scale: int = 256,
         focus: int = 4, block_rows: int = 16384, anchor_rows: int = 4096, n_buckets: int = 8, id_col: str = "vec_id",
         vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per anchor, positive and hard negative: ``anchor_id``, ``positive_id``, ``rank``, ``negative_id``,
    ``positive_score``, ``negative_score``.

    Anchors are the rows where ``is_anchor`` (over the columns of ``df``) is true. Components
    become ``floor(scale * x)``; the score of a row is its inner product with the anchor, higher
    first, ties by the smaller id. Positives are the first ``positives`` rows of the anchor's label under
    another id; negatives are the first ``negatives`` of the rows of other labels whose score is from
    ``least`` to ``most`` hundredths of the positive's. A negative positive score has none.

    Rows with a null id, a null label, a null vector or a null or non-finite component take no
    part; vectors are compared with those of their own length, an empty one scores 0. Equal
    anchor rows give one result; other rows that repeat are rows of their own. A score beyond a
    long raises OverflowError. Other columns are not read; an empty table gives an empty result.
    """
    taking = F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & finite(vec_col)
    rows = df.where(taking).select(F.col(id_col).cast("long").alias("id"), integers(vec_col, scale).alias("x"),
                                   F.col(label_col).cast("string").alias("label"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    norm2 = F.aggregate("x", F.lit(0.0), lambda s, v: s + v.cast("double") * v)
    rows = staged(rows.withColumn("norm2", norm2).withColumn("size", F.size("x")), "mine-rows")
    anchors = staged(rows.where("anchor").select("id", "x", "label", "norm2", "size").distinct(), "mine-anchors")
    options = dict(focus=focus, block_rows=block_rows, anchor_rows=anchor_rows, n_buckets=n_buckets)

    any_score = F.array(F.lit(-(1 << 63) + 1)), F.array(F.lit((1 << 63) - 1))
    best = _find(rows, anchors.withColumns({"low": any_score[0], "high": any_score[1]}), ["size", "label"], wanted=positives, same=True,
                 least=F.lit(None).cast("long"), **options)
    own = staged(_first(best, positives).select("id", "x", "label", F.col("rank").alias("place"), F.col("found").alias("positive_id"),
                                                F.col("score").alias("positive_score")), "mine-positives")
    # the bands of an anchor's positives, in the order of its positives; products as decimals, so that none overflows
    s = F.col("positive_score").cast("decimal(19,0)")
    low, high = F.ceil(s * least / 100).cast("long"), F.floor(s * most / 100).cast("long")
    band = F.struct("place", low.alias("low"), high.alias("high"))
    bands = (own.where("positive_score >= 0").groupBy("id", "x", "label").agg(F.array_sort(F.collect_list(band)).alias("bands"))
             .select("id", "x", "label", F.col("bands.low").alias("low"), F.col("bands.high").alias("high"), F.col("bands.place").alias("places")))
    asked = staged(bands.join(anchors, ["id", "x", "label"]), "mine-bands")
    worst = _find(rows, asked.drop("places"), ["size"], wanted=negatives, same=False, least=F.array_min("low"), **options)
    ranked = _first(worst, negatives).join(asked.select("id", "x", "label", "places"), ["id", "x", "label"])
    out = staged(ranked.withColumn("place", F.get("places", F.col("band"))).join(own, ["id", "x", "label", "place"]).select(
        F.col("id").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"), F.col("found").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score")), "mine-out")
    for t in (rows, anchors, best, own, asked, worst):
        unstage(t.staged_path)
    return out
