"""Near-duplicate embeddings by a subspace pigeonhole join (operator 3).

Unit vectors are rotated by one orthogonal matrix and split into blocks. If two vectors lie
within squared distance ``2 - 2 * cosine``, at least one block has no more than its
proportional share of that. So each block is range-joined on its own: vectors are dealt to
the cells of a grid over the block's first coordinates, as wide as the block's radius, and
only cells that touch are compared: first the block's distance, then, for what passes, the
cosine in double precision. A pair belongs to the first block that finds it, so the union
over blocks needs no deduplication.

Equal vectors are one class with a count before anything else. The classes of a label are
split by hash into strips of a bounded number of bytes; a task takes one strip or two and
joins all blocks of them, so a vector is shuffled once for each strip of its label, however
many blocks and cells there are. A task returns the number of links of each class and a
spanning forest of its links, never the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from tidemark.llm.common import components, staged, unstage

#: pairs that are tested at once
_PAIRS = 1 << 19
#: two cells with more pairs than this are tested as a matrix, others pair by pair
_DENSE = 1 << 14
#: rows and columns of such a matrix
_TILE = 1024


def rotation(size: int, seed: int) -> np.ndarray:
    """Random orthogonal matrix, the same for the same arguments."""
    q, r = np.linalg.qr(np.random.default_rng([seed, size]).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def _unit(table: pa.Table) -> np.ndarray:
    flat = table.column("vec").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    v = flat.reshape(table.num_rows, -1)
    # scaled first, so that no square overflows or vanishes
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _spans(size: int, n_blocks: int) -> list[slice]:
    edges = [size * k // n_blocks for k in range(n_blocks + 1)]
    return [slice(a, b) for a, b in zip(edges, edges[1:]) if b > a]


class Pairs:
    """Links between the rows of two strips, or (``right`` None) among those of one.

    ``tests`` counts the pairs whose distance was computed in the block that proposed them.
    """

    def __init__(self, left: np.ndarray, right: np.ndarray | None, n_blocks: int, grid: int, cosine: float, seed: int):
        self.own, self.cosine, self.tests = right is None, cosine, 0
        self.u = left
        self.v = left if right is None else right
        size = left.shape[1]
        q = rotation(size, seed)
        self.ru = left @ q
        self.rv = self.ru if right is None else right @ q
        self.spans, self.grid = _spans(size, n_blocks), grid
        # each block's share of the squared distance, by its width
        self.budgets = [(2 - 2 * cosine) * (s.stop - s.start) / size + 1e-12 for s in self.spans]

    def _cells(self, b: int) -> tuple[list, list]:
        """Codes of the cells that are met, where the rows of each begin, and the rows by cell; for both sides."""
        s = self.spans[b]
        axes = slice(s.start, min(s.stop, s.start + self.grid))
        width = math.sqrt(self.budgets[b]) * (1 + 1e-9)
        # a linear code: the cell an offset away has a code that far away; two cells that share one only cost tests
        factor = self._factors(axes.stop - axes.start)
        sides = []
        for x in (self.ru,) if self.own else (self.ru, self.rv):
            code = (np.floor(x[:, axes] / width).astype(np.int64) * factor).sum(axis=1)
            order = np.argsort(code, kind="stable")
            cells, first = np.unique(code[order], return_index=True)
            sides.append([cells, np.append(first, len(code)), order])
        return sides[0], sides[-1]

    @staticmethod
    def _factors(n: int) -> np.ndarray:
        return np.array([pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) for k in range(n)], np.uint64).astype(np.int64)

    def _near_pairs(self, b: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        s = self.spans[b]
        return ((self.ru[i, s] - self.rv[j, s]) ** 2).sum(axis=1) <= self.budgets[b]

    def _near_tile(self, b: int, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
        """Which pairs are within block ``b``'s budget; borderline ones are tested term by term."""
        s, budget = self.spans[b], self.budgets[b]
        x, y = self.ru[rows, s], self.rv[cols, s]
        d = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1) - 2 * (x @ y.T)
        near = d <= budget
        i, j = np.nonzero(np.abs(d - budget) < 1e-11)
        near[i, j] = self._near_pairs(b, rows[i], cols[j])
        return near

    def _confirm_pairs(self, b: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        self.tests += len(i)
        for test in (lambda: self._near_pairs(b, i, j), lambda: (self.u[i] * self.v[j]).sum(axis=1) >= self.cosine,
                     *[lambda c=c: ~self._near_pairs(c, i, j) for c in range(b)]):
            if not len(i):
                break
            ok = test()
            i, j = i[ok], j[ok]
        return i, j

    def _confirm_tile(self, b: int, rows: np.ndarray, cols: np.ndarray, half: bool) -> tuple[np.ndarray, np.ndarray]:
        ok = self._near_tile(b, rows, cols)
        if half:
            ok &= rows[:, None] < cols
        self.tests += int((rows[:, None] < cols).sum()) if half else ok.size
        for c in range(b):
            if not ok.any():
                break
            ok &= ~self._near_tile(c, rows, cols)
        if ok.any():
            cos = self.u[rows] @ self.v[cols].T
            i, j = np.nonzero(ok & (np.abs(cos - self.cosine) < 1e-12))
            exact = (self.u[rows[i]] * self.v[cols[j]]).sum(axis=1) >= self.cosine
            ok &= cos >= self.cosine
            ok[i, j] = exact
        i, j = np.nonzero(ok)
        return rows[i], cols[j]

    def links(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Left and right rows of the links, each link once, a bounded number at a time."""
        for b in range(len(self.spans)):
            (codes, first, order), (codes_r, first_r, order_r) = self._cells(b)
            axes = min(self.grid, self.spans[b].stop - self.spans[b].start)
            zero = (0,) * axes
            for offset in product((-1, 0, 1), repeat=axes):
                # within one strip half of the cells around will do: each two cells meet once
                if self.own and offset < zero:
                    continue
                half = self.own and offset == zero
                want = codes + (np.array(offset, np.int64) * self._factors(axes)).sum()
                at = np.minimum(np.searchsorted(codes_r, want), len(codes_r) - 1)
                mine = np.flatnonzero(codes_r[at] == want)
                at = at[mine]
                rows, cols = first[mine + 1] - first[mine], first_r[at + 1] - first_r[at]
                dense = rows * cols > _DENSE
                for k in np.flatnonzero(dense):
                    left, right = order[first[mine[k]]:first[mine[k] + 1]], order_r[first_r[at[k]]:first_r[at[k] + 1]]
                    for x in range(0, len(left), _TILE):
                        for y in range(x if half else 0, len(right), _TILE):
                            yield self._confirm_tile(b, left[x:x + _TILE], right[y:y + _TILE], half)
                keep = ~dense
                n = (rows * cols)[keep]
                if not len(n):
                    continue
                starts, starts_r, wide = first[mine][keep], first_r[at][keep], cols[keep]
                # as many pairs of cells at a time as make _PAIRS pairs of rows
                cuts = np.unique(np.append(np.searchsorted(np.cumsum(n), np.arange(0, n.sum(), _PAIRS)), len(n)))
                for x, y in zip(cuts, cuts[1:]):
                    part = n[x:y]
                    cell = np.repeat(np.arange(x, y), part)
                    place = np.arange(len(cell)) - np.repeat(np.cumsum(part) - part, part)
                    i, j = order[starts[cell] + place // wide[cell]], order_r[starts_r[cell] + place % wide[cell]]
                    if half:
                        i, j = i[i < j], j[i < j]
                    yield self._confirm_pairs(b, i, j)


class _Forest:
    """Links that join rows not joined before."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def root(self, x: int) -> int:
        p = self.parent
        while p[x] != x:
            p[x] = p[p[x]]
            x = p[x]
        return int(x)

    def add(self, i: np.ndarray, j: np.ndarray) -> Iterator[tuple[int, int]]:
        """The links that join two trees, in the order given."""
        while len(i):
            # shorten all paths first, so that only links between trees are left
            p = self.parent
            while (p[p] != p).any():
                p[:] = p[p]
            apart = p[i] != p[j]
            i, j = i[apart], j[apart]
            for a, b in zip(i[:4096].tolist(), j[:4096].tolist()):
                x, y = self.root(a), self.root(b)
                if x != y:
                    p[y] = x
                    yield a, b
            i, j = i[4096:], j[4096:]


def link_vectors(df: DataFrame, *, cosine: float = 0.98, n_blocks: int = 8, grid: int = 4, strip: int = 16_384,
                 strip_bytes: int = 8 << 20, seed: int = 7, id_col: str = "vec_id", vec_col: str = "embedding",
                 label_col: str | None = "label") -> DataFrame:
    """One row per input row: id, ``n_links``, ``component_id``, ``kept``.

    Vectors are compared if their labels are equal and not null (all, without a label
    column) and their sizes are equal. Null, empty and zero vectors and those with null or
    non-finite components link with nothing: no links, a component of their own. Rows with a
    null id are left out of links and get null component and ``kept`` false. Rows that
    repeat an id with an equal vector count as one vector and are each returned. Other
    columns are not read; an empty table gives an empty one. A strip has at most about
    ``strip`` rows and ``strip_bytes`` bytes of components (16 rows at least).
    """
    if not 0 < cosine <= 1:
        raise ValueError("cosine must be over 0 and at most 1")
    vec = F.col("vec")
    label = F.col(label_col).cast("string") if label_col else F.lit("")
    good = (F.col("id").isNotNull() & F.col("label").isNotNull() & vec.isNotNull() & (F.size(vec) > 0)
            & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists(vec, lambda x: x != 0))
    double = F.transform(vec, lambda x: x.cast("double") + F.lit(0.0))
    single = isinstance(df.schema[vec_col].dataType.elementType, FloatType)
    # components of four bytes are shuffled as such, others as doubles
    rows = df.select(F.col(id_col).alias("id"), label.alias("label"),
                     (F.col(vec_col) if single else F.transform(vec_col, lambda x: x.cast("double"))).alias("vec"))
    rows = rows.select("id", "label", "vec", F.coalesce(good, F.lit(False)).alias("good"),
                       F.xxhash64("label", double).alias("h1"), F.xxhash64(F.lit(1), double, "label").alias("h2"))
    # classes of equal vectors: their smallest id and how many ids they have; both sides are grouped alike, so the join moves nothing
    fine = rows.where("good")
    ids = fine.select("h1", "h2", "id").distinct().groupBy("h1", "h2").agg(F.min("id").alias("cls"), F.count("*").alias("n"))
    vectors = fine.groupBy("h1", "h2").agg(F.first("label").alias("label"), F.first("vec").alias("vec"))
    classes = staged(ids.hint("merge").join(vectors, ["h1", "h2"]), "classes")

    placed = classes.select("cls", "n", "label", F.size("vec").alias("size"), "vec")
    most = F.least(F.lit(strip), F.greatest(F.lit(16), F.floor(F.lit(strip_bytes) / (8 * F.col("size")))))
    sizes = staged(placed.groupBy("label", "size").agg(F.count("*").alias("rows")).where("rows > 1")
                   .select("label", "size", F.ceil(F.col("rows") / most).cast("int").alias("strips")), "sizes")
    tasks = (placed.join(sizes, ["label", "size"])
             .withColumn("mine", F.pmod(F.xxhash64("cls"), "strips").cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("strips") - 1)))
             .select("cls", "n", "vec", "label", "size", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
                     (F.col("mine") <= F.col("other")).alias("left")))

    def compare(table: pa.Table) -> pa.Table:
        own = table.column("i")[0] == table.column("j")[0]
        left = table if own else table.filter(table.column("left"))
        right = table if own else table.filter(pa.compute.invert(table.column("left")))
        out: list[tuple] = []
        if left.num_rows and right.num_rows:
            ids_l, ids_r = left.column("cls").to_numpy(), right.column("cls").to_numpy()
            n_l, n_r = left.column("n").to_numpy(), right.column("n").to_numpy()
            pairs = Pairs(_unit(left), None if own else _unit(right), n_blocks, grid, cosine, seed)
            got_l, got_r = np.zeros(len(ids_l), np.int64), np.zeros(len(ids_r), np.int64)
            forest, past = _Forest(len(ids_l) if own else len(ids_l) + len(ids_r)), 0 if own else len(ids_l)
            for i, j in pairs.links():
                np.add.at(got_l, i, n_r[j])
                np.add.at(got_r, j, n_l[i])
                out += [(int(ids_l[x]), int(ids_r[y - past]), 0) for x, y in forest.add(i, j + past)]
            for ids_, got in ((ids_l, got_l), (ids_r, got_r)):
                out += [(int(ids_[x]), None, int(got[x])) for x in np.flatnonzero(got)]
        a, b, n = zip(*out) if out else ((), (), ())
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(n, pa.int64())], names=["a", "b", "n"])

    found = staged(tasks.groupBy("label", "size", "i", "j").applyInArrow(compare, "a long, b long, n long"), "found")
    roots = components(found.where("b IS NOT NULL"))
    linked = found.where("b IS NULL").groupBy("a").agg(F.sum("n").alias("others"))
    result = staged(classes.select("h1", "h2", "cls", "n")
                    .join(linked.withColumnRenamed("a", "cls"), "cls", "left").join(roots.withColumnRenamed("v", "cls"), "cls", "left")
                    .select("h1", "h2", (F.coalesce("others", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                            F.coalesce("root", "cls").alias("component_id"), F.lit(True).alias("good")), "result")
    for t in (sizes, found, classes):
        unstage(t.staged_path)
    out = rows.select("id", "good", "h1", "h2").join(result, ["h1", "h2", "good"], "left")
    component = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
