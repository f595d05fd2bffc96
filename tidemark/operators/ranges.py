"""Ranges of an order: equal shares of the rows that tasks can take one by one.

Work in order (fills, as-of joins, running sums) is cut into ranges of the order, done in each
on its own and carried across by one row a range. Bounds are tuples of the order columns: a
value of the first that very many rows share is cut at quantiles of the next column among
those rows, and so on. Bounds decide only who does the work, never the result.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: ranges for each shuffle partition, so that hashing them to tasks stays even
RANGES = 4
_EXACT = ("byte", "short", "integer", "long", "float", "double", "boolean", "date", "timestamp", "timestamp_ntz")


def as_number(df: DataFrame, column: str) -> Column | None:
    """A column as a double in the same order, or None for a type that has no such form."""
    kind = df.schema[column].dataType.typeName()
    if kind in ("timestamp", "timestamp_ntz"):
        return F.unix_micros(F.col(column).cast("timestamp")).cast("double")
    if kind == "date":
        return F.unix_date(F.col(column)).cast("double")
    return F.col(column).cast("double") if kind in _EXACT or kind == "decimal" else None


def _cut_further(df: DataFrame, column: str, value: float) -> bool:
    """Rows that share ``value`` as a double share it in truth, so the next column may order them."""
    return df.schema[column].dataType.typeName() in _EXACT and abs(value) < 2 ** 53


def range_bounds(df: DataFrame, order: list[str], n: int) -> list[tuple[float, ...]]:
    """At most about ``n`` bounds of the tuples ``order``, in order; shorter ones end where no column cuts further.

    One aggregation, and one more for each further column while values are shared by more
    rows than a range holds. They are fetched: as many as ranges are asked for, whatever the data.
    """
    numbers = [as_number(df, c) for c in order]
    if numbers[0] is None:
        raise ValueError(f"no ranges of {order[0]}: not a number, date or time")
    found = df.agg(F.percentile_approx(numbers[0], [i / n for i in range(1, n)], max(10_000, 10 * n))).first()[0] or []
    shared = {(v,): m for v, m in Counter(found).items()}
    bounds: list[tuple[float, ...]] = []
    for level in range(len(order)):
        deeper = level + 1 < len(order) and numbers[level + 1] is not None
        heavy = {t: m for t, m in shared.items() if m > 1 and deeper and _cut_further(df, order[level], t[-1])}
        bounds += [t for t in shared if t not in heavy]
        if not heavy:
            break
        prefix = F.struct(*[numbers[k].alias(f"c{k}") for k in range(level + 1)])
        listed = F.array(*[F.struct(*[F.lit(v).alias(f"c{k}") for k, v in enumerate(t)]) for t in heavy])
        most = max(heavy.values())
        cut = (df.where(F.array_contains(listed, prefix)).groupBy(prefix.alias("p"))
               .agg(F.percentile_approx(numbers[level + 1], [i / (most + 1) for i in range(1, most + 1)], max(10_000, 10 * most)).alias("q")))
        shared = Counter()
        for r in cut.collect():
            t = tuple(r["p"])
            q, m = r["q"] or [], heavy[t]
            for i in range(1, m + 1):
                if q:
                    shared[*t, q[min(round(i * (most + 1) / (m + 1)), len(q)) - 1]] += 1
    return sorted(set(bounds))


def with_range(df: DataFrame, order: list[str], out: str, n: int | None = None) -> DataFrame:
    """``df`` with ``out``: how many bounds of its ``n`` ranges lie at or before a row in ``order``."""
    from pyspark.ml.feature import Bucketizer

    n = n or RANGES * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = range_bounds(df, order, n)
    firsts = sorted({t[0] for t in bounds if abs(t[0]) < float("inf")})
    splits = [float("-inf"), *(firsts or [0.0]), float("inf")]
    at = df.withColumn("__at", as_number(df, order[0]))
    at = Bucketizer(splits=splits, inputCol="__at", outputCol=out, handleInvalid="keep").transform(at)
    longer = {v: [t[1:] for t in bounds if t[0] == v and len(t) > 1] for v in firsts}
    longer = {v: ts for v, ts in longer.items() if ts}
    if longer:
        depth = max(len(t) for ts in longer.values() for t in ts)

        def point(values: list[Column]) -> Column:
            return F.struct(*[v.alias(f"c{k}") for k, v in enumerate(values)])
        held = F.create_map(*[c for v, ts in longer.items() for c in (F.lit(v), F.array(*[
            point([F.lit(x) for x in (*t, *[float("-inf")] * (depth - len(t)))]) for t in ts]))])
        before = [sum(t[0] < v for t in bounds) for v in firsts] + [len(bounds)]
        own = point([as_number(df, c) for c in order[1:depth + 1]])
        beyond = F.size(F.filter(F.try_element_at(held, F.col("__at")), lambda b: b > own))
        total = F.element_at(F.array(*map(F.lit, [0, *before[1:]])), F.least(F.col(out), F.lit(len(firsts))).cast("int") + 1)
        at = at.withColumn(out, (total - F.greatest(F.coalesce(beyond, F.lit(0)), F.lit(0))).cast("double"))
    return at.drop("__at")
