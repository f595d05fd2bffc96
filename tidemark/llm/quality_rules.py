"""Quality rules with adaptive thresholds (operator 7), DataFrame functions only.

Each text is counted where it is. The shares made of the counts go into mergeable quantile
sketches per language and source: counts of values cut to six significant bits, so a
sketch has a bounded number of rows, merging is adding, and the result does not depend on
the order of rows or on retries. The sketches of languages and of the whole are merged from those
of the groups. A group's distribution is a blend of its own, its language's and the whole one, a group of
``n`` texts having the weight ``n / (n + weight)`` in its own and its language likewise in what is left; so
small groups lean on larger ones by degrees. A threshold lies halfway between two upper (or lower) quantiles
of the blend. Nothing but these quantiles is fixed. Thresholds are joined to the documents' counts,
and those beyond any are rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import staged
from tidemark.llm.line_dedup import WHITE

SYMBOLS = "#*$%&|<>"
SPLIT = r"[\x20\x09-\x0D]+"
SPAN = 8

# share of a document, in ten thousandths or hundredths of a character: counts it is made of, factor, and the quantiles, in
# thousandths, that its upper and its lower threshold lie halfway between
SHARES = {
    "word_length": ("word_chars", "n_words", 100, (950, 990), (10, 50)),
    "symbols": ("n_symbols", "n_words", 10_000, (900, 950), None),
    "dup_lines": ("n_dup_lines", "n_lines", 10_000, (990, 1000), None),
    "repeats": ("n_repeat_words", "n_words", 10_000, (990, 1000), None),
}


def counts(df: DataFrame, text: Column) -> DataFrame:
    """``df`` with the counts of a text column added; null counts as empty."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    trimmed = F.btrim(text, F.lit(WHITE))
    df = df.withColumns({
        "_words": F.when(trimmed == "", F.array().cast("array<bigint>")).otherwise(
            F.transform(F.split(trimmed, SPLIT, -1), lambda w: F.xxhash64(w))),
        "_lines": F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(WHITE)) != ""),
        "word_chars": F.char_length(F.translate(text, WHITE, "")).cast("long"),
        "n_symbols": (F.char_length(text) - F.char_length(F.translate(text, SYMBOLS, ""))).cast("long"),
    })
    word = F.col("_words")
    windows = F.when(F.size(word) >= SPAN, F.transform(
        F.sequence(F.lit(0), F.size(word) - SPAN), lambda i: F.xxhash64(*[F.get(word, i + k) for k in range(SPAN)]))
    ).otherwise(F.array().cast("array<bigint>"))
    df = df.select(*[c for c in df.columns if c not in ("_words", "_lines")], F.size("_words").cast("long").alias("n_words"),
                   F.size("_lines").cast("long").alias("n_lines"),
                   (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
                   windows.alias("_windows"))
    # windows by hash, only where some window is found twice
    df = df.withColumn("_sorted", F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), F.array_sort(
        F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("at"))))))
    same = F.col("_sorted")
    starts = F.array_sort(F.transform(F.filter(same, lambda x, i: (x["h"] == F.get(same, i - 1)["h"]) | (
        x["h"] == F.get(same, i + 1)["h"])), lambda x: x["at"]))
    covered = F.aggregate(
        starts, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, s: F.struct((a["n"] + s + SPAN - F.greatest(s, a["end"])).alias("n"), (s + SPAN).alias("end")))
    return df.withColumn("n_repeat_words", F.coalesce(covered["n"], F.lit(0)).cast("long")).drop("_windows", "_sorted")


def rounded(v: Column) -> Column:
    """A whole number cut to its six leading bits: the sketch's bucket."""
    down = F.greatest(F.length(F.bin(v)) - 6, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", v, down), down)


def sketches(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, share, value, n): the sketch of every share in every group."""
    shares = F.array(*[F.struct(F.lit(name).alias("share"), rounded(F.col(name)).alias("value")) for name in SHARES])
    return (rows.select(*keys, F.explode(shares).alias("s"))
            .groupBy(*keys, "s.share", "s.value").agg(F.count("*").alias("n")))


def _distribution(sketch: DataFrame, keys: list[str], support: DataFrame) -> DataFrame:
    """(key, share, value, f, n): the share of a group's texts up to every value of ``support``, and the number of its texts."""
    own = sketch.groupBy(F.struct(*keys).alias("key"), "share", "value").agg(F.sum("n").alias("n"))
    # a group's rows are as many as the support, which the rounding bounds
    groups = own.select("key", "share").distinct().join(F.broadcast(support), "share")
    group = Window.partitionBy("key", "share")
    at = groups.join(own, ["key", "share", "value"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    upto, total = F.sum("n").over(group.orderBy("value")), F.sum("n").over(group)
    return at.select("key", "share", "value", (upto / total).alias("f"), total.alias("n"))


def limits(sketch: DataFrame, weight: int) -> DataFrame:
    """(group, <share>_high and _low per share): twice the thresholds, as sums of two quantiles, for each language and source."""
    # the values that occur in a share: at most 32 for each power of two, whatever the rows
    support = staged(sketch.select("share", "value").distinct(), "support")
    own = _distribution(sketch, ["lang", "source"], support).select(
        F.col("key").alias("group"), F.struct("key.lang").alias("key"), "share", "value", F.col("f").alias("fo"), F.col("n").alias("no"))
    langs = _distribution(sketch, ["lang"], support).withColumnsRenamed({"f": "fl", "n": "nl"})
    whole = _distribution(sketch.withColumn("all", F.lit(1)), ["all"], support).select("share", "value", F.col("f").alias("fw"))
    at = own.join(langs, ["key", "share", "value"]).join(F.broadcast(whole), ["share", "value"])
    a, b = F.col("no") / (F.col("no") + weight), F.col("nl") / (F.col("nl") + weight)
    at = at.withColumn("f", a * F.col("fo") + (1 - a) * (b * F.col("fl") + (1 - b) * F.col("fw")))

    def quantile(p: int) -> Column:
        return F.min(F.when(F.col("f") >= p / 1000 - 1e-9, F.col("value")))
    out = [F.max(F.when(F.col("share") == name, F.col(f"q{p}") + F.col(f"q{q}"))).alias(f"{name}_{side}")
           for name, v in SHARES.items() for side, pair in (("high", v[3]), ("low", v[4])) if pair for p, q in (pair,)]
    every = sorted({p for v in SHARES.values() for pair in v[3:] if pair for p in pair})
    q = at.groupBy("group", "share").agg(*[quantile(p).alias(f"q{p}") for p in every])
    return q.groupBy("group").agg(*out)


def judge(df: DataFrame, *, min_words: int = 20, max_repeats: int = 30, weight: int = 200,
          id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """One row per input row: id, the counts, ``base_failed`` and ``kept``.

    ``base_failed``: fewer than ``min_words`` words, or more than ``max_repeats`` percent of
    the words in repeated windows. Others are kept unless a share, cut to six bits, lies beyond its group's
    threshold; they alone make the sketches. ``weight`` is how many texts a group needs for half the say in its own
    thresholds. Null language or source is a group like any other; null and empty texts have no words and fail. Rows
    that repeat count each time; extra columns are not read; an empty table gives an empty one.
    """
    rows = counts(df.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"),
                            F.col(source_col).cast("string").alias("source"), F.col(text_col).alias("text")), F.col("text"))
    shares = {name: F.when(F.col(of) > 0, F.floor(factor * F.col(part) / F.col(of))).otherwise(0).cast("long")
              for name, (part, of, factor, _, _) in SHARES.items()}
    rows = rows.drop("text").withColumns(shares).withColumn("base_failed", (F.col("n_words") < min_words) | (
        100 * F.col("n_repeat_words") > max_repeats * F.col("n_words")))
    rows = staged(rows, "counts")
    sketch = staged(sketches(rows.where("NOT base_failed"), ["lang", "source"]), "sketch")
    chosen = staged(limits(sketch, weight), "thresholds")
    out = rows.withColumn("group", F.struct("lang", "source")).join(chosen, "group", "left")
    fine = ~F.col("base_failed")
    for name, v in SHARES.items():
        twice = 2 * rounded(F.col(name))
        fine &= twice <= F.col(f"{name}_high")
        if v[4]:
            fine &= twice >= F.col(f"{name}_low")
    return out.select(F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", F.coalesce(fine, F.lit(False)).alias("kept"))
