"""Column-name rules.

Names of DataFrame columns are lists of strings at planning time; names inside landed
payloads are map keys, so their rules are column expressions. Repeated names follow one
rule in both places: the first free numbered form of the name.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from itertools import chain, count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words that mark a price/volume column (P7) and an FX-rate
# column (P8), as the pipeline defines them.
NUMERIC_FIELD_WORDS = ("open", "high", "low", "close", "volume")
FX_FIELD_WORDS = ("rate", "exchange")


def series_field_expr(k: Column) -> Column:
    """P1 for map keys, ``4b. close (EUR)`` to ``close``: without number and unit."""
    return F.substring_index(F.substring_index(k, ". ", -1), " (", 1)


def quote_field_expr(k: Column) -> Column:
    """P2 for map keys, ``6. Last Refreshed`` to ``last_refreshed``: what follows the
    first blank, in lower case with ``_`` for blanks; empty without a blank."""
    at = F.instr(k, " ")
    rest = F.substr(k, at + 1)
    return F.when(at > 0, F.lower(F.replace(rest, F.lit(" "), F.lit("_")))).otherwise(F.lit(""))


def free_names(names: list[str], form: Callable[[str, int], str]) -> list[str]:
    """Each name itself or, where it is taken, the first of its numbered forms that is free."""
    taken: dict[str, None] = {}
    for name in names:
        forms = chain([name], (form(name, i) for i in count(1)))
        taken[next(f for f in forms if f not in taken)] = None
    return list(taken)


def free_names_expr(names: Column) -> Column:
    """P3 on an array of names: ``x``, ``x_1``, ``x_2``; a form that is a name itself is skipped."""
    def add(taken: Column, name: Column) -> Column:
        forms = F.concat(F.array(name), F.transform(
            F.sequence(F.lit(1), F.size(taken) + 1), lambda i: F.concat(name, F.lit("_"), i.cast("string"))))
        return F.concat(taken, F.slice(F.filter(forms, lambda f: ~F.array_contains(taken, f)), 1, 1))
    return F.aggregate(names, F.array().cast("array<string>"), add)


def rename_duplicates(df: DataFrame) -> DataFrame:
    """Repeats of a column become ``x_dup``, ``x_dup2`` and so on (no data movement)."""
    return df.toDF(*free_names(df.columns, lambda name, i: f"{name}_dup" + str(i) * (i > 1)))


def drop_repeated_columns(df: DataFrame) -> DataFrame:
    """P5: keep the first of each repeated column name."""
    tmp = [f"__c{i}" for i in range(len(df.columns))]
    first: dict[str, str] = {}
    for name, t in zip(df.columns, tmp):
        first.setdefault(name, t)
    renamed = df.toDF(*tmp)
    return renamed.select(*[F.col(t).alias(n) for n, t in first.items()])


def normalize_columns(df: DataFrame) -> DataFrame:
    """Column names trimmed, in lower case, ``_`` for each blank."""
    return df.toDF(*("_".join(c.lower().strip().split(" ")) for c in df.columns))


def columns_with(columns: list[str], words: tuple[str, ...]) -> list[str]:
    """The columns whose name holds any of the words, in order."""
    return list(filter(re.compile("|".join(map(re.escape, words))).search, columns))
