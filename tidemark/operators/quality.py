"""Row filters and data-quality checks (Q1-Q4, S4 counting)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



class CheckViolation(Exception):
    """Raised when rows break a named check and the mode is ``fail``."""


def drop_any_null(df: DataFrame) -> DataFrame:
    """Q1: drop rows with a null (or NaN) in any column."""
    return df.na.drop(how="any")


def drop_null_subset(df: DataFrame, subset: list[str]) -> DataFrame:
    """Q3: drop rows with a null in one of ``subset``."""
    return df.na.drop(how="any", subset=list(subset))


def keep_positive(df: DataFrame, col: str = "close") -> DataFrame:
    """Q2: keep rows with ``col > 0``; null and NaN are dropped.

    Written as ``col > 0 AND NOT isnan(col)`` so the comparison is pushed to
    the Parquet scan (row groups whose max is <= 0 are skipped)."""
    c = F.col(col)
    return df.filter((c > 0) & ~F.isnan(c))


def violation(rule: str | Column) -> Column:
    """True where a row breaks ``rule``."""
    cond = F.expr(rule) if isinstance(rule, str) else rule
    # A row violates a rule when the rule is false or cannot be decided (null).
    return F.coalesce(~cond, F.lit(True))


def check_report(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Q4: one row per rule with its violation count, from a single scan.

    All rules are counted in one aggregation (partial counts per task, one
    tiny final merge), then turned into rows with ``stack``.
    """
    aggs = [F.count_if(violation(expr)).alias(f"v{i}") for i, expr in enumerate(rules.values())]
    counts = df.agg(*aggs)

    def quoted(name: str) -> str:
        return "'" + name.replace("\\", "\\\\").replace("'", "\\'") + "'"
    pairs = ", ".join(f"{quoted(name)}, v{i}" for i, name in enumerate(rules))
    return counts.selectExpr(f"stack({len(rules)}, {pairs}) as (rule, violations)")


def split_by_checks(df: DataFrame, rules: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Q4 quarantine mode: (rows passing every rule, rows failing any rule with
    the list of failed rule names in ``_failed_rules``)."""
    failed = F.filter(
        F.array(*[F.when(violation(e), F.lit(n)) for n, e in rules.items()]),
        lambda x: x.isNotNull())
    tagged = df.withColumn("_failed_rules", failed)
    good = tagged.filter(F.size("_failed_rules") == 0).drop("_failed_rules")
    bad = tagged.filter(F.size("_failed_rules") > 0)
    return good, bad


def enforce_checks(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Q4 fail mode: raise ``CheckViolation`` if any row breaks a rule.

    Runs one aggregation job (counts only) before the write it guards.
    """
    report = {r["rule"]: r["violations"] for r in check_report(df, rules).collect()}
    broken = {k: v for k, v in report.items() if v}
    if broken:
        raise CheckViolation(f"check constraint violated: {broken}")
    return df
