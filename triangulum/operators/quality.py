"""Row expectations: drop failing rows, or only count them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Rules = Mapping[str, "Column | str"]


def _predicate(rule: Column | str) -> Column:
    """A rule that evaluates to NULL counts as failed."""
    return F.coalesce(F.expr(rule) if isinstance(rule, str) else rule, F.lit(False))


def expect_or_drop(df: DataFrame, rules: Rules) -> DataFrame:
    """Keep rows that pass every rule; one filter, so simple rules reach the scan."""
    for rule in rules.values():
        df = df.filter(_predicate(rule))
    return df


def expect(df: DataFrame, rules: Rules, name: str = "expectations") -> DataFrame:
    """Warn-only: rows pass unchanged, failures per rule are observed as metrics."""
    return df.observe(
        name,
        F.count("*").alias("rows"),
        *[F.count_if(~_predicate(r)).alias(f"failed_{n}") for n, r in rules.items()],
    )


def expectation_report(df: DataFrame, drop_rules: Rules, warn_rules: Rules | None = None) -> DataFrame:
    """One row per rule: passed, failed and the action taken; a single pass over the data."""
    rules = [(n, r, "drop") for n, r in drop_rules.items()]
    rules += [(n, r, "warn") for n, r in (warn_rules or {}).items()]
    counts = df.agg(
        F.count("*").alias("_rows"),
        *[F.count_if(_predicate(r)).alias(f"_p{i}") for i, (_, r, _) in enumerate(rules)],
    )
    entries = [
        F.struct(
            F.lit(n).alias("rule"),
            F.lit(action).alias("action"),
            F.col(f"_p{i}").alias("passed"),
            (F.col("_rows") - F.col(f"_p{i}")).alias("failed"),
        )
        for i, (n, _, action) in enumerate(rules)
    ]
    return counts.select(F.inline(F.array(*entries)))
