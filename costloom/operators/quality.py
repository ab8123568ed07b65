"""Row expectations: count violations, keep every row."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, functions as F


def _failed(rule: Column | str) -> Column:
    test = F.expr(rule) if isinstance(rule, str) else rule
    return F.count_if(~F.coalesce(test, F.lit(False)))


def expect(df: DataFrame, rules: Mapping[str, Column | str], name: str | None = None):
    """Return ``(df, observation)``; the counts fill in when an action runs on ``df``.

    No extra pass over the data: the metrics ride along with whatever reads it.
    """
    seen = Observation(name) if name else Observation()
    metrics = [_failed(rule).alias(label) for label, rule in rules.items()]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *metrics), seen


def expectation_report(df: DataFrame, rules: Mapping[str, Column | str]) -> DataFrame:
    """One row per rule: rows checked and rows that break it."""
    labels = list(rules)
    wide = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[_failed(rules[l]).alias(f"__f{i}") for i, l in enumerate(labels)],
    )
    pairs = F.array(*[
        F.struct(F.lit(l).alias("rule_lb"), F.col(f"__f{i}").alias("failed_nb"))
        for i, l in enumerate(labels)
    ])
    return wide.select("__rows", F.explode(pairs).alias("r")).select(
        "r.rule_lb", F.col("__rows").alias("checked_nb"), "r.failed_nb"
    )
