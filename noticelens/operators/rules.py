"""Ordered keyword rules as one CASE expression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticelens.fixed_values import HARD_RULES

Rule = tuple[str, str, str, Sequence[tuple[str, str]]]


def _found(text: Column, pattern: str) -> Column:
    return text.rlike(f"(?iu){pattern}")


def rule_decision(text: Column, rules: Sequence[Rule] = HARD_RULES) -> Column:
    """struct(label, status) of the first group whose trigger is found, else null.

    Within a group the last override that is found decides, so overrides are
    tested from the end.
    """
    decision = None
    for status, trigger, label, overrides in rules:
        chosen = F.lit(label)
        for pattern, other in overrides:
            chosen = F.when(_found(text, pattern), F.lit(other)).otherwise(chosen)
        hit = F.struct(chosen.alias("label"), F.lit(status).alias("status"))
        fired = _found(text, trigger)
        decision = F.when(fired, hit) if decision is None else decision.when(fired, hit)
    return decision


def apply_rules(
    df: DataFrame, text_col: str, rules: Sequence[Rule] = HARD_RULES
) -> DataFrame:
    """Adds rule_label (null where no rule fires) and rule_status (then empty)."""
    decided = df.withColumn("_rule", rule_decision(F.col(text_col), rules))
    return decided.withColumns(
        {
            "rule_label": F.col("_rule.label"),
            "rule_status": F.coalesce(F.col("_rule.status"), F.lit("")),
        }
    ).drop("_rule")
