"""Candidate prompts for a judge model and the parsing of its replies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from noticelens.fixed_values import CLASSIFICATION_ERROR, PARSE_ERROR
from noticelens.functions.text import strip

INVALID_REPLY = "invalid_reply"


def candidate_line(label: Column, keywords: Column, shown: int = 150) -> Column:
    """One entry of the candidate block; the keyword text is shown up to ``shown`` characters."""
    return F.concat(
        F.lit("- Label: "), label, F.lit("\n  Keywords: "), F.substring(keywords, 1, shown), F.lit("...")
    )


def judge_prompt(title: Column, candidates: Column) -> Column:
    return F.concat(
        F.lit("Pick the one label that fits this notice title best.\nTitle: "),
        title,
        F.lit("\nCandidates, most similar first:\n"),
        candidates,
        F.lit('\nAnswer with JSON only: {"best_label": "...", "reason": "one short sentence"}'),
    )


def parse_judgement(response: Column) -> Column:
    """struct(label, reason) from a reply; code fences are dropped.

    A reply that is not one JSON object gets the classification-error label and a
    stable reason code; an object without ``best_label`` gets the parse-error label.
    """
    text = strip(F.replace(F.replace(response, F.lit("```json"), F.lit("")), F.lit("```"), F.lit("")))
    parsed = F.from_json(
        text,
        "best_label string, reason string, broken string",
        {"columnNameOfCorruptRecord": "broken", "mode": "PERMISSIVE", "allowSingleQuotes": "false"},
    )
    ok = F.coalesce(
        text.startswith("{")
        & text.endswith("}")
        & parsed.isNotNull()
        & parsed["broken"].isNull(),
        F.lit(False),
    )
    keys = F.json_object_keys(F.when(ok, text))
    label = (
        F.when(~ok, F.lit(CLASSIFICATION_ERROR))
        .when(F.array_contains(keys, "best_label"), parsed["best_label"])
        .otherwise(F.lit(PARSE_ERROR))
    )
    reason = (
        F.when(~ok, F.lit(INVALID_REPLY))
        .when(F.array_contains(keys, "reason"), parsed["reason"])
        .otherwise(F.lit(""))
    )
    return F.struct(label.alias("label"), reason.alias("reason"))
