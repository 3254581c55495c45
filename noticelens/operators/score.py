"""Batch scoring of notices from the logits of both models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticelens.functions.scoring import bid_category, bid_possibility, prob_map

BINARY_LABELS = ("LABEL_0", "LABEL_1")


def score_batch(
    notices: DataFrame,
    labels: Sequence[str],
    id_col: str = "id",
    text_col: str = "text",
    binary_logits: str = "binary_logits",
    multi_logits: str = "multi_logits",
    empty_score: float = 50.0,
) -> DataFrame:
    """(original_id, possibility, category) per notice; two projections, no shuffle.

    The probability maps are columns of their own, so the many rules that read
    them do not repeat their expressions. Duplicate ids are scored again.
    """
    mapped = notices.select(
        F.col(id_col).cast("string").alias("original_id"),
        F.col(text_col).alias("text"),
        prob_map(F.col(binary_logits), BINARY_LABELS).alias("binary"),
        prob_map(F.col(multi_logits), labels).alias("multi"),
    )
    return mapped.select(
        "original_id",
        bid_possibility(F.col("binary"), empty_score).alias("possibility"),
        bid_category(F.col("text"), F.col("multi")).alias("category"),
    )
