"""Class preparation: eligible titles, the balanced set, weights, folds and ids."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from noticelens.fixed_values import SEED
from noticelens.functions.text import clean_title
from noticelens.operators.ranking import (
    dense_index,
    seeded_order,
    seeded_rank,
    seeded_sample,
)
from noticelens.session import lookup


def eligible_titles(
    df: DataFrame, company: str, company_col: str = "bid_company_name", title_col: str = "notice_name"
) -> DataFrame:
    """Distinct titles of one company."""
    return df.filter(F.col(company_col) == company).select(title_col).distinct()


def balanced_dataset(
    pos: DataFrame,
    neg: DataFrame,
    pos_key: str,
    neg_key: str,
    text_col: str = "notice_name",
    seed: int = SEED,
    clean: Callable[[Column], Column] = clean_title,
    shuffle: bool = True,
) -> DataFrame:
    """Equal seeded samples of both classes, cleaned, deduplicated and shuffled.

    ``pos`` comes deduplicated on its text, ``neg`` as it is; both keys are
    unique. A title in both classes keeps label 1, since positives come last in
    the union and the last copy is kept. Cleaning may merge titles, so the final
    classes can be a little below 1:1.
    """
    sizes = pos.agg(F.count(F.lit(1)).alias("n")).unionByName(
        neg.agg(F.count(F.lit(1)).alias("n"))
    )
    n = sizes.agg(F.min("n")).first()[0]
    parts = [
        seeded_sample(side, n, F.col(key), seed).select(
            F.col(text_col).alias("service_title"), F.lit(label).alias("label")
        )
        for side, key, label in ((neg, neg_key, 0), (pos, pos_key, 1))
    ]
    # The length is an aggregate, so its filter is not pushed below the cleaning,
    # where it would run the cleaning a second time.
    merged = (
        parts[0]
        .unionByName(parts[1])
        .withColumn("service_title", clean(F.col("service_title")))
        .groupBy("service_title")
        .agg(F.max("label").alias("label"), F.max(F.length("service_title")).alias("_length"))
        .filter(F.col("_length") > 0)
        .drop("_length")
    )
    if not shuffle:
        return merged
    return merged.orderBy(seeded_order(F.col("service_title"), seed), "service_title")


def class_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows and share per class; the window runs over one row per class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(W.partitionBy()))


def class_weights(df: DataFrame, label: str = "label", mode: str = "balanced") -> DataFrame:
    """Per-class weight n / (k * n_c).

    ``auto`` (two classes 0 and 1) weighs only if their shares differ by more
    than 0.1, a missing class counting as 0; else every weight is 1.
    """
    if mode not in ("balanced", "auto"):
        raise ValueError(f"unknown mode {mode}")
    every = W.partitionBy()
    balanced = F.sum("n").over(every) / (F.count(F.lit(1)).over(every) * F.col("n"))
    dist = class_distribution(df, label)
    if mode == "balanced":
        return dist.select(label, "n", "share", balanced.alias("weight"))

    def share(value: int) -> Column:
        return F.coalesce(F.max(F.when(F.col(label) == value, F.col("share"))).over(every), F.lit(0.0))

    skewed = F.abs(share(0) - share(1)) > 0.1
    return dist.select(label, "n", "share", F.when(skewed, balanced).otherwise(1.0).alias("weight"))


def keep_common_classes(df: DataFrame, label: str = "label", min_count: int = 20) -> DataFrame:
    """Rows whose class has at least ``min_count`` rows; nulls in other columns still count."""
    kept = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= min_count)
    return lookup(df, kept.select(label), [label], "left_semi")


def encode_labels(df: DataFrame, label: str = "label", out: str = "label_id") -> DataFrame:
    """Adds the dense id of each label in sorted order."""
    return lookup(df, dense_index(df, label, out), [label])


def prepare_multiclass(
    df: DataFrame, text_col: str, label_col: str, min_count: int = 20
) -> DataFrame:
    """Common classes only, counted before null rows go, with dense label ids."""
    kept = keep_common_classes(df.filter(F.col(label_col).isNotNull()), label_col, min_count)
    rows = kept.withColumnsRenamed({text_col: "text", label_col: "label"}).dropna(
        subset=["text", "label"]
    )
    return encode_labels(rows)


def stratified_folds(
    df: DataFrame, key: str, label: str = "label", k: int = 5, seed: int = SEED, out: str = "fold"
) -> DataFrame:
    """Seeded fold per row; fold sizes within a class differ by at most one."""
    ranked = seeded_rank(df, [label], F.col(key), seed, "_rank")
    return ranked.withColumn(out, F.pmod(F.col("_rank") - 1, F.lit(k)).cast("int")).drop("_rank")
