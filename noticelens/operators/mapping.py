"""Lookups: label information, department audit, code roll-up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticelens.fixed_values import MATCH, MISMATCH, UNDETERMINED, VALIDATION_SKIPPED
from noticelens.session import lookup, small_side


def require_unique(df: DataFrame, key: str) -> DataFrame:
    """The frame itself, or an error when a key occurs twice."""
    twice = df.groupBy(key).count().filter("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"duplicate {key}: {twice[0][0]!r}")
    return df


def label_info(
    df: DataFrame,
    kb: DataFrame,
    label: str = "predicted_label",
    default: str | None = "N/A",
    div: str = "div",
    dept: str = "dep",
) -> DataFrame:
    """Adds predicted_div and predicted_dept; a miss or a null gives ``default``."""
    info = require_unique(kb, "final_label").select(
        F.col("final_label").alias(label),
        F.col(div).alias("predicted_div"),
        F.col(dept).alias("predicted_dept"),
    )
    joined = lookup(df, info, [label], "left")
    if default is None:
        return joined
    return joined.fillna(default, subset=["predicted_div", "predicted_dept"])


def standard_dept(df: DataFrame, dept_map: DataFrame, raw: str, out: str) -> DataFrame:
    """Adds the standard name of a department; an unknown one stays as it is."""
    names = require_unique(dept_map, "key").select(
        F.col("key").alias(raw), F.col("value").alias("_standard")
    )
    joined = lookup(df, names, [raw], "left")
    return joined.withColumn(out, F.coalesce("_standard", raw)).drop("_standard")


def dept_status(predicted_dept: Column, predicted_label: Column, actual: Column) -> Column:
    """match, undetermined or mismatch; a match is looked for first."""
    actual = F.coalesce(actual, F.lit("nan"))
    predicted = F.split(F.coalesce(predicted_dept, F.lit("nan")), ", ")
    open_case = predicted_label.isNull() | predicted_label.contains("error") | (actual == "nan")
    return (
        F.when(F.array_contains(predicted, actual), MATCH)
        .when(open_case, UNDETERMINED)
        .otherwise(MISMATCH)
    )


def dept_match(
    df: DataFrame,
    dept_map: DataFrame | None,
    actual: str = "participating_dept",
    label: str = "predicted_label",
) -> DataFrame:
    """Adds standard_dept_actual and dept_match_status."""
    if actual not in df.columns:
        return df.withColumn("dept_match_status", F.lit(VALIDATION_SKIPPED))
    out = "standard_dept_actual"
    if dept_map is None:
        df = df.withColumn(out, F.col(actual))
    else:
        df = standard_dept(df, dept_map, actual, out)
    return df.withColumn(
        "dept_match_status", dept_status(F.col("predicted_dept"), F.col(label), F.col(out))
    )


def rollup_codes(df: DataFrame, code: str, codes: DataFrame) -> DataFrame:
    """Adds the canonical field of a code; an unknown code stays null."""
    names = codes.select(F.col("key").alias(code), F.col("value").alias("field"))
    return lookup(df, names, [code], "left")


def field_labels(df: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """One row per label of the row's field; a label under two fields fans out."""
    labels = taxonomy.select(F.col("key").alias("field"), F.explode("value").alias("field_label"))
    return df.join(small_side(labels), "field")
