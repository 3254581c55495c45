"""Title cleaning, keyword lists and tokens, as column expressions."""

from __future__ import annotations

import html
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Unicode white space. Java's \s is ASCII only, so the other members are named.
SPACE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
SPACES = SPACE + "+"
BRACKETED = r"[\(\[]([^\n]+?)[\)\]]"
WORD = r"[\p{L}\p{N}_]"


@F.pandas_udf(StringType())
def html_unescape(text: pd.Series) -> pd.Series:
    return text.map(html.unescape, na_action="ignore")


def strip(col: Column) -> Column:
    return F.regexp_replace(col, f"^{SPACES}|{SPACES}$", "")


def clean_entities(col: Column) -> Column:
    """Null becomes empty; HTML entities are decoded once.

    Only rows holding an ampersand carry their text to the Python worker; the
    others send a null and keep the JVM string.
    """
    text = F.coalesce(col, F.lit(""))
    return F.coalesce(html_unescape(F.when(text.contains("&"), text)), text)


def clean_light(col: Column) -> Column:
    """Entities decoded, white space collapsed and stripped."""
    return F.trim(F.regexp_replace(clean_entities(col), SPACES, " "))


def clean_title(col: Column) -> Column:
    """Strong clean: bracket contents move to the end, separators go.

    Bracket contents are appended after separators were removed, so a slash or
    colon inside a bracket survives.
    """
    text = clean_entities(col)
    inner = F.regexp_extract_all(text, F.lit(BRACKETED), F.lit(1))
    body = F.translate(F.regexp_replace(text, BRACKETED, " "), "/:#´'", " ")
    joined = F.when(
        F.size(inner) > 0, F.concat(body, F.lit(" "), F.array_join(inner, " "))
    ).otherwise(body)
    return F.trim(F.regexp_replace(joined, SPACES, " "))


def keyword_list(col: Column, null_as_nan: bool = False) -> Column:
    """Comma list to an array of stripped, non-empty keywords.

    ``null_as_nan`` keeps a quirk of table readers that print a null cell as the
    word ``nan``.
    """
    cell = F.coalesce(col, F.lit("nan" if null_as_nan else ""))
    return F.filter(F.transform(F.split(cell, ","), strip), lambda k: k != "")


def join_keyword_columns(columns: Sequence[str]) -> Column:
    """All columns whose name holds ``Keyword``, joined and skipping nulls."""
    picked = [F.col(c).cast("string") for c in columns if "Keyword" in c]
    return F.concat_ws(", ", *picked)


def word_tokens(col: Column, stop_words: Sequence[str] = (), min_len: int = 2) -> Column:
    """Lower-cased runs of letters, digits and underscore, minus the stop words."""
    found = F.regexp_extract_all(F.lower(col), F.lit(f"({WORD}{{{min_len},}})"), F.lit(1))
    if not stop_words:
        return found
    return F.filter(found, lambda t: ~t.isin(list(stop_words)))


def token_window(tokens: Column, max_len: int = 128, pad: str = "[PAD]") -> Column:
    """Cut or pad a token array to ``max_len``; returns struct(tokens, mask)."""
    cut = F.slice(tokens, 1, max_len)
    missing = F.lit(max_len) - F.size(cut)
    return F.struct(
        F.concat(cut, F.array_repeat(F.lit(pad), missing)).alias("tokens"),
        F.concat(
            F.array_repeat(F.lit(1), F.size(cut)), F.array_repeat(F.lit(0), missing)
        ).alias("mask"),
    )


def register_functions(spark: SparkSession) -> None:
    """Make ``html_unescape`` callable from SQL."""
    spark.udf.register("html_unescape", html_unescape)
