"""A folder of CSV files in unknown encodings.

The bytes are read as ISO-8859-1, which maps every byte to one character and back,
so files split and parse on the JVM whatever their true encoding: in UTF-8, EUC-KR
and CP949 no byte of a longer character equals a comma, quote or line break. A first
pass finds, per file, the first encoding that decodes every line; the second pass
parses and decodes the fields.
"""

from __future__ import annotations

import csv
import logging
import re
from collections import defaultdict
from collections.abc import Iterator, Sequence
from functools import reduce
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql.types import StringType, StructField, StructType

from noticelens.sources.tables import or_missing

log = logging.getLogger(__name__)

# The orders in which encodings are tried.
UTF8_FIRST = ("utf-8-sig", "euc-kr", "cp949")
CP949_FIRST = ("cp949", "euc-kr", "utf-8-sig")
RAW = "ISO-8859-1"


def _decodes(encodings: Sequence[str]):
    """One flag per encoding: does every line of the batch row decode?"""

    def good(raw: bytes, encoding: str) -> bool:
        try:
            raw.decode(encoding)
            return True
        except UnicodeDecodeError:
            return False

    @F.pandas_udf("array<boolean>")
    def flags(lines: pd.Series) -> pd.Series:
        return lines.map(lambda raw: [good(bytes(raw), e) for e in encodings])

    return flags


def _decoded(raw: Column, encoding: str) -> Column:
    """Field text from its ISO-8859-1 reading; UTF-8 stays on the JVM."""
    data = F.encode(raw, RAW)
    if encoding.startswith("utf-8"):
        return F.decode(data, "UTF-8")

    @F.pandas_udf("string")
    def legacy(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield part.map(lambda b: bytes(b).decode(encoding), na_action="ignore")

    return legacy(data)


def probe_files(spark: SparkSession, path: str, encodings: Sequence[str]) -> DataFrame:
    """(path, header, encoding) per file; encoding is null where none fits.

    One scan with a partial aggregate per file; long files are split as usual.
    """
    lines = spark.read.text(path, pathGlobFilter="*.csv").select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("value").cast("binary").alias("raw"),
    )
    # Plain ASCII lines decode in every encoding; the Python worker gets an empty one.
    legacy = F.when(_has_high_byte(F.col("raw")), F.col("raw")).otherwise(F.lit(b""))
    flagged = lines.withColumn("ok", _decodes(encodings)(legacy)).withColumn(
        "row", F.monotonically_increasing_id()
    )
    first = F.min_by("raw", F.when(F.col("start") == 0, F.col("row")))
    fits = [
        F.bool_and(F.get("ok", F.lit(i))).alias(f"ok{i}") for i in range(len(encodings))
    ]
    files = flagged.groupBy("path").agg(first.alias("header"), *fits)
    chosen = F.coalesce(*[F.when(F.col(f"ok{i}"), F.lit(e)) for i, e in enumerate(encodings)])
    return files.select("path", "header", chosen.alias("encoding"))


def _has_high_byte(raw: Column) -> Column:
    """Each byte reads as one ISO-8859-1 character; those above ASCII are looked for."""
    return F.decode(raw, RAW).rlike("[^\\x00-\\x7f]")


def read_csv_dir(
    spark: SparkSession,
    path: str,
    encodings: Sequence[str] = UTF8_FIRST,
    on_fail: str = "skip",
    require: Sequence[str] = (),
    multi_line: bool = False,
    schema: StructType | None = None,
    missing: str = "raise",
) -> DataFrame:
    """All CSV files of a folder as one frame of string columns.

    A file no encoding fits is skipped or raises; a file without the ``require``
    columns is skipped. ``multi_line`` allows line breaks inside quotes.
    """
    if on_fail not in ("skip", "raise"):
        raise ValueError(f"unknown choice {on_fail}")

    def read() -> DataFrame:
        return _read(spark, path, encodings, on_fail, require, multi_line, schema)

    return or_missing(spark, read, schema, missing)


def _literal(path: str) -> str:
    """A file's URL as a path that the reader takes literally."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(path))


def _read(spark, path, encodings, on_fail, require, multi_line, schema) -> DataFrame:
    groups: dict[tuple[str, tuple[str, ...]], list[str]] = defaultdict(list)
    # One row per file, like the file listing the driver keeps for any scan.
    for file in probe_files(spark, path, encodings).toLocalIterator():
        if file.encoding is None:
            if on_fail == "raise":
                raise ValueError(f"no encoding of {', '.join(encodings)} fits {file.path}")
            log.warning("no encoding fits, skipped: %s", file.path)
            continue
        header = bytes(file.header or b"").decode(file.encoding).lstrip("﻿")
        columns = tuple(next(csv.reader([header]), []))
        if all(c in columns for c in require) and columns:
            groups[(file.encoding, columns)].append(_literal(file.path))
    parts = []
    for (encoding, columns), paths in sorted(groups.items()):
        fields = ", ".join(f"c{i} string" for i in range(len(columns)))
        rows = (
            spark.read.schema(fields)
            .options(header=True, encoding=RAW, multiLine=multi_line, quote='"', escape='"')
            .csv(sorted(paths))
        )
        parts.append(
            rows.select(*[_decoded(F.col(f"c{i}"), encoding).alias(c) for i, c in enumerate(columns)])
        )
    if not parts:
        log.warning("no usable CSV file in %s", path)
        empty = schema or StructType([StructField(c, StringType()) for c in require])
        return spark.createDataFrame([], empty)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_csv(spark: SparkSession, path: str, encoding: str = "utf-8-sig", **options) -> DataFrame:
    """CSV files of one known encoding; raises if they do not decode."""
    return read_csv_dir(spark, path, (encoding,), on_fail="raise", **options)
