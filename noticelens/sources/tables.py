"""Readers with missing-input and required-column checks, and the matching writers."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

log = logging.getLogger(__name__)


class MissingColumns(ValueError):
    pass


def or_missing(
    spark: SparkSession, read: Callable[[], DataFrame], schema: StructType | None, missing: str
) -> DataFrame:
    """The frame read, or an empty typed one if the input does not exist."""
    if missing not in ("raise", "empty"):
        raise ValueError(f"unknown choice {missing}")
    try:
        return read()
    except AnalysisException as error:
        if missing == "raise" or error.getCondition() != "PATH_NOT_FOUND":
            raise
        if schema is None:
            raise ValueError("an empty frame needs a schema") from error
        log.warning("input not found, going on with an empty table: %s", error.getMessage())
        return spark.createDataFrame([], schema)


def require_columns(df: DataFrame, cols: Sequence[str], how: str = "raise") -> DataFrame:
    """Check columns before a plan is built: raise, or go on with an empty typed frame."""
    absent = [c for c in cols if c not in df.columns]
    if not absent:
        return df
    if how == "raise":
        raise MissingColumns(f"missing columns: {', '.join(absent)}")
    log.warning("missing columns %s, going on with an empty table", absent)
    return df.sparkSession.createDataFrame([], ", ".join(f"`{c}` string" for c in cols))


def read_table(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    missing: str = "raise",
    fmt: str = "parquet",
) -> DataFrame:
    def read() -> DataFrame:
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.format(fmt).load(path)

    return or_missing(spark, read, schema, missing)


def read_sheet(
    spark: SparkSession,
    book: str,
    sheet: str,
    schema: StructType | None = None,
    missing: str = "raise",
) -> DataFrame:
    """A sheet of a book's last complete version; a plain folder of sheets is a book, too."""
    path = _sheets(spark, book).get(sheet, f"{book.rstrip('/')}/{sheet}")
    return read_table(spark, path, schema, missing)


def _glob(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match, on whatever file system they are; the names only come here."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(str(f.getPath()) for f in found or [])


def complete_folders(spark: SparkSession, pattern: str) -> list[str]:
    """Folders that match and were written to their end, by name."""
    return [path.rpartition("/")[0] for path in _glob(spark, f"{pattern}/_SUCCESS")]


def _versions(spark: SparkSession, book: str) -> list[str]:
    """Folders of the book's manifests, oldest first."""
    return complete_folders(spark, f"{book.rstrip('/')}/_manifest/*")


def _sheets(spark: SparkSession, book: str) -> dict[str, str]:
    versions = _versions(spark, book)
    rows = spark.read.schema("sheet string, folder string").json(versions[-1]).collect() if versions else []
    return {r["sheet"]: f"{book.rstrip('/')}/{r['folder']}" for r in rows}


def write_book(
    tables: Mapping[str, DataFrame], book: str, partition_by: Mapping[str, str] | None = None
) -> None:
    """Write one table per sheet, all of them visible at once; other sheets of the book stay.

    Sheets go into folders of their own; a manifest that names a folder for every sheet is
    written last, so readers see all sheets of one version or none of it, whatever fails in
    between. Earlier versions stay readable for those who opened them. A sheet may be split
    into one folder per value. Of two writers at once one fails and leaves the book as it is.
    """
    if not tables:
        return
    spark, book = next(iter(tables.values())).sparkSession, book.rstrip("/")
    versions = _versions(spark, book)
    number = int(versions[-1].rpartition("/")[2]) + 1 if versions else 0
    folders = {sheet: path.removeprefix(f"{book}/") for sheet, path in _sheets(spark, book).items()}
    for name, df in tables.items():
        folders[name] = f"{name}-{uuid.uuid4().hex}"
        writer = df.write
        column = (partition_by or {}).get(name)
        if column:
            writer = writer.partitionBy(column)
        writer.parquet(f"{book}/{folders[name]}")
    manifest = spark.createDataFrame(sorted(folders.items()), "sheet string, folder string")
    manifest.coalesce(1).write.json(f"{book}/_manifest/{number:012d}")


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, UTF-8 without a byte order mark."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def read_mapping(
    spark: SparkSession, path: str, value: str = "string", missing: str = "raise"
) -> DataFrame:
    """A JSON object as rows (key, value); values are strings or arrays of strings."""
    schema = StructType.fromDDL(f"key string, value {_mapping_type(value)}")

    def read() -> DataFrame:
        return mapping_rows(spark.read.text(path, wholetext=True), "value", value)

    return or_missing(spark, read, schema, missing)


def _mapping_type(value: str) -> str:
    return {"string": "string", "array": "array<string>"}[value]


def mapping_rows(df: DataFrame, json_col: str, value: str = "string") -> DataFrame:
    """Rows (key, value) of JSON objects held in a column."""
    parsed = F.from_json(F.col(json_col), f"map<string,{_mapping_type(value)}>", {"mode": "FAILFAST"})
    return df.select(F.explode(parsed).alias("key", "value"))


def write_vectors(df: DataFrame, path: str, json_path: str | None = None) -> None:
    """Vector table (id, embedding, title, label) and, on request, id -> title and label as JSON lines."""
    require_columns(df, ["id", "embedding", "title", "label"])
    df.select("id", "embedding", "title", "label").write.mode("overwrite").parquet(path)
    if json_path:
        df.select("id", "title", "label").write.mode("overwrite").json(json_path)
