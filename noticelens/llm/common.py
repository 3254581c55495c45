"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import filterfalse

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noticelens.session import SMALL_ROWS, lookup, shared_path


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write a table under the shared folder and read it back.

    The plan behind it is cut, and a lost executor costs only what it was doing.
    """
    path = shared_path(df.sparkSession, name)
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_remainder(id_col: str, modulus: int = 5) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % modulus


def strings(column: pa.Array, some: int = 256) -> Iterator[str]:
    """The texts of an Arrow column, a few of them at a time; null is empty."""
    for n in range(0, len(column), some):
        for value in column.slice(n, some).to_pylist():
            yield value or ""


def utf8(text: str) -> bytes:
    """UTF-8 bytes; a lone surrogate, which UTF-8 has no code for, becomes ``?``."""
    return text.encode("utf-8", "replace")


def digest64(data: bytes) -> int:
    """A signed 64-bit hash that is the same in every process."""
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def attached(
    df: DataFrame, table: DataFrame, on: list[str], how: str = "inner", spread: list[str] | None = None
) -> DataFrame:
    """Join a table of few narrow columns, unique in ``on``, to rows with uneven keys.

    The table is written and counted; it is broadcast up to a bound of rows and joined by
    salted keys beyond.
    """
    table = stored(table, "attached")
    return lookup(df, table, on, how, spread=spread, small=table.count() <= SMALL_ROWS)


def kept(sent: dict, make):
    """``make(sent["source"])``, made once per Python worker.

    A worker keeps the values of broadcasts between its tasks, and so what is put there.
    """
    if "made" not in sent:
        sent["made"] = make(sent["source"])
    return sent["made"]


class Recent(dict):
    """A dictionary of bounded size that keeps what was asked for lately.

    What was not used since the last turn but one is forgotten.
    """

    def __init__(self):
        self.old = {}

    def __missing__(self, key: str) -> bytes:
        self[key] = value = self.old[key]
        return value

    def unknown(self, keys: Iterable[str]) -> set[str]:
        return set(filterfalse(self.__contains__, keys)).difference(self.old)

    def turn(self, bound: int) -> None:
        if len(self) >= bound:
            self.old = dict(self)
            self.clear()
