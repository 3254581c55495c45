"""Exact ranks, samples and top-n that never put a hot group into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from noticelens.fixed_values import SEED
from noticelens.session import cut_lineage, small_side

# Seeded order is an md5 in hex, so its first digits cut any group into equal slices.
SLICE_DIGITS = 3


def seeded_order(key: Column, seed: int = SEED) -> Column:
    """A reproducible pseudo-random order, independent of partitioning."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")).cast("binary"))


def _slices(df: DataFrame, group: Column, key: Column, seed: int) -> DataFrame:
    return (
        df.withColumn("_group", group)
        .withColumn("_key", key)
        .withColumn("_order", seeded_order(F.col("_key"), seed))
        .withColumn("_slice", F.substring("_order", 1, SLICE_DIGITS))
    )


def _slice_offsets(sliced: DataFrame) -> DataFrame:
    """Rows in earlier slices of the group; at most 16**SLICE_DIGITS rows per group."""
    earlier = W.partitionBy("_group").orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    return (
        sliced.groupBy("_group", "_slice")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    )


_HELPERS = ("_group", "_key", "_order", "_slice", "_rows", "_before")


def seeded_rank(
    df: DataFrame, group_cols: Sequence[str], key: Column, seed: int = SEED, out: str = "rank"
) -> DataFrame:
    """row_number over (partition by group order by md5), split over slices of the md5.

    A group is ranked slice by slice and each slice starts at the number of rows
    before it, so a group with a third of all rows spreads over 4096 tasks. The
    join and the window share one partitioning by (group, slice).
    """
    sliced = _slices(df, F.struct(*[F.col(c) for c in group_cols]), key, seed)
    within = W.partitionBy("_group", "_slice").orderBy("_order", "_key")
    return (
        sliced.join(_slice_offsets(sliced), ["_group", "_slice"])
        .withColumn(out, F.col("_before") + F.row_number().over(within))
        .drop(*_HELPERS)
    )


# Rows of one md5 prefix that are ranked in one task.
SLICE_ROWS = 100_000


def seeded_sample(
    df: DataFrame, n: int, key: Column, seed: int = SEED, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """Exactly the first ``n`` rows in md5 order (all rows when there are fewer).

    The place of the n-th row is found on keys alone: rows are counted by a prefix of
    their md5, and the one prefix that holds the n-th row is refined until it has few
    rows, which are ranked. A filter then picks the rows where they lie, without a
    shuffle. ``key`` is unique.
    """
    keys = df.select(key.alias("_key")).withColumn("_order", seeded_order(F.col("_key"), seed))
    prefix, wanted = "", n
    while wanted > 0:
        inside = keys.filter(F.col("_order").startswith(prefix))
        slices = inside.groupBy(F.substring("_order", 1, len(prefix) + SLICE_DIGITS).alias("p"))
        found, rows = None, 0
        # At most 16**SLICE_DIGITS counts.
        for p, rows in sorted(slices.agg(F.count(F.lit(1)).alias("rows")).collect()):
            if rows >= wanted:
                found = p
                break
            wanted -= rows
        if found is None:
            return df
        prefix = found
        if rows <= slice_rows or len(prefix) >= 30:
            break
    if wanted <= 0:
        return df.limit(0)
    nth = keys.filter(F.col("_order").startswith(prefix)).orderBy("_order", "_key").limit(wanted)
    last = nth.agg(F.max(F.struct("_order", "_key"))).scalar()
    place = F.struct(seeded_order(F.col("_key"), seed).alias("_order"), F.col("_key"))
    return df.withColumn("_key", key).filter(place <= last).drop("_key")


def top_n(
    df: DataFrame,
    group_cols: Sequence[str],
    order: Sequence[Column],
    n: int,
    spread: Column,
    out: str = "rank",
    salts: int = 64,
) -> DataFrame:
    """First ``n`` rows per group in two steps: per salted part, then over the survivors.

    Exact, since a row of the overall top n is also in the top n of its part.
    """
    parts = W.partitionBy(*group_cols, "_salt").orderBy(*order)
    whole = W.partitionBy(*group_cols).orderBy(*order)
    return (
        df.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)))
        .withColumn(out, F.row_number().over(parts))
        .filter(F.col(out) <= n)
        .withColumn(out, F.row_number().over(whole))
        .filter(F.col(out) <= n)
        .drop("_salt")
    )


def dense_index(df: DataFrame, col: str, out: str = "index") -> DataFrame:
    """Distinct values of ``col`` in order with a dense id from 0.

    The sorted values are range partitioned and checkpointed, which fixes their
    partitions; each partition is numbered on its own from the count before it.
    """
    ordered = cut_lineage(df.select(col).distinct().orderBy(col)).withColumn(
        "_part", F.spark_partition_id()
    )
    earlier = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    # One row per partition of the sorted values.
    starts = (
        ordered.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        .drop("_rows")
    )
    within = W.partitionBy("_part").orderBy(col)
    return ordered.join(small_side(starts), "_part").select(
        col, (F.col("_before") + F.row_number().over(within) - 1).cast("int").alias(out)
    )
