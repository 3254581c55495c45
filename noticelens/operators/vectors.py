"""Vector columns: cosine channels against a bounded table, pooling, int8 storage.

Similarity work runs as Arrow batches against a matrix shipped to the executors.
The matrix is only shipped after its size was measured; a larger one goes out in
blocks, one after the other, and the block results are merged, which is exact.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from noticelens.fixed_values import SEED
from noticelens.operators.ranking import seeded_sample, top_n
from noticelens.session import written

# At most this many vector cells (64 MB of doubles) travel to the executors at once.
MAX_BLOCK_CELLS = 8_000_000
# Scores held by one task at a time.
MAX_SCORE_CELLS = 4_000_000


def blocks(
    df: DataFrame, key_cols: Sequence[str], vec_cols: Sequence[str], max_cells: int
) -> tuple[int, Iterator[list[Row]]]:
    """The rows of a vector table in pieces of bounded size, in the order of the keys.

    Gives the number of pieces, usually one, and an iterator that fetches them one by
    one; only the piece in use is on the driver. The table is written once, in ranges of
    the keys if there are several. Rows without a vector are left out.
    """
    df = written(df.dropna(subset=list(vec_cols)), "vectors")
    cells = df.agg(*[F.coalesce(F.sum(F.size(c)), F.lit(0)).alias(c) for c in vec_cols]).first()
    n = sum(cells)
    if n == 0:
        return 0, iter(())
    if n <= max_cells:
        return 1, iter([df.orderBy(*key_cols).collect()])
    parts = math.ceil(2 * n / max_cells)
    ranges = df.repartitionByRange(parts, *key_cols).withColumn("_piece", F.spark_partition_id())
    ranges = written(ranges, "pieces", partition_by="_piece")
    names = sorted(r[0] for r in ranges.select("_piece").distinct().collect())
    pieces = (
        ranges.filter(F.col("_piece") == i).drop("_piece").orderBy(*key_cols).collect() for i in names
    )
    return len(names), pieces


def to_matrix(column: pa.Array, dim: int) -> np.ndarray:
    """List column to a dense double matrix; a null vector becomes zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if column.null_count == 0:
        return flat.reshape(len(column), dim)
    out = np.zeros((len(column), dim))
    out[column.is_valid().to_numpy(zero_copy_only=False)] = flat.reshape(-1, dim)
    return out


def unit_rows(m: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; a zero row stays zero, so its cosine is 0."""
    norms = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(norms == 0, 1.0, norms)


def stack(rows: Sequence[Row], col: str) -> np.ndarray:
    return np.array([r[col] for r in rows], dtype=np.float64)


def map_batches(
    df: DataFrame,
    vec_cols: Sequence[str],
    added: Sequence[T.StructField],
    work: Callable[[pa.RecordBatch], list[pa.Array]],
    width: int,
) -> DataFrame:
    """Replace the vector columns by ``added`` columns; the other columns ride along.

    Batches are cut so that rows x ``width`` scores stay within a task's share.
    """
    kept = [c for c in df.columns if c not in vec_cols]
    schema = T.StructType([df.schema[c] for c in kept] + list(added))
    step = max(1, MAX_SCORE_CELLS // max(1, width))
    names = [f.name for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                columns = [part.column(part.schema.get_field_index(c)) for c in kept]
                yield pa.RecordBatch.from_arrays(columns + work(part), names=names)

    return df.mapInArrow(run, schema)


def column_of(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def mean_pool(
    tokens: DataFrame, key: str, vec_col: str, mask_col: str, out: str = "embedding"
) -> DataFrame:
    """Mean of the unmasked token vectors per key; the divisor is at least 1e-9.

    The mask is 0 or 1. Summarizer merges partial sums before the shuffle, so a long
    text costs one row per map task.
    """
    mask = F.col(mask_col).cast("double")
    cells = F.col(vec_col).cast("array<double>")
    masked = F.when(mask > 0, cells).otherwise(F.array_repeat(F.lit(0.0), F.size(cells)))
    pooled = tokens.groupBy(key).agg(
        Summarizer.sum(array_to_vector(masked)).alias("_sum"), F.sum(mask).alias("_n")
    )
    mean = F.transform(vector_to_array("_sum"), lambda x: x / F.greatest("_n", F.lit(1e-9)))
    return pooled.select(key, mean.alias(out))


def group_means(df: DataFrame, keys: Sequence[str], vec_cols: Sequence[str]) -> DataFrame:
    """Mean vector per group and vector column over rows that have all of them.

    Merged partially before the shuffle.
    """
    means = df.dropna(subset=list(vec_cols)).groupBy(*keys).agg(
        *[
            Summarizer.mean(array_to_vector(F.col(c).cast("array<double>"))).alias(c)
            for c in vec_cols
        ]
    )
    return means.select(*keys, *[vector_to_array(c).alias(c) for c in vec_cols])


def calibrate_minmax(
    df: DataFrame, key: str, vec_col: str, n: int | None = None, seed: int = SEED
) -> DataFrame:
    """One row: range, scale and zero point of all vectors, or of a seeded sample of ``n``.

    A constant range would give scale 0, so the scale falls back to 1.
    """
    sample = df.filter(F.col(vec_col).isNotNull()).select(key, vec_col)
    if n is not None:
        sample = seeded_sample(sample, n, F.col(key), seed)
    ranges = sample.agg(
        F.min(F.array_min(vec_col)).cast("double").alias("low"),
        F.max(F.array_max(vec_col)).cast("double").alias("high"),
    )
    span = F.col("high") - F.col("low")
    return ranges.withColumn("scale", F.when(span > 0, span / 255).otherwise(1.0)).withColumn(
        "zero_point", F.rint(-F.col("low") / F.col("scale")).cast("int")
    )


def quantize_int8(
    df: DataFrame, vec_col: str, calibration: DataFrame, out: str = "q"
) -> DataFrame:
    """Affine 8-bit codes of a vector column, the decoded vector and its worst error.

    Values outside the calibrated range saturate.
    """
    params = calibration.select(F.struct("scale", "zero_point")).scalar()
    with_params = df.withColumn("_params", params).withColumns(
        {"_scale": F.col("_params.scale"), "_zero": F.col("_params.zero_point")}
    )
    cells = F.col(vec_col).cast("array<double>")

    def encode(x: Column) -> Column:
        # rint rounds half to even.
        code = F.rint(x / F.col("_scale")).cast("int") + F.col("_zero")
        return F.least(F.greatest(code, F.lit(0)), F.lit(255)).cast("short")

    def decode(q: Column) -> Column:
        return (q - F.col("_zero")) * F.col("_scale")

    coded = with_params.withColumn(out, F.transform(cells, encode))
    errors = F.zip_with(cells, out, lambda x, q: F.abs(x - decode(q)))
    return coded.withColumns(
        {"decoded": F.transform(out, decode), "max_error": F.array_max(errors)}
    ).drop("_params", "_scale", "_zero")


def knn(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    query_id: str = "query_id",
    corpus_id: str = "id",
    vec_col: str = "embedding",
    max_cells: int = MAX_BLOCK_CELLS,
) -> DataFrame:
    """Exact nearest corpus vectors by squared L2: (query_id, id, distance, rank).

    A block of queries goes to the executors; each task keeps its best k per
    query, so only tasks x queries x k rows are shuffled. Ties take the smaller id.
    """
    sc = corpus.sparkSession.sparkContext
    corpus = corpus.select(F.col(corpus_id).cast("bigint").alias("id"), F.col(vec_col).alias("vec"))
    schema = T.StructType(
        [queries.schema[query_id], T.StructField("id", T.LongType()), T.StructField("distance", T.DoubleType())]
    )
    found = None
    count, pieces = blocks(queries.select(query_id, vec_col), [query_id], [vec_col], max_cells)
    for rows in pieces:
        shared = sc.broadcast(([r[query_id] for r in rows], stack(rows, vec_col)))
        part = corpus.mapInArrow(_nearest_in_task(shared, k, query_id), schema)
        if count > 1:
            part = written(part, "nearest")
            shared.unpersist()
        found = part if found is None else found.unionByName(part)
    if found is None:
        return corpus.sparkSession.createDataFrame([], schema.add("rank", T.IntegerType()))
    return top_n(found, [query_id], [F.asc("distance"), F.asc("id")], k, F.col("id"))


def _nearest_in_task(shared, k: int, query_id: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, q = shared.value
        square = (q * q).sum(axis=1)[:, None]
        best = [(np.empty(0), np.empty(0, dtype=np.int64)) for _ in names]
        step = max(1, MAX_SCORE_CELLS // len(names))
        for batch in batches:
            valid = batch.filter(column_of(batch, "vec").is_valid())
            for start in range(0, valid.num_rows, step):
                part = valid.slice(start, step)
                ids = column_of(part, "id").to_numpy(zero_copy_only=False)
                c = to_matrix(column_of(part, "vec"), q.shape[1])
                near = square + (c * c).sum(axis=1)[None, :] - 2.0 * (q @ c.T)
                near = np.round(np.maximum(near, 0.0), 9)
                for i, (kept, kept_ids) in enumerate(best):
                    d, all_ids = np.concatenate([kept, near[i]]), np.concatenate([kept_ids, ids])
                    if len(d) > k:
                        close = np.flatnonzero(d <= np.partition(d, k - 1)[k - 1])
                        d, all_ids = d[close], all_ids[close]
                    order = np.lexsort((all_ids, d))[:k]
                    best[i] = (d[order], all_ids[order])
        for name, (d, ids) in zip(names, best):
            if len(d):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(d)), pa.array(ids), pa.array(d)],
                    names=[query_id, "id", "distance"],
                )

    return run
