"""An exact L2 index on disk: vectors in cells around pivots, searched by pruning whole cells.

``write_index`` picks pivots from a seeded sample, moves them to the means of the sample's
cells, puts every vector into the cell of its nearest pivot and writes one folder per cell,
its rows by their distance from the pivot. A table of cells holds pivot, rows, and the least
and greatest distance.

``search_index`` finds the exact nearest rows. By the triangle inequality no row of a cell is
nearer to a query than the gap between the query's distance from the pivot and the cell's
range of distances. First, each query searches the cells nearest to it that hold k rows, which
bounds how far the k-th row can be; then all other cells whose gap is within that bound. Cells
that no query needs are not read at all. Rows and queries meet by cell in one shuffle a round,
whatever the number of queries: a cell's queries are cut into blocks and its rows into pieces,
and a task streams a piece's rows past one block of queries.

Only the pivots, their number a parameter, are on the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from noticelens.fixed_values import SEED
from noticelens.operators.ranking import seeded_sample, top_n
from noticelens.operators.vectors import MAX_BLOCK_CELLS, MAX_SCORE_CELLS, column_of, map_batches, to_matrix
from noticelens.session import lookup, written
from noticelens.sources.tables import read_table

# Sampled vectors per pivot; rounds that move the pivots.
SAMPLE_PER_CELL, ROUNDS = 32, 3
# Rows of a piece of a cell, queries of a block.
PIECE, BLOCK = 200_000, 1_024


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    near = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2.0 * (a @ b.T)
    return np.maximum(near, 0.0)


def _pivots(sample: np.ndarray, cells: int) -> np.ndarray:
    """The sample's first distinct vectors, moved to the means of their cells."""
    _, at = np.unique(sample, axis=0, return_index=True)
    pivots = sample[np.sort(at)[:cells]]
    for _ in range(ROUNDS):
        own = _squares(sample, pivots).argmin(axis=1)
        counts = np.bincount(own, minlength=len(pivots))
        sums = np.zeros_like(pivots)
        np.add.at(sums, own, sample)
        pivots = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], pivots)
    return pivots


def write_index(
    rows: DataFrame,
    path: str,
    cells: int = 256,
    id_col: str = "id",
    vec_col: str = "embedding",
    seed: int = SEED,
    piece: int = PIECE,
) -> None:
    """Write ``path``/rows (one folder a cell) and ``path``/cells; the other columns go along.

    The sample of ``cells`` * 32 vectors only places the pivots: every vector is indexed, and
    the search is exact for any pivots. Rows without a vector are left out. A cell of very many
    rows, such as copies of one vector, is written by several tasks.
    """
    spark = rows.sparkSession
    there = rows.filter(F.col(vec_col).isNotNull())
    sample = seeded_sample(there.select(id_col, vec_col), cells * SAMPLE_PER_CELL, F.col(id_col), seed)
    vectors = np.array([r[vec_col] for r in sample.orderBy(id_col).collect()], dtype=np.float64)
    if not len(vectors):
        raise ValueError("there are no vectors to index")
    pivots = _pivots(vectors[np.random.default_rng(seed).permutation(len(vectors))], cells)
    if pivots.size > MAX_BLOCK_CELLS:
        raise ValueError("the pivots are too large for the driver")
    sent = spark.sparkContext.broadcast(pivots)
    added = [T.StructField("_cell", T.IntegerType()), T.StructField("_far", T.DoubleType())]

    def place(batch: pa.RecordBatch) -> list[pa.Array]:
        x = to_matrix(column_of(batch, "_vec"), sent.value.shape[1])
        squares = _squares(x, sent.value)
        cell = squares.argmin(axis=1)
        far = np.sqrt(((x - sent.value[cell]) ** 2).sum(axis=1))
        return [pa.array(cell.astype(np.int32)), pa.array(far)]

    placed = map_batches(there.withColumn("_vec", F.col(vec_col)), ["_vec"], added, place, len(pivots))
    placed = written(placed, "placed")
    ranges = placed.groupBy("_cell").agg(
        F.count(F.lit(1)).alias("rows"), F.min("_far").alias("near"), F.max("_far").alias("far")
    )
    ranges = written(ranges, "ranges")
    table = spark.createDataFrame([(n, p.tolist()) for n, p in enumerate(pivots)], "_cell int, pivot array<double>")
    table.join(ranges, "_cell").withColumnRenamed("_cell", "cell").write.mode("overwrite").parquet(f"{path}/cells")
    pieces = ranges.select("_cell", F.ceil(F.col("rows") / piece).cast("int").alias("_pieces"))
    spread = lookup(placed, pieces, ["_cell"], spread=[id_col]).withColumn(
        "_piece", F.pmod(F.xxhash64(id_col, "_far"), F.col("_pieces"))
    )
    ordered = spread.repartition("_cell", "_piece").sortWithinPartitions("_cell", "_far")
    ordered.drop("_piece", "_pieces").write.mode("overwrite").partitionBy("_cell").parquet(f"{path}/rows")


@dataclass
class Index:
    """An opened index: its rows, and by number the cells' pivots, sizes and ranges."""

    rows: DataFrame
    cells: np.ndarray
    pivots: np.ndarray
    count: np.ndarray
    near: np.ndarray
    far: np.ndarray


def open_index(spark: SparkSession, path: str) -> Index:
    cells = sorted(read_table(spark, f"{path}/cells").collect(), key=lambda r: r["cell"])
    columns = ([r[c] for r in cells] for c in ("cell", "pivot", "rows", "near", "far"))
    return Index(read_table(spark, f"{path}/rows"), *(np.array(c) for c in columns))


def _visits(index: Index, queries: DataFrame, k: int, query_id: str, later: bool) -> DataFrame:
    """(query_id, vec, bound, cell) of the cells that each query looks into.

    At first those nearest to it that hold k rows, later the others within its bound.
    """
    sent = queries.sparkSession.sparkContext.broadcast(
        (index.cells, index.pivots, index.count, index.near, index.far)
    )
    schema = T.StructType([*queries.schema.fields, T.StructField("cell", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, pivots, count, near, far = sent.value
        step = max(1, MAX_SCORE_CELLS // (4 * len(cells)))
        for whole in batches:
            for start in range(0, whole.num_rows, step):
                batch = whole.slice(start, step)
                q = to_matrix(column_of(batch, "vec"), pivots.shape[1])
                away = np.sqrt(_squares(q, pivots))
                gap = np.maximum(np.maximum(away - far, near - away), 0.0)
                order = np.lexsort((np.broadcast_to(cells, gap.shape), away, gap), axis=1)
                before = np.cumsum(count[order], axis=1) - count[order]
                first = np.zeros(gap.shape, dtype=bool)
                np.put_along_axis(first, order, before < k, axis=1)
                wanted = first
                if later:
                    bound = column_of(batch, "bound").to_numpy(zero_copy_only=False).astype(np.float64)
                    # Rounding must not hide a row: the gap is taken a little smaller.
                    reach = np.sqrt(np.where(np.isnan(bound), np.inf, bound))[:, None]
                    wanted = ~first & (gap * (1 - 1e-9) - 1e-6 <= reach)
                row, cell = np.nonzero(wanted)
                part = batch.take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(cells[cell].astype(np.int32))], names=[*batch.schema.names, "cell"]
                )

    return queries.mapInArrow(run, schema)


def _searched(index: Index, visits: DataFrame, k: int, query_id: str, id_col: str, vec_col: str, piece: int, block: int):
    """The k nearest rows of every query in every piece of the cells it visits."""
    spark = visits.sparkSession
    asked = {r["cell"]: r["n"] for r in visits.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    # One row a cell, so this is as small as the pivots.
    split = spark.createDataFrame(
        [(int(c), -(-asked[c] // block), -(-int(n) // piece)) for c, n in zip(index.cells, index.count) if c in asked],
        "cell int, blocks int, pieces int",
    )
    cells = [int(c) for c in asked]
    rows = index.rows.filter(F.col("_cell").isin(cells)).select(
        F.col("_cell").alias("cell"), F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).alias("vec")
    )
    key = visits.schema[query_id].dataType

    def every(count: str):
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    rows = rows.join(F.broadcast(split), "cell").select(
        "cell", every("blocks").alias("block"), F.pmod(F.xxhash64("id"), F.col("pieces")).cast("int").alias("piece"),
        F.lit(True).alias("is_row"), F.lit(None).cast(key).alias("query_id"), "id", F.col("vec").cast("array<double>").alias("vec"),
    )
    asks = visits.join(F.broadcast(split), "cell").select(
        "cell", F.pmod(F.xxhash64(query_id), F.col("blocks")).cast("int").alias("block"), every("pieces").alias("piece"),
        F.lit(False).alias("is_row"), F.col(query_id).alias("query_id"), F.lit(None).cast("bigint").alias("id"),
        F.col("vec").cast("array<double>").alias("vec"),
    )
    group = ["cell", "block", "piece"]
    both = rows.unionByName(asks).repartition(*group).sortWithinPartitions(*group, "is_row")
    schema = T.StructType([T.StructField(query_id, key), T.StructField("id", T.LongType()), T.StructField("distance", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, names, queries, best = None, [], [], []

        def done() -> Iterator[pa.RecordBatch]:
            found = [(n, d, i) for n, (d, i) in zip(names, best) if len(d)]
            if found:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([n for n, d, _ in found for _ in d], batch.schema.field(4).type),
                        pa.array(np.concatenate([i for _, _, i in found])),
                        pa.array(np.concatenate([d for _, d, _ in found])),
                    ],
                    names=[query_id, "id", "distance"],
                )

        for batch in batches:
            marks = np.stack([batch.column(n).to_numpy(zero_copy_only=False) for n in range(4)])
            cuts = np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1
            for first, last in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                part = batch.slice(first, last - first)
                if tuple(marks[:3, first]) != now:
                    yield from done()
                    now, names, queries, best = tuple(marks[:3, first]), [], [], []
                if not marks[3, first]:
                    names += part.column(4).to_pylist()
                    queries += part.column(6).to_pylist()
                    best += [(np.empty(0), np.empty(0, dtype=np.int64))] * part.num_rows
                elif names:
                    q = np.array(queries, dtype=np.float64)
                    for start in range(0, part.num_rows, max(1, MAX_SCORE_CELLS // len(names))):
                        some = part.slice(start, max(1, MAX_SCORE_CELLS // len(names)))
                        ids = some.column(5).to_numpy(zero_copy_only=False)
                        near = np.round(_squares(q, to_matrix(some.column(6), q.shape[1])), 9)
                        for n, (kept, kept_ids) in enumerate(best):
                            d, all_ids = np.concatenate([kept, near[n]]), np.concatenate([kept_ids, ids])
                            if len(d) > k:
                                close = np.flatnonzero(d <= np.partition(d, k - 1)[k - 1])
                                d, all_ids = d[close], all_ids[close]
                            order = np.lexsort((all_ids, d))[:k]
                            best[n] = d[order], all_ids[order]
        yield from done()

    return both.mapInArrow(run, schema)


def search_index(
    spark: SparkSession,
    path: str,
    queries: DataFrame,
    k: int,
    query_id: str = "query_id",
    id_col: str = "id",
    vec_col: str = "embedding",
    piece: int = PIECE,
    block: int = BLOCK,
) -> tuple[DataFrame, DataFrame]:
    """Exact nearest rows (query_id, id, distance, rank) and (query_id, cells_read, cells).

    Distances are squared; ties take the smaller id. ``query_id`` names the queries, which
    must differ; queries without a vector have no rows. The second frame counts the cells
    that each query looked into.
    """
    index = open_index(spark, path)
    asked = written(queries.select(query_id, F.col(vec_col).alias("vec")).filter("vec is not null"), "queries")
    first = written(_visits(index, asked, k, query_id, later=False), "visits")
    near = written(_searched(index, first, k, query_id, id_col, vec_col, piece, block), "nearest")
    order = [F.asc("distance"), F.asc("id")]
    heads = top_n(near, [query_id], order, k, F.col("id"))
    bounds = heads.groupBy(query_id).agg(F.when(F.count(F.lit(1)) >= k, F.max("distance")).alias("bound"))
    bounded = written(asked.join(bounds, query_id, "left"), "bounded")
    later = written(_visits(index, bounded, k, query_id, later=True), "visits")
    more = _searched(index, later, k, query_id, id_col, vec_col, piece, block)
    found = top_n(near.unionByName(more), [query_id], order, k, F.col("id"))
    reads = first.select(query_id).unionByName(later.select(query_id)).groupBy(query_id)
    return found, reads.agg(F.count(F.lit(1)).alias("cells_read")).withColumn("cells", F.lit(len(index.cells)))
