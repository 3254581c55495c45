"""Exact top-k search by inner product with best-first search in M-trees.

The vectors are dealt by a hash of their ids into shards of bounded size, and each shard
becomes an M-tree: pages of entries around a centre, with the covering radius of every
page and the distance of every entry to the centre of its page. One more component,
sqrt(m - |v|^2) with m the largest squared length of the tree, makes all vectors equally
long, so that the Euclidean distance to a query (with 0 there) falls as the inner product
grows, and the triangle inequality holds.

A query visits pages in the order of the least distance they may hold and stops when that
exceeds its k-th best. Distances that the stored ones already rule out are not computed.
Inner products are of integers and exact; bounds give way by a rounding margin.

The queries are a set of their own. They go to the trees in blocks of bounded size, one
block at a time; tasks keep the best of all their trees, and the best of the tasks are
merged in two steps.

Defined cases: vectors that are null or hold null, infinite or undefined components take
no part, nor do rows without an id; vectors of different lengths are never compared;
a query never meets rows of its own id; repeated rows are candidates each, repeated
queries are asked once; ties go to the smaller id; with fewer than k candidates all are
returned; other columns are not read; empty tables give an empty result.
"""

from __future__ import annotations

import heapq
import io
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from noticelens.llm.common import stored

SHARD, PAGE, FANOUT, BLOCK = 8_192, 256, 16, 4_096
# Margin of computed distances against rounding, relative.
MARGIN = 1e-9


@dataclass
class Tree:
    """Pages as arrays; children of a page, or entries of a leaf, lie side by side."""

    ids: np.ndarray
    vectors: np.ndarray
    to_centre: np.ndarray
    centre: np.ndarray
    radius: np.ndarray
    to_parent: np.ndarray
    first: np.ndarray
    count: np.ndarray
    leaf: np.ndarray
    square: float

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{k: v for k, v in vars(self).items()})
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> Tree:
        with np.load(io.BytesIO(data)) as found:
            return cls(**{k: found[k] for k in found.files})

    def distance(self, squared_query: float, products: np.ndarray) -> np.ndarray:
        """Distances to a query from its inner products."""
        return np.sqrt(np.maximum(squared_query + self.square - 2 * products, 0))


def build(ids: np.ndarray, vectors: np.ndarray) -> Tree:
    """Bulk-load a tree: deal vectors to the nearest of some of them, level by level."""
    vectors = vectors.astype(np.float64)
    squares = (vectors**2).sum(1)
    square = squares.max(initial=0.0)
    points = np.hstack([vectors, np.sqrt(square - squares)[:, None]])
    order: list[np.ndarray] = []
    pages: list[list] = []  # centre, radius, distance to parent's centre, first, count, leaf
    entries = 0

    def deal(rows: np.ndarray) -> list[np.ndarray]:
        seeds = min(FANOUT, -(-2 * len(rows) // PAGE))
        chosen = points[rows[np.arange(seeds) * len(rows) // seeds]]
        far = (chosen**2).sum(1)[None, :] - 2 * points[rows] @ chosen.T
        group = far.argmin(1)
        if np.bincount(group).max() == len(rows):  # equal points
            group = np.arange(len(rows)) * seeds // len(rows)
        return [rows[group == g] for g in range(seeds) if (group == g).any()]

    def page(rows: np.ndarray, parent: int | None) -> list:
        centre = rows[len(rows) // 2]
        away = np.linalg.norm(points[rows] - points[centre], axis=1)
        up = 0.0 if parent is None else float(np.linalg.norm(points[centre] - points[parent]))
        return [centre, float(away.max()), up, 0, 0, True]

    open_ = [(0, np.arange(len(ids)))]
    if len(ids):
        pages.append(page(open_[0][1], None))
    else:
        open_ = []
    to_centre = []
    while open_:
        at, rows = open_.pop()
        if len(rows) <= PAGE:
            pages[at][3:] = [entries, len(rows), True]
            order.append(rows)
            to_centre.append(np.linalg.norm(points[rows] - points[pages[at][0]], axis=1))
            entries += len(rows)
            continue
        parts = deal(rows)
        pages[at][3:] = [len(pages), len(parts), False]
        for part in parts:
            open_.append((len(pages), part))
            pages.append(page(part, pages[at][0]))
    rows = np.concatenate(order) if order else np.zeros(0, dtype=np.int64)
    columns = list(zip(*pages)) or [()] * 6
    return Tree(
        ids[rows],
        vectors[rows],
        np.concatenate(to_centre) if to_centre else np.zeros(0),
        vectors[np.array(columns[0], dtype=np.int64)],
        np.array(columns[1]),
        np.array(columns[2]),
        np.array(columns[3], dtype=np.int64),
        np.array(columns[4], dtype=np.int64),
        np.array(columns[5], dtype=bool),
        float(square),
    )


def search(tree: Tree, own: int, query: np.ndarray, best: list[tuple[int, int]], k: int) -> None:
    """Merge the k best (score, -id) of a tree into ``best``, a heap with the worst first."""
    if not len(tree.ids):
        return
    squared = float(query @ query)

    def limit() -> float:
        if len(best) < k:
            return np.inf
        return float(tree.distance(squared, np.float64(best[0][0]))) * (1 + MARGIN) + MARGIN

    root = float(tree.distance(squared, tree.centre[0] @ query))
    waiting, reach = [(max(root - tree.radius[0], 0.0), 0, root)], limit()
    while waiting:
        least, at, here = heapq.heappop(waiting)
        if least > reach:
            return
        part = slice(tree.first[at], tree.first[at] + tree.count[at])
        if tree.leaf[at]:
            near = np.nonzero(np.abs(tree.to_centre[part] - here) <= reach)[0] + part.start
            products = tree.vectors[near] @ query
            if len(best) == k:
                good = products >= best[0][0]
                near, products = near[good], products[good]
            for score, number in zip(products.astype(np.int64).tolist(), tree.ids[near].tolist()):
                if number == own:
                    continue
                if len(best) < k:
                    heapq.heappush(best, (score, -number))
                elif (score, -number) > best[0]:
                    heapq.heapreplace(best, (score, -number))
            reach = limit()
        else:
            gap = np.abs(tree.to_parent[part] - here) - tree.radius[part]
            near = np.nonzero(gap <= reach)[0] + part.start
            away = tree.distance(squared, tree.centre[near] @ query)
            bounds = np.maximum(away - tree.radius[near], 0)
            for n, bound, distance in zip(near.tolist(), bounds.tolist(), away.tolist()):
                if bound <= reach:
                    heapq.heappush(waiting, (bound, n, distance))


def scaled(vector_col: str, factor: int = 256) -> Column:
    """floor(factor * x) of every component; null if the vector cannot take part."""
    x = F.col(vector_col)
    fit = x.isNotNull() & F.forall(
        x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    )
    return F.when(fit, F.transform(x, lambda v: F.floor(v.cast("double") * factor).cast("long")))


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    factor: int = 256,
) -> DataFrame:
    """(query_id, rank, id, score): the k best rows of every query, from all rows.

    Inner products are sums of doubles, exact below 2**53; components so large that one could
    reach that are refused.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"),
        scaled(vector_col, factor).alias("v"),
        is_query.alias("asks"),
    ).filter("id is not null and v is not null")
    rows = stored(rows.withColumn("size", F.size("v")), "vectors")
    largest = F.array_max(F.transform("v", lambda x: F.abs(x))).cast("double")
    count, reach = rows.agg(F.count(F.lit(1)), F.max(largest * largest * F.col("size"))).first()
    if (reach or 0) >= 2.0**53:
        raise ValueError("components are too large for exact inner products")
    forest = stored(_forest(rows, max(1, -(-count // SHARD))), "forest")
    queries = rows.filter("asks").select("id", "v", "size").distinct()
    blocks = max(1, -(-rows.filter("asks").count() // BLOCK))
    number = F.pmod(F.xxhash64("id", "v"), F.lit(blocks)).cast("int")
    queries = stored(queries.withColumn("block", number), "queries", partition_by="block")
    found = None
    for block in range(blocks):
        part = queries.filter(F.col("block") == block).select("id", "v", "size").toPandas()
        answers = stored(_answers(forest, part, k), "answers")
        found = answers if found is None else found.unionByName(answers)
    return _merged(found, k).select("query_id", "rank", F.col("id").alias(id_col), "score")


def _forest(rows: DataFrame, shards: int) -> DataFrame:
    """(size, shard, tree) of the trees of all shards."""

    def grow(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        size, shard = key
        matrix = np.array(group["v"].tolist(), dtype=np.int64).reshape(len(group), size)
        tree = build(group["id"].to_numpy(np.int64), matrix)
        return pd.DataFrame({"size": [size], "shard": [shard], "tree": [tree.to_bytes()]})

    shard = F.pmod(F.xxhash64("id", F.lit(5)), F.lit(shards)).cast("int")
    grown = rows.withColumn("shard", shard).groupBy("size", "shard")
    return grown.applyInPandas(grow, "size int, shard int, tree binary")


def _answers(forest: DataFrame, queries: pd.DataFrame, k: int) -> DataFrame:
    """(query_id, query, part, id, score): what each task found for a block of queries."""
    by_size = {
        int(size): (group["id"].tolist(), np.array(group["v"].tolist(), dtype=np.float64))
        for size, group in queries.groupby("size")
    }
    sent = forest.sparkSession.sparkContext.broadcast(by_size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple[int, int], list] = {}
        for batch in batches:
            for size, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                if size not in sent.value:
                    continue
                tree = Tree.from_bytes(data.as_buffer())
                for n, (own, query) in enumerate(zip(*sent.value[size])):
                    search(tree, own, query, best.setdefault((size, n), []), k)
        out = [
            (sent.value[size][0][n], size, n, -negative, score)
            for (size, n), found in best.items()
            for score, negative in found
        ]
        columns = list(zip(*out)) or [()] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()))],
            names=["query_id", "size", "query", "id", "score"],
        )

    schema = "query_id long, size int, query int, id long, score long"
    found = forest.select("size", "tree").mapInArrow(run, schema)
    return found.withColumn("part", F.spark_partition_id() % 64)


def _merged(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query: first among some of the tasks, then among those."""
    one = ["query_id", "size", "query"]
    order = [F.desc("score"), F.asc("id")]
    for keys in ([*one, "part"], one):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        found = found.withColumn("rank", rank).filter(F.col("rank") <= k)
    return found
