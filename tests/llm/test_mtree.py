import math

import numpy as np
import pytest
from helpers import CLASH, CLASHING
from pyspark.sql import functions as F

from noticelens.llm import mtree


def brute(rows, k):
    """(query_id, rank, vec_id, score) by scoring all pairs."""
    fit = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            fit.append((i, tuple(math.floor(256 * float(np.float32(x))) for x in v)))
    out = []
    for i, q in sorted({(i, v) for i, v in fit if i % 50 == 0}):
        scores = sorted(
            (-sum(a * b for a, b in zip(q, v)), j) for j, v in fit if j != i and len(v) == len(q)
        )
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scores[:k])]
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(4)
    data = rng.normal(size=(700, 6))
    data[::3] = data[0]  # a hot vector: many ties
    data[5] *= 30
    out = [(n, v.tolist()) for n, v in enumerate(data)]
    out += [(1000, None), (1050, []), (1051, []), (1100, [1.0, None]), (1150, [math.nan, 1.0]), (1151, [math.inf, 0.0])]
    out += [(1200, [0.5, -0.5]), (1201, [0.25, 0.25]), (None, [1.0] * 6), (50, out[50][1]), (51, out[51][1])]
    return out


@pytest.fixture(scope="module")
def df(spark, rows):
    data = [(i, v, 0, *CLASH) for i, v in rows]
    return spark.createDataFrame(data, f"vec_id long, embedding array<float>, label int, {CLASHING}")


@pytest.mark.parametrize("shard,page,block", [(8192, 256, 4096), (100, 8, 3)])
def test_equals_all_pairs(df, rows, shard, page, block, monkeypatch):
    for name, value in (("SHARD", shard), ("PAGE", page), ("BLOCK", block)):
        monkeypatch.setattr(mtree, name, value)
    got = mtree.top_k(df, F.col("vec_id") % 50 == 0)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 5)


def test_few_candidates_and_empty_table(df):
    few = df.filter("vec_id in (50, 51, 52)").dropDuplicates(["vec_id"])
    got = mtree.top_k(few, F.col("vec_id") % 50 == 0).collect()
    assert [(r.query_id, r.rank) for r in sorted(got)] == [(50, 1), (50, 2)]
    assert mtree.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_tree_bounds_hold_and_prune():
    rng = np.random.default_rng(1)
    vectors = np.rint(np.concatenate([rng.normal(c, 3, size=(400, 4)) for c in (0, 60, 200)])).astype(np.int64)
    tree = mtree.build(np.arange(len(vectors)), vectors)
    points = np.hstack([tree.vectors, np.sqrt(tree.square - (tree.vectors**2).sum(1))[:, None]])
    centres = np.hstack([tree.centre, np.sqrt(np.maximum(tree.square - (tree.centre**2).sum(1), 0))[:, None]])

    def entries(page):
        part = range(tree.first[page], tree.first[page] + tree.count[page])
        return list(part) if tree.leaf[page] else [e for p in part for e in entries(p)]

    assert sorted(tree.ids[entries(0)]) == list(range(len(vectors)))
    for page in range(len(tree.leaf)):
        away = np.linalg.norm(points[entries(page)] - centres[page], axis=1)
        assert away.max() <= tree.radius[page] + 1e-6
    seen = []
    full, tree.vectors = tree.vectors, Counting(tree.vectors, seen)
    mtree.search(tree, -1, full[0], [], 3)
    assert sum(seen) < len(full) / 2


class Counting:
    """Counts the rows that are looked at."""

    def __init__(self, rows, seen):
        self.rows, self.seen = rows, seen

    def __getitem__(self, at):
        self.seen.append(len(at))
        return self.rows[at]


def test_components_beyond_exact_products_are_refused(spark):
    df = spark.createDataFrame([(0, [3e7]), (50, [1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError, match="too large"):
        mtree.top_k(df, F.col("vec_id") % 50 == 0)
