import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from noticelens.operators import density


def brute(points, eps, min_samples, min_size, count_self=False):
    """Cluster ids by plain graph search."""
    keys = sorted(points)
    near = {
        a: [b for b in keys if b != a and (points[a][0] - points[b][0]) ** 2 + (points[a][1] - points[b][1]) ** 2 <= eps * eps]
        for a in keys
    }
    core = {a for a in keys if len(near[a]) + count_self >= min_samples}
    seen, groups = set(), []
    for a in keys:
        if a in core and a not in seen:
            stack, group = [a], []
            seen.add(a)
            while stack:
                x = stack.pop()
                group.append(x)
                for y in near[x]:
                    if y in core and y not in seen:
                        seen.add(y)
                        stack.append(y)
            groups.append(group)
    out = dict.fromkeys(keys, -1)
    for n, group in enumerate(g for g in sorted(groups, key=min) if len(g) >= min_size):
        out.update(dict.fromkeys(group, n))
    return out


def frame(spark, points, parts=5):
    rows = [(k, float(x), float(y)) for k, (x, y) in points.items()]
    return spark.createDataFrame(rows, "id bigint, x double, y double").repartition(parts)


def run(spark, points, *args, **kw):
    return {r.id: r.cluster_id for r in density.density_cluster(frame(spark, points), *args, **kw).collect()}


def mixture(seed):
    """Blobs, a sparse background, a long chain, and one spot with a third of the points."""
    rng = np.random.default_rng(seed)
    parts = [
        rng.normal((0, 0), 0.05, (80, 2)),
        rng.normal((0.6, 0.1), 0.08, (60, 2)),
        rng.uniform(-2, 2, (120, 2)),
        np.column_stack([np.linspace(-2, 2, 90), np.full(90, 1.5)]),
        np.full((170, 2), (0.9, -0.9)),
    ]
    cloud = np.vstack(parts)
    order = rng.permutation(len(cloud))
    return {int(k): cloud[i] for k, i in enumerate(order)}


@pytest.mark.parametrize("seed,eps,min_samples,min_size,count_self", [(1, 0.1, 4, 8, False), (2, 0.05, 3, 5, True), (3, 0.21, 9, 20, False)])
def test_equals_graph_search(spark, seed, eps, min_samples, min_size, count_self):
    points = mixture(seed)
    got = run(spark, points, eps, min_samples, min_size, count_self=count_self)
    assert got == brute(points, eps, min_samples, min_size, count_self)


def test_two_dense_spots_near_the_radius(spark):
    rng = np.random.default_rng(5)
    for gap, together in ((0.0999, 1), (0.1001, 2)):
        left = np.column_stack([-rng.uniform(0, 0.02, 60), rng.uniform(0, 0.5, 60)])
        right = np.column_stack([gap + rng.uniform(0, 0.02, 60), rng.uniform(0, 0.5, 60)])
        left[0], right[0] = (0.0, 0.25), (gap, 0.25)
        points = dict(enumerate(np.vstack([left, right])))
        got = run(spark, points, 0.1, 3, 5)
        assert got == brute(points, 0.1, 3, 5)
        if together == 2:
            assert len(set(got.values()) - {-1}) == 2


def test_rows_without_coordinates_are_noise(spark):
    df = frame(spark, {n: (0.0, 0.0) for n in range(6)}).unionByName(
        spark.createDataFrame([(77, None, 1.0)], "id bigint, x double, y double")
    )
    got = {r.id: r.cluster_id for r in density.density_cluster(df, 0.1, 3, 3).collect()}
    assert got == {**dict.fromkeys(range(6), 0), 77: -1}


def test_no_core_point_at_all(spark):
    got = run(spark, {0: (0.0, 0.0), 1: (9.0, 9.0)}, 0.1, 3, 1)
    assert got == {0: -1, 1: -1}


def test_components_of_long_paths(spark):
    rng = np.random.default_rng(3)
    ids = rng.permutation(400).tolist()
    paths = [ids[:300], ids[300:390]]
    edges = [(a, b) for p in paths for a, b in zip(p, p[1:])]
    both = spark.createDataFrame(edges + [(b, a) for a, b in edges], "u bigint, v bigint")
    nodes = spark.createDataFrame([(n,) for n in ids], "id bigint")
    got = {r.id: r.root for r in density.components(nodes, both).collect()}
    expected = {n: min(p) for p in paths for n in p} | {n: n for n in ids[390:]}
    assert got == expected


def test_components_of_a_large_graph(spark, monkeypatch):
    monkeypatch.setattr(density, "is_small", lambda df: False)
    edges = [(n, n + 2) for n in range(60)]
    both = spark.createDataFrame(edges + [(b, a) for a, b in edges], "u bigint, v bigint")
    nodes = spark.createDataFrame([(n,) for n in range(62)], "id bigint")
    got = {r.id: r.root for r in density.components(nodes, both).collect()}
    assert got == {n: n % 2 for n in range(62)}


def test_suggest_eps(spark):
    points = mixture(6)
    xy = np.array([points[k] for k in sorted(points)])
    d = np.sqrt(((xy[:, None] - xy[None]) ** 2).sum(-1))
    expected = np.sort(np.sort(d, axis=1)[:, 4])
    got = density.suggest_eps(frame(spark, points), 4, 0.9, 10_000)
    assert expected[int(0.88 * len(xy))] - 1e-4 <= got <= expected[int(0.92 * len(xy))] + 1e-4


def test_row_order_does_not_matter(spark):
    points = mixture(4)
    df = frame(spark, points)
    a = density.density_cluster(df, 0.1, 4, 8).collect()
    b = density.density_cluster(df.orderBy(F.desc("id")).coalesce(1), 0.1, 4, 8).collect()
    assert sorted(a) == sorted(b)


def test_query_reads_whole_vectors(spark, tmp_path):
    """Three groups that differ in the last two cells only."""
    from noticelens.plans.clusters import density_cluster as query

    rng = random.Random(5)
    centres = ((0.0, 0.0), (9.0, 0.0), (0.0, 5.0))
    rows = [
        (n, [rng.random() * 1e-3 for _ in range(62)] + [c + rng.random() for c in centres[n % 3]], n % 3)
        for n in range(150)
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    df.write.parquet(str(tmp_path / "embeddings.parquet"))
    found = {}
    for r in query(spark, str(tmp_path)).collect():
        if r.cluster_id >= 0:
            found.setdefault(r.id % 3, set()).add(r.cluster_id)
    assert len(found) == 3 and not found[0] & found[1] and not found[0] & found[2] and not found[1] & found[2]
