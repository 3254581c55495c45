import math
import random
import tracemalloc

import numpy as np
import pytest

from noticelens.operators import hierarchy
from noticelens.operators.hierarchy import SHORTEST, _octant, _octant_gap2, hierarchical_cluster


def brute(points, needed, smallest, allow_single=False):
    """Clusters of (key, x, y) by raising the threshold over all pairs."""
    keys = [p[0] for p in points]
    xy = np.array([p[1:] for p in points], dtype=float).reshape(-1, 2)
    size = len(points)
    if size < max(needed + 1, smallest):
        return dict.fromkeys(keys, -1)
    d2 = (xy[:, None, 0] - xy[None, :, 0]) ** 2 + (xy[:, None, 1] - xy[None, :, 1]) ** 2
    core = np.sort(d2 + np.diag(np.full(size, -1.0)), axis=1)[:, needed]
    reach = np.maximum(np.maximum(core[:, None], core[None, :]), d2)
    # Prim's order: the components of a threshold are runs without a heavier step.
    left, best, order, steps = set(range(1, size)), reach[0].copy(), [0], [math.inf]
    while left:
        n = min(left, key=lambda k: best[k])
        left.remove(n)
        order.append(n)
        steps.append(best[n])
        best = np.minimum(best, reach[n])
    since, parent, member, joined = [], [], {}, {}
    now = {}  # first place of a large component -> (last place, node)
    for w in sorted(set(steps[1:])):
        starts = [n for n in range(size) if steps[n] > w] + [size]
        after = {}
        for first, last in zip(starts, starts[1:]):
            if last - first < smallest:
                continue
            inner = [node for at, (end, node) in now.items() if first <= at and end <= last]
            if len(inner) == 1:
                node = inner[0]
            else:
                node = len(since)
                since.append(w)
                parent.append(-1)
                for n in inner:
                    parent[n] = node
            after[first] = (last, node)
            for place in range(first, last):
                if order[place] not in joined:
                    joined[order[place]] = (node, w)
        now = after
    dense = lambda w: 1 / max(math.sqrt(w), SHORTEST)
    below = {n: [c for c in range(len(since)) if parent[c] == n] for n in range(len(since))}
    count, value, taken = {}, {}, {}
    for n in range(len(since)):
        birth = dense(since[parent[n]]) if parent[n] >= 0 else 0.0
        own = [dense(w) for node, w in joined.values() if node == n]
        inner = sum(count[c] for c in below[n])
        count[n] = len(own) + inner
        gain = sum(own) - len(own) * birth + inner * (dense(since[n]) - birth)
        rest = sum(value[c] for c in below[n])
        taken[n] = (parent[n] >= 0 or allow_single) and (not below[n] or gain >= rest - 1e-9 * abs(rest))
        value[n] = gain if taken[n] else rest
    label = {}
    for n in reversed(range(len(since))):
        up = label.get(parent[n], -1)
        label[n] = up if up >= 0 else n if taken[n] else -1
    raw = {keys[n]: label[joined[n][0]] if n in joined else -1 for n in range(size)}
    firsts = {}
    for k in sorted(raw):
        if raw[k] >= 0:
            firsts.setdefault(raw[k], len(firsts))
    return {k: firsts.get(v, -1) for k, v in raw.items()}


def blobs(seed, size, ties=False):
    rng = random.Random(seed)
    centres = [(rng.uniform(-9, 9), rng.uniform(-9, 9), rng.uniform(0.1, 0.9)) for _ in range(7)]
    out = []
    for n in range(size):
        cx, cy, spread = rng.choice(centres)
        x, y = (rng.uniform(-10, 10), rng.uniform(-10, 10)) if n % 6 == 0 else (rng.gauss(cx, spread), rng.gauss(cy, spread))
        out.append((n + 100, round(x * 4) / 4, round(y * 4) / 4) if ties else (n + 100, x, y))
    return out


def clusters(spark, points, **options):
    df = spark.createDataFrame(points, "id long, x double, y double")
    found = hierarchical_cluster(df, **options)
    assert found.columns == ["id", "cluster_id"]
    return {r.id: r.cluster_id for r in found.collect()}


@pytest.mark.parametrize("tile", [4_096, 60])
@pytest.mark.parametrize("ties", [False, True])
def test_equals_brute_force(spark, ties, tile):
    points = blobs(5, 2_000, ties)
    want = brute(points, 5, 20)
    assert len(set(want.values())) > 4
    assert clusters(spark, points, min_samples=5, min_cluster_size=20, tile=tile) == want


def test_hot_spots_and_lines(spark):
    # A third of all rows at one place, another hot place, points on a line, a lattice.
    points = [(n, 1.0, 1.0) for n in range(150)] + [(n, 5.0, 1.0) for n in range(150, 200)]
    points += [(n, 0.05 * n, -3.0) for n in range(200, 280)]
    points += [(300 + 10 * i + j, 20.0 + i, 20.0 + j) for i in range(10) for j in range(10)]
    points += [(500 + n, 40.0 - n, -n * n / 7.0) for n in range(30)]
    for tile in (4_096, 25):
        got = clusters(spark, points, min_samples=4, min_cluster_size=15, tile=tile)
        assert got == brute(points, 4, 15)


def test_single_cluster_and_few_points(spark):
    points = [(n, float(n % 10), float(n // 10)) for n in range(100)]
    assert set(clusters(spark, points, min_samples=3, min_cluster_size=10).values()) == {-1}
    alone = clusters(spark, points, min_samples=3, min_cluster_size=10, allow_single=True)
    assert alone == brute(points, 3, 10, allow_single=True) and set(alone.values()) == {0}
    assert set(clusters(spark, points[:3], min_samples=3, min_cluster_size=2).values()) == {-1}
    assert clusters(spark, []) == {}


def test_rows_without_coordinates_are_noise(spark):
    points = blobs(2, 300)
    odd = [(1, None, 0.0), (2, 0.0, math.nan), (3, math.inf, 0.0)]
    got = clusters(spark, points + odd, min_samples=4, min_cluster_size=10)
    assert [got.pop(k) for k in (1, 2, 3)] == [-1, -1, -1]
    assert got == brute(points, 4, 10)


def test_octants_and_their_gaps():
    rng = np.random.default_rng(1)
    corner = rng.integers(-5, 5, (200, 2)).astype(float)
    side = rng.integers(0, 4, (200, 2)).astype(float)
    boxes = np.array([corner[:, 0], corner[:, 0] + side[:, 0], corner[:, 1], corner[:, 1] + side[:, 1]])
    for number in range(8):
        gap = _octant_gap2(np.zeros(1), np.zeros(1), np.array([number]), boxes)[0]
        for n in range(200):
            xs = np.linspace(boxes[0, n], boxes[1, n], 9)
            ys = np.linspace(boxes[2, n], boxes[3, n], 9)
            gx, gy = (g.ravel() for g in np.meshgrid(xs, ys))
            there = (_octant(gx, gy) == number) & ((gx != 0) | (gy != 0))
            if there.any():
                assert gap[n] <= (gx[there] ** 2 + gy[there] ** 2).min() + 1e-12
    angles = np.radians(np.arange(0, 360, 15) + 1)
    assert _octant(np.cos(angles), np.sin(angles)).tolist() == [n // 3 for n in range(24)]


def test_a_task_holds_few_distances_at_a_time():
    """The arrays of a full tile, and of spots against very many boxes, stay small together."""

    def peak_mb(run) -> float:
        tracemalloc.start()
        run()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return peak / 1e6

    gaps = np.random.default_rng(1).normal(size=(hierarchy.ROWS, hierarchy.TILE))
    assert peak_mb(lambda: hierarchy._octant(gaps, gaps[::-1])) < 40
    spots, boxes = np.zeros(max(1, hierarchy.GAPS // 5_000)), np.zeros((4, 5_000))
    octant = np.arange(len(spots)) % 8
    assert peak_mb(lambda: hierarchy._octant_gap2(spots, spots, octant, boxes)) < 60
