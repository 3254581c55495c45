"""Density clustering of 2-D points with noise, without listing pairs inside a dense spot.

The DBSCAN* cut: a point is core when at least ``min_samples`` other points lie
within ``eps``; core points within ``eps`` of each other share a cluster; all
else is noise. The plane is cut into cells whose diagonal is below ``eps``:

* any two points of one cell are neighbours, so a cell with enough points is
  all core and already one component, whatever its size;
* points of sparse cells are few per cell; their neighbours are counted against
  bounding boxes of sub-cells first, and point by point only where a box
  straddles the radius;
* two cells are linked when some pair of their core points is within ``eps``,
  which is decided on bounding boxes of ever finer sub-cells;
* components are found on cells, at most 24 links each.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticelens.fixed_values import SEED
from noticelens.operators.ranking import dense_index, seeded_sample
from noticelens.operators.vectors import knn
from noticelens.session import is_small, lookup, small_side, written

_FINEST = 10
_REACH = range(-2, 3)


def _gap(low_a: Column, high_a: Column, low_b: Column, high_b: Column) -> Column:
    return F.greatest(low_a - high_b, low_b - high_a, F.lit(0.0))


def _span(low_a: Column, high_a: Column, low_b: Column, high_b: Column) -> Column:
    return F.greatest(F.abs(high_a - low_b), F.abs(high_b - low_a))


def _box_distances(a: str, b: str) -> tuple[Column, Column]:
    """Least and greatest squared distance between points of two bounding boxes."""

    def sides(name: str, axis: str):
        return F.col(f"{name}.{axis}0"), F.col(f"{name}.{axis}1")

    parts = [
        (_gap(*sides(a, axis), *sides(b, axis)), _span(*sides(a, axis), *sides(b, axis)))
        for axis in ("x", "y")
    ]
    (gx, sx), (gy, sy) = parts
    return gx * gx + gy * gy, sx * sx + sy * sy


def _sub_cells(points: DataFrame, side: float, level: int) -> DataFrame:
    """Bounding boxes per sub-cell; the last level keeps every distinct point apart."""
    if level < _FINEST:
        step = side / 4**level
        ids = [F.floor(F.col("x") / step).cast("double"), F.floor(F.col("y") / step).cast("double")]
    else:
        ids = [F.col("x"), F.col("y")]
    return (
        points.groupBy("cx", "cy", ids[0].alias("sx"), ids[1].alias("sy"))
        .agg(
            F.min("x").alias("x0"),
            F.max("x").alias("x1"),
            F.min("y").alias("y0"),
            F.max("y").alias("y1"),
            F.count(F.lit(1)).alias("n"),
        )
    )


def _around(df: DataFrame, reach: list[tuple[int, int]]) -> DataFrame:
    """One row per neighbouring cell (nx, ny)."""
    steps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in reach])
    return (
        df.withColumn("_step", F.explode(steps))
        .withColumns({"nx": F.col("cx") + F.col("_step.i"), "ny": F.col("cy") + F.col("_step.j")})
        .drop("_step")
    )


def _core_sparse(sparse: DataFrame, points: DataFrame, eps: float, side: float, needed: int) -> DataFrame:
    """Keys of the core points among the points of sparse cells.

    ``needed`` counts the point itself.
    """
    limit = eps * eps
    boxes = _sub_cells(points, side, 1).alias("b")
    reach = [(i, j) for i in _REACH for j in _REACH]
    seekers = _around(
        sparse.select("key", "cx", "cy", *[F.col(v).alias(f"{v}{e}") for v in "xy" for e in "01"]), reach
    ).alias("a")
    near, far = _box_distances("a", "b")
    seen = seekers.join(
        boxes,
        (F.col("a.nx") == F.col("b.cx")) & (F.col("a.ny") == F.col("b.cy")) & (near <= limit),
    ).select(
        "a.key",
        F.col("a.x0").alias("x"),
        F.col("a.y0").alias("y"),
        *[F.col(f"b.{c}").alias(c) for c in ("cx", "cy", "sx", "sy", "n")],
        (far <= limit).alias("inside"),
    )
    seen = written(seen, "density")
    bounds = seen.groupBy("key").agg(
        F.sum(F.when(F.col("inside"), F.col("n")).otherwise(0)).alias("sure"),
        F.sum("n").alias("most"),
    )
    certain = bounds.filter(F.col("sure") >= needed).select("key")
    open_keys = bounds.filter((F.col("sure") < needed) & (F.col("most") >= needed))
    # Few points look at one sub-cell; its own points may be many, so they are salted.
    salts = 16
    straddling = (
        seen.filter(~F.col("inside"))
        .join(open_keys.select("key", "sure"), "key")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        .alias("a")
    )
    step = side / 4
    placed = points.select(
        "x",
        "y",
        "cx",
        "cy",
        F.floor(F.col("x") / step).cast("double").alias("sx"),
        F.floor(F.col("y") / step).cast("double").alias("sy"),
        F.pmod(F.xxhash64("key"), F.lit(salts)).cast("int").alias("_salt"),
    ).alias("b")
    dx, dy = F.col("a.x") - F.col("b.x"), F.col("a.y") - F.col("b.y")
    same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("cx", "cy", "sx", "sy", "_salt")]
    close = straddling.join(placed, same + [dx * dx + dy * dy <= limit])
    counted = close.groupBy("a.key").agg(
        (F.count(F.lit(1)) + F.max("a.sure")).alias("found")
    )
    return certain.unionByName(counted.filter(F.col("found") >= needed).select("key"))


def _links(core: DataFrame, eps: float, side: float) -> DataFrame:
    """Pairs of cells with core points within eps, each pair once."""
    limit = eps * eps
    half = [(i, j) for i in _REACH for j in _REACH if (i, j) > (0, 0)]
    cells = core.select("cx", "cy").distinct()
    pairs = (
        _around(cells, half)
        .join(cells.select(F.col("cx").alias("nx"), F.col("cy").alias("ny")), ["nx", "ny"])
        .select("cx", "cy", "nx", "ny")
    )
    linked = None
    for level in range(_FINEST + 1):
        if level > 1:
            # Few pairs are still open; only their cells are cut finer.
            open_cells = pairs.select("cx", "cy").union(pairs.select("nx", "ny")).distinct()
            core = written(lookup(core, open_cells, ["cx", "cy"], "left_semi", ["key"]), "density")
        boxes = _sub_cells(core, side, level)
        ours = pairs.join(boxes, ["cx", "cy"]).alias("a")
        theirs = boxes.alias("b")
        near, far = _box_distances("a", "b")
        tested = ours.join(
            theirs,
            (F.col("a.nx") == F.col("b.cx")) & (F.col("a.ny") == F.col("b.cy")) & (near <= limit),
        ).select("a.cx", "a.cy", "a.nx", "a.ny", (far <= limit).alias("sure"))
        verdict = written(
            tested.groupBy("cx", "cy", "nx", "ny").agg(F.bool_or("sure").alias("sure")), "density"
        )
        decided = verdict.filter("sure").drop("sure")
        linked = decided if linked is None else linked.unionByName(decided)
        pairs = verdict.filter(~F.col("sure")).drop("sure")
        if pairs.isEmpty():
            break
    return linked


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, root): the smallest id of each node's component.

    ``nodes`` has id; ``edges`` has u and v in both directions. Parents are hooked
    onto the smallest grandparent of any neighbour and shortcut every round, so
    the number of rounds grows with the logarithm of the path length.
    """
    edges = written(edges, "density")
    state = written(nodes.select("id", F.col("id").alias("f"), F.col("id").alias("gf")), "density")
    small, total = is_small(state), None
    while True:
        lowest = (
            edges.join(state.select(F.col("id").alias("v"), "gf"), "v")
            .groupBy(F.col("u").alias("id"))
            .agg(F.min("gf").alias("m"))
        )
        seen = state.join(lowest, "id", "left").withColumn("m", F.least("m", "gf"))
        # Roots may collect offers from very many nodes; min merges them before the shuffle.
        offers = seen.groupBy(F.col("f").alias("id")).agg(F.min("m").alias("offer"))
        hooked = seen.join(offers, "id", "left").select(
            "id", F.least("f", "gf", "m", "offer").alias("f")
        )
        parents = hooked.select(F.col("id").alias("f"), F.col("f").alias("gf"))
        jumped = lookup(hooked, parents, ["f"], spread=["id"], small=small)
        state = written(jumped.select("id", "f", "gf"), "density")
        # Parents only ever fall, so equal sums mean that nothing moved.
        sums = [F.sum(F.col(c).cast("decimal(38,0)")) for c in ("f", "gf")]
        now = tuple(state.agg(*sums).first())
        if now == total:
            return state.select("id", F.col("f").alias("root"))
        total = now


def density_cluster(
    df: DataFrame,
    eps: float,
    min_samples: int = 15,
    min_cluster_size: int = 100,
    key: str = "id",
    x: str = "x",
    y: str = "y",
    count_self: bool = False,
) -> DataFrame:
    """(key, cluster_id): clusters numbered from 0 by their smallest key, noise -1.

    ``key`` is a unique bigint. ``count_self`` lets a point count among its own
    ``min_samples``. Rows without coordinates are noise.
    """
    needed = min_samples if count_self else min_samples + 1
    side = eps / math.sqrt(2) * (1 - 1e-9)
    rows = df.select(
        F.col(key).alias("key"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")
    ).withColumns(
        {"cx": F.floor(F.col("x") / side).cast("long"), "cy": F.floor(F.col("y") / side).cast("long")}
    )
    located = rows.filter(F.col("cx").isNotNull() & F.col("cy").isNotNull())
    cells = located.groupBy("cx", "cy").agg((F.count(F.lit(1)) >= needed).alias("dense"))
    points = written(lookup(located, cells, ["cx", "cy"], spread=["key"]), "density")
    sparse = points.filter(~F.col("dense"))
    core_keys = _core_sparse(sparse, points, eps, side, needed)
    core = points.filter("dense").unionByName(sparse.join(core_keys, "key", "left_semi"))
    core = written(core, "density")
    nodes = written(
        core.groupBy("cx", "cy").agg(F.min("key").alias("id"), F.count(F.lit(1)).alias("n")), "density"
    )
    ends = _links(core, eps, side)
    left = nodes.select("cx", "cy", F.col("id").alias("u"))
    right = nodes.select(F.col("cx").alias("nx"), F.col("cy").alias("ny"), F.col("id").alias("v"))
    once = ends.join(left, ["cx", "cy"]).join(right, ["nx", "ny"]).select("u", "v")
    both = once.unionByName(once.select(F.col("v").alias("u"), F.col("u").alias("v")))
    roots = nodes.join(components(nodes, both), "id")
    large = roots.groupBy("root").agg(F.sum("n").alias("size")).filter(F.col("size") >= min_cluster_size)
    numbers = dense_index(large, "root", "cluster_id")
    cell_cluster = roots.join(small_side(numbers), "root").select("cx", "cy", "cluster_id")
    members = lookup(core, cell_cluster, ["cx", "cy"], spread=["key"]).select("key", "cluster_id")
    return (
        rows.select("key")
        .join(members, "key", "left")
        .select(F.col("key").alias(key), F.coalesce("cluster_id", F.lit(-1)).alias("cluster_id"))
    )


def suggest_eps(
    df: DataFrame,
    min_samples: int = 15,
    share: float = 0.9,
    n: int = 1000,
    seed: int = SEED,
    key: str = "id",
    x: str = "x",
    y: str = "y",
) -> float:
    """A radius: the given quantile of the distance to the min_samples-th neighbour of a sample."""
    points = df.select(
        F.col(key).alias("id"), F.array(F.col(x), F.col(y)).cast("array<double>").alias("embedding")
    )
    sample = seeded_sample(points, n, F.col("id"), seed).withColumnRenamed("id", "query_id")
    # The nearest hit is the point itself or a copy of it.
    last = knn(sample, points, min_samples + 1).filter(F.col("rank") == min_samples + 1)
    return last.agg(F.percentile_approx(F.sqrt("distance"), share, 10_000)).first()[0]
