"""Hierarchical density clustering of 2-D points: no radius, clusters chosen by stability.

The core distance of a point is that to its ``min_samples``-th other point; two points are
linked at the largest of their core distances and their own distance. Raising the threshold of
the links merges points into ever larger components; those of at least ``min_cluster_size``
points form a tree of clusters, from which the most stable ones are taken. The result depends
on thresholds only, so ties, copies and partitioning do not change it.

1. Equal points become one spot. Spots are dealt into tiles of about ``TILE`` by quantiles.
   A tile finds the nearest spots inside, and asks other tiles whose box is near enough.
2. Of the links, few can matter: those to spots strictly within a core distance, and in each
   of eight octants around a spot the one to the spot q with the smallest larger of q's core
   distance and the distance to it. For any other link p-q, the octant's spot r has links to
   both ends that are no heavier, and r is nearer to q than p is. So links are searched in the
   tile first and then in those tiles alone that an octant reaches.
3. Components are contracted tile by tile, then by regions of 8 x 8 tiles, and so on. In a
   region, a component's next merge is known as long as its lightest link stays inside the
   region; where it leads out, the component waits for the next level, which sees about the
   rims of the regions before. A small component whose lightest link leads to a cluster joins
   it there; two small ones merge, and found a cluster when they are large enough.
4. The clusters and the lightest links between them, at most rows / ``min_cluster_size``, are
   merged on the driver into the tree. Points are summed up by cluster in Spark, which gives
   the stabilities.

Every group a task holds is a tile or region: about ``TILE`` spots, or the waiting components
of 64 regions.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticelens.session import lookup, small_side, written

TILE = 4_096
# Rows of a distance matrix at a time; tiles that an open octant asks in its first round.
ROWS, FIRST = 128, 4
# Distances of spots from boxes at a time; a worker holds some twenty arrays of that size.
GAPS = 250_000
# Tiles along the side of a region's parent.
SIDE = 8
# Links below this distance count as that long in stabilities, where 0 would weigh endlessly.
SHORTEST = 1e-9


def _batch(names: str, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns), names=names.split())


def _cells(table: pa.Table, *names: str) -> list[np.ndarray]:
    return [table.column(n).combine_chunks().to_numpy(zero_copy_only=False) for n in names]


def _gap2(x, y, boxes) -> np.ndarray:
    """Squared distances of points (rows) from boxes (columns)."""
    dx = np.maximum(np.maximum(boxes[0] - x[:, None], x[:, None] - boxes[1]), 0.0)
    dy = np.maximum(np.maximum(boxes[2] - y[:, None], y[:, None] - boxes[3]), 0.0)
    return dx * dx + dy * dy


def _octant(dx: np.ndarray, dy: np.ndarray) -> np.ndarray:
    """Number of the half-open sector of 45 degrees that a vector points into."""
    # Turned by half a circle if below, then by a quarter if to the left.
    flip = (dy < 0) | ((dy == 0) & (dx < 0))
    ux, uy = np.where(flip, -dx, dx), np.where(flip, -dy, dy)
    left = ux <= 0
    vx, vy = np.where(left, uy, ux), np.where(left, -ux, uy)
    return (4 * flip + 2 * left + (vy >= vx)).astype(np.int8)


def _octant_gap2(x, y, octant, boxes) -> np.ndarray:
    """Lower bounds of the squared distances of points from the boxes' parts in an octant; inf
    where there is none."""
    x0, x1 = boxes[0] - x[:, None], boxes[1] - x[:, None]
    y0, y1 = boxes[2] - y[:, None], boxes[3] - y[:, None]
    octant = octant[:, None]
    # The same turns as in _octant, for both ends of each side.
    flip = octant >= 4
    x0, x1 = np.where(flip, -x1, x0), np.where(flip, -x0, x1)
    y0, y1 = np.where(flip, -y1, y0), np.where(flip, -y0, y1)
    left = octant % 4 >= 2
    u0, u1 = np.where(left, y0, x0), np.where(left, y1, x1)
    v0, v1 = np.where(left, -x1, y0), np.where(left, -x0, y1)
    steep = octant % 2 == 1
    u0, u1, v0, v1 = np.where(steep, v0, u0), np.where(steep, v1, u1), np.where(steep, u0, v0), np.where(steep, u1, v1)
    low = np.maximum(v0, 0.0)
    far = np.maximum(u0, low)
    inside = (u1 >= low) & (v1 >= 0) & (u1 >= 0) & (far <= u1)
    return np.where(inside, far * far + low * low, np.inf)


def _tiles(spots: DataFrame, count: int, tile: int) -> tuple[DataFrame, int, int]:
    """Adds the tile: strips by quantiles of x, cut by quantiles of y; (rows, strips, cuts)."""
    spark = spots.sparkSession
    strips = max(1, math.ceil(math.sqrt(count / tile)))

    def bounds(col: str, parts: int):
        return F.percentile_approx(col, [n / parts for n in range(1, parts)], max(10_000, 20 * parts))

    at_x = spots.agg(bounds("x", strips).alias("at")).first()["at"] if strips > 1 else []
    sent_x = spark.sparkContext.broadcast(np.array(at_x, dtype=np.float64))

    def strip_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            strip = np.searchsorted(sent_x.value, b.column(1).to_numpy(), side="left").astype(np.int32)
            yield _batch("spot x y w strip", *b.columns, pa.array(strip))

    placed = written(spots.select("spot", "x", "y", "w").mapInArrow(strip_of, "spot long, x double, y double, w long, strip int"), "strips")
    most = placed.groupBy("strip").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    cuts = max(1, math.ceil(most / tile))
    at_y = {}
    if cuts > 1:
        at_y = {r["strip"]: r["at"] for r in placed.groupBy("strip").agg(bounds("y", cuts).alias("at")).collect()}
    sent_y = spark.sparkContext.broadcast({s: np.array(at, dtype=np.float64) for s, at in at_y.items()})

    def tile_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            strip, y = b.column(4).to_numpy(), b.column(2).to_numpy()
            number = strip.astype(np.int32) * cuts
            for s in np.unique(strip):
                if s in sent_y.value:
                    own = strip == s
                    number[own] += np.searchsorted(sent_y.value[s], y[own], side="left").astype(np.int32)
            yield _batch("spot x y w tile", *[b.column(n) for n in range(4)], pa.array(number))

    return written(placed.mapInArrow(tile_of, "spot long, x double, y double, w long, tile int"), "tiles"), strips, cuts


def _boxes(placed: DataFrame):
    """Numbers of the tiles, and the sides of their boxes; one row a tile comes here."""
    sides = [F.min("x"), F.max("x"), F.min("y"), F.max("y")]
    found = np.array([tuple(r) for r in placed.groupBy("tile").agg(*sides).orderBy("tile").collect()], dtype=np.float64)
    return found[:, 0].astype(np.int32), found[:, 1:].T


def _nearest(d2: np.ndarray, weights: np.ndarray, needed: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``needed`` + 1 smallest squared distances of every row, sorted, with their weights."""
    kept = min(needed + 1, d2.shape[1])
    at = np.argpartition(d2, kept - 1, axis=1)[:, :kept]
    near = np.take_along_axis(d2, at, axis=1)
    order = np.argsort(near, axis=1, kind="stable")
    at = np.take_along_axis(at, order, axis=1)
    return np.take_along_axis(near, order, axis=1), np.take_along_axis(weights, at, axis=1)


def _lists(values: np.ndarray) -> pa.Array:
    offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values.ravel()))


_NEAR = "kind string, tile int, spot long, x double, y double, w long, bound double, d array<double>, n array<long>"


def core_distances(placed: DataFrame, boxes, needed: int) -> DataFrame:
    """(spot, x, y, w, tile, core): squared distance to the ``needed``-th other point."""
    sent = placed.sparkSession.sparkContext.broadcast(boxes)
    names = " ".join(c.split()[0] for c in _NEAR.split(", "))

    def in_tile(table: pa.Table) -> pa.Table:
        numbers, sides = sent.value
        spot, x, y, w, tile = _cells(table, "spot", "x", "y", "w", "tile")
        out = []
        for first in range(0, len(x), ROWS):
            own = slice(first, first + ROWS)
            rows = np.arange(len(x[own]))
            d2 = (x[own, None] - x) ** 2 + (y[own, None] - y) ** 2
            weights = np.broadcast_to(w, d2.shape).copy()
            # Of the spot itself, the other copies count.
            weights[rows, first + rows] -= 1
            near, n = _nearest(d2, weights, needed)
            so_far = np.cumsum(n, axis=1)
            enough = so_far[:, -1] >= needed
            bound = np.where(enough, near[rows, (so_far < needed).sum(axis=1).clip(max=near.shape[1] - 1)], np.inf)
            ask = (_gap2(x[own], y[own], sides) < bound[:, None]) & (numbers != tile[0])
            row, other = np.nonzero(ask)
            blank = pa.nulls(len(row), pa.list_(pa.float64())), pa.nulls(len(row), pa.list_(pa.int64()))
            out.append(_batch(
                names, pa.array(["own"] * len(rows)), pa.array(tile[own]), pa.array(spot[own]), pa.array(x[own]),
                pa.array(y[own]), pa.array(w[own]), pa.array(bound), _lists(near), _lists(n),
            ))
            out.append(_batch(
                names, pa.array(["ask"] * len(row), pa.string()), pa.array(numbers[other]), pa.array(spot[own][row]),
                pa.array(x[own][row]), pa.array(y[own][row]), pa.array(w[own][row]), pa.array(bound[row]), *blank,
            ))
        return pa.Table.from_batches(out)

    def in_other(key, here: pa.Table, asking: pa.Table) -> pa.Table:
        x, y, w = _cells(here, "x", "y", "w")
        spot, px, py, bound = _cells(asking, "spot", "x", "y", "bound")
        out = []
        for first in range(0, len(spot), ROWS):
            own = slice(first, first + ROWS)
            d2 = (px[own, None] - x) ** 2 + (py[own, None] - y) ** 2
            near, n = _nearest(d2, np.broadcast_to(w, d2.shape), needed)
            out.append(_batch("spot d n", pa.array(spot[own]), _lists(near), _lists(n)))
        empty = _batch("spot d n", pa.array([], pa.int64()), pa.array([], pa.list_(pa.float64())), pa.array([], pa.list_(pa.int64())))
        return pa.Table.from_batches(out or [empty])

    found = written(placed.groupBy("tile").applyInArrow(in_tile, _NEAR), "near", partition_by="kind")
    own, asks = found.filter("kind = 'own'"), found.filter("kind = 'ask'").drop("d", "n", "kind")
    told = placed.groupBy("tile").cogroup(asks.groupBy("tile")).applyInArrow(in_other, "spot long, d array<double>, n array<long>")

    def pairs(d: str, n: str):
        return F.arrays_zip(F.col(d).alias("d"), F.col(n).alias("n"))

    told = told.groupBy("spot").agg(F.flatten(F.collect_list(pairs("d", "n"))).alias("told"))
    every = F.array_sort(F.concat(pairs("d", "n"), F.coalesce("told", F.array().cast("array<struct<d:double,n:bigint>>"))))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(None).cast("double").alias("d"))
    core = F.aggregate(
        every,
        start,
        lambda s, p: F.struct(
            (s["n"] + p["n"]).alias("n"),
            F.when(s["d"].isNull() & (s["n"] + p["n"] >= needed), p["d"]).otherwise(s["d"]).alias("d"),
        ),
    )["d"]
    return written(own.join(told, "spot", "left").select("spot", "x", "y", "w", "tile", core.alias("core")), "core")


_LINKS = "kind string, a long, ta int, la boolean, b long, tb int, lb boolean, w double, octant int, reach double"
_LINK_TYPES = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "double": pa.float64()}


def _link_rows(kind: str, **columns) -> pa.RecordBatch:
    size = len(columns["a"])
    cells = []
    for name, of in (c.split() for c in _LINKS.split(", ")):
        if name == "kind":
            cells.append(pa.array([kind] * size, pa.string()))
        elif name in columns:
            cells.append(pa.array(columns[name], _LINK_TYPES[of]))
        else:
            cells.append(pa.nulls(size, _LINK_TYPES[of]))
    return pa.RecordBatch.from_arrays(cells, names=[c.split()[0] for c in _LINKS.split(", ")])


def _within_core(own, d2, core, there) -> pa.RecordBatch:
    """Links of the points ``own`` to those of a tile strictly within their core distance."""
    spot, tile, large, own_core = own
    row, other = np.nonzero(d2 < own_core[:, None])
    w = np.maximum(np.maximum(own_core[row], core[other]), d2[row, other])
    return _link_rows("link", a=spot[row], ta=tile[row], la=large[row], b=there[0][other], tb=there[1][other], lb=there[2][other], w=w)


def _best_of_octants(own, d2, octant, wanted, core, there) -> list[pa.RecordBatch]:
    """For every point and wanted octant the spot with the smallest larger of core and distance."""
    spot, tile, large, own_core = own
    out, reach = [], np.maximum(core[None, :], d2)
    for number in range(8):
        rows = np.flatnonzero(wanted(number))
        if not len(rows):
            continue
        part = np.where(octant[rows] == number, reach[rows], np.inf)
        best = part.argmin(axis=1)
        found = part[np.arange(len(rows)), best]
        has = np.isfinite(found)
        row, at, found = rows[has], best[has], found[has]
        out.append(_link_rows(
            "octant", a=spot[row], ta=tile[row], la=large[row], b=there[0][at], tb=there[1][at], lb=there[2][at],
            w=np.maximum(own_core[row], found), octant=np.full(len(row), number, dtype=np.int32), reach=found,
        ))
    return out


def links(cored: DataFrame, boxes, smallest: int) -> DataFrame:
    """(a, ta, la, b, tb, lb, w): links that keep the components of every threshold, with the
    tiles of both ends and whether an end is a cluster by itself; w is squared."""
    spark = cored.sparkSession
    sent = spark.sparkContext.broadcast(boxes)

    def table_of(table: pa.Table):
        spot, x, y, w, tile, core = _cells(table, "spot", "x", "y", "w", "tile", "core")
        return x, y, core, (spot, tile, w >= smallest)

    def in_tile(table: pa.Table) -> pa.Table:
        x, y, core, there = table_of(table)
        out = [_link_rows("link", a=[])]
        for first in range(0, len(x), ROWS):
            cut = slice(first, first + ROWS)
            dx, dy = x - x[cut, None], y - y[cut, None]
            d2 = dx**2 + dy**2
            d2[np.arange(len(d2)), first + np.arange(len(d2))] = np.inf
            own = there[0][cut], there[1][cut], there[2][cut], core[cut]
            out.append(_within_core(own, d2, core, there))
            out += _best_of_octants(own, d2, _octant(dx, dy), lambda n: np.ones(len(d2), dtype=bool), core, there)
        return pa.Table.from_batches(out)

    found = written(cored.groupBy("tile").applyInArrow(in_tile, _LINKS), "links")
    edges = [found.filter("kind = 'link'")]
    numbers = F.explode(F.sequence(F.lit(-1), F.lit(7)))
    # Octant -1 stands for the spots within the core distance.
    state = cored.select("spot", "x", "y", "w", "tile", "core", numbers.alias("octant")).join(
        found.filter("kind = 'octant'").select(F.col("a").alias("spot"), "octant", "reach"), ["spot", "octant"], "left"
    )
    reach = F.when(F.col("octant") < 0, F.col("core")).otherwise(F.coalesce("reach", F.lit(math.inf)))
    state = state.withColumns({"reach": reach, "asked": F.lit(0)})
    best, step = found.filter("kind = 'octant'"), FIRST
    columns = "spot long, x double, y double, w long, tile int, core double, octant int, reach double, asked int"
    asking = f"target int, {columns}, more boolean"

    def route(batches: Iterator[pa.RecordBatch], step: int) -> Iterator[pa.RecordBatch]:
        """The next tiles of every open octant: all within reach, or the ``step`` nearest if
        nothing was found yet."""
        numbers, sides = sent.value
        rows_at_once = max(1, GAPS // len(numbers))
        for whole in batches:
            for first in range(0, whole.num_rows, rows_at_once):
                b = whole.slice(first, rows_at_once)
                x, y, tile, octant, reach, asked = (b.column(n).to_numpy(zero_copy_only=False) for n in (1, 2, 4, 6, 7, 8))
                near = octant < 0
                gap = np.where(near[:, None], _gap2(x, y, sides), _octant_gap2(x, y, np.maximum(octant, 0), sides))
                gap[numbers == tile[:, None]] = np.inf
                open_ = (gap < reach[:, None]) & np.isfinite(gap)
                order = np.argsort(np.where(open_, gap, np.inf), axis=1, kind="stable")
                place = np.empty_like(order)
                np.put_along_axis(place, order, np.broadcast_to(np.arange(gap.shape[1]), gap.shape), axis=1)
                # What was asked before comes first again: then, nothing had been found.
                last = np.where(np.isfinite(reach), gap.shape[1], asked + step)[:, None]
                now = open_ & (place >= asked[:, None]) & (place < last)
                row, target = np.nonzero(now)
                more = (open_ & (place >= last)).any(axis=1)[row]
                part = b.take(pa.array(row))
                cells = part.columns[:-1] + [pa.array((asked + step)[row].astype(np.int32))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(numbers[target]), *cells, pa.array(more)], names=[c.split()[0] for c in asking.split(", ")]
                )

    def in_other(key, here: pa.Table, asks: pa.Table) -> pa.Table:
        x, y, core, there = table_of(here)
        spot, px, py, w, tile, own_core, octant, reach = _cells(asks, "spot", "x", "y", "w", "tile", "core", "octant", "reach")
        out = [_link_rows("link", a=[])]
        for first in range(0, len(spot), ROWS):
            cut = slice(first, first + ROWS)
            dx, dy = x - px[cut, None], y - py[cut, None]
            d2 = dx**2 + dy**2
            own = spot[cut], tile[cut], w[cut] >= smallest, own_core[cut]
            near = octant[cut] < 0
            out.append(_within_core(tuple(c[near] for c in own), d2[near], core, there))
            out += _best_of_octants(own, d2, _octant(dx, dy), lambda n: octant[cut] == n, core, there)
        return pa.Table.from_batches(out)

    while len(boxes[0]) > 1:
        # Bound now: the function runs later, in the tasks.
        asks = written(state.select(*[c.split()[0] for c in columns.split(", ")]).mapInArrow(lambda b, n=step: route(b, n), asking), "asks")
        if asks.isEmpty():
            break
        told = cored.groupBy("tile").cogroup(asks.withColumnRenamed("tile", "own").withColumnRenamed("target", "tile").groupBy("tile"))
        told = written(told.applyInArrow(lambda k, here, a: in_other(k, here, a.rename_columns(["at" if c == "tile" else "tile" if c == "own" else c for c in a.column_names])), _LINKS), "links")
        edges.append(told.filter("kind = 'link'"))
        best = best.unionByName(told.filter("kind = 'octant'"))
        # Still open: octants that found nothing and have further tiles.
        waiting = asks.filter((F.col("reach") == math.inf) & F.col("more")).select(*[c.split()[0] for c in columns.split(", ")]).distinct()
        now = told.filter("kind = 'octant'").groupBy(F.col("a").alias("spot"), "octant").agg(F.min("reach").alias("found"))
        state = waiting.join(now, ["spot", "octant"], "left").withColumn("reach", F.coalesce("found", "reach")).drop("found")
        # A first find may be beaten by tiles that were not asked: those within its reach are next.
        step *= 4
    ends = ("a", "ta", "la", "b", "tb", "lb", "w")
    best = best.groupBy("a", "octant").agg(
        F.min_by(F.struct(*ends), F.struct("reach", "b")).alias("e")
    ).select("e.*")
    every = best.select(*ends)
    for more in edges:
        every = every.unionByName(more.select(*ends))
    swapped = F.col("a") > F.col("b")
    turned = [F.when(swapped, F.col(d)).otherwise(F.col(c)).alias(c) for c, d in zip(ends, ("b", "tb", "lb", "a", "ta", "la", "w"))]
    return written(every.select(*turned).dropDuplicates(["a", "b"]), "links")


_MOVES = "kind string, a long, ta int, la boolean, b long, tb int, lb boolean, w double, size long"


def _contract(table: pa.Table, smallest: int) -> pa.Table:
    """Merges of one region: see the module.

    Rows of kind 0 are small components (a, ta, w: lightest link out of the region, size), rows
    of kind 1 links inside it. What comes out: ``move`` (component, what it is in now, and at
    which threshold it joined a cluster), ``node`` (components that go on), ``found`` (new
    clusters), ``bridge`` (links of clusters), ``link`` (links that go on).
    """
    is_link = pc.equal(table.column("kind"), 1)
    inside, nodes = table.filter(is_link), table.filter(pc.invert(is_link))
    a, ta, la, b, tb, lb, w = _cells(inside, "a", "ta", "la", "b", "tb", "lb", "w")
    small, at, size, out = _cells(nodes, "a", "ta", "size", "w")
    ids = np.unique(np.concatenate([small, a, b]))
    tile, large = np.zeros(len(ids), dtype=np.int64), np.zeros(len(ids), dtype=bool)
    for one, its_tile, is_large in ((a, ta, la), (b, tb, lb)):
        place = np.searchsorted(ids, one)
        tile[place], large[place] = its_tile, is_large
    place = np.searchsorted(ids, small)
    tile[place] = at
    count, out_by = np.zeros(len(ids), dtype=np.int64), np.full(len(ids), np.inf)
    count[place], out_by[place] = size, out
    order = np.lexsort((b, a, w))
    ends = [np.searchsorted(ids, c[order]).tolist() for c in (a, b)]

    def find(parent: list[int], n: int) -> int:
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    joined, group = list(range(len(ids))), list(range(len(ids)))
    cluster = [n if large[n] else -1 for n in range(len(ids))]
    members = {int(n): [int(n)] for n in place}
    waits = [False] * len(ids)
    count, out_by = count.tolist(), out_by.tolist()
    moves, found, kept = [], [], []
    for x, y, by in zip(*ends, w[order].tolist()):
        p, q = find(joined, x), find(joined, y)
        if p == q:
            continue  # the heaviest link of a ring
        joined[q] = p
        p, q = find(group, x), find(group, y)
        if cluster[p] >= 0 and cluster[q] >= 0:
            kept.append((p, q, by))
            continue
        for n in (p, q):
            waits[n] = waits[n] or (cluster[n] < 0 and out_by[n] < by)
        if waits[p] or waits[q]:
            # Neither can be told before what the waiting one joins; a cluster never waits.
            for n in (p, q):
                waits[n] = cluster[n] < 0
            kept.append((p, q, by))
            continue
        if cluster[p] >= 0:
            p, q = q, p
        if cluster[q] >= 0:
            home = cluster[q]
            moves += [(n, home, by) for n in members.pop(p)]
            group[p] = q
            continue
        group[q] = p
        count[p] += count[q]
        out_by[p] = min(out_by[p], out_by[q])
        members[p] += members.pop(q)
        if count[p] >= smallest:
            home = min(members[p])
            found.append((home, by))
            moves += [(n, home, by) for n in members.pop(p)]
            cluster[p] = home
    rows: dict[str, list] = {c.split()[0]: [] for c in _MOVES.split(", ")}

    def add(kind: str, **cells) -> None:
        for c, column in rows.items():
            column.append(kind if c == "kind" else cells.get(c))

    def end(n: int) -> tuple[int, int, bool]:
        n = find(group, n)
        at = cluster[n] if cluster[n] >= 0 else min(members[n])
        return int(ids[at]), int(tile[at]), cluster[n] >= 0

    for n, home, by in moves:
        add("move", a=int(ids[n]), b=int(ids[home]), tb=int(tile[home]), lb=True, w=by)
    for home, by in found:
        add("found", a=int(ids[home]), w=by)
    for p, own in members.items():
        rep = min(own)
        add("node", a=int(ids[rep]), ta=int(tile[rep]), size=count[p])
        for n in own:
            add("move", a=int(ids[n]), b=int(ids[rep]), tb=int(tile[rep]), lb=False)
    for p, q, by in kept:
        (i, ti, li), (j, tj, lj) = end(p), end(q)
        if i != j:
            add("bridge" if li and lj else "link", a=i, ta=ti, la=li, b=j, tb=tj, lb=lj, w=by)
    return pa.Table.from_pydict({n: pa.array(rows[n], _LINK_TYPES[of]) for n, of in (c.split() for c in _MOVES.split(", "))})


def _region(tile: str, cuts: int, level: int):
    """Number of a tile's region: squares of SIDE**level tiles."""
    side, wide = SIDE**level, cuts // SIDE**level + 1
    strip, cut = F.floor(F.col(tile) / cuts), F.col(tile) % cuts
    return (F.floor(strip / side) * wide + F.floor(cut / side)).cast("long")


def contract(spots: DataFrame, edges: DataFrame, strips: int, cuts: int, smallest: int):
    """(joined, founded, bridges): (spot, cluster, w) of every spot that is in a cluster at some
    threshold, (cluster, w) of the clusters, and links (a, b, w) between them."""
    spark = spots.sparkSession
    alone = spots.filter(F.col("w") >= smallest)
    joined = [alone.select("spot", F.col("spot").alias("cluster"), F.col("core").alias("w"))]
    founded = [alone.select(F.col("spot").alias("cluster"), F.col("core").alias("w"))]
    bridges = []
    nodes = spots.filter(F.col("w") < smallest).select(F.col("spot").alias("a"), F.col("tile").alias("ta"), F.col("w").alias("size"))
    members = nodes.select(F.col("a").alias("spot"), F.col("a").alias("node"))
    none = {"boolean": F.lit(None).cast("boolean"), "long": F.lit(None).cast("long"), "int": F.lit(None).cast("int")}
    level = 0
    while True:
        ra, rb = _region("ta", cuts, level), _region("tb", cuts, level)
        inner, outer = edges.filter(ra == rb), edges.filter(ra != rb)
        ways = F.explode(F.array(F.struct("a", "la", "w"), F.struct(F.col("b").alias("a"), F.col("lb").alias("la"), "w")))
        out_by = outer.select(ways.alias("e")).select("e.*").filter(~F.col("la")).groupBy("a").agg(F.min("w").alias("w"))
        own = nodes.join(out_by, "a", "left").select(
            ra.alias("region"), F.lit(0).alias("kind"), "a", "ta", F.lit(False).alias("la"), none["long"].alias("b"),
            none["int"].alias("tb"), none["boolean"].alias("lb"), F.coalesce("w", F.lit(math.inf)).alias("w"), "size",
        )
        with_links = own.unionByName(
            inner.select(ra.alias("region"), F.lit(1).alias("kind"), "a", "ta", "la", "b", "tb", "lb", "w", none["long"].alias("size"))
        )
        done = written(
            with_links.groupBy("region").applyInArrow(lambda t: _contract(t, smallest), _MOVES), "contracted", partition_by="kind"
        )
        moves = done.filter("kind = 'move'").select(
            F.col("a").alias("node"), F.col("b").alias("to"), F.col("tb").alias("tile"), F.col("lb").alias("large"), "w"
        )
        moved = written(members.join(moves, "node"), "members")
        joined.append(moved.filter("large").select("spot", F.col("to").alias("cluster"), "w"))
        founded.append(done.filter("kind = 'found'").select(F.col("a").alias("cluster"), "w"))
        bridges.append(done.filter("kind = 'bridge'").select("a", "b", "w"))
        if strips <= SIDE**level and cuts <= SIDE**level:
            break
        members = moved.filter("not large").select("spot", F.col("to").alias("node"))
        nodes = done.filter("kind = 'node'").select("a", "ta", "size")
        ends = ("a", "ta", "la", "b", "tb", "lb", "w")
        for node, at, is_large in (("a", "ta", "la"), ("b", "tb", "lb")):
            to = moves.select(F.col("node").alias(node), "to", "tile", "large")
            # Many links may lead into one cluster, but a node of this level has few.
            outer = outer.join(to, node, "left").select(
                *[c for c in ends if c not in (node, at, is_large)],
                F.coalesce("to", node).alias(node), F.coalesce("tile", at).alias(at), F.coalesce("large", is_large).alias(is_large),
            )
        rest = done.filter("kind = 'link'").select(*ends).unionByName(outer.select(*ends)).filter("a != b")
        lightest = F.struct("w", "ta", "la", "tb", "lb")
        rest = rest.select(*[F.when(F.col("a") > F.col("b"), F.col(d)).otherwise(F.col(c)).alias(c) for c, d in zip(ends, ("b", "tb", "lb", "a", "ta", "la", "w"))])
        edges = written(rest.groupBy("a", "b").agg(F.min(lightest).alias("e")).select("a", "b", "e.*"), "rest")
        level += 1

    def union(frames: list[DataFrame]) -> DataFrame:
        every = frames[0]
        for frame in frames[1:]:
            every = every.unionByName(frame)
        return every

    return union(joined), union(founded), union(bridges)


class Tree:
    """Clusters by threshold: founded ones, and merges of two or more.

    Thresholds are squared. A cluster founded at the very threshold at which it meets another
    one was never apart from it. ``parent`` is -1 at the top.
    """

    def __init__(self, founded: list[tuple[int, float]], bridges: list[tuple[int, int, float]]):
        founded = sorted(founded)
        self.node = {c: n for n, (c, _) in enumerate(founded)}
        self.since = [w for _, w in founded]
        self.parent = [-1] * len(founded)
        alias = list(range(len(founded)))
        up, top = list(range(len(founded))), list(range(len(founded)))

        def find(n: int) -> int:
            while up[n] != n:
                up[n] = up[up[n]]
                n = up[n]
            return n

        bridges = sorted((w, self.node[a], self.node[b]) for a, b, w in bridges)
        first = 0
        while first < len(bridges):
            w, last = bridges[first][0], first
            meeting: dict[int, set[int]] = {}
            while last < len(bridges) and bridges[last][0] == w:
                p, q = find(bridges[last][1]), find(bridges[last][2])
                if p != q:
                    up[q] = p
                    meeting[p] = meeting.pop(p, {top[p]}) | meeting.pop(q, {top[q]})
                last += 1
            for p, tops in meeting.items():
                older = sorted(n for n in tops if self.since[n] < w)
                fresh = sorted(n for n in tops if self.since[n] >= w)
                if len(older) > 1:
                    home = len(self.since)
                    self.since.append(w)
                    self.parent.append(-1)
                    alias.append(home)
                    for n in older:
                        self.parent[n] = home
                else:
                    home = (older or fresh)[0]
                for n in fresh:
                    alias[n] = home
                top[find(p)] = home
            first = last
        for c, n in self.node.items():
            while alias[n] != n:
                n = alias[n]
            self.node[c] = n
        self.kept = [alias[n] == n for n in range(len(self.since))]

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sorted founded clusters and their nodes; parents and thresholds of the nodes."""
        names = np.array(sorted(self.node), dtype=np.int64)
        nodes = np.array([self.node[c] for c in names.tolist()], dtype=np.int64)
        return names, nodes, np.array(self.parent, dtype=np.int64), np.array(self.since, dtype=np.float64)

    def chosen(self, own: dict[int, tuple[int, float]], allow_single: bool) -> list[int]:
        """The node whose cluster a node's points get, -1 for noise.

        ``own`` has, by node, the points that join it itself and the sum of 1 / threshold over
        them. A cluster is stable by how long its points stay; one is taken if it is at least as
        stable as those below it together.
        """
        size = len(self.since)
        count, gain = [0] * size, [0.0] * size
        below: list[list[int]] = [[] for _ in range(size)]
        for n, p in enumerate(self.parent):
            if p >= 0:
                below[p].append(n)

        def density(n: int) -> float:
            return 1.0 / max(math.sqrt(self.since[n]), SHORTEST)

        # Children come before their parents but for founded ones, which have no children.
        order = sorted(range(size), key=lambda n: (len(below[n]) > 0, n))
        best, taken = [0.0] * size, [False] * size
        for n in order:
            points, total = own.get(n, (0, 0.0))
            birth = density(self.parent[n]) if self.parent[n] >= 0 else 0.0
            inner = sum(count[c] for c in below[n])
            count[n] = points + inner
            gain[n] = total - points * birth + inner * (density(n) - birth)
            rest = sum(best[c] for c in below[n])
            top = self.parent[n] < 0 and not allow_single
            taken[n] = not top and (not below[n] or gain[n] >= rest - 1e-9 * abs(rest))
            best[n] = gain[n] if taken[n] else rest
        label = [-1] * size
        for n in reversed(order):
            p = self.parent[n]
            label[n] = label[p] if p >= 0 and label[p] >= 0 else n if taken[n] and self.kept[n] else -1
        return label


def hierarchical_cluster(
    df: DataFrame,
    min_samples: int = 15,
    min_cluster_size: int = 100,
    key: str = "id",
    x: str = "x",
    y: str = "y",
    allow_single: bool = False,
    tile: int = TILE,
) -> DataFrame:
    """(key, cluster_id): clusters numbered from 0 by their smallest key, noise -1.

    ``key`` is a unique bigint. Rows without finite coordinates are noise. The cluster of all
    rows counts only with ``allow_single``. Without ``min_samples`` + 1 points all is noise.
    """
    spark = df.sparkSession
    rows = df.select(F.col(key).alias("key"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    finite = F.abs("x") < math.inf
    located = written(rows.filter(finite & (F.abs("y") < math.inf)), "points")
    spots = written(located.groupBy("x", "y").agg(F.min("key").alias("spot"), F.count(F.lit(1)).alias("w")), "spots")
    count, points = spots.agg(F.count(F.lit(1)), F.sum("w")).first()
    if (points or 0) < max(min_samples + 1, min_cluster_size):
        return df.select(F.col(key), F.lit(-1).alias("cluster_id"))
    placed, strips, cuts = _tiles(spots, count, tile)
    boxes = _boxes(placed)
    cored = core_distances(placed, boxes, min_samples)
    edges = links(cored, boxes, min_cluster_size)
    joined, founded, bridges = (written(t, "tree") for t in contract(cored, edges, strips, cuts, min_cluster_size))
    lightest = bridges.groupBy("a", "b").agg(F.min("w").alias("w")).collect()
    tree = Tree([tuple(r) for r in founded.collect()], [tuple(r) for r in lightest])
    sent = spark.sparkContext.broadcast(tree.arrays())

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The cluster that a spot joins at its threshold, which may be one of those above."""
        names, nodes, parent, since = sent.value
        for b in batches:
            node, w = nodes[np.searchsorted(names, b.column(1).to_numpy())], b.column(2).to_numpy()
            while True:
                above = parent[node]
                up = (above >= 0) & (since[above] <= w)
                if not up.any():
                    break
                node = np.where(up, above, node)
            yield _batch("spot node w", b.column(0), pa.array(node), b.column(2))

    settled = written(joined.select("spot", "cluster", "w").mapInArrow(settle, "spot long, node long, w double"), "settled")
    weights = cored.select("spot", F.col("w").alias("n"))
    density = F.col("n") / F.greatest(F.sqrt("w"), F.lit(SHORTEST))
    totals = settled.join(weights, "spot").groupBy("node").agg(F.sum("n").alias("n"), F.sum(density).alias("gain"))
    own = {r["node"]: (r["n"], r["gain"]) for r in totals.collect()}
    label = tree.chosen(own, allow_single)
    table = spark.createDataFrame([(n, c) for n, c in enumerate(label) if c >= 0], "node long, label long")
    labelled = written(settled.join(small_side(table), "node").select("spot", "label"), "labelled")
    # One row a cluster comes here; the smallest key of a spot is its name.
    firsts = labelled.groupBy("label").agg(F.min("spot").alias("first")).orderBy("first").collect()
    numbers = spark.createDataFrame([(r["label"], n) for n, r in enumerate(firsts)], "label long, cluster_id int")
    by_spot = labelled.join(small_side(numbers), "label").select("spot", "cluster_id")
    at = spots.join(by_spot, "spot").select("x", "y", "cluster_id")
    found = lookup(located, at, ["x", "y"], spread=["key"]).select("key", "cluster_id")
    return (
        rows.select("key").join(found, "key", "left")
        .select(F.col("key").alias(key), F.coalesce("cluster_id", F.lit(-1)).alias("cluster_id"))
    )
