"""Near-duplicate classes by b-bit MinHash, exact on full shingle sets.

1. One pass measures every whole text: number of distinct shingles, a 128-bit hash of
   the set, keys of ``BANDS`` bands of ``ROWS`` minima, and the low ``BITS`` bits of the
   first ``KEPT`` minima, packed into longs. Equal sets become one node.
2. Nodes sharing a band key are candidates. A bucket is never expanded into its pairs:
   first every node meets the leader of a salted part of its bucket and that leader the
   leader of the bucket; then nodes outside a bucket's largest class meet varying
   members of that class, and only the best estimate is tried.
3. Last, every remaining candidate pair of different classes is settled. In a bucket of up
   to ``FEW`` nodes all of them are built. In a larger one shingles fall into core ones,
   which more than ``FEW`` nodes of such buckets have, and rare ones. Two nodes that share a
   rare one are found by an index of rare shingles. Of any other pair all common shingles
   are core ones. These are counted inside tiles of bounded size, and only links that join
   two classes come out of a tile.

A candidate pair is dropped unconfirmed only if bounds rule it out, of the sizes and of a
bitmap of the shingles (common shingles are common bits, but for those that share a bit
with another one), or if the similarity estimated from the packed bits, corrected for
chance collisions, is far too low.

Each link is confirmed on the two full sets; classes are the connected components.

A pair at similarity 0.8 shares no band with probability (1 - 0.8**5)**36 = 6e-7, and its
estimate falls below the floor with 2e-8.

Defined cases: null or wordless texts have no shingles and no links; repeated rows and
equal texts fall into one class; a null id is linked with nothing and has no class; other
columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from noticelens.llm.common import attached, stored, strings
from noticelens.llm.shingles import WordHashes, shingles
from noticelens.session import SMALL_ROWS, is_small, lookup

BANDS, ROWS = 36, 5
KEPT, BITS = 128, 4
# Standard errors below the threshold at which an estimate rules a pair out.
ERRORS = 5.5
# Shingles hashed at once; bounds the arrays of a task.
BLOCK = 400_000
# Nodes of a bucket that share one leader: a bucket of n nodes has about n / PART leaders.
PART = 2_000
# Size of a bucket, and number of owners of a shingle, up to which pairs are built.
FEW = 64
# Longs of the bitmap of a node's shingles.
MARKS = 32
# Nodes that ask in a tile, nodes that are asked, core shingles of either; pairs compared at once.
GUESTS, ASKED, CORES, CELLS = 8_192, 16_384, 4_000_000, 1 << 17

_LANES = KEPT * BITS // 64


def _multipliers() -> np.ndarray:
    values = np.random.default_rng(20_241).integers(0, 2**63, BANDS * ROWS, dtype=np.int64)
    return values.astype(np.uint64) * np.uint64(2) + np.uint64(1)


def _packed(low: np.ndarray) -> np.ndarray:
    """(rows, KEPT) values of BITS bits -> (rows, lanes) longs."""
    parts = low.reshape(len(low), _LANES, 64 // BITS)
    shifts = (np.arange(64 // BITS, dtype=np.uint64) * np.uint64(BITS))[None, None, :]
    return np.bitwise_or.reduce(parts << shifts, axis=2).view(np.int64)


def _sketches(sets: list[np.ndarray], multipliers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Band keys and packed low bits of non-empty shingle arrays."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    minima = np.empty((len(sets), len(multipliers)), dtype=np.uint64)
    for n, m in enumerate(multipliers):
        minima[:, n] = np.minimum.reduceat(flat * m, starts)
    # The low bits of a product depend on few bits of the shingle; high ones are mixed in.
    minima ^= minima >> np.uint64(31)
    keys = np.zeros((len(sets), BANDS), dtype=np.uint64)
    for n in range(ROWS):
        keys = (keys ^ minima[:, n::ROWS]) * np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(29)
    keys += np.arange(BANDS, dtype=np.uint64)[None, :] * np.uint64(0xD6E8FEB86659FD93)
    return keys.view(np.int64), _packed(minima[:, :KEPT] & np.uint64(2**BITS - 1))


def _set_hash(distinct: np.ndarray) -> bytes:
    return blake2b(distinct.tobytes(), digest_size=16).digest()


def _longs(rows: np.ndarray, valid: np.ndarray) -> pa.Array:
    """A list column with one row of longs where ``valid``, null elsewhere."""
    counts = np.where(valid, rows.shape[1], 0)
    offsets = pa.array(np.concatenate([[0], counts.cumsum()]).astype(np.int32))
    full = pa.ListArray.from_arrays(offsets, pa.array(rows.reshape(-1)))
    return pa.ListArray.from_arrays(
        full.offsets, full.values, mask=pa.array(~valid)
    )


def sketch(docs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """(id, n, hash, bands, bits) of every row; the last three null without shingles."""

    def rows_of(ids: pa.Array, sets: list[np.ndarray], multipliers) -> pa.RecordBatch:
        distinct = [np.unique(s) for s in sets]
        valid = np.array([len(s) > 0 for s in sets], dtype=bool)
        keys = np.zeros((0, BANDS), dtype=np.int64)
        bits = np.zeros((0, _LANES), dtype=np.int64)
        if valid.any():
            keys, bits = _sketches([s for s in distinct if len(s)], multipliers)
        return pa.RecordBatch.from_arrays(
            [
                ids,
                pa.array([len(s) for s in distinct], pa.int64()),
                pa.array([_set_hash(s) if len(s) else None for s in distinct], pa.binary()),
                _longs(keys, valid),
                _longs(bits, valid),
            ],
            names=["id", "n", "hash", "bands", "bits"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, multipliers = WordHashes(), _multipliers()
        for batch in batches:
            first, size, sets = 0, 0, []
            for n, text in enumerate(strings(batch.column(1)), 1):
                sets.append(shingles(text, width, hashes))
                size += len(sets[-1])
                if size >= BLOCK or n == batch.num_rows:
                    yield rows_of(batch.column(0).slice(first, len(sets)), sets, multipliers)
                    first, size, sets = n, 0, []

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, n long, hash binary, bands array<long>, bits array<long>"
    return rows.mapInArrow(run, schema)


def estimate(a: Column, b: Column) -> Column:
    """Similarity from packed bits, corrected for values that agree by chance."""
    differing = F.lit(0)
    for lane in range(_LANES):
        x = a[lane].bitwiseXOR(b[lane])
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        differing = differing + F.bit_count(x.bitwiseAND(F.lit(0x1111111111111111)))
    chance = 1 / 2**BITS
    return ((1 - differing / KEPT) - chance) / (1 - chance)


def _floor(percent: int) -> float:
    chance, t = 1 / 2**BITS, percent / 100
    agree = t + (1 - t) * chance
    return t - ERRORS * (agree * (1 - agree) / KEPT) ** 0.5 / (1 - chance)


def _possible(a: str, b: str, percent: int) -> Column:
    """What sizes, shared marks and packed bits leave possible.

    Common shingles have common marks. A node with n shingles and m marks has n - m
    shingles whose mark another one has too, so no more than that are missed by counting.
    """
    n_a, n_b = F.col(f"{a}.n"), F.col(f"{b}.n")
    shared = F.least(F.col(f"{a}.spare"), F.col(f"{b}.spare"))
    for lane in range(MARKS):
        both = F.col(f"{a}.marks")[lane].bitwiseAND(F.col(f"{b}.marks")[lane])
        shared = shared + F.bit_count(both)
    common = F.least(shared, n_a, n_b)
    return (
        (100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b))
        & (estimate(F.col(f"{a}.bits"), F.col(f"{b}.bits")) >= _floor(percent))
        & (100 * common >= percent * (n_a + n_b - common))
    )


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    first = sets.select(F.col("node").alias("a"), F.col("full").alias("full_a"))
    second = sets.select(F.col("node").alias("b"), F.col("full").alias("full_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    joined = pairs.join(first, "a").join(second, "b").select("a", "b", "full_a", "full_b")
    return joined.mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(node, component) of all linked nodes; the component is its smallest node.

    Alternates the two star operations on edges: every node hands its larger, then its
    smaller neighbours over to its smallest one, until the edges are stars.
    """
    edges = stored(_edges(links.select("a", "b")).distinct(), "edges")
    now, before = _fingerprint(edges), None
    # Edges never grow in number, so neither does the table of smallest neighbours.
    small = now[0] <= SMALL_ROWS // 2
    while now != before:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        larger = lookup(both.filter("b > a"), least, ["a"], spread=["b"], materialised=True, small=small)
        down = stored(_edges(larger.select("b", "m")), "edges")
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        smaller = lookup(down, least, ["a"], spread=["b"], materialised=True, small=small)
        ends = F.explode(F.array("a", "b")).alias("x")
        edges = stored(_edges(smaller.select(ends, "m")).distinct(), "edges")
        now, before = _fingerprint(edges), now
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.withColumn("component", F.col("node"))
    )


def _edges(pairs: DataFrame) -> DataFrame:
    """Edges a > b of two columns of nodes."""
    x, y = (F.col(c) for c in pairs.columns)
    return pairs.select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b")).filter("a != b")


def _side(df: DataFrame) -> DataFrame:
    """A written table of narrow rows; broadcast up to a bound of rows, else shuffled."""
    return F.broadcast(df) if df.count() <= SMALL_ROWS // 2 else df


def _fingerprint(edges: DataFrame) -> tuple:
    total = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), total).first())


def _full_sets(docs, nodes, members, width, id_col, text_col) -> DataFrame:
    """(node, full, marks, spare) of the given nodes: their distinct shingles, from the whole
    texts, the bitmap of these, and how many share a mark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sets = [np.unique(shingles(t, width, hashes)) for t in strings(batch.column(0))]
            marks = [_marked(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([_set_hash(s) for s in sets], pa.binary()),
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                    pa.array([m.tolist() for m, _ in marks], pa.list_(pa.int64())),
                    pa.array([spare for _, spare in marks], pa.int64()),
                ],
                names=["hash", "full", "marks", "spare"],
            )

    wanted = stored(
        nodes.join(members, "node").select(F.col("rep").alias("__mh_rep"), "hash", "node"), "wanted"
    )
    few = wanted.count() <= SMALL_ROWS // 2
    reps, hashes_of = wanted.select("__mh_rep"), wanted.select("hash", "node")
    if few:
        reps, hashes_of = F.broadcast(reps), F.broadcast(hashes_of)
    texts = docs.join(reps, docs[id_col] == reps["__mh_rep"], "left_semi").select(text_col)
    schema = "hash binary, full binary, marks array<long>, spare long"
    found = texts.mapInArrow(run, schema).join(hashes_of, "hash")
    # A repeated id may bring a text twice.
    return stored(found.select("node", "full", "marks", "spare").dropDuplicates(["node"]), "sets")


def _marked(distinct: np.ndarray) -> tuple[np.ndarray, int]:
    """The bitmap of a set of shingles, and the number of shingles beyond its marks."""
    flags = np.zeros(64 * MARKS, dtype=np.uint8)
    flags[(distinct >> np.uint64(20)) % np.uint64(64 * MARKS)] = 1
    return np.packbits(flags).view(np.int64), len(distinct) - int(flags.sum())


def near_duplicates(
    docs: DataFrame,
    width: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, n_shingles, component_id, kept, set_hash) of every row."""
    rows = stored(sketch(docs, width, id_col, text_col), "sketch")
    nodes = stored(
        rows.filter(F.col("hash").isNotNull() & F.col("id").isNotNull())
        .groupBy("hash")
        .agg(
            F.min("id").alias("rep"),
            F.count(F.lit(1)).alias("copies"),
            F.first("n").alias("n"),
            F.first("bands").alias("bands"),
            F.first("bits").alias("bits"),
        )
        .withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    linked = _linked(docs, nodes, width, percent, id_col, text_col)
    classes = (
        nodes.join(linked, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
        .select("hash", "component", "rep", "copies")
    )
    first = (
        classes.groupBy("component")
        .agg(F.min("rep").alias("component_id"), F.sum("copies").alias("size"))
        .filter("size > 1")
    )
    known = attached(classes.select("hash", "component"), first, ["component"], spread=["hash"])
    known = known.select("hash", "component_id")
    out = attached(rows.select("id", "n", "hash"), known, ["hash"], "left", spread=["id"])
    component = F.coalesce("component_id", "id")
    return out.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
        F.col("hash").alias("set_hash"),
    )


def _linked(docs, nodes, width, percent, id_col, text_col) -> DataFrame:
    """(node, component) of the nodes that have a link."""
    placed = nodes.select("node", F.explode("bands").alias("key"))
    salts = max(16, nodes.count() // PART)
    placed = placed.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(salts)).cast("int"))
    parts = placed.groupBy("key", "salt").agg(
        F.min("node").alias("part"), F.count(F.lit(1)).alias("size")
    )
    parts = stored(parts, "parts")
    buckets = parts.groupBy("key").agg(F.min("part").alias("leader"), F.sum("size").alias("size"))
    many = parts.join(buckets.filter("size > 1").select("key", "leader"), "key")
    shared = stored(
        placed.join(many.select("key", "salt", "part", "leader"), ["key", "salt"]).select(
            "key", "node", "part", "leader"
        ),
        "shared",
    )
    members = _side(stored(shared.select("node").distinct(), "members"))
    sets = _full_sets(docs, nodes, members, width, id_col, text_col)
    facts = nodes.join(members, "node", "left_semi").select("node", "n", "bits")
    facts = stored(facts.join(sets.select("node", "marks", "spare"), "node"), "facts")
    facts = _side(facts)

    # Of the leaders that a node meets, the one that looks most similar is tried.
    leaders = shared.select(
        F.explode(
            F.array(
                F.struct(F.col("node").alias("a"), F.col("part").alias("b")),
                F.struct(F.col("part").alias("a"), F.col("leader").alias("b")),
            )
        ).alias("p")
    ).select("p.a", "p.b")
    pairs = leaders.filter("a != b").distinct()
    best = _estimated(pairs, facts, percent).groupBy("a").agg(F.max_by("b", "estimate").alias("b"))
    links = stored(_confirmed(best, sets, percent), "links")
    linked = _side(stored(components(links), "linked"))

    at = _at_mains(shared, linked)
    best = (
        _estimated(_visits(at), facts, percent)
        .groupBy("a", "to")
        .agg(F.max_by("b", "estimate").alias("b"))
    )
    more = stored(_confirmed(best.select("a", "b"), sets, percent), "links")
    if not more.isEmpty():
        links = links.unionByName(more)
        linked = _side(stored(components(links), "linked"))
        at = _at_mains(shared, linked)

    marked = stored(at.join(facts, "node"), "marked")
    pairs, by_core = _of_large(marked, sets, percent)
    pairs = _of_small(marked, percent).unionByName(pairs).distinct()
    rest = stored(_confirmed(pairs, sets, percent).unionByName(by_core), "links")
    if not rest.isEmpty():
        linked = stored(components(links.unionByName(rest)), "linked")
    return linked


def _estimated(pairs: DataFrame, facts: DataFrame, percent: int) -> DataFrame:
    """Pairs that the bounds and the estimate leave possible, with their estimate."""
    a, b = facts.alias("fa"), facts.alias("fb")
    found = (
        pairs.join(a, F.col("a") == F.col("fa.node"))
        .join(b, F.col("b") == F.col("fb.node"))
        .filter(_possible("fa", "fb", percent))
    )
    return found.select(*pairs.columns, estimate(F.col("fa.bits"), F.col("fb.bits")).alias("estimate"))


def _at_mains(shared: DataFrame, linked: DataFrame) -> DataFrame:
    """(key, main, large, node, component) of the buckets that hold several classes; ``main``
    is the largest class of the bucket, ``large`` tells more than ``FEW`` nodes."""
    at = stored(
        shared.join(linked, "node", "left").select(
            "key", "node", F.coalesce("component", "node").alias("component")
        ),
        "at",
    )
    mains = (
        at.groupBy("key", "component")
        .agg(F.count(F.lit(1)).alias("size"))
        .groupBy("key")
        .agg(
            F.max(F.struct("size", "component")).alias("main"),
            F.count(F.lit(1)).alias("classes"),
            F.sum("size").alias("size"),
        )
        .filter("classes > 1")
        .select("key", F.col("main.component").alias("main"), (F.col("size") > FEW).alias("large"))
    )
    return stored(attached(at, mains, ["key"], spread=["node"]), "mains")


def _visits(at: DataFrame) -> DataFrame:
    """(a, b, to): nodes outside a bucket's largest class ``to`` and a member b of that class,
    another one in every bucket."""
    hosts = (
        at.filter("component = main")
        .groupBy("key", F.col("main").alias("to"))
        .agg(F.min(F.struct(F.xxhash64("node", "key").alias("order"), "node")).alias("host"))
        .select("key", "to", F.col("host.node").alias("b"))
    )
    guests = at.filter("component != main").select("key", F.col("node").alias("a"))
    return attached(guests, hosts, ["key"], spread=["a"]).select("a", "b", "to").distinct()


def _apart(percent: int) -> Column:
    """Pairs g, h of one bucket and of different classes, each of them asked for once."""
    return (
        (F.col("g.key") == F.col("h.key"))
        & (F.col("g.component") != F.col("h.component"))
        # Of two nodes outside the largest class, only the smaller one asks.
        & ((F.col("h.component") == F.col("h.main")) | (F.col("g.node") < F.col("h.node")))
        & _possible("g", "h", percent)
    )


def _of_small(marked: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different classes in buckets of few nodes."""
    rows = marked.filter(~F.col("large"))
    pairs = rows.filter("component != main").alias("g").join(rows.alias("h"), _apart(percent))
    return pairs.select(F.least("g.node", "h.node").alias("a"), F.greatest("g.node", "h.node").alias("b"))


def _of_large(marked: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Of different classes in large buckets: pairs (a, b) that share a rare shingle and that
    bounds leave possible, and links (a, b) by core shingles alone."""
    large = marked.filter("large")
    if large.isEmpty():
        none = marked.limit(0).select(F.col("node").alias("a"), F.col("node").alias("b"))
        return none, none
    nodes = (
        large.groupBy("node")
        .agg(
            F.first("component").alias("component"),
            F.first("n").alias("n"),
            F.first("bits").alias("bits"),
            F.first("marks").alias("marks"),
            F.first("spare").alias("spare"),
            F.bool_or(F.col("component") != F.col("main")).alias("outside"),
        )
    )
    nodes = stored(nodes, "large")
    told = _side(nodes.select("node"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, full in zip(batch.column(0).to_pylist(), batch.column(1)):
                values = np.frombuffer(full.as_buffer(), dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values), pa.array(np.full(len(values), node))], names=["s", "node"]
                )

    places = sets.join(told, "node", "left_semi").select("node", "full")
    places = stored(places.mapInArrow(run, "s long, node long"), "places")
    owners = places.groupBy("s").agg(F.count(F.lit(1)).alias("df"), F.min("node").alias("node"))
    owners = stored(owners, "owners")
    few = owners.filter(F.col("df").between(2, FEW)).select("s", "df")
    rare = stored(attached(places, few, ["s"], spread=["node"]), "rare")
    own = owners.filter("df = 1").groupBy("node").agg(F.count(F.lit(1)).alias("own"))
    shared = rare.groupBy("node").agg(F.count(F.lit(1)).alias("rare"))
    zero = F.lit(0).cast("long")
    nodes = stored(
        nodes.join(own, "node", "left")
        .join(shared, "node", "left")
        .withColumn("rare", F.coalesce("rare", zero))
        .withColumn("core", F.col("n") - F.coalesce("own", zero) - F.col("rare")),
        "judged",
    )
    judged = _side(nodes)
    many = owners.filter(F.col("df") > FEW).select("s")
    cores = attached(places, many, ["s"], spread=["node"]).groupBy("node").agg(F.collect_list("s").alias("cores"))
    by_core = _by_core(large, nodes, cores, percent)
    # So many rare shingles a partner shares at least; all but so many need no lookup.
    needed = F.greatest(F.ceil(percent * F.col("n") / 100) - F.col("core"), F.lit(1))
    asked = judged.filter("outside").withColumn("looked", F.col("rare") - needed + 1)
    order = Window.partitionBy("node").orderBy("df", "s")
    asking = (
        rare.withColumn("place", F.row_number().over(order))
        .join(asked.select("node", "looked"), "node")
        .filter("place <= looked")
        .select("s", F.col("node").alias("a"))
    )
    met = (
        asking.join(rare.select("s", F.col("node").alias("b")), "s")
        .filter("a != b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
    by_rare = (
        met.join(judged.alias("g"), F.col("a") == F.col("g.node"))
        .join(judged.alias("h"), F.col("b") == F.col("h.node"))
        .filter((F.col("g.component") != F.col("h.component")) & _possible("g", "h", percent))
        .select("a", "b")
    )
    return by_rare, by_core


_TILE = ["main", "unit", "of_g", "of_h"]


def _tiles(rows: DataFrame) -> DataFrame:
    """Rows (*_TILE, asks, node, component) of a stored table (key, main, node, component, core):
    every node outside its bucket's largest class, asking, meets each node of the bucket once.

    The buckets of one largest class are taken as one if that asks for no more pairs than
    they do apart.
    """
    outside = F.col("component") != F.col("main")
    measures = [
        F.count(F.lit(1)).alias("size"),
        F.sum("core").alias("weight"),
        F.count(F.when(outside, True)).alias("guests"),
        F.coalesce(F.sum(F.when(outside, F.col("core"))), F.lit(0)).alias("guests_weight"),
    ]
    apart = rows.groupBy("main", "key").agg(*measures).groupBy("main")
    apart = apart.agg(F.sum(F.col("guests") * F.col("size")).alias("pairs"))
    as_one = rows.dropDuplicates(["main", "node"]).groupBy("main").agg(*measures).join(apart, "main")
    as_one = as_one.filter(F.col("guests") * F.col("size") <= F.col("pairs")).select("main", F.lit(True).alias("one"))
    rows = attached(rows, as_one, ["main"], "left", spread=["node"])
    # A class's buckets are taken either all as one or all apart, so 0 stands for no bucket.
    rows = rows.withColumn("unit", F.when(F.col("one"), F.lit(0).cast("long")).otherwise(F.col("key")))
    rows = stored(rows.dropDuplicates(["main", "unit", "node"]).drop("key", "one"), "able")

    def chunks(n: str, most: int, weight: str) -> Column:
        return F.greatest(F.ceil(F.col(n) / most), F.ceil(F.col(weight) / CORES))

    units = rows.groupBy("main", "unit").agg(*measures).filter("guests > 0")
    units = units.select(
        "main", "unit", chunks("guests", GUESTS, "guests_weight").alias("g"), chunks("size", ASKED, "weight").alias("h")
    )
    rows = attached(rows, units, ["main", "unit"], spread=["node"])
    some_g, some_h = (F.pmod(F.xxhash64("node", F.lit(c)), F.col(c)) for c in "gh")
    all_g, all_h = (F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1)) for c in "gh")
    same = ["main", "unit", "node", "component"]
    asking = rows.filter(outside).select(*same, F.lit(True).alias("asks"), some_g.alias("of_g"), all_h.alias("of_h"))
    asked = rows.select(*same, F.lit(False).alias("asks"), all_g.alias("of_g"), some_h.alias("of_h"))
    return asking.unionByName(asked).select(*_TILE, "asks", "node", "component")


def _by_core(large: DataFrame, nodes: DataFrame, cores: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of nodes outside a large bucket's largest class, by common core shingles.

    ``nodes`` is stored; ``cores`` has the core shingles of every node.
    """
    # No more shingles are common than core ones, and the union has at least n.
    able = nodes.filter(100 * F.col("core") >= percent * F.col("n")).select("node", "core")
    rows = large.select("key", "main", "node", "component")
    rows = stored(attached(rows, able, ["node"], spread=["key"]), "able")
    facts = nodes.select("node", "n", "bits").join(cores, "node")
    rows = _tiles(rows).join(facts, "node").select(*_TILE, "asks", "node", "component", "n", "bits", "cores")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(parts, *_TILE).sortWithinPartitions(*_TILE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.column_stack([batch.column(n).to_numpy() for n in range(len(_TILE))])
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for first, last in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)]):
                if held and tuple(keys[first]) != key:
                    yield _tile_links(pa.Table.from_batches(held), percent)
                    held = []
                key = tuple(keys[first])
                held.append(batch.slice(first, last - first))
        if held:
            yield _tile_links(pa.Table.from_batches(held), percent)

    return rows.mapInArrow(run, "a long, b long")


def _lists(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The values of a column of lists, and where each list begins, with the end."""
    lists = column.combine_chunks()
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    offsets = lists.offsets.to_numpy()
    return lists.values.to_numpy()[offsets[0] : offsets[-1]], offsets - offsets[0]


def _tile_links(tile: pa.Table, percent: int) -> pa.RecordBatch:
    """Links (a, b) by which the asking nodes of a tile join classes; of several that join
    the same ones the first stays."""
    main = tile["main"][0].as_py()
    asks = tile["asks"].to_numpy()
    node, component, n = (tile[c].to_numpy() for c in ("node", "component", "n"))
    bits = _lists(tile["bits"])[0].view(np.uint64).reshape(-1, _LANES)
    values, starts = _lists(tile["cores"])
    distinct, ids = np.unique(values, return_inverse=True)
    core = np.diff(starts)
    chance = 1 / 2**BITS
    most = KEPT * (1 - chance) * (1 - _floor(percent))
    g, h = np.flatnonzero(asks), np.flatnonzero(~asks)
    has = np.zeros(len(distinct), dtype=bool)
    root: dict[int, int] = {}
    out: list[tuple[int, int]] = []

    def find(x: int) -> int:
        while x in root:
            root[x] = root.get(root[x], root[x])
            x = root[x]
        return x

    def possible(some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = some[:, None]
        both = np.minimum(core[x], core[h])
        fits = 100 * both >= percent * (n[x] + n[h] - both)
        fits &= component[x] != component[h]
        # Of two nodes outside the largest class, only the smaller one asks.
        fits &= (component[h] == main) | (node[x] < node[h])
        x, y = np.nonzero(fits)
        x, y = some[x], h[y]
        apart = bits[x] ^ bits[y]
        apart |= apart >> np.uint64(1)
        apart |= apart >> np.uint64(2)
        apart = np.bitwise_count(apart & np.uint64(0x1111111111111111)).sum(axis=1)
        return x[apart <= most], y[apart <= most]

    def linked(x: int, others: np.ndarray) -> np.ndarray:
        has[ids[starts[x] : starts[x + 1]]] = True
        size = core[others]
        ends = size.cumsum()
        places = np.arange(ends[-1]) + np.repeat(starts[others] - (ends - size), size)
        both = np.add.reduceat(has[ids[places]], ends - size, dtype=np.int64)
        has[ids[starts[x] : starts[x + 1]]] = False
        return others[100 * both >= percent * (n[x] + n[others] - both)]

    step = max(1, CELLS // max(1, len(h)))
    for first in range(0, len(g), step):
        x, y = possible(g[first : first + step])
        cuts = np.flatnonzero(np.diff(x)) + 1
        for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(x)]):
            # Long sets are counted a few at a time.
            while low < high:
                end = low + max(1, int(np.searchsorted(core[y[low:high]].cumsum(), CORES // 4)))
                end = min(end, high)
                found = linked(x[low], y[low:end])
                _, firsts = np.unique(component[found], return_index=True)
                for other in found[firsts].tolist():
                    a, b = find(int(component[x[low]])), find(int(component[other]))
                    if a != b:
                        root[a] = b
                        out.append((int(node[x[low]]), int(node[other])))
                low = end
    a, b = (pa.array([pair[k] for pair in out], pa.int64()) for k in (0, 1))
    return pa.RecordBatch.from_arrays([a, b], names=["a", "b"])


def one_of_each(
    docs: DataFrame,
    width: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row of each class, with all its columns: that of the smallest id.

    Of rows that repeat an id with the same shingles one stays, settled by a hash of the
    whole row. Rows whose id is null stay.
    """
    found = stored(near_duplicates(docs, width, percent, id_col, text_col), "classes")
    gone = found.filter(~F.col("kept")).select(F.col(id_col).alias("__mh_id")).distinct()
    repeated = (
        found.filter(F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("__mh_id"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .filter("rows > 1")
        .select("__mh_id")
    )
    gone, repeated = stored(gone, "gone"), stored(repeated, "repeated")
    if repeated.isEmpty():
        return docs.join(_hinted(gone), F.col(id_col) == F.col("__mh_id"), "left_anti")
    once = docs.join(_hinted(gone.union(repeated).distinct()), F.col(id_col) == F.col("__mh_id"), "left_anti")
    many = docs.join(_hinted(repeated), F.col(id_col) == F.col("__mh_id"), "left_semi")
    return once.unionByName(_one_of_repeated(many, found, width, id_col, text_col))


def _hinted(ids: DataFrame) -> DataFrame:
    ids = stored(ids, "ids")
    return F.broadcast(ids) if is_small(ids) else ids


def _one_of_repeated(many, found, width, id_col, text_col) -> DataFrame:
    """Of rows whose id is repeated, one for each id and set of shingles that stays."""
    names = many.columns
    whole = F.struct(*[F.col(c) for c in names])
    rows = many.select(F.col(id_col).alias("__mh_id"), F.col(text_col).alias("_text"), whole.alias("_row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sets = [np.unique(shingles(t, width, hashes)) for t in strings(batch.column(1))]
            hashed = pa.array([_set_hash(s) if len(s) else b"" for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, hashed], names=["__mh_id", "_text", "_row", "_set"])

    schema = T.StructType([*rows.schema.fields, T.StructField("_set", T.BinaryType())])
    kept = (
        found.filter("kept")
        .select(F.col(id_col).alias("__mh_id"), F.coalesce("set_hash", F.lit(b"")).alias("_set"))
        .distinct()
    )
    return (
        rows.mapInArrow(run, schema)
        .join(kept, ["__mh_id", "_set"])
        .groupBy("__mh_id", "_set")
        .agg(F.min_by("_row", F.xxhash64("_row")).alias("_row"))
        .select("_row.*")
        .select(*names)
    )
