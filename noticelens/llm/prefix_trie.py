"""Prefix trie of conversations by range minima over sorted longest common prefixes.

1. A turn becomes a 128-bit digest of role and text and a number of bytes; a conversation
   is a row with the digests of its turns in order, its path.
2. Paths are sorted over all partitions, equal ones by id, so the members of every prefix
   stand together. A partition is cut into blocks of at most ``BLOCK`` turns.
3. In a block, the lengths of the common prefixes of neighbouring paths get a sparse table
   of range minima. Every prefix of every path is a candidate: from its conversation, it
   binary-searches on its own how far to the left and to the right the minimum stays at its
   depth or above. The interval it finds holds its members; equal intervals of a depth are
   one node. Nodes by first member, then depth, are in preorder, so a subtree is a run of
   them and its sums are differences of running sums.
4. Nodes that reach an end of their block may go on in the next one. They are few, the
   prefixes of a block's first and last path, and are merged by the digest of their prefix;
   running sums over them, in preorder again, complete the sums of their subtrees.

A conversation is one row of 24 bytes a turn, and a block takes one whole path at least; a
prefix is held by one block or merged, so one that very many conversations share, or very
many equal conversations, are spread over as many blocks as they need.

Defined cases: rows without a conversation id belong to no conversation; a null turn comes
first, equal turn numbers follow the digest of role and text; null role or text is empty;
repeated rows are turns of their own; other columns are not read; an empty table has no
nodes, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from noticelens.llm.common import attached, stored

# Turns of a block, and bytes of a piece of a list of ids.
BLOCK, PIECE = 200_000, 1 << 20
DIGEST = 16

_ROW = 40  # bits of a row's number inside its partition
_EMPTY = hashlib.sha256(b"").hexdigest()


def turn_digest(role: Column, text: Column) -> Column:
    """128 bits of SHA-256, in hex; the length tells where the role ends."""
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return F.substring(F.sha2(whole, 256), 1, 2 * DIGEST)


def conversations(
    turns: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    family: Column | None = None,
) -> DataFrame:
    """(family, id, turns) of every conversation: digests and bytes of its turns in order.

    Rows are dealt by ``family``, by default the id itself; texts are not.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = turns.filter(F.col(id_col).isNotNull()).select(
        (F.col(id_col) if family is None else family).cast("long").alias("family"),
        F.col(id_col).cast("long").alias("id"),
        F.struct(
            F.col(turn_col).isNotNull().alias("has"),
            F.col(turn_col).alias("turn"),
            turn_digest(role, text).alias("digest"),
            F.octet_length(text).alias("bytes"),
        ).alias("turn"),
    )
    in_order = F.transform(F.array_sort(F.collect_list("turn")), lambda t: F.struct(t["digest"], t["bytes"]))
    return rows.repartition("family").groupBy("family", "id").agg(in_order.alias("turns"))


def branched(
    turns: DataFrame,
    modulus: int = 5,
    most: int = 9,
    **columns: str,
) -> DataFrame:
    """(id, turns) of conversations rebuilt on the one that begins their family.

    Conversation c gets the first h turns of conversation c - c % ``modulus``, all if those
    are fewer, and goes on with its own turns after its first h; h is crc32(c) % ``most``.
    """
    id_col = F.col(columns.get("id_col", "conv_id")).cast("long")
    rows = conversations(turns, family=id_col - id_col % modulus, **columns)
    head = F.when(F.col("id") == F.col("family"), F.slice("turns", 1, most))
    first = F.first(head, ignorenulls=True).over(Window.partitionBy("family"))
    h = (F.crc32(F.col("id").cast("string").cast("binary")) % most).cast("int")
    none = F.slice("turns", 1, 0)
    rows = rows.withColumn("head", F.coalesce(first, none)).withColumn("h", h)
    whole = F.concat(
        F.slice("head", F.lit(1), F.col("h")),
        F.slice("turns", F.col("h") + 1, F.size("turns")),
    )
    return rows.select("id", whole.alias("turns"))


def _minima(values: np.ndarray) -> list[np.ndarray]:
    """Sparse table: level k holds the minima of 2**k values from each place on."""
    table, span = [values], 1
    while 2 * span <= len(values):
        last = table[-1]
        table.append(np.minimum(last[: len(last) - span], last[span:]))
        span *= 2
    return table


def _range_minimum(table: list[np.ndarray], first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Minima of values[first..last], both included."""
    level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
    out = np.empty(len(first), dtype=table[0].dtype)
    for k in np.unique(level):
        at = level == k
        out[at] = np.minimum(table[k][first[at]], table[k][last[at] - (1 << int(k)) + 1])
    return out


def extents(lcp: np.ndarray, home: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last row of each candidate's interval, found by two binary searches.

    ``lcp[i]`` is the common prefix of rows i - 1 and i; a candidate is a row and a depth. A
    search keeps the farthest row for which the range minimum up to it is deep enough, and
    tries steps of half the length each time.
    """
    table = _minima(lcp)
    left, right = home.copy(), home.copy()
    for k in range(len(table) - 1, -1, -1):
        step, level = 1 << k, table[k]
        # Rows left - step + 1 .. left of lcp join row left - step to the interval.
        able = np.flatnonzero(left - step >= 0)
        able = able[level[left[able] - step + 1] >= depth[able]]
        left[able] -= step
        able = np.flatnonzero(right + step < len(lcp))
        able = able[level[right[able] + 1] >= depth[able]]
        right[able] += step
    return left, right


def common_prefixes(units: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Equal leading units of each path and the one before it, 0 for the first."""
    lcp = np.zeros(len(size), dtype=np.int64)
    if len(size) < 2:
        return lcp
    start = np.cumsum(size) - size
    both = np.minimum(size[1:], size[:-1])
    begin = np.cumsum(both) - both
    place = np.arange(int(both.sum())) - np.repeat(begin, both)
    same = (units[np.repeat(start[:-1], both) + place] == units[np.repeat(start[1:], both) + place]).all(axis=1)
    lcp[1:] = both
    bad = np.flatnonzero(~same)
    np.minimum.at(lcp, np.repeat(np.arange(1, len(size)), both)[bad], place[bad])
    return lcp


_SCHEMA = (
    "kind string, key binary, parent binary, pos long, last long, conv_id long, depth long, parent_conv_id long, "
    "n_convs long, n_children long, n_leaves long, own long, saved_tokens long, ends string"
)
_NAMES = [c.split()[0] for c in _SCHEMA.split(", ")]


def _prefix_keys(path: bytes) -> list[bytes]:
    """Digests of the prefixes of a path, the empty one first."""
    whole, keys = hashlib.blake2b(digest_size=DIGEST), []
    keys.append(whole.digest())
    for n in range(0, len(path), DIGEST):
        whole.update(path[n : n + DIGEST])
        keys.append(whole.digest())
    return keys


def _pieces(ids: np.ndarray) -> Iterator[str]:
    """Comma-joined ids in pieces of bounded size; each but the first begins with a comma."""
    per = PIECE // 20
    for n in range(0, len(ids), per):
        yield ("," if n else "") + ",".join(map(str, ids[n : n + per].tolist()))


def _block(first_row: int, ids: np.ndarray, paths: list[bytes], sizes: list[np.ndarray]) -> pa.RecordBatch:
    """Closed nodes, parts of open nodes and pieces of their id lists, of a sorted block."""
    size = np.array([len(p) // DIGEST for p in paths], dtype=np.int64)
    units = np.frombuffer(b"".join(paths), dtype=np.uint64).reshape(-1, 2)
    lcp, count = common_prefixes(units, size), len(ids)
    # The candidates of row i are its prefixes of 0 to size[i] turns.
    start = np.cumsum(size + 1) - (size + 1)
    home = np.repeat(np.arange(count), size + 1)
    depth = np.arange(len(home)) - start[home]
    left, right = extents(lcp, home, depth)
    # An interval is one node, kept where it begins; these are in preorder.
    node = np.flatnonzero(left == home)
    number = np.full(len(home), -1, dtype=np.int64)
    number[node] = np.arange(len(node))
    l, r, d = left[node], right[node], depth[node]
    n = r - l + 1
    parent = np.where(d > 0, number[start[left[np.maximum(node - 1, 0)]] + d - 1], -1)
    least = _range_minimum(_minima(ids), l, r)
    # Bytes of the last turn; the 0 in front of each path is the root's.
    own = np.concatenate([x for part in sizes for x in ([0], part)])[start[l] + d]
    is_open = (l == 0) | (r == count - 1)
    children = np.bincount(parent[parent >= 0], minlength=len(node))
    closed_children = np.bincount(parent[(parent >= 0) & ~is_open], minlength=len(node))
    # Running sums over the closed nodes in preorder; a subtree ends before the first node
    # that begins behind it.
    behind = np.searchsorted(l, r, side="right")
    leaf = np.concatenate([[0], np.cumsum((children == 0) & ~is_open)])
    saved = np.concatenate([[0], np.cumsum(np.where(is_open, 0, (n - 1) * own))])
    here = np.arange(len(node))
    leaves, saved = leaf[behind] - leaf[here], saved[behind] - saved[here]
    # Conversations that end in a node are the first of its members.
    ended = np.zeros(len(node), dtype=np.int64)
    np.add.at(ended, number[start[left[start + size]] + size], 1)

    keys: dict[int, bytes] = {}
    for row in {0, count - 1}:
        found = _prefix_keys(paths[row])
        for k in range(len(found)):
            keys[int(number[start[left[start[row] + k]] + k])] = found[k]
    rows: dict[str, list] = {c: [] for c in _NAMES}

    def add(**cells) -> None:
        for c in _NAMES:
            rows[c].append(cells.get(c))

    for k in np.flatnonzero(is_open).tolist():
        add(
            kind="open", key=keys[k], parent=keys[int(parent[k])] if d[k] else None, depth=int(d[k]),
            pos=first_row + int(l[k]), last=first_row + int(r[k]), conv_id=int(least[k]), n_convs=int(n[k]),
            n_children=int(closed_children[k]), n_leaves=int(leaves[k]), own=int(own[k]), saved_tokens=int(saved[k]),
        )
        at = first_row + int(l[k])
        for piece in _pieces(ids[l[k] : l[k] + ended[k]]):
            add(kind="ends", key=keys[k], pos=at, ends=piece)
            at += 1
    open_rows = pa.RecordBatch.from_pydict({c: pa.array(rows[c], _types[c]) for c in _NAMES})
    closed = np.flatnonzero(~is_open)
    if not len(closed):
        return open_rows
    of_open = is_open[parent[closed]]
    ends = [
        hashlib.sha256("".join(_pieces(ids[l[k] : l[k] + ended[k]])).encode()).hexdigest() if ended[k] else _EMPTY
        for k in closed.tolist()
    ]
    cells = {
        "kind": pa.array(["node"] * len(closed)),
        "parent": pa.array([keys[p] if o else None for p, o in zip(parent[closed].tolist(), of_open.tolist())], pa.binary()),
        "conv_id": pa.array(least[closed]),
        "depth": pa.array(d[closed]),
        "parent_conv_id": pa.array(np.where(of_open, 0, least[parent[closed]]), mask=of_open),
        "n_convs": pa.array(n[closed]),
        "n_children": pa.array(children[closed]),
        "n_leaves": pa.array(leaves[closed]),
        "saved_tokens": pa.array(saved[closed]),
        "ends": pa.array(ends),
    }
    blank = {c: pa.nulls(len(closed), _types[c]) for c in _NAMES}
    closed_rows = pa.RecordBatch.from_pydict({c: cells.get(c, blank[c]).cast(_types[c]) for c in _NAMES})
    return pa.concat_batches([open_rows, closed_rows])


_types = {
    c.split()[0]: {"string": pa.string(), "binary": pa.binary(), "long": pa.int64()}[c.split()[1]]
    for c in _SCHEMA.split(", ")
}


def _blocks(batches: Iterator[pa.RecordBatch], bound: int) -> Iterator[pa.RecordBatch]:
    partition, first, row, turns = TaskContext.get().partitionId() << _ROW, 0, 0, 0
    ids, paths, sizes = [], [], []

    def done() -> pa.RecordBatch:
        return _block(partition + first, np.array(ids, dtype=np.int64), paths, sizes)

    for batch in batches:
        for id_, path, size in zip(*(batch.column(c) for c in range(3))):
            path, more = path.as_py(), len(path.as_buffer()) // DIGEST + 1
            if ids and turns + more > bound:
                yield done()
                first, turns, ids, paths, sizes = row, 0, [], [], []
            ids.append(id_.as_py())
            paths.append(path)
            sizes.append(size.values.to_numpy(zero_copy_only=False).astype(np.int64))
            row, turns = row + 1, turns + more
    if ids:
        yield done()


def _list_hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, ends) from the pieces of id lists, sorted by key and place."""
    key, whole = None, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([whole.hexdigest()])], ["key", "ends"])

    for batch in batches:
        for k, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if k != key:
                if whole is not None:
                    yield row()
                key, whole = k, hashlib.sha256()
            elif not piece.startswith(","):
                whole.update(b",")
            whole.update(piece.encode())
    if whole is not None:
        yield row()


def _running(df: DataFrame, order: list[str], values: list[str]) -> DataFrame:
    """Running sums ``sum_<value>`` by the given order, over ranges of it.

    Each range is summed on its own and starts at the sum of those before it, so only the
    table of ranges, one row each, is ordered as a whole.
    """
    ranges = df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    placed = df.repartitionByRange(int(ranges), *order).withColumn("range", F.spark_partition_id())
    placed = stored(placed, "open_ranges")
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    before = placed.groupBy("range").agg(*[F.sum(v).alias(v) for v in values])
    before = before.select("range", *[F.coalesce(F.sum(v).over(earlier), F.lit(0)).alias(f"before_{v}") for v in values])
    within = Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    sums = placed.select("*", *[F.sum(v).over(within).alias(f"sum_{v}") for v in values]).join(F.broadcast(before), "range")
    for v in values:
        sums = sums.withColumn(f"sum_{v}", F.col(f"sum_{v}") + F.col(f"before_{v}"))
    return sums.drop("range", *[f"before_{v}" for v in values])


def _merged(parts: DataFrame) -> DataFrame:
    """Open nodes, whole: parts summed by prefix, subtrees completed by running sums."""
    nodes = parts.groupBy("key").agg(
        F.first("parent", ignorenulls=True).alias("parent"),
        F.first("depth").alias("depth"),
        F.first("own").alias("own"),
        F.min("pos").alias("pos"),
        F.max("last").alias("last"),
        F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
    )
    nodes = stored(nodes, "open_nodes")
    more = nodes.filter("parent is not null").groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("more"))
    nodes = nodes.join(more, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0)))
    value = F.when(F.col("n_children") == 0, 1).otherwise(0), (F.col("n_convs") - 1) * F.col("own")
    nodes = stored(nodes.withColumns({"leaf": value[0].cast("long"), "gain": value[1]}), "open_values")
    # A node stands at its first member; the end of its subtree is looked up behind its last.
    marks = nodes.select("key", F.col("pos").alias("at"), F.lit(0).alias("side"), "depth", "leaf", "gain").unionByName(
        nodes.select("key", F.col("last").alias("at"), F.lit(1).alias("side"), "depth",
                     F.lit(0).cast("long").alias("leaf"), F.lit(0).cast("long").alias("gain"))
    )
    sums = _running(marks, ["at", "side", "depth"], ["leaf", "gain"])
    subtree = sums.groupBy("key").agg(
        *[
            (F.max(F.when(F.col("side") == 1, F.col(f"sum_{v}"))) - F.max(F.when(F.col("side") == 0, F.col(f"sum_{v}") - F.col(v)))).alias(f"all_{v}")
            for v in ("leaf", "gain")
        ]
    )
    return nodes.join(subtree, "key").select(
        "key", "parent", "conv_id", "depth", "n_convs", "n_children",
        (F.col("n_leaves") + F.col("all_leaf")).alias("n_leaves"),
        (F.col("saved_tokens") + F.col("all_gain")).alias("saved_tokens"),
    )


def trie(rebuilt: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per node of the trie of (id, turns): see the module.

    A node is named by its smallest member and its depth. ``n_convs`` counts its members,
    ``n_leaves`` the childless nodes of its subtree; ``saved_tokens`` sums, over the subtree,
    the bytes of each node's last text times its members but one, what a cache of prefixes
    saves; ``ends_sha256`` is the hash of the sorted ids of members that end in it.
    """
    path = F.unhex(F.array_join(F.col("turns.digest"), ""))
    rows = rebuilt.select("id", path.alias("path"), F.col("turns.bytes").alias("bytes"))
    rows = stored(rows, "paths")
    spark = rows.sparkSession
    turns = rows.agg(F.sum(F.size("bytes") + 1)).first()[0] or 0
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), turns // block + 1)
    in_order = rows.repartitionByRange(ranges, "path", "id").sortWithinPartitions("path", "id")
    blocks = in_order.mapInArrow(lambda batches: _blocks(batches, block), _SCHEMA)
    found = stored(blocks, "trie", partition_by="kind")
    opened = stored(_merged(found.filter("kind = 'open'")), "open_whole")
    pieces = found.filter("kind = 'ends'").select("key", "ends", "pos")
    hashes = (
        pieces.repartition("key").sortWithinPartitions("key", "pos").select("key", "ends")
        .mapInArrow(_list_hash, "key binary, ends string")
    )
    columns = ["parent", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]
    whole = opened.join(hashes, "key", "left").withColumn("parent_conv_id", F.lit(None).cast("long"))
    nodes = found.filter("kind = 'node'").select(columns).unionByName(whole.select(columns))
    names = opened.select(F.col("key").alias("parent"), F.col("conv_id").alias("of_open"))
    out = attached(nodes, names, ["parent"], "left", spread=["conv_id", "depth"])
    return out.select(
        "conv_id",
        "depth",
        F.coalesce("parent_conv_id", "of_open").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends", F.lit(_EMPTY)).alias("ends_sha256"),
    )
