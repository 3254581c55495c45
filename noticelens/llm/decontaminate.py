"""Benchmark decontamination by SimHash of item-sized windows, without Python on the rows.

A document leaks an item if one of its windows of as many words as the item has a
weighted Jaccard similarity of at least 0.8 with it, over shingles of five words weighted
by how often they occur (a shorter item or window is one shingle). A document shorter
than the item is one window.

1. A window that similar has at least 0.8 n of the item's n shingles, so it holds one of
   any n - ceil(0.8 n) + 1 of them. Those with the longest word are the item's anchors,
   looked up by that word while the words of a document stream by.
2. All windows over an anchor get a 64-bit SimHash. It is split into ``RADIUS`` + 1
   blocks: fingerprints within the radius agree in one block at least, and the join is on
   size, block and its value.
3. Pairs within the radius are compared exactly.

The fingerprints of a pair at similarity 0.8 differ in 9.7 of 64 bits on average, with a
standard deviation of 2.9; more than 26 come up with a probability below 1e-6 per window.

Words are the lower-cased runs without the six ASCII white space characters. Defined
cases: null and wordless texts neither leak nor are leaked; items of equal words are
found alike; repeated rows are judged alike and rows of one id each by their own text;
null ids are kept; other columns are not read; empty tables give empty or clean results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticelens.llm.common import stored
from noticelens.session import is_small, lookup

WIDTH, RADIUS = 5, 26
# Anchors broadcast at once; more of them mean more passes over the documents.
ANCHORS = 200_000

SPACE = " \t\n\x0b\x0c\r"
SPACES = r"[\x20\x09-\x0D]+"


def row_key(id_col: str, text_col: str) -> Column:
    """Names a row by its id and text, so that null and repeated ids are no matter."""
    return F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col(text_col))


def words_of(text: str) -> Column:
    """The words of a text column; null if there are none."""
    trimmed = F.btrim(F.lower(F.col(text)), F.lit(SPACE))
    return F.when(trimmed != "", F.split(trimmed, SPACES))


def shingle_hashes(words: Column) -> Column:
    """Hashes of all shingles of an array of words, repeats included."""
    width = F.least(F.lit(WIDTH), F.size(words))
    return F.transform(
        F.sequence(F.lit(1), F.size(words) - width + 1),
        lambda at: F.xxhash64(F.array_join(F.slice(words, at, width), " ")),
    )


def simhash(hashes: Column) -> Column:
    """Majority of each bit over the hashes, so weighted by repeats.

    Two counters of 32 bits share a long, so 32 passes count all 64 bits.
    """
    size, out = F.size(hashes), F.lit(0).cast("long")
    pair = F.lit((1 << 32) + 1)
    for bit in range(32):
        counts = F.aggregate(
            hashes,
            F.lit(0).cast("long"),
            lambda total, h: total + F.shiftrightunsigned(h, bit).bitwiseAND(pair),
        )
        low, high = counts.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(counts, 32)
        for count, at in ((low, bit), (high, bit + 32)):
            value = (1 << at) - (1 << 64 if at == 63 else 0)
            out = out.bitwiseOR(F.when(2 * count > size, F.lit(value)).otherwise(F.lit(0)).cast("long"))
    return out


def _masks(radius: int) -> list[int]:
    """The bits of each of ``radius`` + 1 blocks, as signed longs."""
    edges = [64 * n // (radius + 1) for n in range(radius + 2)]
    masks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _blocks(print_col: str, radius: int) -> Column:
    """(block, value) of every block of a fingerprint."""
    return F.explode(
        F.array(
            *[
                F.struct(F.lit(n).alias("block"), F.col(print_col).bitwiseAND(F.lit(m)).alias("value"))
                for n, m in enumerate(_masks(radius))
            ]
        )
    ).alias("b")


def _first_block(x: Column, radius: int) -> Column:
    """The first block in which two fingerprints with the exclusive or x agree."""
    return F.coalesce(
        *[F.when(x.bitwiseAND(F.lit(m)) == 0, F.lit(n)) for n, m in enumerate(_masks(radius))]
    )


def _common(a: Column, b: Column) -> Column:
    """Size of the multiset intersection of two arrays."""
    def count(array: Column, value: Column) -> Column:
        return F.size(F.filter(array, lambda y: y == value))

    plain = (F.size(F.array_distinct(a)) == F.size(a)) & (F.size(F.array_distinct(b)) == F.size(b))
    return F.when(plain, F.size(F.array_intersect(a, b))).otherwise(
        F.aggregate(
            F.array_distinct(a), F.lit(0), lambda n, x: n + F.least(count(a, x), count(b, x))
        )
    )


def _anchors(items: DataFrame, percent: int) -> DataFrame:
    """(word, offset, shingle, width, m): shingles of which a leak has one at least."""
    width = F.least(F.lit(WIDTH), F.col("m"))
    listed = items.select(
        "words",
        "m",
        F.posexplode(
            F.transform(
                F.sequence(F.lit(1), F.col("m") - width + 1),
                lambda at: F.slice("words", at, width),
            )
        ).alias("at", "part"),
    )
    # The longest word of each shingle, and the place of its first occurrence there.
    longest = F.array_max(F.transform("part", lambda w: F.struct(F.length(w).alias("l"), w.alias("w"))))
    listed = listed.withColumn("longest", longest)
    ranked = listed.groupBy("words", "m").agg(
        F.reverse(F.array_sort(F.collect_list(F.struct("longest", "at", "part")))).alias("all")
    )
    n = F.size("all")
    needed = n - F.ceil(n * percent / 100).cast("int") + 1
    part = F.col("a.part")
    return (
        ranked.select("m", F.explode(F.slice("all", F.lit(1), needed)).alias("a"))
        .select(
            F.col("a.longest.w").alias("word"),
            (F.array_position(part, F.col("a.longest.w")) - 1).cast("int").alias("offset"),
            F.array_join(part, " ").alias("shingle"),
            F.size(part).alias("width"),
            "m",
        )
        .distinct()
    )


def _anchored(rows: DataFrame, anchors: DataFrame) -> DataFrame:
    """(row, n, at, m): where anchors of items of m words stand in the documents."""
    blocks = max(1, -(-anchors.count() // ANCHORS))
    found = None
    for block in range(blocks):
        some = anchors.filter(F.pmod(F.xxhash64("shingle"), F.lit(blocks)) == block)
        places = rows.select("row", "words", F.posexplode("words").alias("at", "word"))
        hits = places.join(F.broadcast(some), "word").filter(F.col("at") >= F.col("offset"))
        start = F.col("at") - F.col("offset")
        hits = hits.filter(
            F.array_join(F.slice("words", start + 1, F.col("width")), " ") == F.col("shingle")
        ).select("row", F.size("words").alias("n"), start.alias("at"), "width", "m")
        found = hits if found is None else found.unionByName(hits)
    return found


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    percent: int = 80,
    radius: int = RADIUS,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(row, item, similarity) of every leaked item, with the best of its windows."""
    items = stored(
        benchmark.select(F.col(item_col).alias("item"), words_of(item_text_col).alias("words"))
        .filter("words is not null")
        .withColumn("m", F.size("words"))
        .withColumn("hashes", shingle_hashes(F.col("words")))
        .withColumn("print", simhash(F.col("hashes"))),
        "items",
    )
    anchors = stored(_anchors(items.select("words", "m").distinct(), percent), "anchors")
    rows = docs.select(row_key(id_col, text_col).alias("row"), words_of(text_col).alias("words"))
    rows = rows.filter("words is not null")
    # All windows of m words, or the whole document, that hold the anchor.
    last = F.greatest(F.col("n") - F.col("m"), F.lit(0))
    first = F.greatest(F.least(F.col("at") + F.col("width") - F.col("m"), last), F.lit(0))
    starts = stored(
        _anchored(rows, anchors)
        .select("row", "m", F.explode(F.sequence(first, F.least(F.col("at"), last))).alias("start"))
        .distinct(),
        "starts",
    )
    keys = stored(starts.select("row").distinct(), "keys")
    chosen = rows.join(F.broadcast(keys) if is_small(keys) else keys, "row", "left_semi")
    windows = (
        chosen.dropDuplicates(["row"])
        .join(starts, "row")
        .select("row", "m", "start", F.slice("words", F.col("start") + 1, F.col("m")).alias("window"))
        .select("row", "m", "start", shingle_hashes(F.col("window")).alias("hashes"))
    )
    windows = stored(windows.withColumn("print", simhash(F.col("hashes"))), "windows")
    seen = windows.select("row", "m", "start", F.col("print").alias("seen"), _blocks("print", radius))
    index = items.select("item", "m", "print", _blocks("print", radius)).select(
        "item", "m", "print", "b.block", "b.value"
    )
    x = F.col("seen").bitwiseXOR(F.col("print"))
    seen = seen.select("row", "m", "start", "seen", "b.block", "b.value")
    near = (
        seen.join(F.broadcast(index) if is_small(index) else index, ["m", "block", "value"])
        .filter((F.bit_count(x) <= radius) & (F.col("block") == _first_block(x, radius)))
        .select("row", "m", "start", "item")
    )
    known = items.select("item", "m", F.col("hashes").alias("of_item")).dropDuplicates()
    pairs = lookup(
        near.join(windows.select("row", "m", "start", "hashes"), ["row", "m", "start"]),
        known,
        ["item", "m"],
        spread=["row", "start"],
    )
    total = F.size("hashes") + F.size("of_item")
    pairs = pairs.select("row", "item", _common(F.col("hashes"), F.col("of_item")).alias("c"), total.alias("t"))
    return (
        pairs.filter(100 * F.col("c") >= percent * (F.col("t") - F.col("c")))
        .groupBy("row", "item")
        .agg(F.max(F.col("c") / (F.col("t") - F.col("c"))).alias("similarity"))
    )


def judged(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, leaked, n_items, item_ids, similarity) of every row."""
    per = found.groupBy("row").agg(
        F.array_sort(F.collect_set("item")).alias("items"), F.max("similarity").alias("similarity")
    )
    rows = docs.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("row"))
    out = lookup(rows, per, ["row"], "left", spread=["id"])
    return out.select(
        F.col("id").alias(id_col),
        F.col("items").isNotNull().alias("leaked"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.array_join(F.col("items").cast("array<string>"), ",").alias("item_ids"),
        "similarity",
    )


def clean(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that leak no item, with all their columns."""
    rows = stored(found.select("row").distinct(), "leaking").select(F.col("row").alias("__leaking"))
    rows = F.broadcast(rows) if is_small(rows) else rows
    return docs.join(rows, row_key(id_col, text_col) == F.col("__leaking"), "left_anti")
