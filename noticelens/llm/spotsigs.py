"""Document fingerprints by SpotSigs: chains of content words behind common words.

A text's words are its runs of letters and digits in lower case. Common words of four
languages are anchors; at every run of anchors a chain of the next ``CHAIN`` content words,
other anchors left out, is a signature, hashed to 32 bits. The distinct signatures in order
are the fingerprint. Common words stand all over prose but hardly in menus or lists, so the
set follows the text itself.

Two fingerprints are compared by Jaccard similarity. Sets are partitioned by length, and a
pair is compared only if its lengths leave at least ``LEAST`` possible; any other is 0.

``with_next`` puts every document beside the next one by id. Whole texts move once: rows are
dealt by ranges of (id, hash of the text, row), so no repeated id meets in one task, and
written bucketed by range, where windows need no second shuffle; the last document of a
range gets the first one of the next range from a table of one row a range.

Only DataFrame functions run on the rows.

Defined cases: null texts are empty; empty texts have the empty fingerprint, which is like
itself only; a text without any chain takes one at every content word, and one of too few
words is its own only signature, so other texts' fingerprints are never empty; documents
without an id come first, equal ids follow the hash of the text; the next one of the last
document is the first; repeated rows are documents of their own; other columns are not
read; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from noticelens.llm.common import stored
from noticelens.session import lookup, shared_path

# Frequent function words of English, Spanish, German and French.
ANCHORS = (
    *"the of and to a in is that it for was on with as be by this are at from".split(),
    *"de la que el en y los se del un las por con no una su para es al lo".split(),
    *"der die und den von zu das des mit sich auf für ist im dem nicht ein eine als".split(),
    *"le et les du une est pour qui dans par au sur pas avec ou".split(),
)
CHAIN = 3
# Similarity below which a pair is not compared if its lengths rule out more: one in LEAST.
LEAST = 10
# Bytes of texts in a range.
RANGE = 32 << 20

_MARK = "·"  # neither letter nor digit, so in no word


def _spotted(text: Column, anchors: tuple[str, ...]) -> Column:
    """Content words between single spaces, those behind anchors marked."""
    words = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    words = F.concat(F.lit(" "), words, F.lit(" "))
    return F.regexp_replace(words, rf"(?: (?:{'|'.join(anchors)})(?= ))++ ", f" {_MARK}")


def _hashes(chains: Column) -> Column:
    return F.array_sort(F.array_distinct(F.transform(chains, lambda c: F.substring(F.md5(c), 1, 8))))


def with_signatures(
    rows: DataFrame, text_col: str, out: str, anchors: tuple[str, ...] = ANCHORS, chain: int = CHAIN
) -> DataFrame:
    """Adds the sorted distinct signatures of a text, 8 hexadecimal digits each."""
    of_chain = r"(?=([^ ]+" + " [^ ]+" * (chain - 1) + ") )"
    def unmarked(words: Column) -> Column:
        return F.replace(words, F.lit(_MARK), F.lit(""))

    spots = F.regexp_extract_all("__spotted", F.lit(_MARK + of_chain), F.lit(1))
    content = unmarked(F.col("__spotted"))
    every = F.regexp_extract_all(content, F.lit("(?<= )" + of_chain), F.lit(1))
    whole = F.when(F.col(text_col) != "", F.array(F.col(text_col))).otherwise(F.array().cast("array<string>"))
    return (
        rows.withColumn("__spotted", _spotted(F.col(text_col), anchors))
        .withColumn("__chains", F.transform(spots, unmarked))
        .withColumn("__chains", F.when(F.size("__chains") > 0, F.col("__chains")).otherwise(every))
        .withColumn("__chains", F.when(F.size("__chains") > 0, F.col("__chains")).otherwise(whole))
        .withColumn(out, _hashes(F.col("__chains")))
        .drop("__spotted", "__chains")
    )


def fingerprint(signatures: Column) -> Column:
    """The text form of a set of signatures."""
    return F.array_join(signatures, "")


def signatures_of(printed: Column) -> Column:
    """The set of signatures of a text form."""
    return F.regexp_extract_all(printed, F.lit("[0-9a-f]{8}"), F.lit(0))


def length_band(size: Column, least: int = LEAST) -> Column:
    """Partition of a set by its length; sets two partitions apart are not similar enough."""
    return F.floor(F.log(float(least), F.greatest(size, F.lit(1)) + 0.5)).cast("int")


def likeness(a: Column, b: Column, least: int = LEAST) -> Column:
    """Jaccard similarity of two sets, 0 where their lengths rule out 1 / ``least``."""
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    common = F.size(F.array_intersect(a, b))
    return (
        F.when(large == 0, 1.0)
        .when((length_band(large, least) - length_band(small, least) > 1) | (small * least < large), 0.0)
        .otherwise(common / (F.size(a) + F.size(b) - common))
    )


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", range_bytes: int = RANGE) -> DataFrame:
    """(id, text, text_set, next, next_set): every document's text and its next one's, with
    their signatures."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // range_bytes + 1)
    order = ["id", "tie", "row"]
    rows = rows.withColumns({"tie": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    placed = rows.repartitionByRange(ranges, *order).withColumn("range", F.spark_partition_id())
    name, path = f"spotsigs_{uuid.uuid4().hex}", shared_path(spark, "ranges")
    placed.write.bucketBy(ranges, "range").option("path", path).option("compression", "zstd").saveAsTable(name)
    placed = spark.table(name)
    # The files stay, and the frame knows their buckets; only the name goes.
    spark.sql(f"DROP TABLE {name}")

    following = Window.partitionBy("range").orderBy(*order)
    inside = with_signatures(placed, "text", "text_set").select(
        "id",
        "text",
        "text_set",
        F.lead("text").over(following).alias("next"),
        F.lead("text_set").over(following).alias("next_set"),
    )
    place = F.struct(*order)
    limits = placed.groupBy("range").agg(F.min(place).alias("low"), F.max(place).alias("high"))
    # One row a range, and the texts of two rows of each.
    limits = stored(limits, "limits")
    ends = stored(
        lookup(placed.withColumn("place", place), limits, ["range"], spread=["row"], materialised=True)
        .filter("place = low or place = high")
        .select("range", "id", "text", (F.col("place") == F.col("low")).alias("first"), (F.col("place") == F.col("high")).alias("last")),
        "ends",
    )
    by_number = Window.orderBy("range")
    after = limits.select(
        "range",
        # Behind the last range comes the first one.
        F.coalesce(F.lead("range").over(by_number), F.first("range").over(by_number)).alias("after"),
    )
    heads = ends.filter("first").select(F.col("range").alias("after"), F.col("text").alias("next"))
    edges = ends.filter("last").select("range", "id", "text").join(after, "range").join(heads, "after")
    edges = with_signatures(with_signatures(edges, "text", "text_set"), "next", "next_set")
    return inside.filter("next is not null").unionByName(edges.select(inside.columns))


def edited(text: Column, other: Column) -> Column:
    """The last quarter of a text's code points replaced by as many of another text's first."""
    size = F.char_length(text)
    cut = F.floor(size / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), size - cut), F.substring(other, F.lit(1), cut))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", range_bytes: int = RANGE) -> DataFrame:
    """Fingerprints of every document and its edited text, and how alike they are."""
    rows = with_next(docs, id_col, text_col, range_bytes)
    rows = rows.withColumn("edited", edited(F.col("text"), F.col("next")))
    rows = rows.select(
        "id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        "text_set",
        "next_set",
        "edited",
    )
    rows = with_signatures(rows, "edited", "edited_set")
    return rows.select(
        F.col("id").alias(id_col),
        "n_chars",
        "edited_sha256",
        fingerprint(F.col("text_set")).alias("fingerprint"),
        fingerprint(F.col("edited_set")).alias("edited_fingerprint"),
        likeness(F.col("text_set"), F.col("edited_set")).alias("near_edited"),
        likeness(F.col("text_set"), F.col("next_set")).alias("near_next"),
    )
