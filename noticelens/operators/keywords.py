"""Cluster description: TF-IDF keywords, samples, statistics and reports."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from noticelens.fixed_values import NO_KEYWORDS, SEED, STOP_WORDS
from noticelens.functions.text import word_tokens
from noticelens.operators.ranking import seeded_order, top_n
from noticelens.session import small_side, written

# Words of a chunk of texts; bytes of the texts that a task counts, two chunks of common words.
CHUNK, PART_BYTES = 1_000_000, 12 << 20


def cluster_keywords(
    df: DataFrame,
    cluster: str,
    key: str,
    text_col: str,
    n: int = 20,
    max_features: int | None = None,
    stop_words: Sequence[str] = tuple(STOP_WORDS),
) -> DataFrame:
    """Top terms per cluster by summed, length-normalised TF-IDF: (cluster, rank, term, score).

    Every cluster is a corpus of its own. Texts are put in order of their clusters, a large one
    over many tasks, as few texts of many clusters share few terms. They are counted in chunks,
    each with a dictionary of the terms of its clusters: a chunk's counts stay together as
    arrays, and only its distinct terms travel, to be summed into the vocabulary and to fetch
    their weights. Norms and sums are then made inside a chunk. ``key`` may repeat or be null,
    as rows are told apart by their place; rows without a cluster or text take no part.
    ``max_features`` keeps the most used terms of each cluster only. Ranking uses the score
    rounded to 6 digits, ties alphabetical.
    """
    rows = df.filter(F.col(cluster).isNotNull() & F.col(text_col).isNotNull())
    sizes = rows.groupBy(F.col(cluster).alias("c")).agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(F.octet_length(text_col)).alias("size")
    )
    sizes = written(sizes, "sizes")
    parts = max(1, -(-(sizes.agg(F.sum("size")).first()[0] or 0) // PART_BYTES))
    together = rows.repartitionByRange(parts, F.col(cluster), F.xxhash64(key, text_col))
    chunks = written(_chunks(together, cluster, text_col, stop_words), "chunks", partition_by="kind")
    # A term has a row per chunk here, however often it is used.
    terms = chunks.filter("kind = 'term'").select("chunk", "c", "term", "number", "total", "df")
    if max_features is None:
        of_term = W.partitionBy("c", "term")
        used = terms.select("chunk", "c", "term", "number", F.sum("df").over(of_term).alias("df"))
    else:
        vocabulary = terms.groupBy("c", "term").agg(F.sum("total").alias("total"), F.sum("df").alias("df"))
        order = [F.desc("total"), F.asc("term")]
        vocabulary = top_n(vocabulary, ["c"], order, max_features, F.col("term")).select("c", "term", "df")
        used = terms.select("chunk", "c", "term", "number").join(vocabulary, ["c", "term"])
    idf = F.log((1 + F.col("n_docs")) / (1 + F.col("df"))) + 1
    weights = used.join(small_side(sizes.drop("size")), "c").select("chunk", "c", "term", "number", idf.alias("idf"))
    counts = chunks.filter("kind = 'counts'").select(F.col("chunk").alias("of"), "counts")
    schema = T.StructType([T.StructField("c", df.schema[cluster].dataType), *_SCORED])
    shares = counts.groupBy("of").cogroup(weights.groupBy("chunk")).applyInArrow(_shares, schema)
    scores = shares.groupBy("c", "term").agg(F.round(F.sum("share"), 6).alias("score"))
    ranked = top_n(scores, ["c"], [F.desc("score"), F.asc("term")], n, F.col("term"))
    return ranked.select(F.col("c").alias(cluster), "rank", "term", "score")


_SCORED = [T.StructField("term", T.StringType()), T.StructField("share", T.DoubleType())]


def _chunks(rows: DataFrame, cluster: str, text_col: str, stop_words: Sequence[str]) -> DataFrame:
    """Per chunk the terms of its clusters (``term``: number, total, df), and its counts, packed
    (``counts``)."""
    kind = rows.schema[cluster].dataType
    fields = [
        ("kind", T.StringType()), ("chunk", T.LongType()), ("c", kind), ("term", T.StringType()), ("number", T.IntegerType()),
        ("total", T.LongType()), ("df", T.LongType()), ("counts", T.BinaryType()),
    ]
    names = [name for name, _ in fields]
    stop = pa.array(list(stop_words), pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for whole in batches:
            lengths = pc.list_value_length(whole.column(1)).to_numpy(zero_copy_only=False)
            # Cut so that a chunk has about CHUNK words, or one text.
            cuts = np.flatnonzero(np.diff(np.cumsum(lengths) // CHUNK)) + 1
            for first, last in zip([0, *cuts.tolist()], [*cuts.tolist(), whole.num_rows]):
                batch, size = whole.slice(first, last - first), lengths[first:last]
                words = batch.column(1).flatten().dictionary_encode()
                if not len(words):
                    continue
                clusters = batch.column(0).dictionary_encode()
                row = np.repeat(np.arange(len(size)), size)
                term = words.indices.to_numpy()
                kept = ~pc.is_in(words.dictionary, value_set=stop).to_numpy(zero_copy_only=False)[term]
                pairs, tf = np.unique(row[kept] * len(words.dictionary) + term[kept], return_counts=True)
                row, term = pairs // len(words.dictionary), pairs % len(words.dictionary)
                owner = clusters.indices.to_numpy()[row]
                found, number, df = np.unique(
                    owner * len(words.dictionary) + term, return_inverse=True, return_counts=True
                )
                if not len(found):
                    continue
                total = np.bincount(number, weights=tf).astype(np.int64)
                counts = _packed(row, number, tf)
                types = dict(zip(names, _types(whole.column(0).type)))
                cells = {
                    "kind": pa.repeat("term", len(found)),
                    "chunk": pa.array(np.full(len(found), chunk)),
                    "c": clusters.dictionary.take(pa.array(found // len(words.dictionary))),
                    "term": words.dictionary.take(pa.array(found % len(words.dictionary))),
                    "number": pa.array(np.arange(len(found), dtype=np.int32)),
                    "total": pa.array(total),
                    "df": pa.array(df),
                    "counts": pa.nulls(len(found), pa.binary()),
                }
                yield pa.RecordBatch.from_pydict({n: cells[n] for n in names})
                whole_counts = {"kind": ["counts"], "chunk": [chunk], "counts": [counts]}
                yield pa.RecordBatch.from_pydict({n: pa.array(whole_counts.get(n, [None]), types[n]) for n in names})
                chunk += 1

    words = rows.select(F.col(cluster).alias("c"), word_tokens(F.col(text_col)).alias("words"))
    return words.mapInArrow(run, T.StructType([T.StructField(n, t) for n, t in fields]))


def _types(kind: pa.DataType) -> list[pa.DataType]:
    return [pa.string(), pa.int64(), kind, pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]


def _packed(row: np.ndarray, number: np.ndarray, tf: np.ndarray) -> bytes:
    """Rows, term numbers and counts. Rows and, in a row, numbers ascend, so their steps are
    small; the bytes of one place lie together and compress well."""
    cells = np.concatenate([np.diff(row, prepend=0), np.diff(number, prepend=0), tf]).astype("<i4")
    return zstandard.ZstdCompressor(level=1).compress(cells.view(np.uint8).reshape(-1, 4).T.tobytes())


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8).reshape(4, -1)
    row, number, tf = np.ascontiguousarray(planes.T).view("<i4").reshape(3, -1)
    return np.cumsum(row), np.cumsum(number), tf


def _shares(key, counts: pa.Table, weights: pa.Table) -> pa.Table:
    """(c, term, share): sums of normalised weights over the rows of a chunk."""
    number = weights.column("number").to_numpy()
    # There is one row of counts; the terms of a chunk come from its counts.
    row, term, tf = _unpacked(counts.column("counts")[0].as_py())
    idf = np.zeros(int(max(term.max(initial=-1), number.max(initial=-1))) + 1)
    idf[number] = weights.column("idf").to_numpy()
    w = tf * idf[term]
    # Rows whose terms all fell out have no length; their shares are 0.
    size = np.sqrt(np.bincount(row, weights=w * w))[row]
    share = np.bincount(term, weights=np.divide(w, size, out=np.zeros(len(w)), where=size > 0), minlength=len(idf))
    return pa.table({"c": weights.column("c"), "term": weights.column("term"), "share": share[number]})


def _first_rows(
    df: DataFrame, cluster: str, key: str, text_col: str, order: Column, n: int
) -> DataFrame:
    """First ``n`` rows per cluster as (cluster, rank, key, text).

    Ranks are found on keys alone, in two steps that no cluster puts into one task;
    the chosen texts are fetched by a join on the key.
    """
    chosen = top_n(df.select(cluster, key), [cluster], [order, F.col(key)], n, F.col(key))
    texts = df.select(key, text_col)
    return texts.join(small_side(chosen), key).select(cluster, "rank", key, text_col)


def cluster_samples(
    df: DataFrame, cluster: str, key: str, text_col: str, n: int = 30, seed: int = SEED
) -> DataFrame:
    """Up to ``n`` seeded sample rows per cluster."""
    return _first_rows(df, cluster, key, text_col, seeded_order(F.col(key), seed), n)


def cluster_heads(
    df: DataFrame, cluster: str, key: str, text_col: str, n: int = 5, noise: int = -1
) -> DataFrame:
    """First ``n`` rows per cluster by key, noise left out."""
    return _first_rows(df.filter(F.col(cluster) != noise), cluster, key, text_col, F.col(key), n)


def cluster_stats(df: DataFrame, cluster: str, noise: int = -1) -> DataFrame:
    """Rows, clusters (noise not counted) and noise rows, from per-cluster counts."""
    sizes = df.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"))
    real = F.col(cluster) != noise
    return sizes.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.count_if(real).alias("n_clusters"),
        F.coalesce(F.sum(F.when(~real, F.col("n"))), F.lit(0)).alias("n_noise"),
    )


def cluster_name(cluster: str, noise: int = -1):
    return F.when(F.col(cluster) == noise, "Noise").otherwise(
        F.concat(F.lit("Cluster "), F.col(cluster).cast("string"))
    )


def cluster_summary(
    df: DataFrame, keywords: DataFrame, cluster: str, text_col: str, shown: int = 5, noise: int = -1
) -> DataFrame:
    """One row per cluster: name, size and its first keywords.

    A cluster whose texts hold no usable word says so; one without any text has
    no keywords at all.
    """
    sizes = df.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("size"), F.count(text_col).alias("_texts")
    )
    first = (
        keywords.filter(F.col("rank") <= shown)
        .groupBy(cluster)
        .agg(F.sort_array(F.collect_list(F.struct("rank", "term"))).alias("_k"))
        .select(cluster, F.array_join(F.transform("_k", lambda k: k["term"]), ", ").alias("_words"))
    )
    fallback = F.when(F.col("_texts") > 0, NO_KEYWORDS).otherwise("")
    return sizes.join(first, cluster, "left").select(
        cluster,
        cluster_name(cluster, noise).alias("name"),
        "size",
        F.coalesce("_words", fallback).alias("top_keywords"),
    )


def cluster_detail(keywords: DataFrame, samples: DataFrame, cluster: str, text_col: str) -> DataFrame:
    """Keywords and sample texts of a cluster side by side, the shorter list padded with null."""
    left = keywords.select(cluster, "rank", F.col("term").alias("top_keyword"))
    right = samples.select(cluster, "rank", F.col(text_col).alias("sample_text"))
    return left.join(right, [cluster, "rank"], "full")
