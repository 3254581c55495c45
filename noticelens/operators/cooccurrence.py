"""Word vectors of a corpus: co-occurrences, positive mutual information, main factors.

``pair_counts`` counts how often two words stand within a window of each other, chunk by
chunk first. ``positive_pmi`` weighs the pairs. ``factors`` finds the main axes of that
symmetric matrix by block power iteration from random vectors: a product with the matrix is a
join on the word and a sum per word, and the columns are made orthonormal from their products,
a matrix of axes x axes, which is all that the driver holds. Vocabulary, pairs and factors stay
tables. ``encode_domain`` gives a text the mean of its words' vectors, at length 1.

Words that pairs are joined on may be very uneven: those joins broadcast a small table of
vectors or spread the pairs over salts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticelens.fixed_values import SEED
from noticelens.functions.text import word_tokens
from noticelens.operators.vectors import to_matrix
from noticelens.session import lookup, written

WINDOW = 5
# Words of a chunk.
CHUNK = 1_000_000
# Axes beyond those asked for, and rounds of the iteration.
SPARE, ROUNDS = 8, 8


def pair_counts(df: DataFrame, text_col: str, window: int = WINDOW) -> DataFrame:
    """(word, other, n): places where ``other`` stands at most ``window`` words from ``word``.

    Both orders of a pair are there; a word may pair with itself. Null texts have no words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            lengths = pc.list_value_length(whole.column(0)).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.diff(np.cumsum(lengths) // CHUNK)) + 1
            for first, last in zip([0, *cuts.tolist()], [*cuts.tolist(), whole.num_rows]):
                words = whole.column(0).slice(first, last - first).flatten().dictionary_encode()
                if not len(words):
                    continue
                code = words.indices.to_numpy().astype(np.int64)
                row = np.repeat(np.arange(last - first), lengths[first:last])
                size, found = len(words.dictionary), []
                for step in range(1, window + 1):
                    near = row[step:] == row[:-step]
                    a, b = code[:-step][near], code[step:][near]
                    found += [a * size + b, b * size + a]
                pair, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [words.dictionary.take(pa.array(pair // size)), words.dictionary.take(pa.array(pair % size)), pa.array(n)],
                    names=["word", "other", "n"],
                )

    tokens = df.filter(F.col(text_col).isNotNull()).select(word_tokens(F.col(text_col)).alias("words"))
    parts = tokens.mapInArrow(run, "word string, other string, n long")
    return parts.groupBy("word", "other").agg(F.sum("n").alias("n"))


def positive_pmi(pairs: DataFrame, least: int = 1) -> DataFrame:
    """(word, other, n, pmi) of pairs that occur at least ``least`` times and more often than by
    chance, ln(n * total / (n of the word * n of the other))."""
    kept = written(pairs.filter(F.col("n") >= least), "pairs")
    words = written(kept.groupBy("word").agg(F.sum("n").alias("own")), "words")
    total = words.agg(F.sum("own").alias("total")).scalar()
    others = words.select(F.col("word").alias("other"), F.col("own").alias("its"))
    both = lookup(lookup(kept, words, ["word"], materialised=True), others, ["other"], materialised=True)
    pmi = F.log(F.col("n").cast("double") * total / (F.col("own").cast("double") * F.col("its")))
    return both.withColumn("pmi", pmi).filter("pmi > 0").select("word", "other", "n", "pmi")


def _times(table: DataFrame, matrix: np.ndarray) -> DataFrame:
    """Rows (word, v) times a small matrix."""
    sent = table.sparkSession.sparkContext.broadcast(matrix)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = to_matrix(batch.column(1), sent.value.shape[0]) @ sent.value
            offsets = pa.array(np.arange(len(out) + 1, dtype=np.int32) * out.shape[1])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, pa.array(out.ravel()))], names=["word", "v"])

    return table.select("word", "v").mapInArrow(run, "word string, v array<double>")


def _products(left: DataFrame, axes: int, right: DataFrame | None = None) -> np.ndarray:
    """Sum over words of the outer products of their vectors; one matrix a task is summed up."""
    both = left.select("word", "v", F.col("v").alias("u")) if right is None else left.join(right.select("word", F.col("v").alias("u")), "word").select("word", "v", "u")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((axes, axes))
        for batch in batches:
            total += to_matrix(batch.column(1), axes).T @ to_matrix(batch.column(2), axes)
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel()], pa.list_(pa.float64()))], names=["m"])

    # Grouped, as a sum over nothing at all is refused.
    parts = both.mapInArrow(run, "m array<double>").groupBy(F.lit("all"))
    found = parts.agg(Summarizer.sum(array_to_vector("m")).alias("m")).first()
    return np.zeros((axes, axes)) if found is None else found["m"].toArray().reshape(axes, axes)


def factors(weights: DataFrame, dims: int, seed: int = SEED, rounds: int = ROUNDS) -> DataFrame:
    """(word, v): the ``dims`` main eigenvectors of the symmetric weights, by largest absolute
    eigenvalue, each scaled by the square root of that value and with its entry of the largest
    size positive. With fewer words than axes the last axes are 0.
    """
    axes = dims + SPARE
    table = written(weights.select("word", "other", F.col("pmi").alias("w")), "weights")
    words = table.select("word").distinct()
    cells = F.transform(
        F.sequence(F.lit(0), F.lit(axes - 1)),
        # Sums of hashed uniform numbers are near enough to normal ones.
        lambda n: sum(F.pmod(F.xxhash64("word", n, F.lit(seed), F.lit(k)), F.lit(2_000_003)) / 2_000_003.0 - 0.5 for k in range(4)),
    )
    block = written(words.select("word", cells.alias("v")), "block")
    for _ in range(rounds):
        block = _orthonormal(_applied(table, block), axes)
    turned = written(_applied(table, block), "turned")
    small = _products(block, axes, turned)
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    order = np.argsort(-np.abs(values), kind="stable")[:dims]
    found = written(_times(block, vectors[:, order] * np.sqrt(np.abs(values[order]))), "factors")
    largest = [F.max_by(F.get("v", F.lit(n)), F.struct(F.abs(F.get("v", F.lit(n))), "word")).alias(f"s{n}") for n in range(dims)]
    tops = found.agg(*largest).first()
    signs = np.diag([1.0 if (t or 0) >= 0 else -1.0 for t in tops])
    return _times(found, signs)


def _applied(table: DataFrame, block: DataFrame) -> DataFrame:
    """The weights times a block of vectors."""
    near = lookup(table, block.select(F.col("word").alias("other"), "v"), ["other"], spread=["word"], materialised=True)
    weighed = near.select("word", F.transform("v", lambda x: x * F.col("w")).alias("v"))
    return weighed.groupBy("word").agg(vector_to_array(Summarizer.sum(array_to_vector("v"))).alias("v"))


def _orthonormal(block: DataFrame, axes: int) -> DataFrame:
    """The block with orthonormal columns that span the same; columns that add nothing are 0."""
    block = written(block, "block")
    for _ in range(2):  # twice is enough against rounding
        values, vectors = np.linalg.eigh(_products(block, axes))
        good = values > max(float(values.max(initial=0.0)), 0.0) * 1e-13
        scale = np.where(good, 1.0 / np.sqrt(np.where(good, values, 1.0)), 0.0)
        block = written(_times(block, vectors * scale), "block")
    return block


def encode_domain(df: DataFrame, text_col: str, key: str, words: DataFrame, dims: int, out: str = "vec_b") -> DataFrame:
    """(key, out): the sum of a text's word vectors at length 1; ``key`` is unique.

    A text without known words, or a null one, has the zero vector.
    """
    tokens = df.select(key, F.explode(word_tokens(F.coalesce(F.col(text_col), F.lit("")))).alias("word"))
    counts = tokens.groupBy(key, "word").agg(F.count(F.lit(1)).alias("n"))
    near = lookup(counts, words, ["word"], spread=[key])
    weighed = near.select(key, F.transform("v", lambda x: x * F.col("n")).alias("v"))
    sums = weighed.groupBy(key).agg(vector_to_array(Summarizer.sum(array_to_vector("v"))).alias("v"))
    size = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    unit = F.transform("v", lambda x: F.when(F.col("size") > 0, x / F.col("size")).otherwise(F.lit(0.0)))
    made = sums.withColumn("size", size).select(key, unit.alias(out))
    zero = F.array_repeat(F.lit(0.0), dims)
    return df.select(key).join(made, key, "left").withColumn(out, F.coalesce(out, zero))
