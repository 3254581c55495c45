"""Quality classifier: histogram gradient-boosted trees over document statistics.

A bounded sample of labelled rows is measured on the executors, the trees are grown
from its binned statistics, and all of them are flattened into four arrays. Scoring is
one pass without a shuffle: every whole text is measured and the arrays are walked for
a batch of documents at once.

Defined cases: a null text is an empty one, and empty texts get a score like any other;
repeated rows are scored alike; a document with several labels learns from their mean,
null labels are ignored; without labelled rows every score is 0.5; an empty table gives
an empty result; other columns are neither read nor harmed.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticelens.llm.common import id_remainder, strings, utf8

# Bound of the labelled sample that is fitted: about so many rows, picked by a hash of the id.
SAMPLE_ROWS = 40_000
TREES, DEPTH, BINS, RATE, RIDGE = 60, 4, 64, 0.2, 1.0
THRESHOLD = 0.3

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGIT = bytes(range(48, 58))
_ENDS = b".,;:?"
_MARKS = b"#$%&*"
_HIGH = bytes(range(128, 256))
_OTHER = bytes(set(range(33, 127)) - set(_UPPER + _LOWER + _DIGIT + _ENDS + _MARKS + b"!|"))
_CLASSES = (_UPPER, _LOWER, _DIGIT, _ENDS, _MARKS, _HIGH, _OTHER, b"!", b"|", b"\n")

FEATURES = (
    "log_words",
    "word_length",
    "distinct_words",
    "repeated_neighbours",
    "distinct_lines",
    "words_per_line",
    "short_words",
    *(f"class_{n}" for n in range(len(_CLASSES))),
)


def measure(text: str) -> list[float]:
    """Statistics of one whole text, in the order of ``FEATURES``."""
    data = utf8(text)
    words = data.lower().split()
    n, size = max(len(words), 1), max(len(data), 1)
    lines = data.split(b"\n")
    distinct = set(words)
    return [
        float(np.log1p(len(words))),
        sum(map(len, words)) / n,
        len(distinct) / n,
        sum(map(operator.eq, words, words[1:])) / n,
        len(set(lines)) / len(lines),
        len(words) / len(lines),
        sum(len(w) < 4 for w in distinct) / max(len(distinct), 1),
        *((len(data) - len(data.translate(None, c))) / size for c in _CLASSES),
    ]


def measures(column: pa.Array) -> np.ndarray:
    rows = [measure(text) for text in strings(column)]
    return np.array(rows, dtype=np.float64).reshape(len(rows), len(FEATURES))


@dataclass(frozen=True)
class Forest:
    """Complete trees as arrays (tree, node); node i has children 2i+1 and 2i+2."""

    base: float
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray

    def score(self, rows: np.ndarray) -> np.ndarray:
        margin = np.full(len(rows), self.base)
        every = np.arange(len(rows))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
            node = np.zeros(len(rows), dtype=np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (rows[every, feature[node]] > cut[node])
            margin += leaf[node - (2**DEPTH - 1)]
        return 1 / (1 + np.exp(-margin))


def _grow(bins: np.ndarray, cuts: np.ndarray, gradient: np.ndarray, curvature: np.ndarray):
    """One tree, level by level, from histograms of gradient and curvature per node and bin."""
    inner = 2**DEPTH - 1
    feature, cut = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
    node = np.zeros(len(bins), dtype=np.int64)
    for level in range(DEPTH):
        first, width = 2**level - 1, 2**level
        best_gain, best = np.full(width, 1e-6), np.full((width, 2), -1)
        for f in range(bins.shape[1]):
            at = (node - first) * BINS + bins[:, f]
            g = np.bincount(at, gradient, width * BINS).reshape(width, BINS).cumsum(1)
            h = np.bincount(at, curvature, width * BINS).reshape(width, BINS).cumsum(1)
            g_all, h_all = g[:, -1:], h[:, -1:]
            gain = (
                g**2 / (h + RIDGE)
                + (g_all - g) ** 2 / (h_all - h + RIDGE)
                - g_all**2 / (h_all + RIDGE)
            )[:, :-1]
            gain[(h[:, :-1] < 1e-3) | (h_all - h[:, :-1] < 1e-3)] = 0
            at_bin = gain.argmax(1)
            gains = gain[np.arange(width), at_bin]
            better = gains > best_gain
            best_gain[better] = gains[better]
            best[better, 0], best[better, 1] = f, at_bin[better]
        for k in range(width):
            if best[k, 0] >= 0:
                feature[first + k], cut[first + k] = best[k, 0], cuts[best[k, 0], best[k, 1]]
        chosen = feature[node]
        split = np.where(best[:, 0] >= 0, best[:, 1], BINS)[node - first]
        node = 2 * node + 1 + (bins[np.arange(len(bins)), chosen] > split)
    at = node - inner
    g = np.bincount(at, gradient, 2**DEPTH)
    h = np.bincount(at, curvature, 2**DEPTH)
    leaf = -RATE * g / (h + RIDGE)
    return feature, cut, leaf, leaf[at]


def fit_forest(rows: np.ndarray, target: np.ndarray) -> Forest:
    """Boost on binned statistics with the logistic loss; ``target`` is in 0..1."""
    if not len(rows):
        shape = (0, 2**DEPTH - 1)
        return Forest(0.0, np.zeros(shape, dtype=np.int64), np.zeros(shape), np.zeros((0, 2**DEPTH)))
    cuts = np.quantile(rows, np.linspace(0, 1, BINS + 1)[1:-1], axis=0, method="lower").T
    cuts = np.hstack([cuts, np.full((len(cuts), 1), np.inf)])
    bins = np.stack(
        [np.searchsorted(c[:-1], column, side="left") for c, column in zip(cuts, rows.T)], axis=1
    )
    mean = np.clip(target.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(mean / (1 - mean)))
    margin, trees = np.full(len(rows), base), []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        *tree, step = _grow(bins, cuts, p - target, np.maximum(p * (1 - p), 1e-9))
        margin += step
        trees.append(tree)
    return Forest(base, *(np.stack(part) for part in zip(*trees)))


def labelled_sample(
    labels: DataFrame, id_col: str, label_col: str, sample_rows: int = SAMPLE_ROWS
) -> DataFrame:
    """(id, target) of the rows that may teach; about ``sample_rows`` of them by hash."""
    rows = (
        labels.filter((id_remainder(id_col) != 0) & F.col(label_col).isNotNull())
        .groupBy(F.col(id_col).alias("_id"))
        .agg(F.avg(F.col(label_col).cast("double")).alias("_target"))
        .filter(F.col("_id").isNotNull())
    )
    share = min(1.0, sample_rows / max(rows.count(), 1))
    return rows.filter(F.pmod(F.xxhash64("_id"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
) -> Forest:
    """Fit on labelled rows whose id does not fall into the held-out fold (remainder 0).

    The sample is the only thing broadcast and collected: ``sample_rows`` rows of
    ``len(FEATURES) + 1`` numbers, whatever the size of the tables.
    """
    sample = F.broadcast(labelled_sample(labels, id_col, label_col, sample_rows))
    chosen = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(
        sample, "_id"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = measures(batch.column(1))
            columns = [batch.column(0), *(pa.array(rows[:, n]) for n in range(rows.shape[1]))]
            columns.append(batch.column(2))
            yield pa.RecordBatch.from_arrays(columns, names=["_id", *FEATURES, "_target"])

    id_type = chosen.schema["_id"].dataType.simpleString()
    schema = f"_id {id_type}, " + ", ".join(f"{f} double" for f in FEATURES) + ", _target double"
    table = chosen.mapInArrow(run, schema).toPandas().sort_values(["_id", *FEATURES])
    return fit_forest(table[list(FEATURES)].to_numpy(float), table["_target"].to_numpy(float))


def score(
    docs: DataFrame, forest: Forest, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, score) of every row, from its whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = forest.score(measures(batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores)], names=["_id", "score"]
            )

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    id_type = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"_id {id_type}, score double").withColumnRenamed("_id", id_col)


def keep(
    docs: DataFrame, forest: Forest, text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """The rows whose text scores at least ``threshold``, with all their columns."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(forest.score(measures(batch.column(at))) >= threshold))

    return docs.mapInArrow(run, docs.schema)
