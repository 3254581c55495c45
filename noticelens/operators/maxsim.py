"""Max-similarity of text vectors to the keyword vectors of each label.

Knowledge base: ``keywords`` has (label_id, keyword_id, one vector column per
channel); ``labels`` has (label_id, label) and may list labels without keywords,
which score 0.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from noticelens.fixed_values import (
    CONFIDENCE_THRESHOLD,
    CONFIRMED,
    CONFIRMED_ENSEMBLE,
    ENSEMBLE_WEIGHTS,
    INPUT_ERROR,
    REVIEW,
    REVIEW_ENSEMBLE,
)
from noticelens.functions.text import keyword_list
from noticelens.operators.vectors import (
    MAX_BLOCK_CELLS,
    blocks,
    column_of,
    map_batches,
    stack,
    to_matrix,
    unit_rows,
)
from noticelens.session import lookup, written


def explode_keywords(kb: DataFrame, null_as_nan: bool = False) -> DataFrame:
    """(label_id, keyword_id, keyword) from the comma lists of a knowledge base."""
    cells = keyword_list(F.col("keywords"), null_as_nan)
    return kb.select(
        F.col("label_id").cast("bigint").alias("label_id"),
        F.posexplode(cells).alias("keyword_id", "keyword"),
    )


def keyword_universe(kb: DataFrame, null_as_nan: bool = False) -> DataFrame:
    """Every keyword once, so that each is encoded once."""
    return explode_keywords(kb, null_as_nan).select("keyword").distinct()


def attach_vectors(kb: DataFrame, keyword_vectors: DataFrame, null_as_nan: bool = False) -> DataFrame:
    """Keyword vectors per label; a keyword without a vector is left out."""
    return explode_keywords(kb, null_as_nan).join(keyword_vectors, "keyword").drop("keyword")


class KeywordBlock(NamedTuple):
    """Keyword vectors sorted by label, with each label's first row.

    Shipped to the tasks as a plain tuple.
    """

    label_ids: np.ndarray
    starts: np.ndarray
    channels: dict[str, np.ndarray]

    @property
    def width(self) -> int:
        return len(next(iter(self.channels.values())))


def _block(rows: list[Row], channels: Sequence[str]) -> KeywordBlock:
    rows = sorted(rows, key=lambda r: (r["label_id"], r["keyword_id"]))
    ids = np.array([r["label_id"] for r in rows], dtype=np.int64)
    label_ids, starts = np.unique(ids, return_index=True)
    return KeywordBlock(label_ids, starts, {c: unit_rows(stack(rows, c)) for c in channels})


def best_per_label(
    batch: pa.RecordBatch, channel: str, keywords: np.ndarray, starts: np.ndarray
) -> np.ndarray:
    """rows x labels: the largest cosine to any keyword of the label.

    Rounded, so that equal vectors tie whatever the shape of the product.
    """
    titles = unit_rows(to_matrix(column_of(batch, channel), keywords.shape[1]))
    return np.round(np.maximum.reduceat(titles @ keywords.T, starts, axis=1), 12)


def _keyword_blocks(
    keywords: DataFrame, channels: Sequence[str], max_cells: int
) -> tuple[int, Iterator[KeywordBlock]]:
    """Blocks in the order of the labels; a label may go on in the next block."""
    table = keywords.select("label_id", "keyword_id", *channels)
    count, pieces = blocks(table, ["label_id", "keyword_id"], channels, max_cells)
    return count, (_block(rows, channels) for rows in pieces)


def _label_table(labels: DataFrame) -> DataFrame:
    return written(labels.select(F.col("label_id").cast("bigint").alias("label_id"), "label"), "maxsim")


def _without_keywords(
    names: DataFrame, keywords: DataFrame, channels: Sequence[str]
) -> DataFrame:
    given = keywords.dropna(subset=list(channels)).select("label_id").distinct()
    return names.join(given, "label_id", "left_anti")


class _Turn(NamedTuple):
    """One block on its way over the titles.

    ``open_id`` is the last label of the block before, whose score is carried along in
    the column ``_open``, since its keywords may go on in this block.
    """

    block: tuple
    open_id: int | None
    last: bool

    def scores(self, batch: pa.RecordBatch, channels: Sequence[str]):
        """(label ids, a matrix per channel, open scores): labels that are complete now,
        and the scores of the last label unless this is the last block."""
        ids, starts, vectors = self.block
        found = [best_per_label(batch, c, vectors[c], starts) for c in channels]
        if self.open_id is not None:
            carried = to_matrix(column_of(batch, "_open"), len(channels))
            if ids[0] == self.open_id:
                for n, scores in enumerate(found):
                    scores[:, 0] = np.maximum(scores[:, 0], carried[:, n])
            else:
                ids = np.insert(ids, 0, self.open_id)
                found = [np.insert(s, 0, carried[:, n], axis=1) for n, s in enumerate(found)]
        if self.last:
            return ids, found, None
        return ids[:-1], [s[:, :-1] for s in found], np.stack([s[:, -1] for s in found], axis=1)


def _lists(rows: np.ndarray) -> pa.Array:
    offsets = pa.array(np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32)[: len(rows) + 1])
    return pa.ListArray.from_arrays(offsets, pa.array(rows.ravel()))


_OPEN = T.StructField("_open", T.ArrayType(T.DoubleType()))


def _over_blocks(df, keywords, channels, max_cells, state, work) -> DataFrame | None:
    """Send the keyword blocks over the titles, one after the other; none gives None.

    ``state`` are the columns that ``work(turn, batch)`` computes from the turn and from
    their values so far (absent in the first turn). The titles keep their rows, whatever
    their ids, and drop the channels at the end.
    """
    count, pieces = _keyword_blocks(keywords, channels, max_cells)
    sc = df.sparkSession.sparkContext
    open_id, rows = None, None
    for n, piece in enumerate(pieces):
        last = n == count - 1
        shared = sc.broadcast(tuple(_Turn(tuple(piece), open_id, last)))
        before = [] if rows is None else [f.name for f in state] + ["_open"]
        added = list(state) + ([] if last else [_OPEN])

        def run(batch, shared=shared):
            return work(_Turn(*shared.value), batch)

        replaced = [*before, *(channels if last else [])]
        rows = map_batches(df if rows is None else rows, replaced, added, run, piece.width)
        if not last:
            rows = written(rows, "turn")
            shared.unpersist()
        open_id = int(piece.label_ids[-1])
    return rows


def score_labels(
    df: DataFrame,
    keywords: DataFrame,
    channels: Sequence[str],
    max_cells: int = MAX_BLOCK_CELLS,
    id_col: str = "id",
) -> DataFrame:
    """Long score table (id, label_id, one score per channel) of labels with keywords.

    Every title has one row per label, also when its id is null or repeated.
    """
    df = df.select(id_col, *channels)
    names = ["_labels", *(f"_{c}" for c in channels)]
    state = [T.StructField("_labels", T.ArrayType(T.LongType()))]
    state += [T.StructField(f"_{c}", T.ArrayType(T.DoubleType())) for c in channels]

    def work(turn, batch):
        ids, found, carried = turn.scores(batch, channels)
        columns = [np.tile(ids, (batch.num_rows, 1)), *found]
        if turn.open_id is not None:
            width = len(column_of(batch, "_labels")[0]) if batch.num_rows else 0
            sofar = [column_of(batch, c).flatten().to_numpy().reshape(batch.num_rows, width) for c in names]
            columns = [np.hstack(pair) for pair in zip(sofar, columns)]
        out = [_lists(c) if c.size else pa.array([[]] * batch.num_rows, t) for c, t in zip(columns, _types(channels))]
        return out + ([] if carried is None else [_lists(carried)])

    rows = _over_blocks(df, keywords, channels, max_cells, state, work)
    if rows is None:
        schema = T.StructType(
            [df.schema[id_col], T.StructField("label_id", T.LongType())]
            + [T.StructField(c, T.DoubleType()) for c in channels]
        )
        return df.sparkSession.createDataFrame([], schema)
    return rows.select(id_col, F.explode(F.arrays_zip(*names)).alias("_s")).select(
        id_col, F.col("_s._labels").alias("label_id"), *[F.col(f"_s._{c}").alias(c) for c in channels]
    )


def _types(channels: Sequence[str]) -> list[pa.DataType]:
    return [pa.list_(pa.int64()), *[pa.list_(pa.float64())] * len(channels)]


def maxsim(
    df: DataFrame,
    keywords: DataFrame,
    labels: DataFrame,
    channel: str,
    max_cells: int = MAX_BLOCK_CELLS,
    id_col: str = "id",
) -> DataFrame:
    """(id, label, score) for every label; a label without keywords scores 0."""
    scored = score_labels(df, keywords, [channel], max_cells, id_col)
    names = _label_table(labels)
    rows = lookup(scored, names, ["label_id"]).select(
        id_col, "label", F.col(channel).alias("score")
    )
    # One array of label names, repeated per title like the score table itself.
    empty = _without_keywords(names, keywords, [channel]).agg(F.collect_list("label")).scalar()
    zeros = df.withColumn("_empty", empty).select(
        id_col, F.explode("_empty").alias("label"), F.lit(0.0).alias("score")
    )
    return rows.unionByName(zeros)


def ensemble_label(
    df: DataFrame,
    keywords: DataFrame,
    labels: DataFrame,
    channels: Sequence[str] = ("vec_a", "vec_b"),
    weights: Sequence[float] = ENSEMBLE_WEIGHTS,
    threshold: float = CONFIDENCE_THRESHOLD,
    max_cells: int = MAX_BLOCK_CELLS,
    id_col: str = "id",
) -> DataFrame:
    """Label, ensemble score, per-channel best scores and status per title.

    The winner is the label with the best weighted score, the smallest label_id
    among equals. The channel scores are each channel's own best over all labels,
    not the winner's. The score matrix is reduced inside each Arrow batch. A row
    without vectors gets no label and no scores.
    """
    names = _label_table(labels)
    # Labels without keywords all score 0 and only the first of them can win.
    first_empty = _without_keywords(names, keywords, channels).agg(F.min("label_id")).first()[0]

    def work(turn, batch):
        given = np.ones(batch.num_rows, dtype=bool)
        for c in channels:
            given &= column_of(batch, c).is_valid().to_numpy(zero_copy_only=False)
        part = batch.filter(pa.array(given))
        ids, (a, b), carried = turn.scores(part, channels) if part.num_rows else _nothing(channels)
        if turn.open_id is None:
            # Before any label: nothing, or the first label without keywords.
            number = -1 if first_empty is None else first_empty
            score = -np.inf if first_empty is None else 0.0
            best = [np.full(part.num_rows, x) for x in (number, score, score, score)]
        else:
            best = [column_of(part, f.name).to_numpy(zero_copy_only=False).copy() for f in _BEST]
        if len(ids):
            both = np.round(weights[0] * a + weights[1] * b, 12)
            at = both.argmax(axis=1)
            score, number = both[np.arange(len(both)), at], ids[at]
            wins = (score > best[1]) | ((score == best[1]) & (number < best[0]))
            best[0], best[1] = np.where(wins, number, best[0]), np.where(wins, score, best[1])
            best[2], best[3] = np.maximum(best[2], a.max(axis=1)), np.maximum(best[3], b.max(axis=1))
        # Put the results back among the rows without vectors.
        slot = pa.array(np.cumsum(given) - 1, mask=~given)
        columns = [pa.array(best[0].astype(np.int64)), *map(pa.array, best[1:])]
        if not turn.last:
            columns.append(_lists(carried) if len(carried) else pa.array([], pa.list_(pa.float64())))
        return [x.take(slot) for x in columns]

    best = _over_blocks(df, keywords, channels, max_cells, _BEST, work)
    if best is None:
        # No keyword vector at all: with vectors, the first label scores 0.
        has_vectors = reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in channels])
        values = [F.lit(first_empty), *[F.lit(0.0)] * 3]
        best = df.withColumns(
            {f.name: F.when(has_vectors, v).cast(f.dataType) for f, v in zip(_BEST, values)}
        ).drop(*channels)
    found = lookup(best, names, ["label_id"], "left")
    status = F.when(F.col("final_ensemble_score") >= threshold, CONFIRMED_ENSEMBLE).otherwise(
        REVIEW_ENSEMBLE
    )
    return found.withColumn("status", status).withColumnRenamed("label", "predicted_label").drop(
        "label_id"
    )


_BEST = [
    T.StructField("label_id", T.LongType()),
    T.StructField("final_ensemble_score", T.DoubleType()),
    T.StructField("score_a", T.DoubleType()),
    T.StructField("score_b", T.DoubleType()),
]


def _nothing(channels: Sequence[str]):
    """Scores of a batch without any vectors."""
    none = np.zeros((0, 0))
    return np.zeros(0, dtype=np.int64), [none] * len(channels), np.zeros((0, len(channels)))


def top_labels(
    df: DataFrame,
    label_vectors: DataFrame,
    n: int,
    vec_col: str = "embedding",
    later_first: bool = True,
    max_cells: int = MAX_BLOCK_CELLS,
    id_col: str = "id",
) -> DataFrame:
    """Adds ``top``: the n most similar labels as array<struct(score, label_id, label, line)>.

    Among equal scores the later label comes first, or the earlier one on request.
    ``label_vectors`` holds label_id, label, a vector column and optionally ``line``.
    """
    if "line" not in label_vectors.columns:
        label_vectors = label_vectors.withColumn("line", F.lit(None).cast("string"))
    rows = label_vectors.select("label_id", "label", "line", F.col(vec_col).alias("vec"))
    sc = df.sparkSession.sparkContext
    entry = T.StructType(
        [
            T.StructField("score", T.DoubleType()),
            T.StructField("label_id", T.LongType()),
            T.StructField("label", T.StringType()),
            T.StructField("line", T.StringType()),
        ]
    )
    sign = -1 if later_first else 1
    names = ("score", "label_id", "label", "line")
    arrow = pa.list_(
        pa.struct([("score", pa.float64()), ("label_id", pa.int64()), ("label", pa.string()), ("line", pa.string())])
    )
    state = [T.StructField("top", T.ArrayType(entry))]
    count, pieces = blocks(rows, ["label_id"], ["vec"], max_cells)
    out = None
    for turn, piece in enumerate(pieces):
        last = turn == count - 1
        piece = sorted(piece, key=lambda r: sign * r["label_id"])
        texts = [(r["label_id"], r["label"], r["line"]) for r in piece]
        shared = sc.broadcast((texts, unit_rows(stack(piece, "vec"))))

        def work(batch, shared=shared, first=out is None):
            texts, vectors = shared.value
            scores = unit_rows(to_matrix(column_of(batch, vec_col), vectors.shape[1])) @ vectors.T
            # Rounded, so that equal vectors tie whatever the batch shape.
            scores = np.round(scores, 12)
            order = np.argsort(-scores, axis=1, kind="stable")[:, :n]
            top = [[dict(zip(names, (s[j], *texts[j]))) for j in at] for s, at in zip(scores, order)]
            if not first:
                sofar = column_of(batch, "top").to_pylist()
                top = [
                    sorted(a + b, key=lambda e: (-e["score"], sign * e["label_id"]))[:n]
                    for a, b in zip(sofar, top)
                ]
            return [pa.array(top, type=arrow)]

        replaced = ([] if out is None else ["top"]) + ([vec_col] if last else [])
        out = map_batches(df if out is None else out, replaced, state, work, len(piece))
        if not last:
            out = written(out, "turn")
            shared.unpersist()
    if out is None:
        return df.drop(vec_col).withColumn("top", F.array().cast(T.ArrayType(entry)))
    return out


def nearest_label(
    df: DataFrame,
    label_vectors: DataFrame,
    title: Column,
    threshold: float = CONFIDENCE_THRESHOLD,
    vec_col: str = "embedding",
    max_cells: int = MAX_BLOCK_CELLS,
    id_col: str = "id",
) -> DataFrame:
    """Single-channel nearest label with its score and status; an empty title is an input error."""
    df = df.withColumn("_ok", F.coalesce(title != "", F.lit(False)))
    top = top_labels(df, label_vectors, 1, vec_col, False, max_cells, id_col)
    first, ok = F.get("top", F.lit(0)), F.col("_ok")
    score = F.when(ok, first["score"]).otherwise(0.0)
    return top.select(
        *[c for c in top.columns if c not in ("top", "_ok")],
        F.when(ok, first["label"]).otherwise(INPUT_ERROR).alias("predicted_label"),
        score.alias("score"),
        F.when(~ok, INPUT_ERROR)
        .when(score >= threshold, CONFIRMED)
        .otherwise(REVIEW)
        .alias("status"),
    )
