"""Gradient training of linear softmax models for one's own objectives, all folds at once.

A step is one job: every task adds up the gradients of its rows for all models, sums meet in
two levels, and the driver moves the models. What it holds is bounded by models x classes x
cells, whatever the number of rows. Rows are written once, and each step reads that table
once: a row of fold f counts for every model but the f-th, which never sees it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from noticelens.operators.objectives import Objective, Sums, batch_sums, with_bias
from noticelens.operators.vectors import to_matrix
from noticelens.session import written

# Rows whose logits a task holds at a time.
BATCH = 4_096
# Sums that meet in one task at the first level.
FAN_IN = 64


@dataclass(frozen=True)
class Descent:
    """Plain gradient descent."""

    rate: float = 0.1

    def start(self, shape: tuple[int, ...]) -> dict:
        return {}

    def move(self, state: dict, step: int, steps: int, models: np.ndarray, grads: np.ndarray) -> np.ndarray:
        return models - self.rate * grads


@dataclass(frozen=True)
class AdamW:
    """Adam with decoupled weight decay; the rate rises linearly over ``warmup`` of the steps,
    then falls linearly to 0. Biases do not decay."""

    rate: float = 0.05
    decay: float = 0.01
    betas: tuple[float, float] = (0.9, 0.999)
    warmup: float = 0.1
    floor: float = 1e-8

    def start(self, shape: tuple[int, ...]) -> dict:
        return {"m": np.zeros(shape), "v": np.zeros(shape)}

    def _rate(self, step: int, steps: int) -> float:
        rising = int(steps * self.warmup)
        if step < rising:
            return self.rate * step / rising
        return self.rate * (steps - step) / max(1, steps - rising)

    def move(self, state: dict, step: int, steps: int, models: np.ndarray, grads: np.ndarray) -> np.ndarray:
        state["m"] = self.betas[0] * state["m"] + (1 - self.betas[0]) * grads
        state["v"] = self.betas[1] * state["v"] + (1 - self.betas[1]) * grads**2
        m, v = (state[n] / (1 - b ** (step + 1)) for n, b in zip("mv", self.betas))
        decay = np.full(models.shape, self.decay)
        decay[..., -1] = 0.0
        return models - self._rate(step, steps) * (m / (np.sqrt(v) + self.floor) + decay * models)


@dataclass
class Fit:
    """Models (models x classes x cells + bias) and the objective's value before each step and
    after the last one, one list per step."""

    models: np.ndarray
    values: list[list[float]] = field(default_factory=list)


def _views(batch: pa.RecordBatch, cells: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    first, second = (to_matrix(batch.column(n), cells) for n in range(2))
    y, fold = (batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in (2, 3))
    return first, second, y, fold


def _scaled(x: np.ndarray, scale: np.ndarray | None) -> np.ndarray:
    """Cells weighed by a model's scale, rows then at length 1; a zero row stays zero."""
    if scale is None:
        return x
    x = x * scale
    size = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(size == 0, 1.0, size)


def sums_of(rows: DataFrame, objective: Objective, models: np.ndarray, weights: np.ndarray, scales=None) -> list[Sums]:
    """Sums of every model over (first, second, label, fold); fold -1 counts for all models."""
    count, shape = len(models), models.shape[1:]
    sent = rows.sparkSession.sparkContext.broadcast((models, weights, scales))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models, weights, scales = sent.value
        out = np.zeros((count, 4 + 2 * models[0].size))
        for whole in batches:
            for start in range(0, whole.num_rows, BATCH):
                first, second, y, fold = _views(whole.slice(start, BATCH), shape[1] - 1)
                for k in range(count):
                    used = fold != k
                    if used.any():
                        scale = None if scales is None else scales[k]
                        a, b = _scaled(first[used], scale), _scaled(second[used], scale)
                        out[k] += batch_sums(objective, models[k], a, b, y[used], weights[k]).flat()
        yield pa.RecordBatch.from_arrays(
            [pa.array([TaskContext.get().partitionId()]), pa.array([out.ravel()], pa.list_(pa.float64()))],
            names=["task", "sums"],
        )

    parts = rows.select("first", "second", "label", "fold").mapInArrow(run, "task long, sums array<double>")
    vector = Summarizer.sum(array_to_vector("sums"))
    groups = parts.groupBy(F.floor(F.col("task") / FAN_IN).alias("group")).agg(vector.alias("sums"))
    # Grouped, as a sum over nothing at all is refused.
    found = groups.groupBy(F.lit("all")).agg(Summarizer.sum(F.col("sums")).alias("sums")).first()
    sent.unpersist()
    if found is None:
        return [Sums(0.0, 0.0, 0.0, 0.0, np.zeros(shape), np.zeros(shape)) for _ in range(count)]
    return [Sums.of(flat, shape) for flat in found["sums"].toArray().reshape(count, -1)]


def train(
    rows: DataFrame,
    classes: int,
    objective: Objective = Objective(),
    optimiser: Descent | AdamW = AdamW(),
    steps: int = 30,
    folds: int = 0,
    weights: Sequence[float] | np.ndarray | None = None,
    first: str = "features",
    second: str | None = None,
    label: str = "label",
    fold: str = "fold",
    scales: np.ndarray | None = None,
    penalty: float = 0.0,
) -> Fit:
    """Models from zero: one over all rows, or with ``folds`` one per fold that leaves it out.

    ``weights`` are class weights, of all models or one row a model. ``scales`` (models x
    cells) weigh the cells for each model, which then sees rows of length 1, as inverse
    document frequencies do. ``penalty`` adds penalty / 2 * |w|**2 without biases. Rows
    without a label or features take no part; labels are 0 to classes - 1.
    """
    columns = [F.col(first).alias("first"), F.col(second or first).alias("second")]
    place = F.col(fold) if folds else F.lit(-1)
    table = rows.select(*columns, F.col(label).cast("int").alias("label"), place.cast("int").alias("fold"))
    table = written(table.dropna(), "train")
    sizes = table.agg(F.min(F.size("first")), F.max(F.size("first")), F.min(F.size("second")), F.max(F.size("second")))
    found = set(sizes.first())
    if len(found) > 1:
        raise ValueError("all feature arrays must have one length")
    cells, count = (found.pop() or 0), max(1, folds)
    models = np.zeros((count, classes, cells + 1))
    weights = np.ones(classes) if weights is None else np.asarray(weights, dtype=float)
    weights = np.broadcast_to(weights, (count, classes))
    fit, state = Fit(models), optimiser.start(models.shape)
    for step in range(steps + 1):
        totals = [s.total(objective) for s in sums_of(table, objective, fit.models, weights, scales)]
        inner = fit.models[..., :-1]
        fit.values.append([v + penalty / 2 * float((w * w).sum()) for (v, _), w in zip(totals, inner)])
        if step < steps:
            grads = np.array([g for _, g in totals])
            grads[..., :-1] += penalty * inner
            fit.models = optimiser.move(state, step, steps, fit.models, grads)
    return fit


def predict(
    rows: DataFrame,
    fit: Fit,
    features: str = "features",
    fold: str | None = None,
    out: str = "pred",
    scales: np.ndarray | None = None,
) -> DataFrame:
    """Adds the likeliest class, the first of several, by the one model or by the fold's own.

    Rows without features, or of no fold, get null.
    """
    kept = rows.columns
    names = [*kept, out]
    schema = T.StructType([*rows.schema.fields, T.StructField(out, T.IntegerType())])
    sent = rows.sparkSession.sparkContext.broadcast((fit.models, scales))
    at, where = kept.index(features), kept.index(fold) if fold else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models, scales = sent.value
        for batch in batches:
            there = batch.column(at).is_valid().to_numpy(zero_copy_only=False)
            own = np.zeros(batch.num_rows, dtype=np.int64)
            if where is not None:
                own = np.array([-1 if f is None else f for f in batch.column(where).to_pylist()], dtype=np.int64)
            pred = np.full(batch.num_rows, -1, dtype=np.int32)
            x = to_matrix(batch.column(at), models.shape[2] - 1)
            for k in range(len(models)):
                mine = there & (own == k)
                scale = None if scales is None else scales[k]
                pred[mine] = (with_bias(_scaled(x[mine], scale)) @ models[k].T).argmax(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pred, mask=pred < 0)], names=names)

    return rows.mapInArrow(run, schema)


def dropped_cells(features: str, key: str, rate: float, seed: int = 0):
    """Column: features with cells set to 0 by the hash of key, cell and seed, the others scaled
    up, a second view of a row for the consistency term."""
    def cell(x, n):
        gone = F.pmod(F.xxhash64(F.col(key), n, F.lit(seed)), F.lit(1_000_000)) < int(rate * 1_000_000)
        return F.when(gone, F.lit(0.0)).otherwise(x / (1 - rate))

    return F.transform(F.col(features).cast("array<double>"), cell)
