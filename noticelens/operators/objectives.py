"""Training objectives of linear softmax models, with their gradients over batches.

A batch gives sums, not means, so the sums of all tasks add up: ``main`` counts class-weighted
losses and what they are divided by, ``kl`` the disagreement of two views of a row.

* ``focal``: (1 - pt)**gamma * ce with ce = -w_y log p_y and pt = exp(-ce); mean over rows.
* ``smoothed``: weighted cross entropy with label smoothing; divided by the rows' weights.
* consistency: KL(second || first) of two views, mean over rows, times ``consistency``; the
  main loss is then the mean of both views'.
* adversarial: the main loss once more at x + epsilon * g / |g|, g being the row's gradient
  over its features, held constant, times ``adversarial``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Objective:
    loss: str = "focal"
    gamma: float = 2.0
    smoothing: float = 0.1
    consistency: float = 0.0
    adversarial: float = 0.0
    epsilon: float = 1.0

    def __post_init__(self):
        if self.loss not in ("focal", "smoothed"):
            raise ValueError(f"unknown loss {self.loss}")


@dataclass
class Sums:
    """Sums over rows: losses, their divisors and gradients of one model (classes x cells)."""

    main: float
    main_by: float
    kl: float
    kl_by: float
    main_grad: np.ndarray
    kl_grad: np.ndarray

    def flat(self) -> np.ndarray:
        heads = [self.main, self.main_by, self.kl, self.kl_by]
        return np.concatenate([heads, self.main_grad.ravel(), self.kl_grad.ravel()])

    @classmethod
    def of(cls, flat: np.ndarray, shape: tuple[int, int]) -> Sums:
        size = shape[0] * shape[1]
        grads = flat[4 : 4 + size].reshape(shape), flat[4 + size :].reshape(shape)
        return cls(*(float(x) for x in flat[:4]), *grads)

    def total(self, objective: Objective) -> tuple[float, np.ndarray]:
        """The objective's value and gradient; nothing to divide by gives 0."""
        main, kl = (1.0 / by if by > 0 else 0.0 for by in (self.main_by, self.kl_by))
        value = self.main * main + objective.consistency * self.kl * kl
        return value, self.main_grad * main + objective.consistency * self.kl_grad * kl


def log_softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(axis=1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def with_bias(x: np.ndarray) -> np.ndarray:
    return np.concatenate([x, np.ones((len(x), 1))], axis=1)


def _main(objective: Objective, logp: np.ndarray, y: np.ndarray, weights: np.ndarray):
    """Losses and their gradients over the logits."""
    rows, own, p = np.arange(len(y)), weights[y], np.exp(logp)
    if objective.loss == "focal":
        ce = -own * logp[rows, y]
        pt = np.exp(-ce)
        miss = 1 - pt
        slope = miss**objective.gamma
        if objective.gamma:
            # At pt = 1 the second part has the limit 0 for gamma below 1, too, as ce is 0.
            safe = np.where(miss > 0, miss, 1.0)
            slope = slope + np.where(miss > 0, objective.gamma * safe ** (objective.gamma - 1) * pt * ce, 0.0)
        toward = p.copy()
        toward[rows, y] -= 1
        return miss**objective.gamma * ce, (slope * own)[:, None] * toward
    classes = len(weights)
    target = np.tile(objective.smoothing / classes * weights, (len(y), 1))
    target[rows, y] += (1 - objective.smoothing) * own
    return -(target * logp).sum(axis=1), target.sum(axis=1, keepdims=True) * p - target


def batch_sums(
    objective: Objective,
    model: np.ndarray,
    first: np.ndarray,
    second: np.ndarray,
    y: np.ndarray,
    weights: np.ndarray,
) -> Sums:
    """Sums of one model over rows with two views; the views are the same without consistency."""
    views = [first, second] if objective.consistency else [first]
    share = 1.0 / len(views)
    by = float(len(y)) if objective.loss == "focal" else float(weights[y].sum())
    sums = Sums(0.0, by, 0.0, float(len(y)), np.zeros_like(model), np.zeros_like(model))
    logps = []
    for x in views:
        cells = with_bias(x)
        logp = log_softmax(cells @ model.T)
        losses, slopes = _main(objective, logp, y, weights)
        sums.main += share * losses.sum()
        sums.main_grad += share * (slopes.T @ cells)
        logps.append((logp, cells))
        if objective.adversarial and x is first:
            toward = slopes @ model[:, :-1]
            size = np.linalg.norm(toward, axis=1, keepdims=True)
            moved = with_bias(x + objective.epsilon * toward / (size + 1e-8))
            losses, slopes = _main(objective, log_softmax(moved @ model.T), y, weights)
            sums.main += objective.adversarial * losses.sum()
            sums.main_grad += objective.adversarial * (slopes.T @ moved)
    if objective.consistency:
        (a, cells_a), (b, cells_b) = logps
        p, q = np.exp(a), np.exp(b)
        per_class = q * (b - a)
        rows = per_class.sum(axis=1, keepdims=True)
        sums.kl = float(rows.sum())
        sums.kl_grad = (p - q).T @ cells_a + (per_class - q * rows).T @ cells_b
    return sums
