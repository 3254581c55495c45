"""Probability maps and the decisions taken from them."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from noticelens.fixed_values import (
    MODEL_PROBABILITY,
    RULE_PROBABILITY,
    SCORING_RULES,
    UNCLASSIFIED,
)


def array_cells(col: Column, k: int) -> list[Column]:
    """The first ``k`` cells as doubles; unrolled so the projection stays in codegen."""
    return [F.get(col, F.lit(i)).cast("double") for i in range(k)]


def total(cells: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, cells)


def with_value(value: Column, use: Callable[[Column], Column]) -> Column:
    """Bind a value once for an expression that reads it many times."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def softmax(logits: Column) -> Column:
    """Softmax over an array of logits; null logits give null."""

    def exps(cells: Column) -> Column:
        return with_value(F.array_max(cells), lambda top: F.transform(cells, lambda c: F.exp(c - top)))

    def shares(e: Column) -> Column:
        norm = F.aggregate(e, F.lit(0.0), lambda acc, x: acc + x)
        return with_value(norm, lambda n: F.transform(e, lambda x: x / n))

    return with_value(with_value(logits.cast("array<double>"), exps), shares)


def prob_map(logits: Column, labels: Sequence[str]) -> Column:
    """label -> probability; a failed inference (null logits) is an empty map."""
    probs = F.map_from_arrays(F.array(*[F.lit(x) for x in labels]), softmax(logits))
    return F.coalesce(probs, F.create_map().cast("map<string,double>"))


def best_probability(probs: Column) -> Column:
    return F.array_max(F.map_values(probs))


def best_label(probs: Column) -> Column:
    """The most probable key; the first one wins a tie."""
    at = F.array_position(F.map_values(probs), best_probability(probs))
    return F.get(F.map_keys(probs), (at - 1).cast("int"))


def bid_possibility(probs: Column, empty_score: float = 50.0) -> Column:
    """Confidence of the winning class mapped onto a 0..1 possibility, 2 digits, half even."""
    over = F.greatest(best_probability(probs), F.lit(0.5)) - F.lit(0.5)
    winner = best_label(probs)
    raw = (
        F.when(winner == "LABEL_1", F.lit(0.6) + over * F.lit(0.8))
        .when(winner == "LABEL_0", F.lit(0.6) - over * F.lit(1.2))
        .otherwise(F.lit(0.5))
    )
    clipped = F.least(F.greatest(raw, F.lit(0.0)), F.lit(1.0))
    return F.when(F.size(probs) == 0, F.lit(float(empty_score))).otherwise(F.rint(clipped * 100) / 100)


def bid_category(text: Column, probs: Column) -> Column:
    """Keyword rules on the raw text first, else the model's best label if sure enough."""

    def prob(label: str) -> Column:
        return F.coalesce(F.try_element_at(probs, F.lit(label)), F.lit(0.0))

    decided = None
    for words, tried, default in SCORING_RULES:
        hit = reduce(lambda a, b: a | b, [text.contains(w) for w in words])
        answer = F.lit(default)
        for label in reversed(tried):
            answer = F.when(prob(label) >= RULE_PROBABILITY, F.lit(label)).otherwise(answer)
        decided = F.when(hit, answer) if decided is None else decided.when(hit, answer)
    model = F.when(best_probability(probs) >= MODEL_PROBABILITY, best_label(probs))
    return decided.otherwise(F.coalesce(model, F.lit(UNCLASSIFIED)))
