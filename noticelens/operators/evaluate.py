"""Metrics and losses over prediction tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from noticelens.functions.scoring import array_cells, total


def classification_metrics(
    df: DataFrame, truth: str, pred: str, by: Sequence[str] = ()
) -> DataFrame:
    """Accuracy and macro F1 over the classes seen in truth or prediction.

    One pass counts (truth, pred) pairs; everything after works on that table of
    at most classes squared rows per group.
    """
    by = list(by)
    pairs = df.groupBy(*by, F.col(truth).alias("t"), F.col(pred).alias("p")).agg(
        F.count(F.lit(1)).alias("n")
    )
    hit = F.when(F.col("t") == F.col("p"), F.col("n")).otherwise(0)
    sides = F.array(
        F.struct(F.col("t").alias("class"), F.col("n").alias("seen"), hit.alias("hit")),
        F.struct(F.col("p").alias("class"), F.col("n").alias("seen"), F.lit(0).cast("long").alias("hit")),
    )
    classes = (
        pairs.select(*by, F.explode(sides).alias("s"))
        .groupBy(*by, "s.class")
        .agg(F.sum("s.seen").alias("seen"), F.sum("s.hit").alias("hit"))
    )
    # 2tp / (2tp + fp + fn); truth and prediction counts add up to the divisor.
    f1 = F.avg(2.0 * F.col("hit") / F.col("seen"))
    accuracy = 2.0 * F.sum("hit") / F.sum("seen")
    return classes.groupBy(*by).agg(accuracy.alias("accuracy"), f1.alias("f1"))


def fold_summary(metrics: DataFrame, fold: str = "fold") -> DataFrame:
    """Mean accuracy, mean and population deviation of F1, and the earliest best fold."""
    return metrics.agg(
        F.avg("accuracy").alias("mean_accuracy"),
        F.avg("f1").alias("mean_f1"),
        F.stddev_pop("f1").alias("std_f1"),
        F.max_by(fold, F.struct("f1", -F.col(fold))).alias("best_fold"),
    )


class Logits:
    """Logits of ``k`` classes as unrolled columns of one frame.

    ``attach`` adds the log partition as a column of its own, so later expressions
    refer to it instead of repeating it.
    """

    def __init__(self, col: str, k: int, temperature: float = 1.0):
        self.col, self.k, self.temperature = col, k, temperature
        self.partition = f"_lse_{col}_{str(temperature).replace('.', '_')}"

    def cells(self) -> list[Column]:
        return [c / self.temperature for c in array_cells(F.col(self.col), self.k)]

    def attach(self, df: DataFrame) -> DataFrame:
        cells = self.cells()
        top = F.greatest(*cells)
        return df.withColumn(self.partition, F.log(total([F.exp(c - top) for c in cells])) + top)

    def log_probs(self) -> list[Column]:
        return [c - F.col(self.partition) for c in self.cells()]

    def log_prob_of(self, label: Column) -> Column:
        picked = F.get(F.col(self.col), label.cast("int")).cast("double") / self.temperature
        return picked - F.col(self.partition)


def cross_entropy(logits: Logits, label: Column, weight: Column | float = 1.0) -> Column:
    weight = F.lit(weight) if isinstance(weight, (int, float)) else weight
    return -weight * logits.log_prob_of(label)


def focal_loss(
    logits: Logits, label: Column, weight: Column | float = 1.0, gamma: float = 2.0
) -> Column:
    """Per-row focal loss; the class weight sits inside pt = exp(-weighted ce)."""
    ce = cross_entropy(logits, label, weight)
    return F.pow(1 - F.exp(-ce), F.lit(gamma)) * ce


def reduce_loss(df: DataFrame, loss: Column, reduction: str = "mean", out: str = "loss") -> DataFrame:
    """mean, sum, or none (a per-row column)."""
    if reduction == "none":
        return df.withColumn(out, loss)
    return df.agg({"mean": F.avg, "sum": F.sum}[reduction](loss).alias(out))


def smoothed_ce_parts(
    logits: Logits, label: Column, weights: Sequence[Column | float], epsilon: float = 0.1
) -> tuple[Column, Column]:
    """Numerator and divisor per row of the class-weighted, label-smoothed cross entropy.

    The reported loss is sum(numerator) / sum(divisor).
    """
    weights = [F.lit(float(w)) if isinstance(w, (int, float)) else w for w in weights]
    own = F.get(F.array(*weights), label.cast("int"))
    hard = -own * logits.log_prob_of(label)
    spread = total([-w * lp for w, lp in zip(weights, logits.log_probs())]) / logits.k
    return (1 - epsilon) * hard + epsilon * spread, own


def kl_divergence(target: Logits, estimate: Logits) -> Column:
    """Sum over classes of p_target * (ln p_target - ln p_estimate)."""
    pairs = zip(target.log_probs(), estimate.log_probs())
    return total([F.exp(t) * (t - e) for t, e in pairs])


def combined_objective(
    first: Logits, second: Logits, label: Column, weight: Column | float = 1.0,
    gamma: float = 2.0, kl_weight: float = 0.5,
) -> Column:
    """Mean of two focal losses plus the weighted consistency divergence of the passes, per row."""
    focal = (focal_loss(first, label, weight, gamma) + focal_loss(second, label, weight, gamma)) / 2
    return focal + kl_weight * kl_divergence(second, first)


def distill_loss(
    student: str, teacher: str, label: str, k: int, df: DataFrame,
    temperature: float = 2.0, alpha: float = 0.5,
) -> DataFrame:
    """One row: hard loss, softened divergence times T squared, and their blend."""
    plain = Logits(student, k)
    soft, target = Logits(student, k, temperature), Logits(teacher, k, temperature)
    for logits in (plain, soft, target):
        df = logits.attach(df)
    sums = df.agg(
        F.avg(cross_entropy(plain, F.col(label))).alias("ce"),
        (F.avg(kl_divergence(target, soft)) * temperature**2).alias("kl"),
    )
    return sums.withColumn("loss", alpha * F.col("ce") + (1 - alpha) * F.col("kl"))


def strategy_report(runs: DataFrame) -> DataFrame:
    """Long run records (strategy, metric, value) to one ranked row per strategy.

    Metrics are f1, size_mb and speed_ms; the rank is by f1 per millisecond.
    """
    wide = runs.groupBy("strategy").pivot("metric", ["f1", "size_mb", "speed_ms"]).agg(F.avg("value"))
    ratio = F.try_divide("f1", "speed_ms")
    # One row per strategy.
    order = W.orderBy(F.desc("f1_per_ms"), "strategy")
    return wide.withColumn("f1_per_ms", F.round(ratio, 6)).withColumn("rank", F.row_number().over(order))


def markdown(df: DataFrame, max_rows: int) -> str:
    """A report frame of up to ``max_rows`` rows as a markdown table."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"more than {max_rows} rows: write the frame instead")
    lines = ["| " + " | ".join(df.columns) + " |", "|" + " --- |" * len(df.columns)]
    lines += ["| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in rows]
    return "\n".join(lines)
