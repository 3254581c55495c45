"""Training queries for own objectives, with gradient steps in SQL."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from noticelens.operators import classes, evaluate
from noticelens.operators.gradient import Descent, Fit, predict, train
from noticelens.operators.objectives import Objective
from noticelens.plans import inputs as i
from noticelens.plans.labelling import weak_label_ensemble
from noticelens.plans.preparation import SQL_BALANCED_SET, SQL_FOLDS, balanced_dataset
from noticelens.plans.registry import query
from noticelens.session import written


def _sql_log_softmax(cells: str) -> str:
    return (
        f"list_transform({cells}, lambda z: z - list_max({cells}) - "
        f"ln(list_sum(list_transform({cells}, lambda u: exp(u - list_max({cells}))))))"
    )


def sql_training(
    models: str, shape: tuple[int, int], objective: Objective, steps: int, rate: float, own_rows: str = ""
) -> str:
    """CTEs of plain gradient descent over ``rows`` (y, fold, a, b), cells with the 1 of the bias.

    ``models`` selects (k, ws): number and class weights of each model; a row of fold k does
    not count for model k. ``own_rows`` is a further condition on rows and models (as m).
    ``fit`` holds, by step, each model's weights, one list a class, and the objective's value.
    """
    count, cells = shape
    losses, slopes = {
        "focal": (
            f"(1 - pt) ** {objective.gamma} * ce",
            f"((1 - pt) ** {objective.gamma} + {objective.gamma} * (1 - pt) ** {objective.gamma - 1} * pt * ce)"
            " * own * (exp(lp[c]) - CASE WHEN c = y + 1 THEN 1 ELSE 0 END)",
        ),
        "smoothed": (
            f"{1 - objective.smoothing} * ce - list_sum(list_transform(list_zip(lp, ws), lambda z: z[1] * z[2]))"
            f" * {objective.smoothing / count}",
            f"({1 - objective.smoothing} * own + {objective.smoothing / count} * list_sum(ws)) * exp(lp[c])"
            f" - {objective.smoothing / count} * ws[c]"
            f" - CASE WHEN c = y + 1 THEN {1 - objective.smoothing} * own ELSE 0 END",
        ),
    }[objective.loss]
    divisor = "count(*)" if objective.loss == "focal" else "sum(own)"
    two = bool(objective.consistency)
    share = 0.5 if two else 1.0
    zero = f"list_transform(range({count}), lambda c: list_transform(range({cells + 1}), lambda j: 0.0::DOUBLE))"
    parts = [f"models AS MATERIALIZED ({models})", f"w_0 AS MATERIALIZED (SELECT k, ws, {zero} AS w FROM models)"]
    for n in range(steps + 1):
        kl = "list_sum(list_transform(list_zip(lp, lq), lambda z: exp(z[2]) * (z[2] - z[1])))" if two else "0.0"
        views = "SELECT *, a AS x, la AS lp, lb AS lq, 1 AS side FROM p"
        if two:
            views += " UNION ALL SELECT *, b, lb, la, 2 FROM p"
        toward_first = "exp(lp[c]) - exp(lq[c])"
        toward_second = "exp(lp[c]) * ((lp[c] - lq[c]) - kl)"
        slope_kl = f"CASE WHEN side = 1 THEN {toward_first} ELSE {toward_second} END" if two else "0.0"
        parts.append(
            f"""g_{n} AS MATERIALIZED (
      WITH z AS (
        SELECT m.k AS k, ws, y, a, b, ws[y + 1] AS own,
               list_transform(w, lambda v: list_inner_product(v, a)) AS za,
               list_transform(w, lambda v: list_inner_product(v, b)) AS zb
        FROM rows JOIN w_{n} AS m ON rows.fold <> m.k {own_rows}),
      p AS (SELECT *, {_sql_log_softmax('za')} AS la, {_sql_log_softmax('zb')} AS lb FROM z),
      v AS (SELECT *, -own * lp[y + 1] AS ce, exp(own * lp[y + 1]) AS pt FROM ({views})),
      t AS (SELECT *, CASE WHEN side = 1 THEN {kl} ELSE {kl.replace('(lp, lq)', '(lq, lp)')} END AS kl FROM v),
      s AS (
        SELECT k, x, c, {share} * ({slopes}) AS main, {slope_kl} AS other
        FROM t, range(1, {count + 1}) r(c)),
      divisor AS (SELECT k, {divisor} AS main_by, count(*) AS kl_by FROM t WHERE side = 1 GROUP BY k),
      cost AS (SELECT k, sum({share} * ({losses})) AS main, sum(kl) FILTER (side = 1) AS kl FROM t GROUP BY k),
      cell AS (
        SELECT k, c, j, sum(main * x[j]) AS main, sum(other * x[j]) AS other
        FROM s, range(1, {cells + 2}) q(j) GROUP BY k, c, j),
      line AS (
        SELECT k, c, list(main / main_by + {objective.consistency} * other / kl_by ORDER BY j) AS g
        FROM cell JOIN divisor USING (k) GROUP BY k, c)
      SELECT k, main / main_by + {objective.consistency} * kl / kl_by AS value, list(g ORDER BY c) AS g
      FROM line JOIN cost USING (k) JOIN divisor USING (k) GROUP BY k, main, main_by, kl, kl_by)"""
        )
        if n < steps:
            move = f"lambda z: list_transform(list_zip(z[1], z[2]), lambda u: u[1] - {rate} * u[2])"
            parts.append(
                f"w_{n + 1} AS MATERIALIZED (SELECT k, ws, list_transform(list_zip(w, g), {move}) AS w"
                f" FROM w_{n} JOIN g_{n} USING (k))"
            )
    fit = " UNION ALL ".join(f"SELECT {n} AS step, k, value, w FROM w_{n} JOIN g_{n} USING (k)" for n in range(steps + 1))
    return ",\n    ".join([*parts, f"fit AS MATERIALIZED ({fit})"])


SQL_HELD_OUT = """held AS (
      SELECT rows.fold, y AS truth, CAST(list_position(z, list_max(z)) - 1 AS INTEGER) AS pred FROM (
        SELECT rows.fold, y, list_transform(w, lambda v: list_inner_product(v, a)) AS z
        FROM rows JOIN fit ON fit.k = rows.fold AND fit.step = {steps} {own_rows}) AS rows),
    m AS (
      SELECT fold, class, sum(hit) AS hit, sum(seen) AS seen FROM (
        SELECT fold, truth AS class, count(*) AS seen, count(*) FILTER (truth = pred) AS hit FROM held GROUP BY fold, truth
        UNION ALL SELECT fold, pred, count(*), 0 FROM held GROUP BY fold, pred) GROUP BY fold, class),
    per_fold AS (SELECT fold, 2.0 * sum(hit) / sum(seen) AS accuracy, avg(2.0 * hit / seen) AS f1 FROM m GROUP BY fold)"""


def folds_result(fit: Fit, scored: DataFrame, truth: str = "label") -> DataFrame:
    """(fold, accuracy, f1, start_loss, end_loss) of cross-validated models."""
    spark = scored.sparkSession
    metrics = evaluate.classification_metrics(scored, truth, "pred", ["fold"])
    ends = [(k, start, end) for k, (start, end) in enumerate(zip(fit.values[0], fit.values[-1]))]
    losses = spark.createDataFrame(ends, "fold int, start_loss double, end_loss double")
    columns = ("accuracy", "f1", "start_loss", "end_loss")
    return metrics.join(F.broadcast(losses), "fold").select("fold", *[F.round(c, 6).alias(c) for c in columns])


def sql_folds_result(steps: int) -> str:
    return f"""SELECT CAST(fold AS INTEGER) AS fold, round(accuracy, 6) AS accuracy, round(f1, 6) AS f1,
           round(first.value, 6) AS start_loss, round(last.value, 6) AS end_loss
    FROM per_fold JOIN fit AS first ON first.k = fold AND first.step = 0
    JOIN fit AS last ON last.k = fold AND last.step = {steps}"""


def class_weight_list(rows: DataFrame, count: int, label: str = "label", mode: str = "balanced") -> list[float]:
    """Weights by class number, 0 for a class without rows; one row per class comes here."""
    found = {r[label]: r["weight"] for r in classes.class_weights(rows, label, mode).collect()}
    return [found.get(c, 0.0) for c in range(count)]


def _floats(col: Column) -> Column:
    return col.cast("array<double>")


# Own objective: focal loss of two views, held together by their divergence. The second view
# lacks a tenth of the cells, by id and place.
OBJECTIVE = Objective("focal", gamma=2.0, consistency=0.5)
STEPS, RATE, LABELS, CELLS = 6, 0.5, 10, 64
SQL_BALANCED = f"""(SELECT list(coalesce(weight, 0) ORDER BY c) FROM range({LABELS}) t(c) LEFT JOIN (
        SELECT y, sum(n) OVER () / (count(*) OVER () * n) AS weight
        FROM (SELECT y, count(*) AS n FROM rows GROUP BY y)) ON y = c)"""


@query(
    "train_objective",
    f"""WITH rows AS MATERIALIZED (
      SELECT label AS y, -1 AS fold, list_append(embedding::DOUBLE[], 1.0) AS a,
             list_append(list_transform(embedding::DOUBLE[], lambda x, n:
               CASE WHEN (n - 1 + vec_id) % 10 = 0 THEN 0.0::DOUBLE ELSE x / 0.9::DOUBLE END), 1.0) AS b
      FROM embeddings),
    {sql_training(f"SELECT 0 AS k, {SQL_BALANCED} AS ws", (LABELS, CELLS), OBJECTIVE, STEPS, RATE)}
    SELECT CAST(step AS INTEGER) AS step, round(value, 6) AS value,
           round(sqrt(list_sum(list_transform(flatten(w), lambda x: x * x))), 6) AS norm FROM fit""",
)
def train_objective(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Value of the objective and length of the model before each step and after the last."""
    cells = _floats(F.col("embedding"))
    second = F.transform(
        cells, lambda x, n: F.when((n + F.col("vec_id")) % 10 == 0, F.lit(0.0)).otherwise(x / 0.9)
    )
    rows = i.table(spark, sf_dir, "embeddings").select("label", cells.alias("features"), second.alias("second"))
    weights = class_weight_list(rows, LABELS)
    norms: list[float] = []

    class Watched(Descent):
        def move(self, state, step, steps, models, grads):
            norms.append(float((models**2).sum() ** 0.5))
            return super().move(state, step, steps, models, grads)

    fit = train(rows, LABELS, OBJECTIVE, Watched(RATE), STEPS, weights=weights, second="second")
    norms.append(float((fit.models**2).sum() ** 0.5))
    out = [(n, round(v[0], 6), round(norm, 6)) for n, (v, norm) in enumerate(zip(fit.values, norms))]
    return spark.createDataFrame(out, "step int, value double, norm double")


SMOOTHED = Objective("smoothed", smoothing=0.1)


@query(
    "train_folds",
    f"""WITH {SQL_FOLDS}, rows AS MATERIALIZED (
      SELECT embeddings.label AS y, fold, list_append(embedding::DOUBLE[], 1.0) AS a,
             list_append(embedding::DOUBLE[], 1.0) AS b
      FROM embeddings JOIN folds ON id = vec_id),
    {sql_training(f"SELECT k, {SQL_BALANCED} AS ws FROM range(5) f(k)", (LABELS, CELLS), SMOOTHED, STEPS, RATE)},
    {SQL_HELD_OUT.format(steps=STEPS, own_rows="")}
    {sql_folds_result(STEPS)}""",
)
def train_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five models by smoothed, class-weighted cross entropy, one scan a step for all of them."""
    rows = i.table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), "label", _floats(F.col("embedding")).alias("features")
    )
    folded = written(classes.stratified_folds(rows, "id"), "folds")
    weights = class_weight_list(folded, LABELS)
    fit = train(folded, LABELS, SMOOTHED, Descent(RATE), STEPS, folds=5, weights=weights)
    return folds_result(fit, predict(folded, fit, fold="fold"))


# Students of weak labels: common predicted labels only, numbered in sorted order.
LEAST_ROWS, STUDENT_FOLDS = 20, 3
KB_SIZE = len(i.KNOWLEDGE_BASE)


@query(
    "student_folds",
    f"""WITH {i.SQL_VECTORS}, {i.SQL_KEYWORDS}, {i.SQL_KB}, {i.SQL_SCORES}, {i.SQL_ENSEMBLE},
    common AS (
      SELECT *, count(*) OVER (PARTITION BY predicted_label) AS n FROM best JOIN e USING (id)
      WHERE score >= {i.THRESHOLD}),
    numbered AS (
      SELECT id, a AS v, CAST(dense_rank() OVER (ORDER BY predicted_label) - 1 AS INTEGER) AS y
      FROM common WHERE n >= {LEAST_ROWS}),
    rows AS MATERIALIZED (
      SELECT y, list_append(v, 1.0) AS a, list_append(v, 1.0) AS b,
             CAST((row_number() OVER (PARTITION BY y ORDER BY md5('42:' || id), id) - 1) % {STUDENT_FOLDS}
                  AS INTEGER) AS fold
      FROM numbered),
    {sql_training(f"SELECT k, {SQL_BALANCED.replace(f'range({LABELS})', f'range({KB_SIZE})')} AS ws FROM range({STUDENT_FOLDS}) f(k)",
                  (KB_SIZE, CELLS), Objective("focal"), STEPS, RATE)},
    {SQL_HELD_OUT.format(steps=STEPS, own_rows="")}
    {sql_folds_result(STEPS)}""",
)
def student_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weak labels to student: the confident labels of the ensemble, prepared, then all folds."""
    confident = F.col("status").startswith("auto_confirmed")
    weak = weak_label_ensemble(spark, sf_dir).filter(confident).select("id", "predicted_label")
    vecs = i.vectors(spark, sf_dir).select("id", _floats(F.col("vec_a")).alias("vec_a"))
    prepared = classes.prepare_multiclass(vecs.join(weak, "id"), "vec_a", "predicted_label", LEAST_ROWS)
    rows = prepared.select("id", F.col("label_id").alias("label"), F.col("text").alias("features"))
    folded = written(classes.stratified_folds(written(rows, "student"), "id", "label", STUDENT_FOLDS), "folds")
    weights = class_weight_list(folded, KB_SIZE)
    fit = train(folded, KB_SIZE, Objective("focal"), Descent(RATE), STEPS, folds=STUDENT_FOLDS, weights=weights)
    return folds_result(fit, predict(folded, fit, fold="fold"))


# Binary models of the balanced set: counts of words by bucket, weighed by the inverse document
# frequency of the rows that a model is fitted on.
BUCKETS, BINARY_FOLDS = 64, 5


def bucket_counts(rows: DataFrame, text: str, buckets: int = BUCKETS) -> DataFrame:
    """The rows with ``features`` for their text: how many of its words fall into each bucket
    by their md5. Counted where the row lies; only distinct words of a batch are hashed."""
    words = F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}_]{2,})"), F.lit(1))
    table = rows.withColumn("features", words)
    names = table.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column(batch.num_columns - 1)
            distinct = found.flatten().dictionary_encode()
            sums = [hashlib.md5(w.encode()).digest() for w in distinct.dictionary.to_pylist()]
            of_word = np.array([int.from_bytes(s[:2]) % buckets for s in sums], dtype=np.int64)
            sizes = found.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(batch.num_rows), sizes)
            counts = np.bincount(row * buckets + of_word[distinct.indices.to_numpy()], minlength=batch.num_rows * buckets)
            ends = pa.array(np.arange(0, counts.size + 1, buckets, dtype=np.int32))
            cells = pa.ListArray.from_arrays(ends, pa.array(counts.astype(float)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], cells], names=names)

    schema = T.StructType([*rows.schema.fields, T.StructField("features", T.ArrayType(T.DoubleType()))])
    return table.mapInArrow(run, schema)


def fold_scales(rows: DataFrame, folds: int, cells: int) -> np.ndarray:
    """Inverse document frequencies of the cells for each model, without the fold it leaves out.

    One row a fold comes here.
    """
    there = F.transform("features", lambda x: (x > 0).cast("double"))
    counts = rows.groupBy("fold").agg(Summarizer.sum(array_to_vector(there)).alias("df"), F.count(F.lit(1)).alias("n"))
    df, n = np.zeros((folds, cells)), np.zeros((folds, 1))
    for r in counts.collect():
        df[r["fold"]], n[r["fold"]] = r["df"].toArray(), r["n"]
    return np.log((1 + n.sum() - n) / (1 + df.sum(axis=0) - df)) + 1


@query(
    "balanced_folds",
    rf"""WITH balanced AS ({SQL_BALANCED_SET}),
    base AS (
      SELECT service_title AS t, label AS y,
             CAST((row_number() OVER (PARTITION BY label ORDER BY md5('42:' || service_title), service_title) - 1)
                  % {BINARY_FOLDS} AS INTEGER) AS fold,
             list_transform(regexp_extract_all(lower(service_title), '([\p{{L}}\p{{N}}_]{{2,}})', 1),
                            lambda x: CAST('0x' || left(md5(x), 4) AS INTEGER) % {BUCKETS}) AS found
      FROM balanced),
    cell AS (
      SELECT t, y, fold, bucket, len(list_filter(found, lambda x: x = bucket))::DOUBLE AS n
      FROM base, range({BUCKETS}) b(bucket)),
    idf AS (
      SELECT k, bucket, ln((1 + count(*)) / (1 + count(*) FILTER (n > 0))) + 1 AS idf
      FROM cell JOIN range({BINARY_FOLDS}) f(k) ON fold <> k GROUP BY k, bucket),
    rows AS MATERIALIZED (
      SELECT k, t, y, fold, list_append(list(n * idf / CASE WHEN size = 0 THEN 1 ELSE size END ORDER BY bucket), 1.0) AS a,
             a AS b
      FROM (SELECT k, t, y, fold, bucket, n, idf, sqrt(sum(n * idf * n * idf) OVER (PARTITION BY k, t)) AS size
            FROM cell JOIN idf USING (bucket))
      GROUP BY k, t, y, fold),
    {sql_training(f"SELECT k, {SQL_BALANCED.replace(f'range({LABELS})', 'range(2)')} AS ws FROM range({BINARY_FOLDS}) f(k)",
                  (2, BUCKETS), Objective("focal"), STEPS, RATE, "AND rows.k = m.k")},
    {SQL_HELD_OUT.format(steps=STEPS, own_rows="AND rows.k = fit.k")}
    {sql_folds_result(STEPS)}""",
)
def balanced_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balanced set to binary classifier: every model's word weights come from its own rows."""
    rows = balanced_dataset(spark, sf_dir).select("service_title", "label")
    counted = written(bucket_counts(rows, "service_title"), "balanced")
    coded = written(classes.stratified_folds(counted, "service_title", "label", BINARY_FOLDS), "coded")
    scales = fold_scales(coded, BINARY_FOLDS, BUCKETS)
    weights = class_weight_list(coded, 2)
    fit = train(
        coded, 2, Objective("focal"), Descent(RATE), STEPS, folds=BINARY_FOLDS, weights=weights, scales=scales
    )
    return folds_result(fit, predict(coded, fit, fold="fold", scales=scales))
