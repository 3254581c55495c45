"""Scoring, metrics, losses and training queries."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticelens.fixed_values import MODEL_PROBABILITY, RULE_PROBABILITY, SCORING_RULES
from noticelens.functions.scoring import array_cells
from noticelens.operators import classes, encoders, evaluate, maxsim, train
from noticelens.operators.score import score_batch
from noticelens.plans import inputs as i
from noticelens.plans.labelling import SQL_NEAREST, nearest
from noticelens.plans.preparation import SQL_FOLDS
from noticelens.plans.registry import query
from noticelens.session import shared_path, written
from noticelens.streaming.scoring import read_batches, score_batches, score_stream

MULTI, BINARY = len(i.SCORED_LABELS), 2


def requests(embeddings: DataFrame) -> DataFrame:
    """Scoring requests: a title phrase and the logits of both models.

    Every 11th inference failed and has no logits; every 4th is a sharp one.
    """
    key = F.col("vec_id")
    ok = key % 11 != 0
    sharp = F.when(key % 4 == 0, 3.0).otherwise(1.0)
    rows = embeddings.select(
        key.alias("id"),
        i.phrase("vec_id").alias("text"),
        i.logits("b", BINARY),
        i.logits("m", MULTI),
        ok.alias("ok"),
        sharp.alias("sharp"),
    )
    return rows.select(
        "id",
        "text",
        F.when(F.col("ok"), F.transform("b", lambda x: x * F.col("sharp"))).alias("binary_logits"),
        F.when(F.col("ok"), F.transform("m", lambda x: x * F.col("sharp"))).alias("multi_logits"),
    )


def _sql_category() -> str:
    cases = []
    for words, tried, default in SCORING_RULES:
        hit = " OR ".join(f"contains(text, '{w}')" for w in words)
        tests = "".join(
            f" WHEN coalesce(m[{i.SCORED_LABELS.index(t) + 1}], 0) >= {RULE_PROBABILITY} THEN '{t}'"
            for t in tried
        )
        cases.append(f"WHEN {hit} THEN " + (f"CASE{tests} ELSE '{default}' END" if tests else f"'{default}'"))
    best = i.sql_pick(i.SCORED_LABELS, "list_position(m, list_max(m)) - 1")
    return (
        f"CASE {' '.join(cases)} WHEN list_max(m) >= {MODEL_PROBABILITY} THEN {best} ELSE 'unclassified' END"
    )


def _sql_softmax(cells: str) -> str:
    exps = f"list_transform({cells}, lambda x: exp(x * sharp - list_max({cells}) * sharp))"
    return f"list_transform({exps}, lambda p: p / list_sum({exps}))"


SQL_SCORE = f"""WITH r AS (
      SELECT vec_id AS id, {i.sql_phrase('vec_id')} AS text, vec_id % 11 <> 0 AS ok,
             CASE WHEN vec_id % 4 = 0 THEN 3.0::DOUBLE ELSE 1.0::DOUBLE END AS sharp,
             {i.sql_logits(BINARY)} AS bl, {i.sql_logits(MULTI)} AS ml FROM embeddings),
    s AS (SELECT id, text, CASE WHEN ok THEN {_sql_softmax('bl')} END AS b,
                 CASE WHEN ok THEN {_sql_softmax('ml')} END AS m FROM r),
    t AS (SELECT *, greatest(list_max(b), 0.5) - 0.5 AS o FROM s)
    SELECT CAST(id AS VARCHAR) AS original_id,
           CASE WHEN b IS NULL THEN 50.0::DOUBLE
                WHEN b[2] > b[1] THEN round_even(least(0.6 + 0.8 * o, 1.0) * 100, 0) / 100
                ELSE round_even(greatest(0.6 - 1.2 * o, 0.0) * 100, 0) / 100 END AS possibility,
           {_sql_category()} AS category FROM t"""


@query("score_batch", SQL_SCORE)
def batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_batch(requests(i.table(spark, sf_dir, "embeddings")), i.SCORED_LABELS)


@query("score_stream", SQL_SCORE)
def stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, checkpoint = shared_path(spark, "scored"), shared_path(spark, "stream")
    run = score_stream(
        spark,
        # In braces, as a pattern may match a file or a folder of files; a plain path must be a folder.
        f"{sf_dir}/{{embeddings.parquet}}",
        i.table(spark, sf_dir, "embeddings").schema,
        lambda df: score_batch(requests(df), i.SCORED_LABELS),
        out,
        checkpoint,
        files="*",
    )
    run.awaitTermination()
    return spark.read.parquet(out)


# Every seventh request comes once more with the next file.
SQL_SCORE_TWICE = SQL_SCORE.replace(
    "FROM embeddings)", "FROM (SELECT * FROM embeddings UNION ALL SELECT * FROM embeddings WHERE vec_id % 7 = 0))"
)


@query("score_batches", SQL_SCORE_TWICE)
def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arriving files with repeated ids, scored into one folder a batch."""
    arrived, out, checkpoint = (shared_path(spark, n) for n in ("arrived", "scored", "stream"))
    rows = i.table(spark, sf_dir, "embeddings")
    again = rows.filter("vec_id % 7 = 0").withColumn("part", (F.col("vec_id") + 1) % 3)
    parts = rows.withColumn("part", F.col("vec_id") % 3).unionByName(again)
    for n in range(3):
        parts.filter(F.col("part") == n).drop("part").write.parquet(f"{arrived}/{n}")
    files = len(spark.read.option("recursiveFileLookup", "true").parquet(arrived).inputFiles())
    run = score_batches(
        spark,
        arrived,
        rows.schema,
        lambda df: score_batch(requests(df), i.SCORED_LABELS),
        out,
        checkpoint,
        max_files=-(-files // 3),
    )
    run.awaitTermination()
    return read_batches(spark, out).drop("batch")


SQL_METRICS = """m AS (
      SELECT fold, class, sum(hit) AS hit, sum(seen) AS seen FROM (
        SELECT fold, truth AS class, count(*) AS seen, count(*) FILTER (truth = pred) AS hit
        FROM f GROUP BY fold, truth
        UNION ALL SELECT fold, pred, count(*), 0 FROM f GROUP BY fold, pred) GROUP BY fold, class),
    metrics AS (
      SELECT fold, 2.0 * sum(hit) / sum(seen) AS accuracy, avg(2.0 * hit / seen) AS f1 FROM m GROUP BY fold)"""


def _predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Truth and nearest-centroid label id per vector."""
    vecs = i.vectors(spark, sf_dir)
    centroids = i.label_vectors(vecs).withColumn("label", F.col("label_id").cast("string"))
    rows = vecs.select("id", F.col("label").alias("truth"), F.col("vec_a").alias("embedding"))
    found = maxsim.top_labels(rows, centroids, 1, later_first=False)
    pred = F.get("top", F.lit(0))["label_id"].cast("int")
    return found.select("id", "truth", pred.alias("pred"))


@query(
    "eval_metrics",
    f"""WITH {i.SQL_VECTORS}, {i.SQL_CENTROIDS}, {SQL_NEAREST},
    f AS (SELECT 0 AS fold, truth, pred FROM nearest), {SQL_METRICS}
    SELECT round(accuracy, 6) AS accuracy, round(f1, 6) AS f1 FROM metrics""",
)
def eval_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = evaluate.classification_metrics(_predictions(spark, sf_dir), "truth", "pred")
    return scores.select(F.round("accuracy", 6).alias("accuracy"), F.round("f1", 6).alias("f1"))


@query(
    "fold_summary",
    f"""WITH {i.SQL_VECTORS}, {i.SQL_CENTROIDS}, {SQL_NEAREST}, {SQL_FOLDS},
    f AS (SELECT fold, truth, pred FROM nearest JOIN folds USING (id)), {SQL_METRICS}
    SELECT round(avg(accuracy), 6) AS mean_accuracy, round(avg(f1), 6) AS mean_f1,
           round(stddev_pop(f1), 6) AS std_f1, arg_max(fold, {{'f': f1, 'i': -fold}}) AS best_fold
    FROM metrics""",
)
def fold_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Ranking reads its input twice; the predictions are made once.
    folded = classes.stratified_folds(written(_predictions(spark, sf_dir), "predictions"), "id", "truth")
    per_fold = evaluate.classification_metrics(folded, "truth", "pred", ["fold"])
    summary = evaluate.fold_summary(per_fold)
    rounded = [F.round(c, 6).alias(c) for c in ("mean_accuracy", "mean_f1", "std_f1")]
    return summary.select(*rounded, "best_fold")


# Two passes over a row: the cells folded in two ways.
FIRST, SECOND = (10, 1), (10, 7)
SQL_LOGITS = f"""l AS (
      SELECT label, {i.sql_logits(*FIRST)} AS first, {i.sql_logits(*SECOND)} AS second FROM embeddings),
    cw AS (SELECT label, (SELECT count(*) FROM l) / (count(*) OVER () * n) AS weight
           FROM (SELECT label, count(*) AS n FROM l GROUP BY label))"""


def _sql_log_softmax(col: str, temperature: str = "1.0::DOUBLE") -> str:
    cells = f"list_transform({col}, lambda x: x / {temperature})"
    return f"list_transform({cells}, lambda x: x - ln(list_sum(list_transform({cells}, lambda y: exp(y)))))"


def two_passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return i.table(spark, sf_dir, "embeddings").select(
        "label", i.logits("first", *FIRST), i.logits("second", *SECOND)
    )


@query(
    "eval_losses",
    f"""WITH {SQL_LOGITS},
    w AS (SELECT list(coalesce(weight, 0) ORDER BY k) AS ws FROM range(10) t(k) LEFT JOIN cw ON label = k),
    p AS (SELECT label, weight, ws, {_sql_log_softmax('first')} AS a, {_sql_log_softmax('second')} AS b
          FROM l JOIN cw USING (label), w),
    t AS (
      SELECT weight, -weight * a[label + 1] AS ca, -weight * b[label + 1] AS cb,
             list_sum(list_transform(list_zip(a, b), lambda z: exp(z[2]) * (z[2] - z[1]))) AS kl,
             list_sum(list_transform(list_zip(a, ws), lambda z: -z[1] * z[2])) / 10 AS spread FROM p),
    f AS (SELECT *, (1 - exp(-ca)) ** 2 * ca AS fa, (1 - exp(-cb)) ** 2 * cb AS fb FROM t)
    SELECT round(avg(fa), 6) AS focal_mean, round(sum(fa), 4) AS focal_sum, round(max(fa), 6) AS focal_max,
           round(sum(0.9 * ca + 0.1 * spread) / sum(weight), 6) AS smoothed_ce,
           round(avg(kl), 6) AS kl, round(avg((fa + fb) / 2 + 0.5 * kl), 6) AS combined FROM f""",
)
def eval_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = two_passes(spark, sf_dir)
    # One map of class weights as a scalar subquery; a class without rows weighs 0.
    by_label = F.map_from_entries(F.collect_list(F.struct("label", "weight")))
    weights = F.transform(
        F.sequence(F.lit(0), F.lit(9)),
        lambda k: F.coalesce(F.try_element_at("by_label", k.cast("int")), F.lit(0.0)),
    )
    rows = rows.withColumn("by_label", classes.class_weights(rows).agg(by_label).scalar())
    rows = rows.withColumn("weights", weights)
    label = F.col("label")
    own = F.get("weights", label)
    first, second = evaluate.Logits("first", 10), evaluate.Logits("second", 10)
    rows = second.attach(first.attach(rows))
    focal = evaluate.focal_loss(first, label, own)
    smooth, divisor = evaluate.smoothed_ce_parts(first, label, array_cells(F.col("weights"), 10))
    kl = evaluate.kl_divergence(second, first)
    combined = evaluate.combined_objective(first, second, label, own)
    return rows.agg(
        F.round(F.avg(focal), 6).alias("focal_mean"),
        F.round(F.sum(focal), 4).alias("focal_sum"),
        F.round(F.max(focal), 6).alias("focal_max"),
        F.round(F.sum(smooth) / F.sum(divisor), 6).alias("smoothed_ce"),
        F.round(F.avg(kl), 6).alias("kl"),
        F.round(F.avg(combined), 6).alias("combined"),
    )


@query(
    "distill_loss",
    f"""WITH {SQL_LOGITS},
    p AS (SELECT label, {_sql_log_softmax('first')} AS s1, {_sql_log_softmax('first', '2.0::DOUBLE')} AS s,
                 {_sql_log_softmax('second', '2.0::DOUBLE')} AS t FROM l),
    q AS (SELECT avg(-s1[label + 1]) AS ce,
                 avg(list_sum(list_transform(list_zip(s, t), lambda z: exp(z[2]) * (z[2] - z[1])))) * 4 AS kl FROM p)
    SELECT round(ce, 6) AS ce, round(kl, 6) AS kl, round(0.5 * ce + 0.5 * kl, 6) AS loss FROM q""",
)
def distill_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    loss = evaluate.distill_loss("first", "second", "label", 10, two_passes(spark, sf_dir))
    return loss.select(*[F.round(c, 6).alias(c) for c in ("ce", "kl", "loss")])


@query(
    "strategy_report",
    """WITH r AS (
      SELECT event_type AS strategy, value, length(props) AS bytes, user_id % 2 = 1 AS truth,
             CAST(props->>'$.k' AS INTEGER) >= 50 AS pred FROM events),
    m AS (
      SELECT strategy, 2.0 * count(*) FILTER (truth AND pred)
             / (count(*) FILTER (truth) + count(*) FILTER (pred)) AS f1,
             sum(bytes) / 1e6 AS size_mb, avg(value) AS speed_ms FROM r GROUP BY strategy)
    SELECT strategy, round(f1, 6) AS f1, round(size_mb, 6) AS size_mb, round(speed_ms, 6) AS speed_ms,
           round(f1 / speed_ms, 6) AS f1_per_ms,
           CAST(row_number() OVER (ORDER BY round(f1 / speed_ms, 6) DESC, strategy) AS INTEGER) AS rank
    FROM m""",
)
def strategy_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run records taken from the event log: one strategy per event type."""
    pred = F.get_json_object("props", "$.k").cast("int") >= 50
    truth = F.col("user_id") % 2 == 1
    both = F.count_if(truth) + F.count_if(pred)
    measured = (
        i.table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("strategy"))
        .agg(
            F.try_divide(2.0 * F.count_if(truth & pred), both).alias("f1"),
            (F.sum(F.length("props")) / 1e6).alias("size_mb"),
            F.avg("value").alias("speed_ms"),
        )
    )
    runs = measured.unpivot("strategy", ["f1", "size_mb", "speed_ms"], "metric", "value")
    report = evaluate.strategy_report(runs)
    return report.withColumns({c: F.round(c, 6) for c in ("f1", "size_mb", "speed_ms")})


@query(
    "platt_scale",
    f"""WITH RECURSIVE r AS (
      SELECT vec_id AS id, {i.sql_logits(BINARY)}[2] AS x, label % 2 AS y FROM embeddings),
    d AS (SELECT list({{'x': x, 'y': y}}) AS rows FROM r),
    fit(i, w, b) AS (
      SELECT 0, 0.0::DOUBLE, 0.0::DOUBLE
      UNION ALL
      SELECT i + 1, w - (gw * hbb - gb * hwb) / (hww * hbb - hwb * hwb),
             b - (gb * hww - gw * hwb) / (hww * hbb - hwb * hwb)
      FROM (
        SELECT i, w, b, w + list_sum(list_transform(ps, lambda z: (z.p - z.y) * z.x)) AS gw,
               list_sum(list_transform(ps, lambda z: z.p - z.y)) AS gb,
               1 + list_sum(list_transform(ps, lambda z: z.p * (1 - z.p) * z.x * z.x)) AS hww,
               list_sum(list_transform(ps, lambda z: z.p * (1 - z.p) * z.x)) AS hwb,
               list_sum(list_transform(ps, lambda z: z.p * (1 - z.p))) AS hbb
        FROM (SELECT i, w, b, list_transform(rows, lambda z:
                       {{'x': z.x, 'y': z.y, 'p': 1 / (1 + exp(-(w * z.x + b)))}}) AS ps
              FROM fit, d WHERE i < 25))),
    best AS (SELECT w, b FROM fit WHERE i = 25)
    SELECT id, y AS label, round(1 / (1 + exp(-(w * x + b))), 4) AS calibrated FROM r, best""",
)
def platt_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = i.table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"),
        F.get(i.logits("l", BINARY), F.lit(1)).alias("logit"),
        (F.col("label") % 2).alias("label"),
    )
    model = train.platt_fit(rows)
    scored = train.platt_apply(rows, model)
    return scored.select("id", "label", F.round("calibrated", 4).alias("calibrated"))


@query("train_binary_cv")
def train_binary_cv(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = i.table(spark, sf_dir, "documents").join(i.table(spark, sf_dir, "labels"), "doc_id")
    docs = texts.select(F.col("doc_id").alias("id"), F.col("quality").alias("label"), "text")
    docs = written(encoders.with_words(docs, "text").drop("text"), "words")
    stages = encoders.Pipeline(
        stages=[
            encoders.HashingTF(numFeatures=512, inputCol="_words", outputCol="_tf"),
            encoders.IDF(inputCol="_tf", outputCol="_idf"),
            encoders.Normalizer(inputCol="_idf", outputCol="features"),
        ]
    )
    coded = stages.fit(docs).transform(docs).select("id", "label", "features")
    return train.train_cv(coded, k=5, weights="auto").metrics


@query("train_multiclass_cv")
def train_multiclass_cv(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = i.table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("label").cast("string").alias("label"), "embedding"
    )
    prepared = classes.prepare_multiclass(rows, "embedding", "label")
    coded = prepared.select(
        "id",
        F.col("label_id").alias("label"),
        array_to_vector(F.col("text").cast("array<double>")).alias("features"),
    )
    return train.train_cv(coded, k=3, weights="balanced").metrics


@query("distill_train")
def distill_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A student learns the soft labels of a nearest-centroid teacher; agreement per class."""
    vecs = i.vectors(spark, sf_dir)
    centroids = i.label_vectors(vecs).withColumn("label", F.col("label_id").cast("string"))
    scored = maxsim.top_labels(
        vecs.select("id", "vec_a", F.col("vec_a").alias("embedding")), centroids, 10, later_first=False
    )
    by_label = F.array_sort(F.transform("top", lambda t: F.struct(t["label_id"], t["score"])))
    rows = written(
        scored.select(
            "id",
            array_to_vector("vec_a").alias("features"),
            F.transform(by_label, lambda t: t["score"] * 10.0).alias("teacher"),
            F.get("top", F.lit(0))["label_id"].cast("int").alias("truth"),
        ),
        "teacher",
    )
    model = train.distill_train(rows, "teacher", 10)
    scores = train.student_logits(rows, model).withColumn("pred", F.col("prediction").cast("int"))
    agreement = evaluate.classification_metrics(scores, "truth", "pred", ["truth"])
    return agreement.select("truth", F.round("accuracy", 4).alias("accuracy"))


