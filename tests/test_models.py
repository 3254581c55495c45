import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from noticelens.operators import encoders, train
from noticelens.operators.score import score_batch
from noticelens.operators.weaklabel import weak_label_texts
from noticelens.plans import evaluation
from noticelens.session import shared_path
from noticelens.streaming.scoring import score_stream

rng = np.random.default_rng(11)


@pytest.fixture(scope="module")
def blobs(spark):
    rows = []
    for n in range(240):
        label = n % 3
        rows.append((n, label, (rng.normal(size=4) + 3 * np.eye(4)[label]).tolist()))
    df = spark.createDataFrame(rows, "id bigint, label int, v array<double>")
    return df.withColumn("features", array_to_vector("v"))


def test_train_cv(blobs):
    done = train.train_cv(blobs, k=3, weights="balanced")
    rows = done.metrics.collect()
    assert sorted(r.fold for r in rows) == [0, 1, 2] and all(r.f1 > 0.8 for r in rows)
    assert done.summary.first().best_fold == min(r.fold for r in rows if r.f1 == max(x.f1 for x in rows))
    assert done.best_model.numClasses == 3


def test_platt(spark):
    logits = rng.normal(size=400)
    y = (rng.uniform(size=400) < 1 / (1 + np.exp(-(2 * logits - 0.5)))).astype(int)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(logits, y)], "logit double, label int")
    model = train.platt_fit(df)
    assert model.coefficients[0] == pytest.approx(2.0, abs=0.6)
    ours = train.platt_apply(df, model).select("calibrated", "logit").collect()
    for r in ours[:20]:
        z = r.logit * model.coefficients[0] + model.intercept
        assert r.calibrated == pytest.approx(1 / (1 + np.exp(-z)))


def test_student_follows_the_teacher(blobs):
    teacher = F.transform(F.slice("v", 1, 3), lambda x: x * 2.0)
    table = blobs.withColumn("teacher", teacher)
    model = train.distill_train(table, "teacher", 3)
    scored = train.student_logits(table, model)
    truth = F.array_position("teacher", F.array_max("teacher")) - 1
    agree = scored.filter(truth == F.col("prediction")).count()
    assert agree > 220 and len(scored.first().logits) == 3


def test_caller_encoder_is_batched(spark):
    def factory():
        return lambda texts: [[float(len(t)), float(len(texts) <= 2)] for t in texts]

    df = spark.createDataFrame([("abc",), (None,), ("x",)], "t string").coalesce(1)
    got = [r.embedding for r in encoders.encode(df, "t", factory, batch_size=2).collect()]
    assert got == [[3.0, 1.0], None, [1.0, 1.0]]


def test_only_open_titles_are_encoded(spark):
    def factory():
        def encoder(texts):
            if any("safety_check" in t for t in texts):
                raise RuntimeError("a rule had labelled this title")
            return [[float("road" in t), float("port" in t)] for t in texts]

        return encoder

    def both(df, col):
        return encoders.encode(encoders.encode(df, col, factory, "vec_a"), col, factory, "vec_b")

    kb = spark.createDataFrame(
        [(0, "road_design", "road, ", "d", "A"), (1, "harbor_design", "port,port", "d", "B"), (2, "none", None, "d", "C")],
        "label_id bigint, final_label string, keywords string, div string, dep string",
    )
    titles = ["ring road &amp; more", "new port", "safety_check", "neither", None]
    notices = spark.createDataFrame(list(enumerate(titles)), "id bigint, service_title string")
    got = {r.id: (r.predicted_label, r.status, r.confidence_score) for r in weak_label_texts(notices, kb, both).collect()}
    assert got == {
        0: ("road_design", "auto_confirmed (ensemble)", 0.0),
        1: ("harbor_design", "auto_confirmed (ensemble)", 0.0),
        2: ("structural_safety_inspection", "rule:safety_inspection", 1.0),
        3: ("road_design", "manual_review_needed (AI)", 0.0),
        4: ("road_design", "manual_review_needed (AI)", 0.0),
    }


def test_built_in_channels(spark):
    texts = ["road design works", "road repair works", "harbor dredging", "harbor quay", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, t string")
    general, domain = encoders.fit_general(df, "t", 64), encoders.fit_domain(df, "t", 32, 2)
    rows = {r.id: r for r in encoders.encode_channels(df, "t", general, domain).collect()}

    def cos(a, b):
        a, b = np.array(a), np.array(b)
        return a @ b / (np.linalg.norm(a) * np.linalg.norm(b))

    assert cos(rows[0].vec_a, rows[1].vec_a) > cos(rows[0].vec_a, rows[3].vec_a)
    assert np.linalg.norm(rows[0].vec_a) == pytest.approx(1.0) and len(rows[0].vec_b) == 2


def test_project_2d_matches_svd(spark):
    x = rng.normal(size=(60, 5)) * np.array([5, 3, 1, 0.5, 0.1])
    df = spark.createDataFrame([(n, r.tolist()) for n, r in enumerate(x)], "id bigint, embedding array<double>")
    nothing = spark.createDataFrame([(99, None)], df.schema)
    rows = encoders.project_2d(df.unionByName(nothing)).orderBy("id").collect()
    assert rows.pop().x is None
    got = np.array([(r.x, r.y) for r in rows])
    _, _, vt = np.linalg.svd(x - x.mean(axis=0))
    axes = np.array([a * np.sign(a[np.abs(a).argmax()]) for a in vt[:2]])
    assert np.allclose(got, x @ axes.T, atol=1e-6)


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    ddl = "id string, text string, binary_logits array<double>, multi_logits array<double>"
    rows = [(str(n), "road" if n % 2 else "check", [0.0, float(n)], [float(n), 0.0]) for n in range(20)]
    df = spark.createDataFrame(rows, ddl)
    inbox, out, checkpoint = str(tmp_path / "in"), shared_path(spark, "out"), shared_path(spark, "cp")
    labels = ["road_design", "soil_survey"]

    def run():
        score_stream(spark, inbox, ddl, lambda d: score_batch(d, labels), out, checkpoint, max_files=1).awaitTermination()

    df.limit(12).repartition(3).write.parquet(inbox)
    run()
    assert spark.read.parquet(out).count() == 12
    df.limit(5).write.mode("append").parquet(inbox)  # duplicate ids are scored again
    run()
    expected = score_batch(df.limit(12).unionAll(df.limit(5)), labels)
    assert sorted(spark.read.parquet(out).collect()) == sorted(expected.collect())


@pytest.mark.parametrize("folder", [False, True])
def test_stream_query_reads_a_table_of_one_file_or_of_a_folder(spark, tmp_path, folder):
    vectors = spark.createDataFrame(
        [(n, [n / 64.0] * 64, n % 3) for n in range(30)], "vec_id bigint, embedding array<float>, label int"
    )
    table = tmp_path / "embeddings.parquet"
    if folder:
        vectors.repartition(3).write.parquet(str(table))
    else:
        vectors.coalesce(1).write.parquet(str(tmp_path / "other"))
        (file,) = (tmp_path / "other").glob("*.parquet")
        table.write_bytes(file.read_bytes())
    got = evaluation.stream(spark, str(tmp_path)).collect()
    assert sorted(got) == sorted(evaluation.batch(spark, str(tmp_path)).collect()) and len(got) == 30
