import numpy as np
import pytest
from pyspark.sql import functions as F

from noticelens.operators import maxsim as m
from noticelens.operators import vectors as v
from noticelens.session import shared_path
from noticelens.sources.tables import read_sheet, write_book
from noticelens.operators.weaklabel import candidates, judge, value_summary, weak_label

DIM, TITLES = 6, 90
rng = np.random.default_rng(7)
A = rng.normal(size=(TITLES, DIM))
B = rng.normal(size=(TITLES, DIM)) - 0.5
A[3] = 0.0
LABELS = ["l0", "l1", "l2", "empty", "l4"]
# Label 1 holds most keywords; label 3 has none.
KEYWORDS = [(lid, n) for lid, size in ((0, 2), (1, 20), (2, 3), (4, 1)) for n in range(size)]
KA, KB = rng.normal(size=(len(KEYWORDS), DIM)), rng.normal(size=(len(KEYWORDS), DIM)) - 0.5


@pytest.fixture(scope="module")
def titles(spark):
    rows = [(n, f"t{n}", A[n].tolist(), B[n].tolist()) for n in range(TITLES)]
    return spark.createDataFrame(rows, "id bigint, title string, vec_a array<double>, vec_b array<double>")


@pytest.fixture(scope="module")
def keywords(spark):
    rows = [(lid, n, KA[i].tolist(), KB[i].tolist()) for i, (lid, n) in enumerate(KEYWORDS)]
    return spark.createDataFrame(rows, "label_id bigint, keyword_id int, vec_a array<double>, vec_b array<double>")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(list(enumerate(LABELS)), "label_id bigint, label string")


def cosine(x, y):
    norms = np.linalg.norm(x, axis=1)[:, None] * np.linalg.norm(y, axis=1)[None, :]
    return np.divide(x @ y.T, norms, out=np.zeros((len(x), len(y))), where=norms > 0)


def expected_scores(x, k):
    sims, out = cosine(x, k), np.zeros((len(x), len(LABELS)))
    for lid in (0, 1, 2, 4):
        out[:, lid] = sims[:, [i for i, key in enumerate(KEYWORDS) if key[0] == lid]].max(axis=1)
    return out


@pytest.mark.parametrize("max_cells", [v.MAX_BLOCK_CELLS, 60])
def test_maxsim(titles, keywords, labels, max_cells):
    got = m.maxsim(titles, keywords, labels, "vec_a", max_cells).collect()
    expected = expected_scores(A, KA)
    assert len(got) == TITLES * len(LABELS)
    for r in got:
        assert r.score == pytest.approx(expected[r.id, LABELS.index(r.label)], abs=1e-12)


@pytest.mark.parametrize("max_cells", [v.MAX_BLOCK_CELLS, 60])
def test_ensemble(titles, keywords, labels, max_cells):
    got = m.ensemble_label(titles, keywords, labels, threshold=0.5, max_cells=max_cells).collect()
    sa, sb = expected_scores(A, KA), expected_scores(B, KB)
    both = 0.9 * sa + 0.1 * sb
    assert len(got) == TITLES
    for r in got:
        assert r.predicted_label == LABELS[both[r.id].argmax()]
        assert r.final_ensemble_score == pytest.approx(both[r.id].max())
        assert r.score_a == pytest.approx(sa[r.id].max()) and r.score_b == pytest.approx(sb[r.id].max())
        assert r.status.startswith("auto" if both[r.id].max() >= 0.5 else "manual")
        low, high = sorted((sa[r.id].max(), sb[r.id].max()))
        assert r.final_ensemble_score <= high + 1e-12


def test_label_without_keywords_beats_negative_scores(spark, labels):
    title = spark.createDataFrame([(1, [1.0, 0.0], [1.0, 0.0])], "id bigint, vec_a array<double>, vec_b array<double>")
    kw = spark.createDataFrame([(0, 0, [-1.0, 0.0], [-1.0, 0.0]), (1, 0, None, None)], "label_id bigint, keyword_id int, vec_a array<double>, vec_b array<double>")
    r = m.ensemble_label(title, kw, labels).first()
    # Labels 1 to 4 have no keywords here; the first of them wins.
    assert (r.predicted_label, r.final_ensemble_score, r.score_a) == ("l1", 0.0, 0.0)


def test_no_keyword_vector_at_all(titles, keywords, labels):
    got = m.ensemble_label(titles, keywords.limit(0), labels).collect()
    assert {(r.predicted_label, r.final_ensemble_score, r.score_b) for r in got} == {("l0", 0.0, 0.0)}
    scores = m.maxsim(titles, keywords.limit(0), labels, "vec_a")
    assert scores.count() == TITLES * len(LABELS) and scores.filter("score <> 0").count() == 0


@pytest.mark.parametrize("max_cells", [v.MAX_BLOCK_CELLS, 60])
def test_rows_without_vectors_pass_through(titles, keywords, labels, max_cells):
    some = titles.withColumn("vec_a", F.when(F.col("id") % 3 == 0, F.col("vec_a")))
    got = {r.id: r for r in m.ensemble_label(some, keywords, labels, max_cells=max_cells).collect()}
    full = {r.id: r for r in m.ensemble_label(titles, keywords, labels).collect()}
    assert len(got) == TITLES
    for n, r in got.items():
        assert r.predicted_label == (full[n].predicted_label if n % 3 == 0 else None)
        assert (r.final_ensemble_score is None) == (n % 3 != 0)


def test_keyword_lists_join_their_vectors(spark):
    kb = spark.createDataFrame([(0, "a, b,,a"), (1, None)], "label_id bigint, keywords string")
    assert {r.keyword for r in m.keyword_universe(kb).collect()} == {"a", "b"}
    assert {r.keyword for r in m.keyword_universe(kb, null_as_nan=True).collect()} == {"a", "b", "nan"}
    vecs = spark.createDataFrame([("a", [1.0])], "keyword string, vec_a array<double>")
    assert [(r.label_id, r.keyword_id) for r in m.attach_vectors(kb, vecs).orderBy("keyword_id").collect()] == [(0, 0), (0, 2)]


@pytest.mark.parametrize("max_cells", [v.MAX_BLOCK_CELLS, 12])
@pytest.mark.parametrize("later", [True, False])
def test_top_labels_and_ties(spark, max_cells, later):
    vecs = [[1.0, 0.0], [1.0, 0.0], [0.0, 1.0], [1.0, 0.0], [-1.0, 0.0], [1.0, 1.0]]
    kb = spark.createDataFrame([(n, f"l{n}", x) for n, x in enumerate(vecs)], "label_id bigint, label string, embedding array<double>")
    df = spark.createDataFrame([(7, [2.0, 0.0])], "id bigint, embedding array<double>")
    top = m.top_labels(df, kb, 4, later_first=later, max_cells=max_cells).first().top
    assert [t.label_id for t in top] == ([3, 1, 0, 5] if later else [0, 1, 3, 5])


def test_nearest_label_statuses(spark):
    kb = spark.createDataFrame([(0, "x", [1.0, 0.0]), (1, "y", [0.0, 1.0])], "label_id bigint, label string, embedding array<double>")
    df = spark.createDataFrame([(1, "t", [1.0, 0.1]), (2, "t", [1.0, 0.9]), (3, "", [1.0, 0.0])], "id bigint, title string, embedding array<double>")
    got = {r.id: (r.predicted_label, r.status) for r in m.nearest_label(df, kb, F.col("title")).collect()}
    assert got == {1: ("x", "auto_confirmed"), 2: ("x", "manual_review_needed"), 3: ("input error", "input error")}


@pytest.mark.parametrize("max_cells", [v.MAX_BLOCK_CELLS, 24])
def test_knn_is_exact_with_copies(spark, max_cells):
    points = rng.normal(size=(300, 4))
    points[100:200] = points[100]  # a third of the corpus is one vector
    corpus = spark.createDataFrame([(n, p.tolist()) for n, p in enumerate(points)], "id bigint, embedding array<double>").repartition(7)
    queries = np.vstack([points[:9], points[100:101]])
    qdf = spark.createDataFrame([(n, q.tolist()) for n, q in enumerate(queries)], "query_id bigint, embedding array<double>")
    got = {}
    for r in v.knn(qdf, corpus, 12, max_cells=max_cells).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.id, r.distance))
    for n, q in enumerate(queries):
        d = np.round(((points - q) ** 2).sum(axis=1), 9)
        expected = sorted(range(300), key=lambda i: (d[i], i))[:12]
        assert [i for _, i, _ in sorted(got[n])] == expected
    assert len(got) == len(queries)


def test_group_means_skip_missing_vectors(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (1, [3.0, 6.0]), (1, None), (2, None)], "k int, v array<float>")
    assert {r.k: r.v for r in v.group_means(df, ["k"], ["v"]).collect()} == {1: [2.0, 4.0]}


def test_knn_of_nothing(spark):
    q = spark.createDataFrame([], "query_id bigint, embedding array<double>")
    c = spark.createDataFrame([(1, [1.0])], "id bigint, embedding array<double>")
    assert v.knn(q, c, 3).count() == 0 and v.knn(q.limit(0), c.limit(0), 3).count() == 0


def test_mean_pool(spark):
    rows = [(1, [1.0, 2.0], 1), (1, [3.0, 4.0], 1), (1, [9.0, 9.0], 0), (2, [5.0, 5.0], 0)]
    df = spark.createDataFrame(rows, "k int, v array<double>, m int")
    got = {r.k: r.embedding for r in v.mean_pool(df, "k", "v", "m").collect()}
    assert got == {1: [2.0, 3.0], 2: [0.0, 0.0]}


def test_quantize_int8(spark):
    df = spark.createDataFrame([(1, [-1.0, 1.0])], "id bigint, v array<double>")
    calibration = v.calibrate_minmax(df, "id", "v")
    values = spark.createDataFrame([(1, [-1.0, 0.0, 0.5, 1.0, 3.0])], "id bigint, v array<double>")
    r = v.quantize_int8(values, "v", calibration).first()
    assert r.q == [0, 128, 192, 255, 255] and r.max_error > 1.9
    inside = spark.createDataFrame([(n, [float(x) for x in rng.uniform(-1, 1, 50)]) for n in range(9)], "id bigint, v array<double>")
    scale = calibration.first().scale
    assert all(r.max_error <= scale / 2 + 1e-9 for r in v.quantize_int8(inside, "v", calibration).collect())
    flat = v.calibrate_minmax(spark.createDataFrame([(1, [2.0])], "id bigint, v array<double>"), "id", "v")
    assert flat.first().scale == 1.0


KB_ROWS = [(n, label, "A, B" if n == 1 else "C", "d") for n, label in enumerate(LABELS)]


def test_weak_label_rules_come_first(spark, titles, keywords):
    kb = spark.createDataFrame(KB_ROWS, "label_id bigint, final_label string, dep string, div string")
    title = F.when(F.col("id") == 0, "safety_check").otherwise(F.col("title"))
    notices = titles.select("id", title.alias("service_title"), "vec_a", "vec_b", F.lit("B").alias("participating_dept"))
    rows = {r.id: r for r in weak_label(notices, keywords, kb, threshold=0.5).collect()}
    assert len(rows) == TITLES
    first = rows[0]
    assert (first.predicted_label, first.status) == ("structural_safety_inspection", "rule:safety_inspection")
    assert (first.confidence_score, first.final_ensemble_score, first.predicted_dept) == (1.0, None, "N/A")
    assert all(r.confidence_score == 0.0 and r.final_ensemble_score is not None for n, r in rows.items() if n)
    assert {r.dept_match_status for r in rows.values() if r.predicted_label == "l1"} <= {"match"}
    book = shared_path(spark, "book")
    labelled = weak_label(notices, keywords, kb, threshold=0.5)
    write_book(
        {
            "Classification_Result": labelled,
            "Label_Summary": value_summary(labelled, "predicted_label", "final_label"),
        },
        book,
    )
    sheet = read_sheet(spark, book, "Label_Summary")
    assert sheet.agg(F.sum("count")).first()[0] == TITLES
    assert read_sheet(spark, book, "Classification_Result").count() == TITLES
    summary = value_summary(spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "x string"), "x", "label")
    assert [tuple(r) for r in summary.collect()] == [("b", 2), ("a", 1)]


def test_candidates_and_judge(spark):
    kb = spark.createDataFrame(
        [(n, f"l{n}", "k" * 200, [float(n), 1.0]) for n in range(7)],
        "label_id bigint, label string, keywords_str string, embedding array<double>",
    )
    df = spark.createDataFrame([(1, "road", [1.0, 0.0]), (2, "", [1.0, 0.0]), (3, None, [1.0, 0.0]), (4, "boom", [1.0, 0.0])], "id bigint, service_title string, embedding array<double>")
    prompts = candidates(df, kb)
    first = prompts.filter("id = 1").first()
    assert first.candidates.split("\n")[0] == "- Label: l6" and first.candidates.count("- Label") == 5
    assert "k" * 150 + "..." in first.candidates and "k" * 151 not in first.candidates

    def factory():
        def client(prompt):
            if "boom" in prompt:
                raise RuntimeError("down")
            return '```json\n{"best_label": "l6", "reason": "r"}\n```'

        return client

    got = {r.id: (r.predicted_label, r.reasoning) for r in judge(prompts, factory).collect()}
    assert got == {
        1: ("l6", "r"),
        2: ("input error", "empty_title"),
        3: ("input error", "empty_title"),
        4: ("classification error", "invalid_reply"),
    }
    unset = {r.id: r.predicted_label for r in judge(prompts, None).collect()}
    assert unset == {1: "LLM not set", 2: "input error", 3: "input error", 4: "LLM not set"}


@pytest.mark.parametrize("max_cells", [v.MAX_BLOCK_CELLS, 60, 12])
def test_repeated_and_null_ids_keep_their_rows(spark, titles, keywords, labels, max_cells):
    """Rows are judged one by one, whatever their ids and however many blocks there are."""
    odd = titles.withColumn("id", F.when(F.col("id") % 3 != 0, F.lit(1)).cast("bigint"))
    marked = odd.withColumn("title", F.hash("vec_a", "vec_b").cast("string"))
    one = titles.withColumn("title", F.hash("vec_a", "vec_b").cast("string"))
    columns = ("title", "predicted_label", "final_ensemble_score", "score_a", "score_b", "status")
    got = m.ensemble_label(marked, keywords, labels, max_cells=max_cells).select(*columns).collect()
    want = m.ensemble_label(one, keywords, labels).select(*columns).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    scores = m.maxsim(odd, keywords, labels, "vec_a", max_cells)
    assert scores.count() == TITLES * len(LABELS)
    kb = spark.createDataFrame([(n, f"l{n}", [float(n), 1.0, -n / 2]) for n in range(9)], "label_id bigint, label string, embedding array<double>")
    vecs = [[float(n % 4), 1.0, n / 7] for n in range(20)]
    df = spark.createDataFrame([(None if n % 3 else 5, str(n), x) for n, x in enumerate(vecs)], "id bigint, title string, embedding array<double>")
    few = {r.title: r.top for r in m.top_labels(df, kb, 3, max_cells=6).collect()}
    assert len(few) == 20 and few == {r.title: r.top for r in m.top_labels(df, kb, 3).collect()}


@pytest.mark.parametrize("max_cells", [v.MAX_BLOCK_CELLS, 8])
def test_labels_that_share_a_keyword_tie(spark, max_cells):
    """The first of several labels with the same keyword wins, in any block."""
    vec = rng.normal(size=(40, 7))
    rows = [(n, n, vec[0].tolist(), vec[1].tolist()) for n in range(12)]
    kw = spark.createDataFrame(rows, "label_id bigint, keyword_id int, vec_a array<double>, vec_b array<double>")
    names = spark.createDataFrame([(n, f"l{n}") for n in range(12)], "label_id bigint, label string")
    df = spark.createDataFrame([(n, x.tolist(), x.tolist()) for n, x in enumerate(vec)], "id bigint, vec_a array<double>, vec_b array<double>")
    got = m.ensemble_label(df, kw, names, max_cells=max_cells * 7).collect()
    assert {r.predicted_label for r in got} == {"l0"}


def test_calibration_sees_all_rows(spark):
    df = spark.createDataFrame([(n, [float(n)]) for n in range(1000)], "id bigint, v array<double>")
    r = v.calibrate_minmax(df, "id", "v").first()
    assert (r.low, r.high) == (0.0, 999.0)
    assert v.calibrate_minmax(df, "id", "v", n=10).first().high < 999.0 + 1


def test_knn_merges_blocks_of_queries(spark):
    points = rng.normal(size=(60, 3))
    corpus = spark.createDataFrame([(n, p.tolist()) for n, p in enumerate(points)], "id bigint, embedding array<double>")
    q = spark.createDataFrame([(n, p.tolist()) for n, p in enumerate(points[:30])], "query_id bigint, embedding array<double>")
    one, many = (sorted(map(tuple, v.knn(q, corpus, 4, max_cells=c).collect())) for c in (v.MAX_BLOCK_CELLS, 6))
    assert one == many and len(one) == 120
