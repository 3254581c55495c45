import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from noticelens.operators import evaluate, keywords
from noticelens.session import shared_path
from noticelens.sources.tables import read_sheet, write_book

TEXTS = [
    (1, 0, "Road design road repair and bridge"),
    (2, 0, "bridge repair 공고 공고"),
    (3, 0, "harbor"),
    (4, 1, "service and for"),
    (5, 1, None),
    (6, -1, None),
    (7, 2, "x y z"),
    (8, 0, "zeta alpha"),
]
STOP = ["service", "construction", "business", "for", "related", "misc", "and"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(TEXTS, "id bigint, cluster_id int, text string")


def brute(cap):
    out = {}
    for c in (0, 1, 2):
        corpus = [t for _, k, t in TEXTS if k == c and t is not None]
        bags = [Counter(w for w in re.findall(r"\w\w+", t.lower()) if w not in STOP) for t in corpus]
        total, df = Counter(), Counter()
        for bag in bags:
            total.update(bag)
            df.update(bag.keys())
        kept = sorted(total, key=lambda w: (-total[w], w))[:cap]
        idf = {w: math.log((1 + len(corpus)) / (1 + df[w])) + 1 for w in kept}
        score = defaultdict(float)
        for bag in bags:
            w = {t: n * idf[t] for t, n in bag.items() if t in idf}
            norm = math.sqrt(sum(x * x for x in w.values()))
            for t, x in w.items():
                score[t] += x / norm
        ranked = sorted(score, key=lambda t: (-round(score[t], 6), t))
        out.update({(c, n + 1): (t, round(score[t], 6)) for n, t in enumerate(ranked[:20])})
    return out


@pytest.mark.parametrize("cap", [None, 2000, 3])
def test_cluster_keywords(docs, cap):
    got = keywords.cluster_keywords(docs, "cluster_id", "id", "text", max_features=cap)
    rows = {(r.cluster_id, r["rank"]): (r.term, pytest.approx(r.score, abs=1e-6)) for r in got.collect()}
    assert rows == brute(cap)


def test_chunks_hold_texts_of_few_clusters(spark, monkeypatch):
    """Terms are counted together for a cluster, and a large cluster by several tasks."""
    chunks, found = keywords._chunks, []
    monkeypatch.setattr(keywords, "_chunks", lambda *a: found.append(chunks(*a)) or found[0])
    monkeypatch.setattr(keywords, "PART_BYTES", 2_000)
    rows = [(n, n % 10 if n % 2 else 0, f"same words of row n{n}") for n in range(1000)]
    df = spark.createDataFrame(rows, "id bigint, cluster_id int, text string").repartition(4)
    got = keywords.cluster_keywords(df, "cluster_id", "id", "text", n=3)
    assert [r.term for r in got.filter("cluster_id = 3").orderBy("rank").collect()] == ["of", "row", "same"]
    terms = found[0].filter("kind = 'term'").groupBy("chunk").agg(F.collect_set("c").alias("c")).collect()
    assert sum(0 in r.c for r in terms) > 3
    assert sum(len(r.c) for r in terms) < len(terms) + 8


@pytest.mark.parametrize("size", [1, 1000])
def test_counts_are_packed_without_loss(size):
    rng = np.random.default_rng(size)
    row = np.sort(rng.integers(0, 90_000, size))
    number, tf = rng.integers(0, 400_000, size), rng.integers(1, 70_000, size)
    data = keywords._packed(row, number, tf)
    assert all((a == b).all() for a, b in zip(keywords._unpacked(data), (row, number, tf)))
    if size > 1:
        assert len(data) < 12 * size


def test_rows_of_one_key_are_weighed_apart(spark, docs):
    """The key names no row: repeated and null keys change nothing."""
    same = docs.withColumn("id", F.when(F.col("id") % 2 == 0, F.lit(1)).cast("bigint"))
    got, want = (
        sorted(map(tuple, keywords.cluster_keywords(d, "cluster_id", "id", "text").collect())) for d in (same, docs)
    )
    assert got == want and got


def test_no_usable_word_at_all(docs):
    got = keywords.cluster_keywords(docs.filter("cluster_id = 1"), "cluster_id", "id", "text")
    assert got.count() == 0 and got.columns == ["cluster_id", "rank", "term", "score"]


def test_report_book(spark, docs):
    words = keywords.cluster_keywords(docs, "cluster_id", "id", "text")
    samples = keywords.cluster_samples(docs, "cluster_id", "id", "text", n=2)
    book = shared_path(spark, "book")
    write_book(
        {
            "Summary": keywords.cluster_summary(docs, words, "cluster_id", "text"),
            "Detail": keywords.cluster_detail(words, samples, "cluster_id", "text"),
        },
        book,
        partition_by={"Detail": "cluster_id"},
    )
    summary = {r.cluster_id: (r.name, r["size"], r.top_keywords) for r in read_sheet(spark, book, "Summary").collect()}
    assert summary[-1] == ("Noise", 1, "")
    assert summary[1] == ("Cluster 1", 2, "(keyword extraction failed)")
    assert summary[0][0:2] == ("Cluster 0", 4) and summary[0][2].count(",") == 4
    detail = read_sheet(spark, book, "Detail").filter("cluster_id = 0")
    assert detail.count() == words.filter("cluster_id = 0").count()
    assert detail.filter("sample_text is not null").count() == 2


def test_samples_heads_and_stats(docs):
    samples = keywords.cluster_samples(docs, "cluster_id", "id", "text", n=3).collect()
    assert Counter(r.cluster_id for r in samples) == {0: 3, 1: 2, -1: 1, 2: 1}
    heads = keywords.cluster_heads(docs, "cluster_id", "id", "text", n=2).collect()
    assert sorted((r.cluster_id, r.id) for r in heads) == [(0, 1), (0, 2), (1, 4), (1, 5), (2, 7)]
    assert tuple(keywords.cluster_stats(docs, "cluster_id").first()) == (8, 3, 1)


def test_metrics(spark):
    rows = [(0, 0), (0, 0), (0, 1), (1, 1), (2, 0), (0, 9)]
    df = spark.createDataFrame(rows, "t int, p int")
    r = evaluate.classification_metrics(df, "t", "p").first()
    # f1 per class: 0 -> 4/7, 1 -> 2/3, 2 -> 0, 9 -> 0
    assert r.accuracy == pytest.approx(0.5) and r.f1 == pytest.approx((4 / 7 + 2 / 3) / 4)


def test_fold_summary_takes_the_earliest_best(spark):
    df = spark.createDataFrame([(0, 0.5, 0.5), (1, 0.7, 0.9), (2, 0.6, 0.9)], "fold int, accuracy double, f1 double")
    r = evaluate.fold_summary(df).first()
    assert r.best_fold == 1 and r.mean_accuracy == pytest.approx(0.6)
    assert r.std_f1 == pytest.approx(math.sqrt(((0.5 - 2.3 / 3) ** 2 + 2 * (0.9 - 2.3 / 3) ** 2) / 3))


def logit_frame(spark, *pairs):
    rows = [([math.log(p), math.log(1 - p)], [math.log(q), math.log(1 - q)], 0) for p, q in pairs]
    return spark.createDataFrame(rows, "a array<double>, b array<double>, y int")


def test_losses(spark):
    df = logit_frame(spark, (0.8, 0.6))
    a, b = evaluate.Logits("a", 2), evaluate.Logits("b", 2)
    df, y = b.attach(a.attach(df)), F.col("y")
    r = df.select(
        evaluate.focal_loss(a, y).alias("f1"),
        evaluate.focal_loss(a, y, 2.0).alias("f2"),
        evaluate.kl_divergence(b, a).alias("kl"),
        evaluate.cross_entropy(a, y).alias("ce"),
        evaluate.combined_objective(a, b, y).alias("all"),
    ).first()
    assert r.f1 == pytest.approx(0.008926, abs=1e-6) and r.f2 == pytest.approx(0.057839, abs=1e-6)
    assert r.kl == pytest.approx(0.104650, abs=1e-6) and r.ce == pytest.approx(-math.log(0.8))
    focal_b = (1 - 0.6) ** 2 * -math.log(0.6)
    assert r["all"] == pytest.approx((r.f1 + focal_b) / 2 + 0.5 * r.kl)
    top, div = evaluate.smoothed_ce_parts(a, y, [2.0, 1.0])
    s = df.select(top.alias("t"), div.alias("d")).first()
    assert s.d == 2.0
    assert s.t == pytest.approx(0.9 * 2 * -math.log(0.8) + 0.1 * (2 * -math.log(0.8) - math.log(0.2)) / 2)


def test_reductions(spark):
    df = spark.createDataFrame([(1.0,), (3.0,)], "l double")
    assert evaluate.reduce_loss(df, F.col("l")).first()[0] == 2.0
    assert evaluate.reduce_loss(df, F.col("l"), "sum").first()[0] == 4.0
    assert [r.loss for r in evaluate.reduce_loss(df, F.col("l"), "none").collect()] == [1.0, 3.0]


def test_distill_loss(spark):
    df = logit_frame(spark, (0.8, 0.6), (0.3, 0.3))
    r = evaluate.distill_loss("a", "b", "y", 2, df).first()

    def soft(p):
        x, y = math.sqrt(p), math.sqrt(1 - p)
        return x / (x + y), y / (x + y)

    kl = sum(
        sum(t * math.log(t / s) for t, s in zip(soft(q), soft(p))) for p, q in ((0.8, 0.6), (0.3, 0.3))
    ) / 2 * 4
    ce = -(math.log(0.8) + math.log(0.3)) / 2
    assert r.ce == pytest.approx(ce) and r.kl == pytest.approx(kl) and r.loss == pytest.approx((ce + kl) / 2)


def test_strategy_report_and_markdown(spark):
    runs = [("s1", "f1", 0.9), ("s1", "speed_ms", 10.0), ("s1", "size_mb", 3.0), ("s2", "f1", 0.8), ("s2", "speed_ms", 4.0), ("s2", "size_mb", 1.0), ("s2", "speed_ms", 6.0)]
    report = evaluate.strategy_report(spark.createDataFrame(runs, "strategy string, metric string, value double"))
    assert [(r.strategy, r.f1_per_ms) for r in report.orderBy("rank").collect()] == [("s2", 0.16), ("s1", 0.09)]
    text = evaluate.markdown(report.orderBy("rank").select("strategy", "f1"), 10)
    assert text.splitlines() == ["| strategy | f1 |", "| --- | --- |", "| s2 | 0.8 |", "| s1 | 0.9 |"]
    with pytest.raises(ValueError):
        evaluate.markdown(report, max_rows=1)
