import hashlib

import pytest
from pyspark.sql import functions as F

from noticelens.operators import classes
from noticelens.operators.ranking import dense_index, seeded_rank, seeded_sample, top_n
from noticelens.session import lookup


def order(key, seed=42):
    return hashlib.md5(f"{seed}:{key}".encode()).hexdigest(), key


@pytest.fixture(scope="module")
def skewed(spark):
    """Three labels; the first holds most rows, one row has none."""
    rows = [(n, "hot" if n % 5 else f"l{n % 3}") for n in range(2000)] + [(2000, None)]
    return spark.createDataFrame(rows, "id bigint, label string")


def test_seeded_rank_is_the_plain_rank(spark, skewed):
    got = {r.id: (r.label, r["rank"]) for r in seeded_rank(skewed, ["label"], F.col("id")).collect()}
    groups = {}
    for r in skewed.collect():
        groups.setdefault(r.label, []).append(r.id)
    expected = {
        k: (label, n + 1)
        for label, keys in groups.items()
        for n, k in enumerate(sorted(keys, key=order))
    }
    assert got == expected


def test_folds_are_even_per_class(spark, skewed):
    folds = classes.stratified_folds(skewed, "id", k=5).groupBy("label", "fold").count().collect()
    for label in {r.label for r in folds}:
        sizes = [r["count"] for r in folds if r.label == label]
        assert max(sizes) - min(sizes) <= 1 or len(sizes) < 5


@pytest.mark.parametrize("n", [0, 1, 7, 500, 2000, 2001, 5000])
@pytest.mark.parametrize("few", [100_000, 1])
def test_seeded_sample_is_exact(spark, skewed, n, few):
    got = {r.id for r in seeded_sample(skewed, n, F.col("id"), slice_rows=few).collect()}
    assert got == set(sorted(range(2001), key=order)[:n])


def test_sample_does_not_depend_on_partitions(spark, skewed):
    samples = [
        sorted(r.id for r in seeded_sample(skewed.repartition(p), 100, F.col("id")).collect())
        for p in (1, 3, 17)
    ]
    assert samples[0] == samples[1] == samples[2]


def test_top_n_equals_plain_window(spark):
    rows = [("hot" if n % 4 else "cold", n, n * 7919 % 101) for n in range(1000)]
    df = spark.createDataFrame(rows, "g string, id int, v int")
    got = top_n(df, ["g"], [F.desc("v"), F.asc("id")], 9, F.col("id"), salts=8).collect()
    for g in ("hot", "cold"):
        expected = sorted([r for r in rows if r[0] == g], key=lambda r: (-r[2], r[1]))[:9]
        assert [(r.id) for r in sorted(got, key=lambda r: r["rank"]) if r.g == g] == [e[1] for e in expected]


def test_dense_index(spark):
    df = spark.createDataFrame([(f"l{n % 37:03}",) for n in range(500)], "label string").repartition(9)
    got = {r.label: r["index"] for r in dense_index(df, "label").collect()}
    assert got == {f"l{n:03}": n for n in range(37)}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_large_lookup_salts_to_the_same_rows(spark, skewed, how):
    table = spark.createDataFrame([("hot", 1), ("l0", 2)], "label string, v int")
    small = lookup(skewed, table, ["label"], how)
    salted = lookup(skewed, table, ["label"], how, max_rows=0)
    assert sorted(map(str, small.collect())) == sorted(map(str, salted.collect()))


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 2, "label int")
    got = {r.label: r.weight for r in classes.class_weights(df, mode="auto").collect()}
    assert got == {0: 8 / 12, 1: 2.0}
    even = spark.createDataFrame([(0,), (1,)], "label int")
    assert {r.weight for r in classes.class_weights(even, mode="auto").collect()} == {1.0}
    single = spark.createDataFrame([(1,)], "label int")
    assert classes.class_weights(single, mode="auto").first().weight == 1.0


def test_prepare_multiclass_counts_before_dropping_nulls(spark):
    rows = [("a", "x")] * 19 + [(None, "x")] + [("b", "y")] * 19 + [("c", None)] * 30
    df = spark.createDataFrame(rows, "t string, l string")
    got = classes.prepare_multiclass(df, "t", "l", min_count=20)
    assert {(r.label, r.label_id) for r in got.collect()} == {("x", 0)} and got.count() == 19


def test_balanced_dataset(spark):
    pos = spark.createDataFrame([(n, f"p{n} (x)") for n in range(50)] + [(99, "both")], "k bigint, notice_name string")
    neg = spark.createDataFrame([(n, f"n{n}") for n in range(20)] + [(98, "both"), (97, "  ")], "k bigint, notice_name string")
    got = classes.balanced_dataset(pos, neg, "k", "k").collect()
    titles = [r.service_title for r in got]
    assert len(set(titles)) == len(titles) and "" not in titles
    picked = sorted(list(range(50)) + [99], key=order)[:22]
    expected = {"both" if k == 99 else f"p{k} x" for k in picked}
    assert {r.service_title for r in got if r.label == 1} == expected
    assert titles == sorted(titles, key=lambda t: order(t))
