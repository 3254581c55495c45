import zlib

import numpy as np
import pytest
from helpers import ODD, docs_frame, prose

from noticelens.llm import quality

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def forest(spark):
    return quality.fit(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))


def test_held_out_accuracy(spark, forest):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    scores = {r.doc_id: r.score for r in quality.score(docs, forest).collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    held = [r for r in labels if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    right = [(scores[r.doc_id] >= quality.THRESHOLD) == bool(r.quality) for r in held]
    assert len(right) > 30 and sum(right) / len(right) > 0.97


def test_walk_equals_node_by_node(forest):
    rows = np.random.default_rng(1).random((50, len(quality.FEATURES))) * 5

    def one(row):
        margin = forest.base
        for feature, cut, leaf in zip(forest.feature, forest.cut, forest.leaf):
            node = 0
            while node < len(cut):
                node = 2 * node + 1 + int(row[feature[node]] > cut[node])
            margin += leaf[node - len(cut)]
        return 1 / (1 + np.exp(-margin))

    assert np.allclose(forest.score(rows), [one(r) for r in rows])


def test_odd_rows_and_columns(spark, forest):
    df = docs_frame(spark, [*ODD, (60, prose(1, 80)), (60, prose(1, 80))])
    got = quality.score(df, forest).collect()
    assert len(got) == df.count() and all(0 <= r.score <= 1 for r in got)
    twice = [r.score for r in got if r.doc_id == 60]
    assert twice[0] == twice[1]
    kept = quality.keep(df, forest)
    assert kept.columns == df.columns and 0 < kept.count() <= df.count()
    empty = df.limit(0)
    assert quality.score(empty, forest).count() == 0


def test_without_labels_and_with_conflicting_ones(spark):
    df = docs_frame(spark, [(n, prose(n, 30)) for n in range(20)])
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality.score(df, quality.fit(df, none)).collect()} == {0.5}
    both = spark.createDataFrame([(n, q) for n in range(20) for q in (0, 1, None)], "doc_id long, quality int")
    scores = [r.score for r in quality.score(df, quality.fit(df, both)).collect()]
    assert all(abs(s - 0.5) < 1e-9 for s in scores)


def test_sample_is_bounded_and_leaves_out_the_fold(spark):
    labels = spark.range(5000).selectExpr("id as doc_id", "1 as quality")
    rows = quality.labelled_sample(labels, "doc_id", "quality", 500).collect()
    assert 350 < len(rows) < 650
    assert all(zlib.crc32(str(r._id).encode()) % 5 != 0 for r in rows)
