import zlib

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from test_decontaminate import by_sql
from test_minhash import classes

import corpus_pipeline
from noticelens.llm import credentials, quality
from noticelens.session import shared_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        path = shared_path(spark, name)
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        kept.append((name, docs))
    return dict(kept)


def pairs(df):
    return sorted((r.doc_id, r.text) for r in df.collect())


def test_stages_and_columns(stages):
    names = list(stages)
    assert names == ["documents", "quality", "near_duplicates", "decontamination", "secrets", "sentencepiece"]
    for name in names[1:-1]:
        assert sorted(stages[name].columns) == sorted(stages["documents"].columns)


def test_quality_keeps_what_scores(spark, stages):
    docs = stages["documents"]
    forest = quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    want = [(r.doc_id, r.text) for r in docs.collect() if forest.score(quality.measures(_array(r.text)))[0] >= 0.3]
    assert pairs(stages["quality"]) == sorted(want)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    held = [i for i in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    kept = {i for i, _ in want}
    assert all((i in kept) == bool(labels[i]) for i in held)


def _array(text):
    import pyarrow as pa

    return pa.array([text])


def test_one_of_each_class(stages):
    rows = pairs(stages["quality"])
    keep = {i for i, _, c in classes(rows, 5) if i == c}
    assert pairs(stages["near_duplicates"]) == [r for r in rows if r[0] in keep or not r[1].split()]


def test_no_leaks(spark, stages):
    rows = pairs(stages["near_duplicates"])
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {r[0] for r in by_sql(rows, items) if not r[1]}
    assert pairs(stages["decontamination"]) == [r for r in rows if r[0] in clean]
    assert len(clean) < len(rows)


def test_secrets_are_masked(stages):
    before, after = dict(pairs(stages["decontamination"])), dict(pairs(stages["secrets"]))
    assert before.keys() == after.keys()
    marked = {i for i in before if before[i] != after[i]}
    hinted = {i for i, t in before.items() if any(__import__("re").search(k.pattern, t) for k in credentials.KINDS)}
    assert marked <= hinted and bool(marked) == bool(hinted)
    assert all(r.n_chars == len(r.text) for r in stages["secrets"].collect())


def test_pieces_are_those_of_the_library(stages):
    library = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = dict(pairs(stages["secrets"]))
    got = {r.doc_id: r.pieces for r in stages["sentencepiece"].collect()}
    assert got == {i: library.encode(t) for i, t in texts.items()}
