"""One query per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticelens.llm import (
    credentials,
    decontaminate,
    extract,
    hmm,
    idfiles,
    licences,
    minhash,
    mtree,
    pieces,
    prefix_trie,
    quality,
    spelling,
    spotsigs,
    sql,
)
from noticelens.llm.common import id_remainder, read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {
    "op5_top_k": sql.TOP_K,
    "op8_secrets": sql.SECRETS,
    "op9_decontamination": sql.DECONTAMINATION,
    "op11_spelling": sql.SPELLING,
    "op12_prefix_trie": sql.PREFIX_TRIE,
    "op13_spotsigs": sql.FINGERPRINTS,
}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def piece_model() -> bytes:
    """The model file of the encoder; another one is a matter of its path."""
    import public_tokenizers

    return pieces.read_model(public_tokenizers.path("piece_bpe_32k.model"))


@query
def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every text, decoded again: their number, checksum and the way back."""
    docs, model = read(spark, sf_dir, "documents"), piece_model()
    return pieces.round_trip(docs, model)


@query
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    forest = quality.fit(docs, read(spark, sf_dir, "labels"))
    return quality.score(docs, forest).select(
        "doc_id",
        (id_remainder("doc_id") == 0).alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


@query
def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(read(spark, sf_dir, "documents"), width=2, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query
def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credentials.report(read(spark, sf_dir, "documents"))


@query
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return decontaminate.judged(docs, decontaminate.leaks(docs, read(spark, sf_dir, "benchmark")))


@query
def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        tokenizer = file.read()
    path = idfiles.written_path(spark)
    idfiles.write_ids(read(spark, sf_dir, "documents"), path, tokenizer)
    return idfiles.read_ids(spark, path)


@query
def op6_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(read(spark, sf_dir, "documents"))


@query
def op3_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(read(spark, sf_dir, "pages"))


@query
def op5_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree.top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query
def op2_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = id_remainder("doc_id") == 1
    return hmm.score(read(spark, sf_dir, "documents"), held_out=held_out)


@query
def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.vocabulary(read(spark, sf_dir, "documents")))


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(prefix_trie.branched(read(spark, sf_dir, "conversations")))


@query
def op13_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.report(read(spark, sf_dir, "documents"))
