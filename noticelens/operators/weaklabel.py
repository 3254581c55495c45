"""Weak labelling end to end, and candidate prompts for a judge model."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from noticelens.fixed_values import (
    CONFIDENCE_THRESHOLD,
    ENSEMBLE_WEIGHTS,
    HARD_RULES,
    INPUT_ERROR,
    JUDGE_NOT_SET,
)
from noticelens.functions.judgement import candidate_line, judge_prompt, parse_judgement
from noticelens.functions.text import clean_light
from noticelens.operators.mapping import dept_match, label_info
from noticelens.operators.maxsim import (
    attach_vectors,
    ensemble_label,
    keyword_universe,
    top_labels,
)
from noticelens.operators.rules import apply_rules
from noticelens.operators.vectors import MAX_BLOCK_CELLS
from noticelens.session import lookup, shared_path, written
from noticelens.sources.tables import read_table


def weak_label(
    notices: DataFrame,
    keywords: DataFrame,
    kb: DataFrame,
    dept_map: DataFrame | None = None,
    rules: Sequence = HARD_RULES,
    channels: Sequence[str] = ("vec_a", "vec_b"),
    weights: Sequence[float] = ENSEMBLE_WEIGHTS,
    threshold: float = CONFIDENCE_THRESHOLD,
    text_col: str = "service_title",
    id_col: str = "id",
    max_cells: int = MAX_BLOCK_CELLS,
) -> DataFrame:
    """Rules first, the two-channel ensemble for the rest, then lookup and audit.

    ``kb`` holds label_id, final_label, div, dep. Rule rows have confidence 1.0
    and no model scores; model rows keep confidence 0.0 and carry their score in
    final_ensemble_score. It is one pass over the notices: rule rows ride along
    without their vectors, so nothing is scored for them.
    """
    ruled = _ruled(notices, text_col, rules)
    options = (channels, weights, threshold, max_cells, id_col)
    return _label_rest(ruled, keywords, kb, dept_map, *options)


def _ruled(notices: DataFrame, text_col: str, rules: Sequence) -> DataFrame:
    cleaned = notices.withColumn("service_title_cleaned", clean_light(F.col(text_col)))
    return apply_rules(cleaned, "service_title_cleaned", rules)


def _label_rest(
    ruled, keywords, kb, dept_map, channels, weights, threshold, max_cells, id_col
) -> DataFrame:
    by_rule = F.col("rule_label").isNotNull()
    rest = ruled.withColumns({c: F.when(~by_rule, F.col(c)) for c in channels})
    labels = kb.select("label_id", F.col("final_label").alias("label"))
    scored = ensemble_label(rest, keywords, labels, channels, weights, threshold, max_cells, id_col)
    merged = scored.withColumns(
        {
            "predicted_label": F.coalesce("rule_label", "predicted_label"),
            "status": F.when(by_rule, F.col("rule_status")).otherwise(F.col("status")),
            "confidence_score": F.when(by_rule, 1.0).otherwise(0.0),
        }
    ).drop("rule_label", "rule_status")
    return dept_match(label_info(merged, kb), dept_map)


def weak_label_texts(
    notices: DataFrame,
    kb: DataFrame,
    encode: Callable[[DataFrame, str], DataFrame],
    dept_map: DataFrame | None = None,
    rules: Sequence = HARD_RULES,
    weights: Sequence[float] = ENSEMBLE_WEIGHTS,
    threshold: float = CONFIDENCE_THRESHOLD,
    text_col: str = "service_title",
    id_col: str = "id",
    max_cells: int = MAX_BLOCK_CELLS,
    null_as_nan: bool = False,
) -> DataFrame:
    """``weak_label`` from plain texts: titles and keywords go through the same encoder.

    ``encode(df, column)`` adds the channel columns vec_a and vec_b. Each distinct
    keyword is encoded once, and of the titles only those no rule has labelled; the
    others reach the encoder as null. ``kb`` also holds a comma list ``keywords``.
    """
    channels = ("vec_a", "vec_b")
    words = encode(keyword_universe(kb, null_as_nan), "keyword")
    vectors = attach_vectors(kb, words.select("keyword", *channels), null_as_nan)
    ruled = _ruled(notices, text_col, rules)
    open_title = F.when(F.col("rule_label").isNull(), F.col("service_title_cleaned"))
    encoded = encode(ruled.withColumn("_open", open_title), "_open").drop("_open")
    options = (channels, weights, threshold, max_cells, id_col)
    return _label_rest(encoded, vectors, kb, dept_map, *options)


def value_summary(df: DataFrame, col: str, name: str, count: str = "count") -> DataFrame:
    """Non-null values with their counts, most frequent first."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias(name))
    return counts.agg(F.count(F.lit(1)).alias(count)).orderBy(F.desc(count), name)


def candidates(
    notices: DataFrame,
    kb: DataFrame,
    top_n: int = 5,
    text_col: str = "service_title",
    vec_col: str = "embedding",
    max_cells: int = MAX_BLOCK_CELLS,
    id_col: str = "id",
) -> DataFrame:
    """Adds the candidate block and the prompt; an empty title gets neither but an error label.

    ``kb`` holds label_id, label, keywords_str and a vector column of the same name.
    """
    lines = kb.withColumn("line", candidate_line(F.col("label"), F.col("keywords_str")))
    found = top_labels(notices, lines, top_n, vec_col, True, max_cells, id_col)
    ok = F.coalesce(F.col(text_col) != "", F.lit(False))
    block = F.when(ok, F.array_join(F.transform("top", lambda t: t["line"]), "\n"))
    return found.withColumns(
        {
            "error_label": F.when(~ok, INPUT_ERROR),
            "candidates": block,
            "prompt": judge_prompt(F.col(text_col), block),
        }
    ).drop("top")


def judge(
    prompts: DataFrame,
    client_factory: Callable[[], Callable[[str], str]] | None,
    pause: float = 0.0,
    store: str | None = None,
    attempts: int = 1,
    wave: int = 10_000,
) -> DataFrame:
    """Ask a caller-supplied client once per distinct prompt and parse its replies.

    Replies are kept by the prompt's content in the folder ``store``, in waves of about
    ``wave`` prompts, each committed before the next one starts. A run that was killed goes
    on with the prompts that have no reply yet, and later runs never ask the same again; only
    what was under way in the last wave is asked anew. Without ``store`` a fresh folder is used.

    The factory runs once per task; ``pause`` limits the rate per task and doubles with every
    further one of the ``attempts``. A prompt whose calls all fail has no stored reply: it counts
    as a classification error in this run, and the next run asks it again.
    """
    if client_factory is None:
        replies = prompts.withColumn("response", F.lit(None).cast("string"))
    else:
        spark = prompts.sparkSession
        store = store or shared_path(spark, "replies")
        _ask(prompts, client_factory, pause, store, attempts, wave)
        known = _stored_replies(spark, store).groupBy("asked").agg(F.min("response").alias("response"))
        replies = lookup(prompts.withColumn("asked", prompt_key("prompt")), known, ["asked"], "left").drop("asked")
    parsed = parse_judgement(F.coalesce("response", F.lit("")))
    error = F.col("error_label")
    not_set = F.lit(JUDGE_NOT_SET if client_factory is None else None)
    return replies.withColumn("_j", parsed).withColumns(
        {
            "predicted_label": F.coalesce(error, not_set, F.col("_j.label")),
            "reasoning": F.when(error.isNotNull(), "empty_title")
            .when(not_set.isNotNull(), "no_client")
            .otherwise(F.col("_j.reason")),
        }
    ).drop("_j", "error_label")


def prompt_key(prompt: str):
    return F.sha2(F.col(prompt), 256)


def _stored_replies(spark: SparkSession, store: str) -> DataFrame:
    schema = T.StructType.fromDDL("asked string, response string")
    return read_table(spark, store, schema, missing="empty")


def _ask(prompts: DataFrame, client_factory, pause: float, store: str, attempts: int, wave: int) -> None:
    """Fill the store with a reply for every prompt that has none."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client = client_factory()

        def one(prompt: str) -> str | None:
            for attempt in range(attempts):
                try:
                    return client(prompt)
                except Exception:
                    pass
                finally:
                    time.sleep(pause * 2**attempt)
            return None

        for batch in batches:
            replies = pa.array([one(p) for p in batch.column(1).to_pylist()], pa.string())
            answered = pa.RecordBatch.from_arrays([batch.column(0), replies], names=["asked", "response"])
            yield answered.filter(replies.is_valid())

    distinct = prompts.filter(F.col("prompt").isNotNull()).groupBy(prompt_key("prompt").alias("asked")).agg(
        F.min("prompt").alias("prompt")
    )
    open_ = written(distinct.join(_stored_replies(prompts.sparkSession, store), "asked", "left_anti"), "open")
    waves = -(-open_.count() // wave)
    for n in range(waves):
        # The key is a hash in hexadecimal, so any of its digits deal evenly.
        part = open_.filter(F.conv(F.substring("asked", 1, 8), 16, 10).cast("long") % waves == n)
        part.repartition("asked").mapInArrow(ask, "asked string, response string").write.mode("append").parquet(store)
