"""Cleaning, class preparation, folds and sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticelens.functions.text import clean_light, clean_title, keyword_list, token_window, word_tokens
from noticelens.operators import classes
from noticelens.plans import inputs as i
from noticelens.plans.registry import query
from noticelens.session import shared_path
from noticelens.sources.csvdir import UTF8_FIRST, read_csv_dir


@query(
    "eligible_titles",
    "SELECT DISTINCT text AS notice_name FROM documents WHERE source = 'src3'",
)
def eligible_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = i.table(spark, sf_dir, "documents").withColumnsRenamed(
        {"text": "notice_name", "source": "bid_company_name"}
    )
    return classes.eligible_titles(docs, "src3")


@query(
    "title_clean",
    f"WITH {i.SQL_RAW_TEXTS} SELECT kind, id, {i.sql_strong('raw')} AS title FROM raw_texts",
)
def title_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return i.raw_texts(spark, sf_dir).select("kind", "id", clean_title(F.col("raw")).alias("title"))


@query(
    "title_light_clean",
    f"WITH {i.SQL_RAW_TEXTS} SELECT kind, id, {i.sql_light('raw')} AS title FROM raw_texts",
)
def title_light_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return i.raw_texts(spark, sf_dir).select("kind", "id", clean_light(F.col("raw")).alias("title"))


SQL_BALANCED_SET = f"""WITH d AS (SELECT doc_id, text, quality FROM documents JOIN labels USING (doc_id)),
    sides AS (
      SELECT 1 AS label, text, max(doc_id) AS k FROM d WHERE quality = 1 GROUP BY text
      UNION ALL SELECT 0, text, doc_id FROM d WHERE quality = 0),
    n AS (SELECT min(c) AS n FROM (SELECT count(*) AS c FROM sides GROUP BY label)),
    picked AS (
      SELECT label, text, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || k), k) AS r
      FROM sides),
    cleaned AS (
      SELECT label, {i.sql_strong('text')} AS service_title FROM picked WHERE r <= (SELECT n FROM n))
    SELECT service_title, max(label) AS label FROM cleaned
    WHERE service_title <> '' GROUP BY service_title"""


@query("balanced_dataset", SQL_BALANCED_SET)
def balanced_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = i.labelled_documents(spark, sf_dir).select(
        "doc_id", F.col("text").alias("notice_name"), "quality"
    )
    pos = docs.filter("quality = 1").groupBy("notice_name").agg(F.max("doc_id").alias("doc_id"))
    neg = docs.filter("quality = 0")
    return classes.balanced_dataset(pos, neg, "doc_id", "doc_id")


@query(
    "class_distribution",
    """SELECT quality AS label, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share
    FROM labels GROUP BY quality""",
)
def class_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = i.table(spark, sf_dir, "labels").select(F.col("quality").alias("label"))
    dist = classes.class_distribution(labels)
    return dist.withColumn("share", F.round("share", 6))


@query(
    "class_weights",
    """WITH c AS (SELECT quality AS label, count(*) AS n FROM labels GROUP BY quality),
    t AS (SELECT sum(n) AS total, count(*) AS k,
                 coalesce(sum(n) FILTER (label = 0), 0) / sum(n) AS p0,
                 coalesce(sum(n) FILTER (label = 1), 0) / sum(n) AS p1 FROM c)
    SELECT label, n, round(n / total, 6) AS share,
           round(CASE WHEN abs(p0 - p1) > 0.1 THEN total / (k * n) ELSE 1.0 END, 6) AS weight
    FROM c, t""",
)
def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = i.table(spark, sf_dir, "labels").select(F.col("quality").alias("label"))
    weights = classes.class_weights(labels, mode="auto")
    return weights.withColumns({"share": F.round("share", 6), "weight": F.round("weight", 6)})


@query(
    "rare_class_filter",
    """SELECT vec_id, label FROM embeddings
    WHERE label IN (SELECT label FROM embeddings GROUP BY label HAVING count(*) >= 50)""",
)
def rare_class_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = i.table(spark, sf_dir, "embeddings").select("vec_id", "label")
    return classes.keep_common_classes(rows, min_count=50).select("vec_id", "label")


@query(
    "label_encode",
    """SELECT p_partkey, p_brand,
              CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS INTEGER) AS label_id FROM part""",
)
def label_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = i.table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return classes.encode_labels(rows, "p_brand").select("p_partkey", "p_brand", "label_id")


SQL_FOLDS = """folds AS (
  SELECT vec_id AS id, label,
         CAST((row_number() OVER (PARTITION BY label ORDER BY md5('42:' || vec_id), vec_id) - 1) % 5
              AS INTEGER) AS fold
  FROM embeddings)"""


@query("stratified_folds", f"WITH {SQL_FOLDS} SELECT id, label, fold FROM folds")
def stratified_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = i.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "label")
    return classes.stratified_folds(rows, "id").select("id", "label", "fold")


@query(
    "keyword_parse",
    rf"""SELECT keyword, count(*) AS n_uses, count(DISTINCT doc_id) AS n_docs FROM (
      SELECT doc_id, regexp_replace(unnest(string_split(text, ',')),
             '^{i.SQL_SPACE}|{i.SQL_SPACE}$', '', 'g') AS keyword FROM documents)
    WHERE keyword <> '' GROUP BY keyword""",
)
def keyword_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = keyword_list(F.col("text"))

    def counted(keywords, uses: int, docs: int):
        return F.transform(
            keywords, lambda k: F.struct(k.alias("k"), F.lit(uses).alias("u"), F.lit(docs).alias("d"))
        )

    # Every use and every distinct keyword of a text, so one shuffle counts both.
    both = F.concat(counted(words, 1, 0), counted(F.array_distinct(words), 0, 1))
    rows = i.table(spark, sf_dir, "documents").select(F.explode(both).alias("r"))
    return rows.groupBy(F.col("r.k").alias("keyword")).agg(
        F.sum("r.u").alias("n_uses"), F.sum("r.d").alias("n_docs")
    )


@query(
    "token_window",
    r"""WITH t AS (
      SELECT conv_id, turn, regexp_extract_all(lower(text), '([\p{L}\p{N}_]{1,})', 1) AS tokens
      FROM conversations),
    w AS (SELECT conv_id, turn, tokens[1:128] AS cut FROM t)
    SELECT conv_id, turn, array_to_string(cut || list_transform(range(128 - len(cut)), lambda x: '[PAD]'), ' ') AS tokens,
           CAST(len(cut) AS BIGINT) AS n_tokens FROM w""",
)
def window_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = i.table(spark, sf_dir, "conversations")
    window = token_window(word_tokens(F.col("text"), (), 1), 128)
    return rows.select("conv_id", "turn", window.alias("w")).select(
        "conv_id",
        "turn",
        F.array_join("w.tokens", " ").alias("tokens"),
        F.aggregate("w.mask", F.lit(0).cast("bigint"), lambda a, m: a + m).alias("n_tokens"),
    )


# A suffix per encoding; the last syllable exists in CP949 but not in EUC-KR.
CSV_ENCODINGS = [("UTF-8", " 공고 é"), ("EUC-KR", " 공고"), ("x-windows-949", " 공고 똠")]


@query(
    "src_csv_fallback",
    f"""SELECT p_name || {i.sql_pick([s for _, s in CSV_ENCODINGS], 'p_partkey % 3')}
               || ' ' || p_partkey AS notice_name, p_brand AS bid_company_name FROM part""",
)
def src_csv_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the table as CSV files of three encodings, then read the folder back."""
    suffix = i.pick([s for _, s in CSV_ENCODINGS], F.col("p_partkey") % 3)
    rows = i.table(spark, sf_dir, "part").select(
        (F.col("p_partkey") % 3).alias("kind"),
        F.concat("p_name", suffix, F.lit(" "), F.col("p_partkey")).alias("notice_name"),
        F.col("p_brand").alias("bid_company_name"),
    )
    folders = []
    flag = "spark.sql.legacy.javaCharsets"
    before = spark.conf.get(flag)
    # Only writing needs the flag; the reader under test decodes without it.
    spark.conf.set(flag, "true")
    try:
        for kind, (encoding, _) in enumerate(CSV_ENCODINGS):
            folders.append(shared_path(spark, "csv"))
            part = rows.filter(F.col("kind") == kind).drop("kind")
            part.write.options(header=True, encoding=encoding).csv(folders[-1])
    finally:
        spark.conf.set(flag, before)
    parts = [
        read_csv_dir(spark, folder, UTF8_FIRST, require=["notice_name", "bid_company_name"])
        for folder in folders
    ]
    return reduce(DataFrame.unionByName, parts)
