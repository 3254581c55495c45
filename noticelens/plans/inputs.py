"""Inputs that the catalogue derives from the given tables, in Spark and in SQL."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noticelens.fixed_values import CODE_ROLLUP, TAXONOMY
from noticelens.operators.maxsim import attach_vectors
from noticelens.operators.vectors import group_means
from noticelens.sources.tables import mapping_rows

# Title phrases, picked by id; some fire a rule, some do not.
PHRASES = [
    "pipe 3cm supply",
    "SUPERVISION safety_check",
    "safety_check",
    "harbor dam safety_inspection",
    "dam railway safety_inspection",
    "pier performance_assessment",
    "transportation safety_inspection",
    "impact_assessment",
    "disaster power impact_assessment",
    "transportation impact_assessment",
    "technical_inspection",
    "soil_pollution survey",
    "disaster_protection works",
    "seismic_performance_assessment",
    "road design",
    "plain notice",
    "river plan",
]
# Knowledge base (label_id, label, Keyword_1, Keyword_2, div, dep);
# the last label has no keyword vectors.
KNOWLEDGE_BASE = [
    (0, "road_design", "road, ring road", "pavement", "road", "BUILDING, MACHINERY"),
    (1, "structural_design", "girder", None, "structural", "BUILDING"),
    (2, "railway_design", "track, rail", "station", "railway", "MACHINERY"),
    (3, "harbor_design", "quay", "breakwater, berth", "harbor", "FURNITURE"),
    (4, "water_supply_design", "pipe network", None, "water_environment", "HOUSEHOLD"),
    (5, "soil_survey", "boring", "soil", "geotechnical", "AUTOMOBILE, FURNITURE"),
    (6, "hydropower_design", "turbine", "dam", "hydropower", "AUTOMOBILE"),
    (7, "architectural_design", "floor plan", "facade", "architecture", "BUILDING, HOUSEHOLD"),
    (8, "environmental_design", "wetland", None, "environmental_assessment", "MACHINERY"),
    (9, "construction_management", "site", "schedule", "construction_management", "FURNITURE"),
    (10, "landscape_forestry_design", None, None, "landscape", "HOUSEHOLD"),
]
# Raw department -> standard department.
DEPT_MAP = {"HOUSEHOLD": "BUILDING", "AUTOMOBILE": "MACHINERY"}

KEYWORDS_PER_LABEL = 5
THRESHOLD = 0.30
SCORED_LABELS = sorted({label for labels in TAXONOMY.values() for label in labels})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sql_text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def pick(values: list[str | None], index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def sql_pick(values: list[str | None], index: str) -> str:
    return f"list_extract([{', '.join(sql_text(v) for v in values)}], CAST({index} AS INTEGER) + 1)"


def phrase(key: str) -> Column:
    return pick(PHRASES, F.col(key) % len(PHRASES))


def sql_phrase(key: str) -> str:
    return sql_pick(PHRASES, f"{key} % {len(PHRASES)}")


# Raw texts: page titles with entities, and whole documents.
PAGE_TITLE = "<title>(.*?)</title>"


def raw_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.regexp_extract("html", PAGE_TITLE, 1)
    pages = table(spark, sf_dir, "pages").select(
        F.lit("page").alias("kind"), F.col("page_id").alias("id"), title.alias("raw")
    )
    docs = table(spark, sf_dir, "documents").select(
        F.lit("document").alias("kind"), F.col("doc_id").alias("id"), F.col("text").alias("raw")
    )
    return pages.unionByName(docs)


SQL_RAW_TEXTS = f"""raw_texts AS (
  SELECT 'page' AS kind, page_id AS id, regexp_extract(html, '{PAGE_TITLE}', 1) AS raw FROM pages
  UNION ALL SELECT 'document', doc_id, text FROM documents)"""

SQL_SPACE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]+"


def sql_entities(expr: str) -> str:
    """The entities that occur in the given tables; the ampersand comes last."""
    expr = f"coalesce({expr}, '')"
    for entity, char in (("quot", '"'), ("copy", "©"), ("middot", "·")):
        expr = f"regexp_replace({expr}, '&{entity};?', '{char}', 'g')"
    return f"regexp_replace({expr}, '&amp;?', '&', 'g')"


def sql_light(expr: str) -> str:
    return f"trim(regexp_replace({sql_entities(expr)}, '{SQL_SPACE}', ' ', 'g'))"


def sql_strong(expr: str) -> str:
    text = sql_entities(expr)
    bracket = r"[\(\[]([^\n]+?)[\)\]]"
    body = f"regexp_replace({text}, '{bracket}', ' ', 'g')"
    body = f"regexp_replace(replace({body}, '/', ' '), '[:#´'']', '', 'g')"
    inner = f"array_to_string(regexp_extract_all({text}, '{bracket}', 1), ' ')"
    return f"trim(regexp_replace({body} || ' ' || {inner}, '{SQL_SPACE}', ' ', 'g'))"


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")


def rule_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.concat_ws(" ", phrase("p_partkey"), "p_name")
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), title.alias("title"))


SQL_RULE_TITLES = (
    f"rule_titles AS (SELECT p_partkey AS id, {sql_phrase('p_partkey')} || ' ' || p_name AS title"
    " FROM part)"
)


# Vectors. Channel a is the embedding; channel b bends every cell by x * |x|.
def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    def bend(x: Column) -> Column:
        x = x.cast("double")
        return x * F.abs(x)

    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"),
        "label",
        F.col("embedding").alias("vec_a"),
        F.transform("embedding", bend).alias("vec_b"),
    )


def kb_keywords(spark: SparkSession) -> DataFrame:
    """Keyword lists of the knowledge base; keyword ``3:1`` is the second one of label 3."""
    rows = [
        (row[0], ", ".join(f"{row[0]}:{n}" for n in range(KEYWORDS_PER_LABEL)) if row[2] else None)
        for row in KNOWLEDGE_BASE
    ]
    return spark.createDataFrame(rows, "label_id bigint, keywords string")


def keyword_vectors(spark: SparkSession, vecs: DataFrame) -> DataFrame:
    """A vector per keyword, the mean of all vectors of its label in one id residue."""
    name = F.concat_ws(":", F.col("label").cast("string"), (F.col("id") % KEYWORDS_PER_LABEL).cast("string"))
    keyed = vecs.select(name.alias("keyword"), "vec_a", "vec_b")
    means = group_means(keyed, ["keyword"], ["vec_a", "vec_b"])
    return attach_vectors(kb_keywords(spark), means)


def label_vectors(vecs: DataFrame) -> DataFrame:
    means = group_means(
        vecs.select(F.col("label").cast("bigint").alias("label_id"), F.col("vec_a").alias("embedding")),
        ["label_id"],
        ["embedding"],
    )
    return means


def knowledge_base(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        KNOWLEDGE_BASE,
        "label_id bigint, final_label string, Keyword_1 string, Keyword_2 string, div string, dep string",
    )


def kb_labels(spark: SparkSession) -> DataFrame:
    return knowledge_base(spark).select("label_id", F.col("final_label").alias("label"))


SQL_KB = (
    "kb(label_id, final_label, keyword_1, keyword_2, div, dep) AS (VALUES "
    + ", ".join(f"({row[0]}, {', '.join(sql_text(v) for v in row[1:])})" for row in KNOWLEDGE_BASE)
    + ")"
)

SQL_VECTORS = """e AS (
  SELECT vec_id AS id, label, embedding::DOUBLE[] AS a,
         list_transform(embedding::DOUBLE[], lambda x: x * abs(x)) AS b
  FROM embeddings)"""

SQL_KEYWORDS = f"""kw AS (
  SELECT label_id, keyword_id, list(ma ORDER BY i) AS a, list(mb ORDER BY i) AS b
  FROM (SELECT label AS label_id, id % {KEYWORDS_PER_LABEL} AS keyword_id, i,
               avg(a[i]) AS ma, avg(b[i]) AS mb
        FROM e, range(1, 65) t(i) GROUP BY label, id % {KEYWORDS_PER_LABEL}, i)
  GROUP BY label_id, keyword_id)"""

SQL_CENTROIDS = """c AS (
  SELECT label_id, list(m ORDER BY i) AS v
  FROM (SELECT label AS label_id, i, avg(a[i]) AS m FROM e, range(1, 65) t(i) GROUP BY label, i)
  GROUP BY label_id)"""

SQL_SCORES = """scores AS (
  SELECT e.id, kb.label_id, kb.final_label AS label,
         round(coalesce(max(list_cosine_similarity(e.a, kw.a)), 0.0), 12) AS sa,
         round(coalesce(max(list_cosine_similarity(e.b, kw.b)), 0.0), 12) AS sb
  FROM e CROSS JOIN kb LEFT JOIN kw ON kw.label_id = kb.label_id
  GROUP BY e.id, kb.label_id, kb.final_label)"""

SQL_ENSEMBLE = """best AS (
  SELECT id, arg_max(label, {'s': round(0.9 * sa + 0.1 * sb, 12), 'l': -label_id}) AS predicted_label,
         max(round(0.9 * sa + 0.1 * sb, 12)) AS score, max(sa) AS score_a, max(sb) AS score_b
  FROM scores GROUP BY id)"""


CELLS = 64


def _folded(k: int, step: int) -> list[list[int]]:
    """Which cells each of ``k`` logits is the sum of; every cell counts for one."""
    return [[n for n in range(CELLS) if n * step % k == j] for j in range(k)]


def logits(name: str, k: int, step: int = 1) -> Column:
    """Logits of the whole embedding, folded to ``k`` sums of cells and scaled by 10."""
    def cell(n: int) -> Column:
        return F.get("embedding", F.lit(n)).cast("double")

    values = [reduce(Column.__add__, map(cell, group)) * 10.0 for group in _folded(k, step)]
    return F.array(*values).alias(name)


def sql_logits(k: int, step: int = 1, col: str = "embedding") -> str:
    sums = (" + ".join(f"{col}[{n + 1}]::DOUBLE" for n in group) for group in _folded(k, step))
    return "[" + ", ".join(f"({s}) * 10.0::DOUBLE" for s in sums) + "]"


def dept_mapping(spark: SparkSession) -> DataFrame:
    return json_mapping(spark, DEPT_MAP, "string")


def json_mapping(spark: SparkSession, mapping: dict, value: str) -> DataFrame:
    return mapping_rows(spark.createDataFrame([(json.dumps(mapping),)], "body string"), "body", value)


def code_mapping(spark: SparkSession) -> DataFrame:
    return json_mapping(spark, CODE_ROLLUP, "string")


def taxonomy_mapping(spark: SparkSession) -> DataFrame:
    return json_mapping(spark, TAXONOMY, "array")


def sql_pairs(name: str, pairs: list[tuple[str, str]]) -> str:
    rows = ", ".join(f"({sql_text(k)}, {sql_text(v)})" for k, v in pairs)
    return f"{name}(key, value) AS (VALUES {rows})"


# Clusters: the number in documents.source, shifted so that src0 plays the noise.
def clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.regexp_extract("source", r"(\d+)", 1).cast("int") - 1
    return table(spark, sf_dir, "documents").select("doc_id", number.alias("cluster_id"), "text")


SQL_CLUSTERED = r"""clustered AS (
  SELECT doc_id, CAST(regexp_extract(source, '(\d+)', 1) AS INTEGER) - 1 AS cluster_id, text
  FROM documents)"""
