"""Rules, max-similarity, ensemble, lookups and judge queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticelens.fixed_values import CODE_ROLLUP, HARD_RULES, TAXONOMY
from noticelens.functions.judgement import parse_judgement
from noticelens.functions.text import clean_light, join_keyword_columns, word_tokens
from noticelens.operators import encoders, mapping, maxsim, rules, weaklabel
from noticelens.operators.ranking import dense_index, top_n
from noticelens.plans import inputs as i
from noticelens.plans.registry import query
from noticelens.session import shared_path
from noticelens.sources.tables import read_sheet, write_book


def _sql_rules(text: str, what: str) -> str:
    cases = []
    for status, trigger, label, overrides in HARD_RULES:
        value = f"'{status}'"
        if what == "label":
            tests = "".join(
                f" WHEN regexp_matches({text}, '(?i){p}') THEN '{other}'"
                for p, other in reversed(overrides)
            )
            value = f"CASE{tests} ELSE '{label}' END" if tests else f"'{label}'"
        cases.append(f"WHEN regexp_matches({text}, '(?i){trigger}') THEN {value}")
    return f"CASE {' '.join(cases)} ELSE {'NULL' if what == 'label' else chr(39) * 2} END"


@query(
    "hard_rules",
    f"""WITH {i.SQL_RULE_TITLES}
    SELECT id, title, {_sql_rules('title', 'label')} AS rule_label,
           {_sql_rules('title', 'status')} AS rule_status FROM rule_titles""",
)
def hard_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.apply_rules(i.rule_titles(spark, sf_dir), "title")


@query(
    "maxsim_label",
    f"""WITH {i.SQL_VECTORS}, {i.SQL_KEYWORDS}, {i.SQL_KB}, {i.SQL_SCORES}
    SELECT id, label, round(sa, 6) AS score FROM scores""",
)
def maxsim_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    vecs = i.vectors(spark, sf_dir)
    scores = maxsim.maxsim(
        vecs.select("id", "vec_a"), i.keyword_vectors(spark, vecs), i.kb_labels(spark), "vec_a"
    )
    return scores.withColumn("score", F.round("score", 6))


SQL_NEAREST = """nearest AS (
  SELECT e.id, e.label AS truth,
         arg_max(c.label_id, {'s': round(list_cosine_similarity(e.a, c.v), 12), 'l': -c.label_id}) AS pred,
         max(list_cosine_similarity(e.a, c.v)) AS score
  FROM e CROSS JOIN c GROUP BY e.id, e.label)"""


def nearest(spark: SparkSession, sf_dir: str, threshold: float) -> DataFrame:
    vecs = i.vectors(spark, sf_dir)
    centroids = i.label_vectors(vecs).join(i.kb_labels(spark), "label_id")
    notices = vecs.select(
        "id", F.col("label").alias("truth"), F.col("vec_a").alias("embedding"),
        F.when(F.col("id") % 50 != 0, F.lit("title")).otherwise("").alias("title"),
    )
    return maxsim.nearest_label(notices, centroids, F.col("title"), threshold)


@query(
    "nearest_label",
    f"""WITH {i.SQL_VECTORS}, {i.SQL_CENTROIDS}, {i.SQL_KB}, {SQL_NEAREST}
    SELECT id, CASE WHEN id % 50 = 0 THEN 'input error' ELSE final_label END AS predicted_label,
           CASE WHEN id % 50 = 0 THEN 0.0::DOUBLE ELSE round(score, 6) END AS score,
           CASE WHEN id % 50 = 0 THEN 'input error' WHEN score >= 0.3 THEN 'auto_confirmed'
                ELSE 'manual_review_needed' END AS status
    FROM nearest JOIN kb ON kb.label_id = pred""",
)
def nearest_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = nearest(spark, sf_dir, 0.3)
    return found.select("id", "predicted_label", F.round("score", 6).alias("score"), "status")


SQL_STATUS = (
    f"CASE WHEN score >= {i.THRESHOLD} THEN 'auto_confirmed (ensemble)'"
    " ELSE 'manual_review_needed (AI)' END"
)


@query(
    "weak_label_ensemble",
    f"""WITH {i.SQL_VECTORS}, {i.SQL_KEYWORDS}, {i.SQL_KB}, {i.SQL_SCORES}, {i.SQL_ENSEMBLE}
    SELECT id, predicted_label, {SQL_STATUS} AS status, round(score, 6) AS final_ensemble_score,
           round(score_a, 6) AS score_a, round(score_b, 6) AS score_b,
           div AS predicted_div, dep AS predicted_dept
    FROM best JOIN kb ON kb.final_label = predicted_label""",
)
def weak_label_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    vecs = i.vectors(spark, sf_dir)
    labelled = maxsim.ensemble_label(
        vecs.drop("label"), i.keyword_vectors(spark, vecs), i.kb_labels(spark), threshold=i.THRESHOLD
    )
    found = mapping.label_info(labelled, i.knowledge_base(spark))
    return found.select(
        "id",
        "predicted_label",
        "status",
        *[F.round(c, 6).alias(c) for c in ("final_ensemble_score", "score_a", "score_b")],
        "predicted_div",
        "predicted_dept",
    )


SQL_DEPT_STATUS = """CASE
      WHEN list_contains(string_split(predicted_dept, ', '), coalesce(actual, 'nan')) THEN 'match'
      WHEN predicted_label IS NULL OR predicted_label LIKE '%error%' OR actual IS NULL OR actual = 'nan'
        THEN 'undetermined' ELSE 'mismatch' END"""

# Notices: a title, and the vector and actual department of its id if there are any.
# Every 9th has no department; the title is a phrase and the part's name.
SQL_NOTICES = f"""notices AS (
  SELECT r.id, e.a, e.b, r.title || '&amp;  ' AS service_title,
         CASE WHEN r.id % 9 <> 0 THEN c_mktsegment END AS participating_dept
  FROM rule_titles r LEFT JOIN e ON e.id = r.id LEFT JOIN customer ON c_custkey = r.id)"""


def notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    depts = i.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.when(F.col("c_custkey") % 9 != 0, F.col("c_mktsegment")).alias("participating_dept"),
    )
    titles = i.rule_titles(spark, sf_dir).select(
        "id", F.concat("title", F.lit("&amp;  ")).alias("service_title")
    )
    vecs = i.vectors(spark, sf_dir).drop("label")
    return titles.join(vecs, "id", "left").join(depts, "id", "left")


SQL_WEAK = f"""WITH {i.SQL_VECTORS}, {i.SQL_KEYWORDS}, {i.SQL_KB}, {i.SQL_SCORES}, {i.SQL_ENSEMBLE},
    {i.SQL_RULE_TITLES}, {SQL_NOTICES}, {i.sql_pairs('dept_map', list(i.DEPT_MAP.items()))},
    ruled AS (
      SELECT n.id, participating_dept, {i.sql_light('service_title')} AS title FROM notices n),
    decided AS (
      SELECT r.*, {_sql_rules('title', 'label')} AS rule_label,
             {_sql_rules('title', 'status')} AS rule_status FROM ruled r),
    labelled AS (
      SELECT d.id, title, participating_dept, rule_label,
             coalesce(rule_label, b.predicted_label) AS predicted_label,
             CASE WHEN rule_label IS NULL THEN {SQL_STATUS} ELSE rule_status END AS status,
             CASE WHEN rule_label IS NULL THEN 0.0 ELSE 1.0 END AS confidence_score,
             CASE WHEN rule_label IS NULL THEN round(score, 6) END AS final_ensemble_score,
             CASE WHEN rule_label IS NULL THEN round(score_a, 6) END AS score_a,
             CASE WHEN rule_label IS NULL THEN round(score_b, 6) END AS score_b
      FROM decided d LEFT JOIN best b ON b.id = d.id),
    weak AS (
      SELECT l.*, coalesce(div, 'N/A') AS predicted_div, coalesce(dep, 'N/A') AS predicted_dept,
             coalesce(m.value, participating_dept) AS actual
      FROM labelled l LEFT JOIN kb ON kb.final_label = predicted_label
      LEFT JOIN dept_map m ON m.key = participating_dept)"""


def weak_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weaklabel.weak_label(
        notices(spark, sf_dir),
        i.keyword_vectors(spark, i.vectors(spark, sf_dir)),
        i.knowledge_base(spark),
        i.dept_mapping(spark),
        threshold=i.THRESHOLD,
    )


@query(
    "weak_label_full",
    f"""{SQL_WEAK}
    SELECT id, title AS service_title_cleaned, predicted_label, status,
           confidence_score::DOUBLE AS confidence_score, final_ensemble_score, score_a, score_b,
           predicted_div, predicted_dept, actual AS standard_dept_actual,
           {SQL_DEPT_STATUS} AS dept_match_status FROM weak""",
)
def weak_label_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = weak_labels(spark, sf_dir)
    return found.select(
        "id",
        "service_title_cleaned",
        "predicted_label",
        "status",
        "confidence_score",
        *[F.round(c, 6).alias(c) for c in ("final_ensemble_score", "score_a", "score_b")],
        "predicted_div",
        "predicted_dept",
        "standard_dept_actual",
        "dept_match_status",
    )


@query(
    "weak_label_summary",
    f"""{SQL_WEAK}
    SELECT 'label' AS kind, predicted_label AS value, count(*) AS n FROM weak
    WHERE predicted_label IS NOT NULL GROUP BY predicted_label
    UNION ALL
    SELECT 'dept', s, count(*) FROM (SELECT {SQL_DEPT_STATUS} AS s FROM weak) GROUP BY s""",
)
def weak_label_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The result goes into the book first, and the summary is made of its sheet.
    book = shared_path(spark, "labels")
    write_book({"Classification_Result": weak_labels(spark, sf_dir).drop("vec_a", "vec_b")}, book)
    found = read_sheet(spark, book, "Classification_Result").select("predicted_label", "dept_match_status")
    # One pass counts both summaries.
    both = F.array(
        F.struct(F.lit("label").alias("kind"), F.col("predicted_label").alias("value")),
        F.struct(F.lit("dept").alias("kind"), F.col("dept_match_status").alias("value")),
    )
    pairs = found.select(F.explode(both).alias("p")).select("p.kind", "p.value")
    summary = pairs.filter("value IS NOT NULL").groupBy("kind", "value").agg(F.count(F.lit(1)).alias("n"))
    write_book({"Summary": summary}, book)
    return read_sheet(spark, book, "Summary")


@query("weak_label_text")
def weak_label_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page titles labelled from text alone, with the built-in encoders."""
    titles = i.table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("id"),
        F.regexp_extract("html", i.PAGE_TITLE, 1).alias("service_title"),
    )
    cleaned = titles.select(clean_light(F.col("service_title")).alias("text"))
    general, domain = encoders.fit_general(cleaned, "text"), encoders.fit_domain(cleaned, "text")
    # The keywords of a label are words of the titles, found per page host.
    host = F.regexp_extract(F.col("url"), r"\.([a-z]+)/", 1)
    words = i.table(spark, sf_dir, "pages").select(
        host.alias("final_label"),
        F.explode(word_tokens(F.regexp_extract("html", i.PAGE_TITLE, 1), (), 6)).alias("word"),
    )
    counted = words.groupBy("final_label", "word").agg(F.count(F.lit(1)).alias("n"))
    best = top_n(counted, ["final_label"], [F.desc("n"), F.asc("word")], 10, F.col("word"))
    lists = best.groupBy("final_label").agg(
        F.array_join(F.sort_array(F.collect_list("word")), ", ").alias("keywords")
    )
    kb = lists.join(dense_index(lists, "final_label", "label_id"), "final_label").select(
        "label_id", "final_label", "keywords", F.lit("web").alias("div"), F.lit("web").alias("dep")
    )
    found = weaklabel.weak_label_texts(
        titles,
        kb,
        lambda df, col: encoders.encode_channels(df, col, general, domain),
        threshold=i.THRESHOLD,
    )
    return found.select(
        "id", "service_title_cleaned", "predicted_label", "status",
        F.round("final_ensemble_score", 4).alias("final_ensemble_score"),
    )


# Predicted labels picked by id: knowledge-base labels, an unknown one, an error, null.
PREDICTED = [row[1] for row in i.KNOWLEDGE_BASE] + ["bridge_design", "classification error", None]
SQL_PREDICTED = f"""predicted AS (
  SELECT p_partkey AS id, {i.sql_pick(PREDICTED, f'p_partkey % {len(PREDICTED)}')} AS predicted_label
  FROM part)"""


def predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = i.pick(PREDICTED, F.col("p_partkey") % len(PREDICTED))
    return i.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), label.alias("predicted_label")
    )


@query(
    "label_info_lookup",
    f"""WITH {SQL_PREDICTED}, {i.SQL_KB}
    SELECT id, predicted_label, coalesce(div, 'N/A') AS predicted_div,
           coalesce(dep, 'N/A') AS predicted_dept
    FROM predicted LEFT JOIN kb ON kb.final_label = predicted_label""",
)
def label_info_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mapping.label_info(predicted(spark, sf_dir), i.knowledge_base(spark))
    return found.select("id", "predicted_label", "predicted_div", "predicted_dept")


@query(
    "dept_match",
    f"""WITH {SQL_PREDICTED}, {i.SQL_KB}, {i.sql_pairs('dept_map', list(i.DEPT_MAP.items()))},
    x AS (
      SELECT id, predicted_label, coalesce(dep, 'N/A') AS predicted_dept,
             CASE WHEN id % 5 = 0 THEN NULL WHEN id % 5 = 1 THEN 'N/A' ELSE c_mktsegment END AS raw
      FROM predicted LEFT JOIN customer ON c_custkey = id
      LEFT JOIN kb ON kb.final_label = predicted_label),
    y AS (SELECT x.*, coalesce(value, raw) AS actual FROM x LEFT JOIN dept_map ON key = raw)
    SELECT id, predicted_label, predicted_dept, actual AS standard_dept_actual,
           {SQL_DEPT_STATUS} AS dept_match_status FROM y""",
)
def dept_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    depts = i.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), "c_mktsegment")
    raw = (
        F.when(F.col("id") % 5 == 0, F.lit(None))
        .when(F.col("id") % 5 == 1, "N/A")
        .otherwise(F.col("c_mktsegment"))
    )
    rows = mapping.label_info(
        predicted(spark, sf_dir).join(depts, "id", "left").withColumn("participating_dept", raw),
        i.knowledge_base(spark),
    )
    return mapping.dept_match(rows, i.dept_mapping(spark)).select(
        "id", "predicted_label", "predicted_dept", "standard_dept_actual", "dept_match_status"
    )


CODES = [*CODE_ROLLUP, "unknown_code"]


@query(
    "taxonomy_rollup",
    f"""WITH {i.sql_pairs('codes', list(CODE_ROLLUP.items()))},
    {i.sql_pairs('taxonomy', [(k, v) for k, vs in TAXONOMY.items() for v in vs])},
    p AS (SELECT p_partkey, {i.sql_pick(CODES, f'p_partkey % {len(CODES)}')} AS code FROM part)
    SELECT codes.value AS field, taxonomy.value AS field_label, count(*) AS n_parts,
           count(DISTINCT code) AS n_codes
    FROM p JOIN codes ON codes.key = code JOIN taxonomy ON taxonomy.key = codes.value
    GROUP BY codes.value, taxonomy.value""",
)
def taxonomy_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = i.table(spark, sf_dir, "part").select(
        i.pick(CODES, F.col("p_partkey") % len(CODES)).alias("code")
    )
    # Counted per code first, so only one row per code meets the taxonomy.
    per_code = parts.groupBy("code").agg(F.count(F.lit(1)).alias("n"))
    fields = mapping.rollup_codes(per_code, "code", i.code_mapping(spark))
    return (
        mapping.field_labels(fields, i.taxonomy_mapping(spark))
        .groupBy("field", "field_label")
        .agg(F.sum("n").alias("n_parts"), F.count(F.lit(1)).alias("n_codes"))
    )


SQL_JUDGE_CANDIDATES = f"""WITH {i.SQL_VECTORS}, {i.SQL_CENTROIDS}, {i.SQL_KB},
    t AS (SELECT e.id, e.a, CASE WHEN e.id % 50 = 0 THEN '' WHEN e.id % 50 = 1 THEN NULL
                                 ELSE p_name END AS title
          FROM e LEFT JOIN part ON p_partkey = e.id),
    ranked AS (
      SELECT id, c.label_id, final_label, concat_ws(', ', keyword_1, keyword_2) AS k,
             row_number() OVER (PARTITION BY id
               ORDER BY round(list_cosine_similarity(a, v), 12) DESC, c.label_id DESC) AS r
      FROM t CROSS JOIN c JOIN kb ON kb.label_id = c.label_id),
    block AS (
      SELECT id, string_agg('- Label: ' || final_label || chr(10) || '  Keywords: '
                            || substring(k, 1, 150) || '...', chr(10) ORDER BY r) AS b
      FROM ranked WHERE r <= 5 GROUP BY id)
    SELECT id, CASE WHEN coalesce(title, '') = '' THEN 'input error' END AS error_label,
           CASE WHEN coalesce(title, '') <> '' THEN b END AS candidates,
           CASE WHEN coalesce(title, '') <> '' THEN
             'Pick the one label that fits this notice title best.' || chr(10) || 'Title: ' || title
             || chr(10) || 'Candidates, most similar first:' || chr(10) || b || chr(10)
             || 'Answer with JSON only: {{"best_label": "...", "reason": "one short sentence"}}' END AS prompt
    FROM t JOIN block USING (id)"""


@query("judge_candidates", SQL_JUDGE_CANDIDATES)
def judge_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    vecs = i.vectors(spark, sf_dir)
    key = F.col("p_partkey")
    titles = i.table(spark, sf_dir, "part").select(
        key.alias("id"),
        F.when(key % 50 == 0, "").when(key % 50 != 1, F.col("p_name")).alias("service_title"),
    )
    rows = vecs.select("id", F.col("vec_a").alias("embedding")).join(titles, "id", "left")
    words = i.knowledge_base(spark)
    kb = i.label_vectors(vecs).join(words, "label_id").select(
        "label_id",
        F.col("final_label").alias("label"),
        join_keyword_columns(words.columns).alias("keywords_str"),
        "embedding",
    )
    return weaklabel.candidates(rows, kb).select("id", "error_label", "candidates", "prompt")


# Reply forms, picked by event_id; %s stands for the event type.
REPLIES = [
    '```json\n{"best_label": "%s", "reason": "fits"}\n```',
    '{"reason": "%s"}',
    '{"best_label": "%s"}',
    "%s",
    '["%s"]',
    "{'best_label': '%s'}",
    '{"best_label": "%s"} extra',
    '{"best_label": null, "reason": "%s"}',
    "{}",
    "null",
    "",
]


@query(
    "judge_parse",
    rf"""WITH r AS (
      SELECT event_id AS id, replace({i.sql_pick(REPLIES, f'event_id % {len(REPLIES)}')},
                                     '%s', event_type || ' ' || user_id) AS response FROM events),
    t AS (SELECT id, trim(replace(replace(response, '```json', ''), '```', ''), chr(10) || ' ') AS j FROM r),
    p AS (SELECT id, j, json_valid(j) AND starts_with(j, '{{') AND ends_with(j, '}}') AS ok FROM t)
    SELECT id,
      CASE WHEN NOT ok THEN 'classification error'
           WHEN list_contains(json_keys(CASE WHEN ok THEN j ELSE '{{}}' END), 'best_label')
             THEN json_extract_string(CASE WHEN ok THEN j END, '$.best_label')
           ELSE 'parse error' END AS label,
      CASE WHEN NOT ok THEN 'invalid_reply'
           WHEN list_contains(json_keys(CASE WHEN ok THEN j ELSE '{{}}' END), 'reason')
             THEN json_extract_string(CASE WHEN ok THEN j END, '$.reason')
           ELSE '' END AS reason
    FROM p""",
)
def judge_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    who = F.concat("event_type", F.lit(" "), F.col("user_id").cast("string"))
    reply = F.replace(i.pick(REPLIES, F.col("event_id") % len(REPLIES)), F.lit("%s"), who)
    rows = i.table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), parse_judgement(reply).alias("j")
    )
    return rows.select("id", "j.label", "j.reason")


def first_candidate(prompt: str) -> str:
    """A stand-in for a judge model: picks the first candidate, answers some prompts badly."""
    best = prompt.split("- Label: ", 1)[1].split("\n", 1)[0]
    kind = len(prompt) % 5
    if kind == 0:
        return "I would say " + best
    reply = '{"best_label": "%s", "reason": "first"}' % best
    return f"```json\n{reply}\n```" if kind == 1 else '{"reason": "none"}' if kind == 2 else reply


@query(
    "judge_chain",
    f"""WITH c AS ({SQL_JUDGE_CANDIDATES}), {i.SQL_KB},
    r AS (
      SELECT id, error_label, length(prompt) % 5 AS kind,
             string_split(split_part(candidates, '- Label: ', 2), chr(10))[1] AS best FROM c),
    j AS (
      SELECT id,
             coalesce(error_label, CASE kind WHEN 0 THEN 'classification error' WHEN 2 THEN 'parse error' ELSE best END) AS label,
             CASE WHEN error_label IS NOT NULL THEN 'empty_title' WHEN kind = 0 THEN 'invalid_reply'
                  WHEN kind = 2 THEN 'none' ELSE 'first' END AS reasoning FROM r)
    SELECT id, label AS predicted_label, reasoning, coalesce(div, 'N/A') AS predicted_div,
           coalesce(dep, 'N/A') AS predicted_dept
    FROM j LEFT JOIN kb ON kb.final_label = label""",
)
def judge_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates, calls, parsing and lookup; the judged table is written and read again."""
    prompts = judge_candidates(spark, sf_dir)
    judged = weaklabel.judge(prompts, lambda: first_candidate).drop("candidates", "prompt", "response")
    path = shared_path(spark, "judged")
    mapping.label_info(judged, i.knowledge_base(spark)).write.parquet(path)
    found = spark.read.parquet(path)
    return found.select("id", "predicted_label", "reasoning", "predicted_div", "predicted_dept")
