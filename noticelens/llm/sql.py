"""SQL forms of the queries that SQL can express, for DuckDB."""

from __future__ import annotations

from noticelens.llm.credentials import BASE, COPIED_BY, KINDS, PLACEHOLDER
from noticelens.llm.spelling import LEAST_COUNT, LEAST_LENGTH, MISSPELT, RATIO
from noticelens.llm.spotsigs import ANCHORS, CHAIN, LEAST

_WORDS = r"list_filter(string_split_regex(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

DECONTAMINATION = f"""
WITH item AS (
  SELECT item_id, w, len(w) AS m, least(5, len(w)) AS k
  FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0
), item_shingle AS (
  SELECT item_id, m, k, s, count(*) AS c FROM (
    SELECT item_id, m, k,
           unnest(list_transform(range(1, m - k + 2), lambda j: array_to_string(w[j:j + k - 1], ' '))) AS s
    FROM item) GROUP BY ALL
), doc AS (
  SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents
), width AS (SELECT DISTINCT k FROM item
), place AS (
  SELECT r, k, len(w) AS n, unnest(range(0, len(w) - k + 1)) AS p,
         unnest(list_transform(range(1, len(w) - k + 2), lambda j: array_to_string(w[j:j + k - 1], ' '))) AS s
  FROM doc, width WHERE len(w) >= k
), pair AS (
  SELECT DISTINCT r, n, item_id, m, place.k FROM place JOIN item_shingle USING (k, s)
), win AS (
  SELECT *, unnest(range(0, greatest(n - m, 0) + 1)) AS b FROM pair
), overlap AS (
  SELECT r, item_id, b, sum(least(w.c, i.c)) AS o FROM (
    SELECT win.r, win.item_id, b, s, count(*) AS c
    FROM win JOIN place ON place.r = win.r AND place.k = win.k AND place.p BETWEEN b AND b + m - win.k
    GROUP BY ALL) AS w JOIN item_shingle AS i USING (item_id, s) GROUP BY ALL
), sim AS (
  SELECT r, item_id, o, (m - k + 1) + (least(m, n) - k + 1) - o AS u
  FROM overlap JOIN pair USING (r, item_id)
), hit AS (
  SELECT r, item_id, max(CAST(o AS DOUBLE) / CAST(u AS DOUBLE)) AS similarity
  FROM sim WHERE 100 * o >= 80 * u GROUP BY ALL
), per AS (
  SELECT r, count(DISTINCT item_id) AS n_items,
         array_to_string(list_sort(list(DISTINCT item_id)), ',') AS item_ids,
         max(similarity) AS similarity
  FROM hit GROUP BY r
)
SELECT doc_id, per.r IS NOT NULL AS leaked, coalesce(n_items, 0) AS n_items, item_ids, similarity
FROM doc LEFT JOIN per USING (r)
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_KINDS = " UNION ALL ".join(
    f"SELECT r, source, {_quoted(k.name)} AS kind, {n} AS rank, {k.least} AS least, "
    f"string_split_regex(text, {_quoted(k.pattern)}) AS before, "
    f"regexp_extract_all(text, {_quoted(k.pattern)}, 0) AS hit, "
    f"regexp_extract_all(text, {_quoted(k.pattern)}, {k.group}) AS val FROM doc"
    for n, k in enumerate(KINDS)
)
_ENTRY = "kind || ':' || (e - size) || ':' || e"
_IS_BASE = "kind IN (" + ", ".join(_quoted(k) for k in BASE) + ")"

# The source of a document is its owner and its only repository.
SECRETS = f"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents
), kind AS ({_KINDS}
), part AS (
  SELECT r, source, kind, rank, least, unnest(range(1, len(hit) + 1)) AS i, before, hit, val
  FROM kind WHERE len(hit) > 0
), cut AS (
  SELECT r, source, kind, rank, least, i, length(hit[i]) AS size, val[i] AS v,
         sum(length(before[i]) + length(hit[i])) OVER (PARTITION BY r, kind ORDER BY i) AS e
  FROM part
), span AS (SELECT * FROM cut WHERE length(v) >= least
), owner AS (
  SELECT v, count(*) AS owners FROM (SELECT DISTINCT v, source FROM span) GROUP BY v
), judged AS (
  SELECT span.*, owners >= {COPIED_BY} OR regexp_matches(span.v, {_quoted(PLACEHOLDER)}) AS example,
         owners FROM span JOIN owner USING (v)
), per AS (
  SELECT r, {", ".join(f"count(*) FILTER (kind = {_quoted(k)}) AS n_{k}" for k in BASE)},
         string_agg({_ENTRY}, ',' ORDER BY e - size, rank) FILTER ({_IS_BASE}) AS base,
         string_agg({_ENTRY}, ',' ORDER BY e - size, rank) AS spans,
         count(*) FILTER (NOT example AND owners = 1) AS n_live,
         count(*) FILTER (example) AS n_example, max(owners) AS n_owners
  FROM judged GROUP BY r
)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in BASE)},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
       coalesce(n_live, 0) AS n_live, 0::BIGINT AS n_reused, coalesce(n_example, 0) AS n_example,
       coalesce(n_owners, 0) AS n_owners, coalesce(n_owners, 0) AS n_repos
FROM doc LEFT JOIN per USING (r)
"""

TOP_K = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id,
         list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), q AS (SELECT DISTINCT vec_id, e FROM v WHERE vec_id % 50 = 0
), scored AS (
  SELECT q.vec_id AS query_id, q.e, v.vec_id, v.r,
         CAST(list_sum(list_transform(list_zip(q.e, v.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM q JOIN v ON v.vec_id <> q.vec_id AND len(v.e) = len(q.e)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id, e ORDER BY score DESC, vec_id, r) AS rank
  FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""


def _crc32(text: str) -> str:
    """Unsigned crc32 of a text of ASCII characters or a list of bytes, bit by bit."""
    bits = "[-1, -1, -1, -1, -1, -1, -1, -1]"
    steps = f"flatten(list_transform({text}, lambda b: list_concat([b], {bits})))"
    step = "CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {steps}), lambda a, x: {step}), 4294967295)"


def _ascii(text: str) -> str:
    return f"list_transform(string_split({text}, ''), lambda s: ascii(s)::BIGINT)"


PREFIX_TRIE = f"""
WITH turn_of AS (
  SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), t AS (
  SELECT c, turn, substr(sha256(length(role) || ':' || role || text), 1, 32) AS g, strlen(text) AS b FROM turn_of
), own AS (
  SELECT c, CAST({_crc32(_ascii("CAST(c AS VARCHAR)"))} % 9 AS INTEGER) AS h,
         list({{'g': g, 'b': b}} ORDER BY turn NULLS FIRST, g) AS s
  FROM t GROUP BY c
), rebuilt AS (
  SELECT own.c, list_concat(coalesce(base.s[1:own.h], []), own.s[own.h + 1:]) AS s
  FROM own LEFT JOIN own AS base ON base.c = own.c - own.c % 5
), flat AS (
  SELECT c, s, array_to_string(list_transform(s, lambda x: x.g), '') AS path, unnest(range(0, len(s) + 1)) AS d
  FROM rebuilt
), node AS (
  SELECT left(path, 32 * d) AS p, d, min(c) AS conv_id, count(*) AS n,
         CASE WHEN d = 0 THEN 0 ELSE any_value(s[d].b) END AS b,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (len(s) = d), '')) AS ends
  FROM flat GROUP BY 1, 2
), child AS (
  SELECT left(p, 32 * (d - 1)) AS p, count(*) AS n FROM node WHERE d > 0 GROUP BY 1
), whole AS (
  SELECT node.*, coalesce(child.n, 0) AS n_children FROM node LEFT JOIN child USING (p)
), subtree AS (
  SELECT left(p, 32 * e) AS p, count(*) FILTER (n_children = 0) AS n_leaves, sum((n - 1) * b) AS saved
  FROM (SELECT *, unnest(range(0, d + 1)) AS e FROM whole) GROUP BY 1
)
SELECT v.conv_id, CAST(v.d AS BIGINT) AS depth, up.conv_id AS parent_conv_id, v.n AS n_convs, v.n_children,
       n_leaves, CAST(saved AS BIGINT) AS saved_tokens, v.ends AS ends_sha256
FROM whole AS v JOIN subtree USING (p) LEFT JOIN node AS up ON v.d > 0 AND up.p = left(v.p, 32 * (v.d - 1))
"""

_ANCHORS = "[" + ", ".join(_quoted(w) for w in ANCHORS) + "]"


def _signatures(text: str) -> str:
    """Sorted distinct signatures of a text, word by word."""
    words = rf"list_filter(string_split_regex(lower({text}), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '')"
    content = f"list_filter(range(1, len(w) + 1), lambda i: NOT list_contains({_ANCHORS}, w[i]))"
    ends = f"range(1, len(c) - {CHAIN - 2})"
    spots = f"list_filter({ends}, lambda k: c[k] > 1 AND list_contains({_ANCHORS}, w[c[k] - 1]))"
    chain = f"array_to_string(list_transform(c[k:k + {CHAIN - 1}], lambda i: w[i]), ' ')"
    return f"""(
    SELECT coalesce(list_sort(list_distinct(list_transform(chains, lambda x: substr(md5(x), 1, 8)))), [])
    FROM (SELECT CASE WHEN len(k) > 0 THEN list_transform(k, lambda k: {chain})
                      WHEN {text} <> '' THEN [{text}] ELSE [] END AS chains
          FROM (SELECT w, c, CASE WHEN len({spots}) > 0 THEN {spots} ELSE {ends} END AS k
                FROM (SELECT w, {content} AS c FROM (SELECT {words} AS w)))))"""


def _likeness(a: str, b: str) -> str:
    common = f"len(list_intersect({a}, {b}))"
    return f"""CASE WHEN len({a}) + len({b}) = 0 THEN 1.0::DOUBLE
       WHEN least(len({a}), len({b})) * {LEAST} < greatest(len({a}), len({b})) THEN 0.0::DOUBLE
       ELSE CAST({common} AS DOUBLE) / (len({a}) + len({b}) - {common}) END"""


FINGERPRINTS = f"""
WITH doc AS (
  SELECT doc_id, coalesce(text, '') AS text FROM documents
), pair AS (
  SELECT doc_id, text, coalesce(lead(text) OVER w, first_value(text) OVER w) AS next
  FROM doc WINDOW w AS (ORDER BY doc_id NULLS FIRST)
), edit AS (
  SELECT *, left(text, length(text) - length(text) // 4) || left(next, length(text) // 4) AS edited FROM pair
), sets AS (
  SELECT *, {_signatures("text")} AS a, {_signatures("edited")} AS e, {_signatures("next")} AS b FROM edit
)
SELECT doc_id, length(text) AS n_chars, sha256(edited) AS edited_sha256, array_to_string(a, '') AS fingerprint,
       array_to_string(e, '') AS edited_fingerprint, {_likeness("a", "e")} AS near_edited,
       {_likeness("a", "b")} AS near_next
FROM sets
"""

# UTF-8 bytes of texts up to U+00FF.
_LATIN = (
    "flatten(list_transform(string_split(id || ':' || run, ''), "
    "lambda s: CASE WHEN unicode(s) < 128 THEN [unicode(s)::BIGINT] ELSE [195, unicode(s) - 64] END))"
)

SPELLING = rf"""
WITH RECURSIVE found AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
         unnest(regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[a-z\x{{C0}}-\x{{FF}}]+')) AS run
  FROM documents
), hashed AS (
  SELECT run, n, {_crc32(_LATIN)} AS h FROM (SELECT id, run, count(*) AS n FROM found GROUP BY ALL)
), spelt AS (
  SELECT CASE WHEN h % {MISSPELT} = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2)
              ELSE run END AS word, n
  FROM hashed
), v AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spelt WHERE length(word) >= {LEAST_LENGTH}
  GROUP BY word HAVING sum(n) >= {LEAST_COUNT}
), less AS (
  SELECT word, n, i, left(word, i) || substr(word, i + 2) AS d
  FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM v)
), near AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM less AS a JOIN less AS b USING (i, d) WHERE a.word <> b.word
  UNION SELECT less.word, v.word, v.n FROM less JOIN v ON v.word = d
  UNION SELECT v.word, less.word, less.n FROM less JOIN v ON v.word = d
), best AS (
  SELECT word, count(*) AS n_near, arg_min(near, {{'n': -near_n, 'w': near}}) AS near, max(near_n) AS near_n
  FROM near GROUP BY word
), judged AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN near_n >= {RATIO} * v.n THEN near END AS form,
         CASE WHEN near_n >= {RATIO} * v.n THEN near_n END AS form_n
  FROM v LEFT JOIN best USING (word)
), way AS (
  SELECT word, word AS root FROM judged
  UNION ALL SELECT way.word, judged.form FROM way JOIN judged ON judged.word = way.root WHERE judged.form IS NOT NULL
)
SELECT judged.word, judged.form, way.root, judged.n, judged.n_near, judged.form_n
FROM judged JOIN way ON way.word = judged.word JOIN judged AS last ON last.word = way.root AND last.form IS NULL
"""
