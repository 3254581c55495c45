"""Cluster description, density clustering and vector queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticelens.fixed_values import NO_KEYWORDS, STOP_WORDS
from noticelens.operators import cooccurrence, density, encoders, hierarchy, index, keywords, vectors
from noticelens.plans import inputs as i
from noticelens.plans.registry import query
from noticelens.session import lookup, shared_path, small_side, written
from noticelens.sources.tables import read_sheet, write_book

SQL_STOP = "(" + ", ".join(i.sql_text(w) for w in STOP_WORDS) + ")"
SQL_TFIDF = rf"""{i.SQL_CLUSTERED},
    tok AS (
      SELECT cluster_id AS c, doc_id AS d,
             unnest(regexp_extract_all(lower(text), '([\p{{L}}\p{{N}}_]{{2,}})', 1)) AS term
      FROM clustered WHERE text IS NOT NULL),
    tf AS (SELECT c, d, term, count(*) AS tf FROM tok WHERE term NOT IN {SQL_STOP} GROUP BY c, d, term),
    sizes AS (SELECT cluster_id AS c, count(*) AS n FROM clustered WHERE text IS NOT NULL GROUP BY cluster_id),
    voc AS (SELECT c, term, count(*) AS df FROM tf GROUP BY c, term),
    idf AS (
      SELECT voc.c, term, ln((1 + n) / (1 + df)) + 1 AS idf FROM voc JOIN sizes ON sizes.c = voc.c),
    w AS (
      SELECT tf.c, tf.d, tf.term, tf * idf AS w,
             sqrt(sum((tf * idf) * (tf * idf)) OVER (PARTITION BY tf.c, tf.d)) AS norm
      FROM tf JOIN idf ON idf.c = tf.c AND idf.term = tf.term),
    scored AS (SELECT c, term, round(sum(w / norm), 6) AS score FROM w GROUP BY c, term),
    ranked AS (
      SELECT c AS cluster_id, CAST(row_number() OVER (PARTITION BY c ORDER BY score DESC, term) AS INTEGER)
             AS rank, term, score FROM scored)"""


@query(
    "cluster_keywords",
    f"WITH {SQL_TFIDF} SELECT cluster_id, rank, term, score FROM ranked WHERE rank <= 20",
)
def cluster_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = i.clustered(spark, sf_dir)
    return keywords.cluster_keywords(docs, "cluster_id", "doc_id", "text")


SQL_SAMPLED = """sampled AS (
      SELECT cluster_id, doc_id, text, CAST(row_number() OVER (
               PARTITION BY cluster_id ORDER BY md5('42:' || doc_id), doc_id) AS INTEGER) AS rank
      FROM clustered)"""


@query(
    "cluster_samples",
    f"""WITH {i.SQL_CLUSTERED}, {SQL_SAMPLED}
    SELECT 'sample' AS kind, cluster_id, rank, doc_id, text FROM sampled WHERE rank <= 30
    UNION ALL
    SELECT 'head', cluster_id, rank, doc_id, text FROM (
      SELECT *, CAST(row_number() OVER (PARTITION BY cluster_id ORDER BY doc_id) AS INTEGER) AS rank
      FROM clustered WHERE cluster_id <> -1) WHERE rank <= 5""",
)
def cluster_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = i.clustered(spark, sf_dir)
    samples = keywords.cluster_samples(rows, "cluster_id", "doc_id", "text")
    heads = keywords.cluster_heads(rows, "cluster_id", "doc_id", "text")
    return samples.withColumn("kind", F.lit("sample")).unionByName(
        heads.withColumn("kind", F.lit("head"))
    )


@query(
    "cluster_stats",
    f"""WITH {i.SQL_CLUSTERED}
    SELECT count(*) AS n_rows, count(DISTINCT cluster_id) FILTER (cluster_id <> -1) AS n_clusters,
           count(*) FILTER (cluster_id = -1) AS n_noise FROM clustered""",
)
def cluster_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keywords.cluster_stats(i.clustered(spark, sf_dir), "cluster_id")


@query(
    "report_cluster",
    f"""WITH {SQL_TFIDF}, {SQL_SAMPLED},
    k AS (SELECT * FROM ranked WHERE rank <= 20),
    words AS (SELECT cluster_id, string_agg(term, ', ' ORDER BY rank) AS top FROM k WHERE rank <= 5
              GROUP BY cluster_id),
    summary AS (
      SELECT g.cluster_id, CASE WHEN g.cluster_id = -1 THEN 'Noise' ELSE 'Cluster ' || g.cluster_id END AS name,
             g.size, coalesce(top, '{NO_KEYWORDS}') AS top_keywords
      FROM (SELECT cluster_id, count(*) AS size FROM clustered GROUP BY cluster_id) g
      LEFT JOIN words ON words.cluster_id = g.cluster_id),
    detail AS (
      SELECT coalesce(k.cluster_id, s.cluster_id) AS cluster_id, coalesce(k.rank, s.rank) AS rank,
             k.term AS top_keyword, s.text AS sample_text
      FROM k FULL JOIN (SELECT * FROM sampled WHERE rank <= 30) s
        ON s.cluster_id = k.cluster_id AND s.rank = k.rank)
    SELECT cluster_id, name, size, top_keywords, rank, top_keyword, sample_text
    FROM summary JOIN detail USING (cluster_id)""",
)
def report_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the report book, one detail folder per cluster, and read both sheets back."""
    rows = i.clustered(spark, sf_dir)
    words = keywords.cluster_keywords(rows, "cluster_id", "doc_id", "text")
    samples = keywords.cluster_samples(rows, "cluster_id", "doc_id", "text")
    book = shared_path(spark, "book")
    write_book({"keywords": words}, book)
    words = read_sheet(spark, book, "keywords")
    write_book(
        {
            "Summary": keywords.cluster_summary(rows, words, "cluster_id", "text"),
            "Detail": keywords.cluster_detail(words, samples, "cluster_id", "text"),
        },
        book,
        partition_by={"Detail": "cluster_id"},
    )
    summary, detail = (read_sheet(spark, book, sheet) for sheet in ("Summary", "Detail"))
    return summary.join(detail, "cluster_id")


SQL_NEAREST_ROWS = f"""WITH {i.SQL_VECTORS}, {i.SQL_CENTROIDS},
    d AS (
      SELECT label_id AS query_id, id, list_sum(list_transform(list_zip(v, a), lambda z: (z[1] - z[2]) ** 2)) AS d
      FROM c CROSS JOIN e)
    SELECT CAST(query_id AS BIGINT) AS query_id, id, round(d, 6) AS distance,
           CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(d, 9), id) AS INTEGER) AS rank
    FROM d QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY round(d, 9), id) <= 10"""


@query("knn_l2", SQL_NEAREST_ROWS)
def knn_l2(spark: SparkSession, sf_dir: str) -> DataFrame:
    vecs = i.vectors(spark, sf_dir)
    queries = i.label_vectors(vecs).withColumnRenamed("label_id", "query_id")
    found = vectors.knn(queries, vecs.select("id", F.col("vec_a").alias("embedding")), 10)
    return found.withColumn("distance", F.round("distance", 6))


CELLS_OF_INDEX = 32


@query("knn_index", SQL_NEAREST_ROWS)
def knn_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``knn_l2`` from an index that is written and opened again."""
    vecs = i.vectors(spark, sf_dir).select("id", F.col("vec_a").alias("embedding"))
    path = shared_path(spark, "index")
    index.write_index(vecs, path, cells=CELLS_OF_INDEX)
    queries = i.label_vectors(i.vectors(spark, sf_dir)).withColumnRenamed("label_id", "query_id")
    found, _ = index.search_index(spark, path, queries, 10)
    return found.withColumn("distance", F.round("distance", 6))


@query(
    "mean_pool",
    f"""WITH {i.SQL_VECTORS},
    t AS (SELECT id // 8 AS text_id, a, CASE WHEN label % 3 = 0 THEN 0 ELSE 1 END AS mask FROM e)
    SELECT text_id, CAST(i - 1 AS INTEGER) AS pos, round(sum(a[i] * mask) / greatest(sum(mask), 1e-9), 6) + 0.0 AS value
    FROM t, range(1, 65) r(i) GROUP BY text_id, i""",
)
def mean_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = i.vectors(spark, sf_dir).select(
        F.floor(F.col("id") / 8).alias("text_id"),
        "vec_a",
        F.when(F.col("label") % 3 == 0, 0).otherwise(1).alias("mask"),
    )
    pooled = vectors.mean_pool(tokens, "text_id", "vec_a", "mask")
    cells = pooled.select("text_id", F.posexplode("embedding").alias("pos", "value"))
    return cells.withColumn("value", F.round("value", 6) + F.lit(0.0))


@query(
    "quantize_int8",
    f"""WITH {i.SQL_VECTORS},
    r AS (SELECT min(list_min(a)) AS low, max(list_max(a)) AS high FROM e),
    k AS (SELECT (high - low) / 255 AS scale, CAST(round_even(-low / ((high - low) / 255), 0) AS INTEGER) AS zero FROM r),
    q AS (
      SELECT id, a, scale, zero, list_transform(a, lambda x: greatest(0, least(255,
               CAST(round_even(x / scale, 0) AS INTEGER) + zero))) AS q FROM e, k)
    SELECT id, array_to_string(q, ',') AS codes,
           round(list_max(list_transform(list_zip(a, q), lambda z: abs(z[1] - (z[2] - zero) * scale))), 6) AS max_error
    FROM q""",
)
def quantize_int8(spark: SparkSession, sf_dir: str) -> DataFrame:
    vecs = i.vectors(spark, sf_dir)
    calibration = vectors.calibrate_minmax(vecs, "id", "vec_a")
    coded = vectors.quantize_int8(vecs.select("id", "vec_a"), "vec_a", calibration)
    return coded.select(
        "id",
        F.array_join(F.col("q").cast("array<string>"), ",").alias("codes"),
        F.round("max_error", 6).alias("max_error"),
    )


def _sql_main_axis(name: str, matrix: str, squarings: int = 14) -> str:
    """The main eigenvector of a symmetric matrix (i, j, v) by repeated squaring."""
    steps, last = [], matrix
    for n in range(squarings):
        now = f"{name}_{n}"
        steps.append(
            f"""{now} AS MATERIALIZED (
      SELECT i, j, v / (sum(v) FILTER (i = j) OVER ()) AS v FROM (
        SELECT a.i, b.j, sum(a.v * b.v) AS v FROM {last} a JOIN {last} b ON a.j = b.i GROUP BY a.i, b.j))"""
        )
        last = now
    steps.append(
        f"""{name} AS MATERIALIZED (
      SELECT i, v * sign(arg_max(v, abs(v)) OVER ()) / sqrt(sum(v * v) OVER ()) AS v
      FROM {last} WHERE j = (SELECT arg_max(i, v) FROM {last} WHERE i = j))"""
    )
    return ",\n    ".join(steps)


SQL_PROJECTED = f"""WITH {i.SQL_VECTORS},
    x AS (SELECT id, i, a[i] AS v FROM e, range(1, 65) t(i)),
    mu AS (SELECT i, avg(v) AS m FROM x GROUP BY i),
    z AS (SELECT id, x.i, v - m AS v FROM x JOIN mu ON mu.i = x.i),
    cov AS MATERIALIZED (
      SELECT p.i, q.i AS j, sum(p.v * q.v) AS v FROM z p JOIN z q ON p.id = q.id GROUP BY p.i, q.i),
    {_sql_main_axis('axis_x', 'cov')},
    top AS (SELECT sum(cov.v * p.v * q.v) AS value FROM cov JOIN axis_x p ON p.i = cov.i JOIN axis_x q ON q.i = cov.j),
    rest AS MATERIALIZED (
      SELECT cov.i, cov.j, cov.v - value * p.v * q.v AS v
      FROM cov JOIN axis_x p ON p.i = cov.i JOIN axis_x q ON q.i = cov.j, top),
    {_sql_main_axis('axis_y', 'rest')}
    SELECT id, round(sum(x.v * p.v), 6) AS x, round(sum(x.v * q.v), 6) AS y
    FROM x JOIN axis_x p ON p.i = x.i JOIN axis_y q ON q.i = x.i GROUP BY id"""


@query("project_2d", SQL_PROJECTED)
def project_2d(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = i.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    return encoders.project_2d(rows).select(
        "id", F.round("x", 6).alias("x"), F.round("y", 6).alias("y")
    )


@query(
    "density_cluster",
    f"""WITH RECURSIVE p AS MATERIALIZED ({SQL_PROJECTED}),
    sample AS (SELECT * FROM p ORDER BY md5('42:' || id), id LIMIT 1000),
    kth AS (
      SELECT s.id, (s.x - p.x) * (s.x - p.x) + (s.y - p.y) * (s.y - p.y) AS d FROM sample s CROSS JOIN p
      QUALIFY row_number() OVER (PARTITION BY s.id ORDER BY d, p.id) = 6),
    ranked AS (SELECT d, row_number() OVER (ORDER BY d) AS r, count(*) OVER () AS n FROM kth),
    radius AS MATERIALIZED (SELECT greatest(round(sqrt(d), 6), 1e-6::DOUBLE) AS eps FROM ranked WHERE r = ceil(0.9::DOUBLE * n)),
    near AS (
      SELECT a.id AS a, b.id AS b FROM p a CROSS JOIN radius JOIN p b ON a.id <> b.id
        AND (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= eps * eps),
    core AS (SELECT a AS id FROM near GROUP BY a HAVING count(*) >= 5),
    link AS (SELECT a, b FROM near WHERE a IN (SELECT id FROM core) AND b IN (SELECT id FROM core)),
    walk(id, root) AS (
      SELECT id, id FROM core
      UNION SELECT link.b, walk.root FROM walk JOIN link ON link.a = walk.id WHERE walk.root < link.b),
    roots AS (SELECT id, min(root) AS root FROM walk GROUP BY id),
    kept AS (SELECT root, CAST(row_number() OVER (ORDER BY root) - 1 AS INTEGER) AS cluster_id
             FROM (SELECT root FROM roots GROUP BY root HAVING count(*) >= 8))
    SELECT p.id, coalesce(cluster_id, -1) AS cluster_id
    FROM p LEFT JOIN roots ON roots.id = p.id LEFT JOIN kept ON kept.root = roots.root""",
)
def density_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of the projection of whole vectors, at a radius that the table suggests."""
    path = shared_path(spark, "projected")
    project_2d(spark, sf_dir).write.parquet(path)
    points = spark.read.parquet(path)
    eps = density.suggest_eps(points.filter("x is not null"), min_samples=5)
    # Without six points there is no neighbour to measure, and no cluster at any radius.
    eps = 1.0 if eps is None else max(round(eps, 6), 1e-6)
    return density.density_cluster(points, eps=eps, min_samples=5, min_cluster_size=8)


def _sql_hierarchy(points: str, needed: int, smallest: int) -> str:
    """CTEs up to ``clustered_points`` (id, cluster_id) of points (id, x, y).

    Prim's order makes the components of a threshold runs without a heavier step. Clusters are
    followed from threshold to threshold, then folded from the bottom of their tree.
    """
    return f"""p AS MATERIALIZED ({points}),
    n AS (SELECT id, x, y, row_number() OVER (ORDER BY id) AS k FROM p),
    gap AS MATERIALIZED (
      SELECT a.k AS a, b.k AS b, (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) AS d FROM n a CROSS JOIN n b),
    core AS MATERIALIZED (SELECT a AS k, d AS core FROM gap WHERE a <> b QUALIFY row_number() OVER (PARTITION BY a ORDER BY d) = {needed}),
    reach AS MATERIALIZED (
      SELECT a, list(greatest(f.core, g.core, d) ORDER BY b) AS ws
      FROM gap JOIN core f ON f.k = a JOIN core g ON g.k = b GROUP BY a),
    prim(step, k, place, w) AS (
      SELECT 1, k, CASE WHEN k = 1 THEN 1 END, CASE WHEN k = 1 THEN 'inf'::DOUBLE ELSE ws[k] END
      FROM n, reach WHERE reach.a = 1
      UNION ALL
      SELECT step + 1, k, CASE WHEN k = best THEN step + 1 ELSE place END,
             CASE WHEN place IS NULL AND k <> best THEN least(w, ws[k]) ELSE w END
      FROM (SELECT *, first_value(k) OVER (ORDER BY place IS NOT NULL, w, k) AS best
            FROM prim WHERE step < (SELECT count(*) FROM n)) JOIN reach ON reach.a = best),
    line AS MATERIALIZED (SELECT k, place, w FROM prim WHERE step = (SELECT count(*) FROM n)),
    level AS MATERIALIZED (
      SELECT w AS t, row_number() OVER (ORDER BY w) AS r FROM (SELECT DISTINCT w FROM line WHERE place > 1)),
    seg AS MATERIALIZED (
      SELECT r, place, sum(CASE WHEN w > t THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY place) AS seg
      FROM level CROSS JOIN line),
    big AS MATERIALIZED (
      SELECT r, min(place) AS lo, max(place) AS hi FROM seg GROUP BY r, seg HAVING count(*) >= {smallest}),
    grown(r, lo, hi, node) AS (
      SELECT r, lo, hi, r * 1000000 + lo FROM big WHERE r = (SELECT min(r) FROM big)
      UNION ALL
      SELECT r, lo, hi, CASE WHEN count(node) = 1 THEN min(node) ELSE r * 1000000 + lo END
      FROM (SELECT big.r, big.lo, big.hi, inside.node
            FROM (SELECT DISTINCT r + 1 AS r FROM grown) AS nxt JOIN big ON big.r = nxt.r
            LEFT JOIN grown AS inside ON inside.lo >= big.lo AND inside.hi <= big.hi)
      GROUP BY r, lo, hi),
    node AS MATERIALIZED (
      SELECT node, row_number() OVER (ORDER BY node) AS i, 1 / greatest(sqrt(t), 1e-9::DOUBLE) AS dense
      FROM (SELECT DISTINCT node, node // 1000000 AS r FROM grown) JOIN level USING (r)),
    up AS MATERIALIZED (
      SELECT DISTINCT c.i AS i, f.i AS parent, f.dense AS birth
      FROM grown a JOIN grown b ON b.r = a.r + 1 AND b.lo <= a.lo AND b.hi >= a.hi AND b.node <> a.node
      JOIN node c ON c.node = a.node JOIN node f ON f.node = b.node),
    joined AS MATERIALIZED (
      SELECT place, node.i, 1 / greatest(sqrt(t), 1e-9::DOUBLE) AS dense
      FROM (SELECT place, min(grown.r) AS r FROM line JOIN grown ON place BETWEEN lo AND hi GROUP BY place) AS f
      JOIN grown ON grown.r = f.r AND place BETWEEN lo AND hi JOIN node ON node.node = grown.node
      JOIN level ON level.r = f.r),
    info AS MATERIALIZED (
      SELECT node.i, node.dense, coalesce(birth, 0) AS birth, up.parent IS NULL AS top, coalesce(points, 0) AS points,
             coalesce(total, 0) AS total, coalesce(kids, []) AS kids
      FROM node LEFT JOIN up USING (i)
      LEFT JOIN (SELECT i, count(*) AS points, sum(dense) AS total FROM joined GROUP BY i) USING (i)
      LEFT JOIN (SELECT parent AS i, list(i ORDER BY i) AS kids FROM up GROUP BY parent) USING (i)),
    fold(i, sizes, best, taken) AS (
      SELECT 0::BIGINT, []::BIGINT[], []::DOUBLE[], []::BOOLEAN[]
      UNION ALL
      SELECT i, list_append(sizes, points + inner_points), list_append(best, CASE WHEN take THEN gain ELSE rest END),
             list_append(taken, take)
      FROM (
        SELECT *, NOT top AND (len(kids) = 0 OR gain >= rest - 1e-9::DOUBLE * abs(rest)) AS take FROM (
          SELECT *, total - points * birth + inner_points * (dense - birth) AS gain FROM (
            SELECT info.*, sizes, best, taken,
                   CAST(coalesce(list_sum(list_transform(kids, lambda c: sizes[c])), 0) AS BIGINT) AS inner_points,
                   coalesce(list_sum(list_transform(kids, lambda c: best[c])), 0)::DOUBLE AS rest
            FROM fold JOIN info ON info.i = fold.i + 1)))),
    chosen AS (SELECT taken FROM fold ORDER BY i DESC LIMIT 1),
    above(i, j) AS (SELECT i, i FROM node UNION ALL SELECT above.i, up.parent FROM above JOIN up ON up.i = above.j),
    label AS (SELECT i, max(j) AS label FROM above, chosen WHERE taken[j] GROUP BY i),
    kept AS (SELECT n.id, label FROM joined JOIN line USING (place) JOIN n ON n.k = line.k JOIN label USING (i)),
    number AS (SELECT label, CAST(row_number() OVER (ORDER BY min(id)) - 1 AS INTEGER) AS cluster_id FROM kept GROUP BY label),
    clustered_points AS (
      SELECT p.id, coalesce(cluster_id, -1) AS cluster_id
      FROM p LEFT JOIN kept ON kept.id = p.id LEFT JOIN number ON number.label = kept.label)"""


NEEDED, SMALLEST = 5, 8


@query(
    "hierarchy_cluster",
    f"""WITH RECURSIVE {_sql_hierarchy(SQL_PROJECTED, NEEDED, SMALLEST)}
    SELECT id, cluster_id FROM clustered_points""",
)
def hierarchy_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of the projection of whole vectors by stability, without a radius."""
    points = written(project_2d(spark, sf_dir), "projected")
    return hierarchy.hierarchical_cluster(points, NEEDED, SMALLEST)


SQL_TFIDF_OF_POINTS = SQL_TFIDF.replace(
    i.SQL_CLUSTERED,
    "clustered AS (SELECT doc_id, cluster_id, text FROM documents JOIN clustered_points ON id = doc_id)",
)


@query(
    "cluster_ontology",
    f"""WITH RECURSIVE {_sql_hierarchy(SQL_PROJECTED, NEEDED, SMALLEST)}, {SQL_TFIDF_OF_POINTS}
    SELECT CASE WHEN cluster_id = -1 THEN 'Noise' ELSE 'Cluster ' || cluster_id END AS name, n AS size,
           cluster_id, rank, term, score
    FROM ranked JOIN (SELECT c AS cluster_id, n FROM sizes) USING (cluster_id) WHERE rank <= 10""",
)
def cluster_ontology(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters found in the vectors, described by the words of their texts."""
    found = written(hierarchy_cluster(spark, sf_dir), "clusters")
    docs = i.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    rows = lookup(docs, found, ["id"]).select("id", "cluster_id", "text")
    words = keywords.cluster_keywords(rows, "cluster_id", "id", "text", n=10)
    sizes = rows.filter("text is not null").groupBy("cluster_id").agg(F.count(F.lit(1)).alias("size"))
    return words.join(small_side(sizes), "cluster_id").select(
        keywords.cluster_name("cluster_id").alias("name"), "size", "cluster_id", "rank", "term", "score"
    )


def page_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return i.table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("id"), F.regexp_extract("html", i.PAGE_TITLE, 1).alias("title")
    )


@query("encode_channels")
def encode_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    titles = page_titles(spark, sf_dir)
    general = encoders.fit_general(titles, "title")
    domain = encoders.fit_domain(titles, "title")
    coded = encoders.encode_channels(titles, "title", general, domain)

    def square(col: str):
        return F.aggregate(col, F.lit(0.0), lambda s, x: s + x * x)

    return coded.select(
        "id",
        F.size("vec_a").alias("dims_a"),
        F.round(square("vec_a"), 6).alias("square_a"),
        F.size("vec_b").alias("dims_b"),
        F.round(square("vec_b"), 6).alias("square_b"),
    )


PAIR_WINDOW = 5


@query(
    "title_pairs",
    rf"""WITH t AS (
      SELECT page_id, regexp_extract_all(lower(regexp_extract(html, '{i.PAGE_TITLE}', 1)),
             '([\p{{L}}\p{{N}}_]{{2,}})', 1) AS w FROM pages),
    place AS (SELECT page_id, w, unnest(range(1, len(w) + 1)) AS a FROM t),
    near AS (SELECT w, a, unnest(range(a + 1, least(a + {PAIR_WINDOW}, len(w)) + 1)) AS b FROM place),
    pair AS (SELECT w[a] AS word, w[b] AS other FROM near UNION ALL SELECT w[b], w[a] FROM near),
    n AS (SELECT word, other, count(*) AS n FROM pair GROUP BY word, other),
    own AS (SELECT word, sum(n) AS own FROM n GROUP BY word)
    SELECT n.word, n.other, n, round(ln(n * (SELECT sum(own) FROM own) / (a.own * b.own)), 6) AS pmi
    FROM n JOIN own a ON a.word = n.word JOIN own b ON b.word = n.other
    WHERE ln(n * (SELECT sum(own) FROM own) / (a.own * b.own)) > 0""",
)
def title_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of page titles that stand near each other more often than by chance."""
    pairs = cooccurrence.pair_counts(page_titles(spark, sf_dir), "title", PAIR_WINDOW)
    return cooccurrence.positive_pmi(pairs).withColumn("pmi", F.round("pmi", 6))
