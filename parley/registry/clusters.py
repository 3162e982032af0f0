"""Queries: vectors, given clusters, TF-IDF, evaluation of given predictions."""

from pyspark.sql import functions as F

from parley.functions import text as T
from parley.functions import vectors as N
from parley.operators import clusters as K
from parley.operators import evaluation as S
from parley.operators import features as X
from parley.operators import kmeans as M
from parley.operators.centers import CenterMatrix, cosine_silhouette, mean_centers, nearest_center
from parley.operators.pooling import pool_chunks
from parley.plans import discover as D
from parley.registry import inputs as I
from parley.registry.base import query, table
from parley.registry.inputs import (
    DESCRIBE_SQL, DOCUMENTS_SQL, PREDICTIONS_SQL, TFIDF_SQL, sql_terms,
)


def vectors(spark, sf):
    return table(spark, sf, "embeddings")


def label_centers(spark, sf):
    return CenterMatrix.collect(mean_centers(vectors(spark, sf), "label", "embedding"))


# ---- vectors ----

BAD_VECTORS = [
    (-1, [1.0, 2.0]), (-2, [float("nan")] * 64), (-3, [float("inf")] + [0.0] * 63), (-4, [0.0] * 64), (-5, None),
]


@query("vector_validity", """WITH rows AS (
    SELECT vec_id, embedding FROM embeddings
    UNION ALL SELECT -1, [1.0::FLOAT, 2.0::FLOAT] UNION ALL SELECT -2, list_transform(range(64), lambda i: 'nan'::FLOAT)
    UNION ALL SELECT -3, list_transform(range(64), lambda i: CASE WHEN i = 0 THEN 'inf'::FLOAT ELSE 0.0::FLOAT END)
    UNION ALL SELECT -4, list_transform(range(64), lambda i: 0.0::FLOAT) UNION ALL SELECT -5, NULL)
  SELECT vec_id, CASE WHEN embedding IS NULL THEN 'missing' WHEN len(embedding) <> 64 THEN 'wrong dimension'
    WHEN len(list_filter(embedding, lambda x: NOT isfinite(x))) > 0 THEN 'not finite'
    WHEN len(list_filter(embedding, lambda x: x <> 0)) = 0 THEN 'zero norm' ELSE 'good' END AS verdict FROM rows""")
def vector_validity(spark, sf):
    rows = vectors(spark, sf).select("vec_id", "embedding")
    rows = rows.unionByName(spark.createDataFrame(BAD_VECTORS, rows.schema))
    return rows.select(
        "vec_id", F.coalesce(N.vector_problem("embedding", 64), F.lit("good")).alias("verdict")
    )


@query("cosine_similarity", """SELECT a.vec_id, round(list_cosine_similarity(
    list_transform(a.embedding, lambda x: x::DOUBLE), list_transform(b.embedding, lambda x: x::DOUBLE)), 6) AS cosine
    FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""")
def cosine_similarity(spark, sf):
    a = vectors(spark, sf).select("vec_id", "embedding")
    b = a.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("next"))
    return a.join(b, "vec_id").select("vec_id", F.round(N.cosine_similarity("embedding", "next"), 6).alias("cosine"))


@query("pool_chunks", """WITH e AS (SELECT vec_id // 4 AS owner, 1 + vec_id % 5 AS w,
    unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS d FROM embeddings),
  m AS (SELECT owner, d, sum(v * w) / sum(w) AS v FROM e GROUP BY ALL)
  SELECT owner, CAST(d - 1 AS INTEGER) AS position, round((v / sqrt(sum(v * v) OVER (PARTITION BY owner)))::FLOAT::DOUBLE, 5) AS value FROM m""")
def pool(spark, sf):
    parts = vectors(spark, sf).select(
        F.floor(F.col("vec_id") / 4).alias("owner"), (1 + F.col("vec_id") % 5).alias("w"), "embedding"
    )
    pooled = pool_chunks(parts, "owner", "embedding", "w")
    return pooled.select("owner", F.posexplode("embedding").alias("position", "v")).select(
        "owner", "position", F.round(F.col("v").cast("double"), 5).alias("value")
    )


_DISTANCES_SQL = I.DISTANCES_SQL


@query("nearest_centroid", f"""WITH {_DISTANCES_SQL}
    SELECT vec_id, cluster_id, round(distance, 6) AS distance, round(similarity, 6) AS similarity FROM pairs
    QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, cluster_id) = 1""")
def nearest_centroid(spark, sf):
    placed = nearest_center(vectors(spark, sf).select("vec_id", "embedding"), "embedding", label_centers(spark, sf))
    return placed.select(
        "vec_id", "cluster_id", F.round("distance", 6).alias("distance"), F.round("similarity", 6).alias("similarity")
    )


@query("silhouette_cosine", """WITH p AS (SELECT a.vec_id, a.label AS own, b.label AS other,
    sum(CASE WHEN a.vec_id = b.vec_id THEN 0 ELSE 1 - list_cosine_similarity(
      list_transform(a.embedding, lambda x: x::DOUBLE), list_transform(b.embedding, lambda x: x::DOUBLE)) END) AS s,
    count(*) AS n FROM embeddings a CROSS JOIN embeddings b GROUP BY ALL),
  w AS (SELECT vec_id, max(CASE WHEN own = other THEN s / greatest(n - 1, 1) END) AS a,
    min(CASE WHEN own <> other THEN s / n END) AS b, max(CASE WHEN own = other THEN n END) AS size FROM p GROUP BY vec_id)
  SELECT round(avg(CASE WHEN size = 1 THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette,
    count(*) AS rows, CAST((SELECT count(DISTINCT label) FROM embeddings) AS INTEGER) AS clusters FROM w""")
def silhouette_cosine(spark, sf):
    score = cosine_silhouette(vectors(spark, sf), "embedding", "label")
    return score.withColumn("silhouette", F.round("silhouette", 6))


# ---- clusters ----


@query("cluster_sizes", """SELECT CAST(range AS INTEGER) AS cluster_id, count(label) AS n
    FROM range(12) LEFT JOIN embeddings ON label = range GROUP BY ALL""")
def cluster_sizes(spark, sf):
    return K.cluster_sizes(vectors(spark, sf), 12, "label")


@query("cluster_size_stats", """WITH s AS (SELECT range AS c, count(label) AS n
    FROM range(12) LEFT JOIN embeddings ON label = range GROUP BY ALL)
  SELECT count(*) AS k, min(n) AS min_size, max(n) AS max_size, round(max(n) / sum(n), 6) AS max_share FROM s""")
def cluster_size_stats(spark, sf):
    stats = K.cluster_size_stats(K.cluster_sizes(vectors(spark, sf), 12, "label"))
    return stats.withColumn("max_share", F.round("max_share", 6))


@query("cluster_domains", """WITH n AS (SELECT source AS cluster_id, lang AS domain, count(*) AS n FROM documents GROUP BY ALL)
  SELECT cluster_id, domain, n, round(n / sum(n) OVER (PARTITION BY cluster_id), 6) AS share,
    CAST(row_number() OVER (PARTITION BY cluster_id ORDER BY n DESC, domain) AS INTEGER) AS rank FROM n
  QUALIFY rank <= 4""")
def cluster_domains(spark, sf):
    top = K.cluster_domains(table(spark, sf, "documents"), "source", "lang", 4)
    return top.select(
        F.col("source").alias("cluster_id"), F.col("lang").alias("domain"), "n", F.round("share", 6).alias("share"), "rank"
    )


_SELECT_SQL = """WITH ks AS (SELECT unnest([8, 12, 16, 20, 24, 30]) AS k),
  d AS (SELECT a.vec_id AS i, b.vec_id AS j, CASE WHEN a.vec_id = b.vec_id THEN 0 ELSE 1 - list_cosine_similarity(
      list_transform(a.embedding, lambda x: x::DOUBLE), list_transform(b.embedding, lambda x: x::DOUBLE)) END AS dist
    FROM embeddings a CROSS JOIN embeddings b),
  p AS (SELECT k, i, i % k AS own, j % k AS other, sum(dist) AS s, count(*) AS n FROM d CROSS JOIN ks GROUP BY ALL),
  w AS (SELECT k, i, max(CASE WHEN own = other THEN s / greatest(n - 1, 1) END) AS a,
    min(CASE WHEN own <> other THEN s / n END) AS b, max(CASE WHEN own = other THEN n END) AS size FROM p GROUP BY k, i),
  sil AS (SELECT k, avg(CASE WHEN size = 1 THEN 0 ELSE (b - a) / greatest(a, b) END) AS silhouette FROM w GROUP BY k),
  sizes AS (SELECT k, c, count(*) AS n FROM (SELECT k, vec_id % k AS c FROM embeddings CROSS JOIN ks) GROUP BY ALL),
  cand AS (SELECT k, silhouette, min(n) AS min_size, max(n) AS max_size, max(n) / sum(n) AS max_share
    FROM sizes JOIN sil USING (k) GROUP BY ALL)"""


@query("select_k", f"""{_SELECT_SQL}, viable AS (SELECT *, max(silhouette) OVER () AS best FROM cand
    WHERE min_size >= 5 AND max_share <= 0.2)
  SELECT CAST(k AS INTEGER) AS k, round(silhouette, 6) AS silhouette, min_size, max_size, round(max_share, 6) AS max_share,
    round(best, 6) AS best_silhouette FROM viable WHERE silhouette >= best - 0.005 ORDER BY k LIMIT 1""")
def select_k(spark, sf):
    chosen = K.select_k(_planted_stats(spark, sf))
    return chosen.select(
        "k", "min_size", "max_size",
        *[F.round(c, 6).alias(c) for c in ("silhouette", "max_share", "best_silhouette")],
    )


def _planted_stats(spark, sf):
    """Figures of clusterings by the remainder of the id."""
    rows = M.as_features(vectors(spark, sf), "embedding").select("vec_id", "_features")
    stats = [M.candidate_stats(rows.withColumn("cluster_id", (F.col("vec_id") % k).cast("int")), k) for k in M.C.K_CANDIDATES]
    return spark.createDataFrame(stats, M.STATS)


@query("candidate_verdicts", f"""{_SELECT_SQL}, small AS (SELECT CASE WHEN k = 16 THEN 4 ELSE min_size END AS min_size,
    CASE WHEN k = 20 THEN 0.21 ELSE max_share END AS max_share, k, silhouette, max_size FROM cand),
  viable AS (SELECT k, silhouette FROM small WHERE min_size >= 5 AND max_share <= 0.2), best AS (SELECT max(silhouette) AS b FROM viable),
  pick AS (SELECT min(k) AS k FROM viable WHERE silhouette >= (SELECT b FROM best) - 0.005)
  SELECT CAST(k AS INTEGER) AS k, round(silhouette, 6) AS silhouette, CASE WHEN min_size < 5 THEN 'a cluster is too small'
    WHEN max_share > 0.2 THEN 'a cluster is too large' WHEN k = (SELECT k FROM pick) THEN 'chosen'
    WHEN silhouette < (SELECT b FROM best) - 0.005 THEN 'silhouette too low' ELSE 'a smaller k is as good' END AS verdict FROM small""")
def candidate_verdicts(spark, sf):
    """What the rule says of each candidate; two of them are given figures that do not pass."""
    stats = _planted_stats(spark, sf)
    stats = stats.withColumn("min_size", F.when(F.col("k") == 16, F.lit(4).cast("long")).otherwise(F.col("min_size"))).withColumn(
        "max_share", F.when(F.col("k") == 20, F.lit(0.21)).otherwise(F.col("max_share")))
    return K.candidate_verdicts(stats).select("k", F.round("silhouette", 6).alias("silhouette"), "verdict")


@query("rep_euclidean", f"""WITH {_DISTANCES_SQL} SELECT cluster_id, vec_id, round(distance, 6) AS distance,
    CAST(row_number() OVER (PARTITION BY cluster_id ORDER BY distance, vec_id) AS INTEGER) AS rank
    FROM pairs WHERE own = cluster_id QUALIFY rank <= 3""")
def rep_euclidean(spark, sf):
    top = K.representatives_by_distance(
        vectors(spark, sf), "embedding", "label", label_centers(spark, sf), "vec_id"
    )
    return top.withColumn("distance", F.round("distance", 6))


_COSINE_SQL = f"""{_DISTANCES_SQL}, reps AS (SELECT cluster_id, vec_id, similarity,
    CAST(row_number() OVER (PARTITION BY cluster_id ORDER BY similarity DESC, vec_id) AS INTEGER) AS rank
    FROM pairs WHERE own = cluster_id QUALIFY rank <= 3)"""


def cosine_representatives(spark, sf):
    return K.representatives_by_cosine(
        vectors(spark, sf), "embedding", "label", label_centers(spark, sf), "vec_id"
    )


@query("rep_cosine", f"WITH {_COSINE_SQL} SELECT cluster_id, vec_id, rank, round(similarity, 6) AS similarity FROM reps")
def rep_cosine(spark, sf):
    return cosine_representatives(spark, sf).withColumn("similarity", F.round("similarity", 6))


@query("rep_with_text", f"""WITH {_COSINE_SQL} SELECT cluster_id, rank, vec_id, lang AS domain,
    substr(replace(text, chr(10), ' '), 1, 180) AS preview FROM reps JOIN documents ON doc_id = vec_id""")
def rep_with_text(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("vec_id"), "text", F.col("lang").alias("domain"))
    return cosine_representatives(spark, sf).join(docs, "vec_id").select(
        "cluster_id", "rank", "vec_id", "domain", T.one_line("text", 180).alias("preview")
    )


# ---- TF-IDF ----


@query("term_df", f"""WITH {DOCUMENTS_SQL}, {sql_terms('docs', 'conversation_id', 'customer_text')},
  tf AS (SELECT conversation_id, term, count(*) AS tf FROM terms GROUP BY ALL)
  SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS total FROM tf GROUP BY term""")
def term_df(spark, sf):
    return X.term_frequencies(I.document_conversations(spark, sf))


@query("centroid_terms_given", f"""WITH {DESCRIBE_SQL}, every AS (SELECT cluster_id, term, weight FROM means)
    SELECT cluster_id, term, round(weight, 6) AS weight, CAST(row_number() OVER (PARTITION BY cluster_id ORDER BY round(weight, 12) DESC, term) AS INTEGER) AS rank
    FROM every QUALIFY rank <= 8""")
def centroid_terms_given(spark, sf):
    """Heaviest terms of given centres: the mean TF-IDF vector of the documents of each language."""
    docs = I.document_conversations(spark, sf)
    rows, tfidf = D.tfidf_vectors(docs)
    centers = CenterMatrix.collect(mean_centers(I.language_clusters(rows), "cluster_id", "features"))
    centers = CenterMatrix(centers.ids, centers.values.round(12))  # order of addition must not break ties
    return K.centroid_terms(centers, tfidf.terms, spark).withColumn("weight", F.round("weight", 6))


@query("tfidf_weights", f"WITH {TFIDF_SQL} SELECT conversation_id, term, round(weight, 6) AS weight FROM weights")
def tfidf_weights(spark, sf):
    return X.tfidf_weights(I.document_conversations(spark, sf)).withColumn("weight", F.round("weight", 6))


@query("descriptive_terms", f"""WITH {DESCRIBE_SQL}
    SELECT cluster_id, term, round(weight, 6) AS weight, CAST(rank AS INTEGER) AS rank FROM described""")
def descriptive_terms(spark, sf):
    docs = I.document_conversations(spark, sf)
    labels = I.language_clusters(docs.select("conversation_id", "domain")).select("conversation_id", "cluster_id")
    top = K.descriptive_terms(X.tfidf_weights(docs), labels)
    return top.withColumn("weight", F.round("weight", 6))


# ---- split and evaluation ----

_SPLIT_SQL = DOCUMENTS_SQL + """, parts AS (SELECT conversation_id, domain,
    CASE WHEN row_number() OVER (PARTITION BY domain ORDER BY md5('42:' || conversation_id), conversation_id)
      <= floor(count(*) OVER (PARTITION BY domain) * 0.2 + 0.5) THEN 'test' ELSE 'train' END AS part FROM docs)"""


@query("stratified_split", f"WITH {_SPLIT_SQL} SELECT conversation_id, domain, part FROM parts")
def stratified_split(spark, sf):
    docs = I.document_conversations(spark, sf).select("conversation_id", "domain")
    return S.stratified_split(docs).select("conversation_id", "domain", "part")


@query("split_overlap", f"""WITH {_SPLIT_SQL} SELECT conversation_id FROM parts WHERE part = 'train'
    INTERSECT SELECT CAST(doc_id AS VARCHAR) FROM labels""")
def split_overlap(spark, sf):
    docs = I.document_conversations(spark, sf).select("conversation_id", "domain")
    train = S.stratified_split(docs).where("part = 'train'")
    other = table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("conversation_id"))
    return S.split_overlap(train, other)


_PER_CLASS_SQL = PREDICTIONS_SQL + """, labels_seen AS (SELECT actual AS label FROM predictions UNION SELECT predicted FROM predictions),
  per AS (SELECT label, count(*) FILTER (actual = label) AS support, count(*) FILTER (predicted = label) AS named,
    count(*) FILTER (actual = label AND predicted = label) AS tp
    FROM labels_seen CROSS JOIN predictions GROUP BY label),
  scores AS (SELECT label, support, tp, CASE WHEN named > 0 THEN tp / named ELSE 0 END AS precision,
    CASE WHEN support > 0 THEN tp / support ELSE 0 END AS recall,
    CASE WHEN named + support > 0 THEN 2 * tp / (named + support) ELSE 0 END AS f1 FROM per)"""


@query("eval_macro", f"""WITH {_PER_CLASS_SQL} SELECT round(sum(tp) / sum(support), 6) AS accuracy,
    round(avg(precision), 6) AS macro_precision, round(avg(recall), 6) AS macro_recall, round(avg(f1), 6) AS macro_f1 FROM scores""")
def eval_macro(spark, sf):
    scores = S.macro_scores(I.rule_predictions(spark, sf))
    return scores.select(*[F.round(c, 6).alias(c) for c in scores.columns])


@query("eval_per_class", f"""WITH {_PER_CLASS_SQL}, report AS (SELECT label, precision, recall, f1, support FROM scores
    UNION ALL SELECT 'accuracy', NULL, NULL, sum(tp) / sum(support), sum(support) FROM scores
    UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM scores
    UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
      sum(f1 * support) / sum(support), sum(support) FROM scores)
  SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
    CAST(support AS BIGINT) AS support FROM report""")
def eval_per_class(spark, sf):
    report = S.classification_report(I.rule_predictions(spark, sf))
    return report.select("label", "support", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])


@query("confusion_matrix", f"""WITH {PREDICTIONS_SQL}, axis AS (SELECT DISTINCT domain AS label FROM docs)
    SELECT a.label AS actual, b.label AS predicted, count(p.actual) AS n FROM axis a CROSS JOIN axis b
    LEFT JOIN predictions p ON p.actual = a.label AND p.predicted = b.label GROUP BY ALL""")
def confusion_matrix(spark, sf):
    labels = S.classes(I.document_conversations(spark, sf), "domain")
    return S.confusion_matrix(I.rule_predictions(spark, sf), labels)


@query("top_confusions", f"""WITH {PREDICTIONS_SQL} SELECT actual, predicted, count(*) AS n FROM predictions
    WHERE actual <> predicted GROUP BY ALL ORDER BY n DESC, actual, predicted LIMIT 10""")
def top_confusions(spark, sf):
    return S.top_confusions(I.rule_predictions(spark, sf))


@query("wrong_samples", f"""WITH {PREDICTIONS_SQL} SELECT conversation_id, actual, predicted,
    substr(replace(customer_text, chr(10), ' '), 1, 160) AS preview FROM predictions
    WHERE actual <> predicted ORDER BY conversation_id LIMIT 5""")
def wrong_samples(spark, sf):
    return S.sample_predictions(I.rule_predictions(spark, sf), limit=5, wrong_only=True)
