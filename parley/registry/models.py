"""Queries on fitted models. Their results depend on a solver, so there is no SQL beside them; the
tests check what must hold of them."""

from pyspark.sql import functions as F

from parley import constants as C
from parley.functions import text as T
from parley.operators import clusters as K
from parley.operators import encoding as E
from parley.operators import evaluation as S
from parley.operators import features as X
from parley.operators import issues as U
from parley.operators import kmeans as M
from parley.functions import vectors as N
from parley.operators.centers import CenterMatrix, nearest_center_of, own_center
from parley.operators.quality import issue_problem, split_by_reason
from parley.plans import analyze as A
from parley.plans import classify as L
from parley.plans import discover as D
from parley.registry import inputs as I
from parley.registry.base import query, table
from parley.registry.clusters import vectors
from parley.sources import artifacts
from parley.sources.workspace import new_path, written

GIVEN_VECTORS = "given vectors"


def customer_texts(spark, sf):
    """Conversations with the language as domain."""
    from parley.operators.conversations import build_conversations

    return build_conversations(I.channel_records(spark, sf))[0]


def document_classifier(spark, sf):
    """Classifier learned on all documents."""
    return L.fit_classifier(I.document_conversations(spark, sf))


def trained(spark, sf):
    docs = I.document_conversations(spark, sf).select("conversation_id", "customer_text", "domain")
    return L.train_classifier(docs)


@query("domain_predict")
def domain_predict(spark, sf):
    """Label and confidence of every conversation from a classifier learned on the documents."""
    scored = L.predict(document_classifier(spark, sf), customer_texts(spark, sf))
    return scored.select("conversation_id", "domain", "predicted", F.round("confidence", 4).alias("confidence"))


@query("domain_eval")
def domain_eval(spark, sf):
    """Report of a classifier on the part of the documents that it has not seen."""
    report = S.classification_report(trained(spark, sf).predictions)
    return report.select("label", "support", *[F.round(c, 4).alias(c) for c in ("precision", "recall", "f1")])


#: Given coefficients: per label an intercept and weights for the share of three groups of letters.
GIVEN_LETTERS = ("[äöüß]", "[èêç]", "[ñóí]")
GIVEN_WEIGHTS = {"de": (-0.5, 80.0, -20.0, -15.0), "en": (1.0, -60.0, -60.0, -60.0), "es": (-0.25, -10.0, -5.0, 70.0), "fr": (-0.5, -12.0, 90.0, 4.0)}


def _sql_score(weights):
    first, *rest = weights
    return " + ".join([f"({first}::DOUBLE)", *[f"({w}::DOUBLE) * s{i}" for i, w in enumerate(rest)]])


@query("label_confidence", f"""WITH f AS (SELECT doc_id, {", ".join(
      f"len(regexp_extract_all(text, '{p}')) / greatest(length(text), 1)::DOUBLE AS s{i}" for i, p in enumerate(GIVEN_LETTERS))} FROM documents),
  z AS (SELECT doc_id, label, score FROM f, LATERAL (VALUES {", ".join(f"('{k}', {_sql_score(w)})" for k, w in GIVEN_WEIGHTS.items())}) v(label, score)),
  p AS (SELECT doc_id, label, exp(score - max(score) OVER d) / sum(exp(score)) OVER d * exp(max(score) OVER d) AS p FROM z WINDOW d AS (PARTITION BY doc_id))
  SELECT doc_id, label, round(p, 6) AS confidence FROM p QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY p DESC, label) = 1""")
def label_confidence(spark, sf):
    """Label and confidence of the documents from given coefficients."""
    text = F.col("text")
    shares = [F.regexp_count(text, F.lit(p)) / F.greatest(F.length(text), F.lit(1)) for p in GIVEN_LETTERS]
    scores = F.array(*[F.lit(b) + sum(F.lit(w) * s for w, s in zip(ws, shares)) for b, *ws in GIVEN_WEIGHTS.values()])
    scored = table(spark, sf, "documents").select("doc_id", N.softmax(scores).alias("p"))
    label, confidence = N.label_and_confidence("p", GIVEN_WEIGHTS)
    return scored.select("doc_id", label.alias("label"), F.round(confidence, 6).alias("confidence"))


@query("domain_eval_support", """WITH parts AS (SELECT lang AS label, row_number() OVER (PARTITION BY lang ORDER BY md5('42:' || doc_id), CAST(doc_id AS VARCHAR))
      <= floor(count(*) OVER (PARTITION BY lang) * 0.2 + 0.5) AS test FROM documents)
  SELECT label, count(*) AS support, true AS sound FROM parts WHERE test GROUP BY label""")
def domain_eval_support(spark, sf):
    """The report's support is the held-out part, and its scores are shares that fit the counts they come from."""
    made = trained(spark, sf)
    report = S.classification_report(made.predictions).where(~F.col("label").isin("accuracy", "macro avg", "weighted avg"))
    right = made.predictions.where("actual = predicted").groupBy(F.col("actual").alias("label")).agg(F.count("*").alias("tp"))
    sound = (F.abs(F.col("recall") * F.col("support") - F.coalesce("tp", F.lit(0))) < 1e-9) & F.col("precision").between(0, 1) & F.col("f1").between(0, 1)
    return report.join(right, "label", "left").where("support > 0").select("label", "support", sound.alias("sound"))


@query("kmeans_nearest", "SELECT vec_id, true AS nearest FROM embeddings")
def kmeans_nearest(spark, sf):
    """Whether every vector's cluster is the one whose centre is nearest, recomputed in blocks of a table of centres."""
    given = vectors(spark, sf).select("vec_id", "embedding")
    rows = M.as_features(given, "embedding").persist()
    try:
        model = M.fit_kmeans(rows, 10)
    finally:
        rows.unpersist()
    centers = CenterMatrix.of_model(model).to_dataframe(spark)
    nearest = nearest_center_of(given, "embedding", centers, prefix="near_").select("vec_id", "near_cluster_id", "near_distance")
    assigned = own_center(model.transform(M.as_features(given, "embedding")), "embedding", "cluster_id", CenterMatrix.of_model(model))
    same = (F.col("cluster_id") == F.col("near_cluster_id")) | (F.abs(F.col("own_distance") - F.col("near_distance")) < 1e-9)
    return assigned.join(nearest, "vec_id").select("vec_id", same.alias("nearest"))


@query("k_sweep_counts", """SELECT CAST(k AS INTEGER) AS k, (SELECT count(*) FROM embeddings) AS rows, true AS sound
    FROM (SELECT unnest([8, 12, 16, 20, 24, 30]) AS k)""")
def k_sweep_counts(spark, sf):
    """Every candidate's clusters hold all vectors, and its figures are within their bounds."""
    given = vectors(spark, sf)
    sweep = M.sweep_k(given, "embedding")
    total, rows = given.count(), []
    for r in sweep.stats.collect():
        sizes = K.cluster_sizes(D.assign(sweep.models[r.k], given, "embedding"), r.k).agg(
            F.sum("n").alias("n"), F.min("n").alias("lo"), F.max("n").alias("hi")).first()
        sound = -1 <= r.silhouette <= 1 and (sizes.lo, sizes.hi) == (r.min_size, r.max_size) and abs(r.max_share - sizes.hi / total) < 1e-12
        rows.append((r.k, sizes.n, sound))
    return spark.createDataFrame(rows, "k int, rows long, sound boolean")


@query("kmeans_assign")
def kmeans_assign(spark, sf):
    """Cluster and similarity of every vector under the best of five starts with ten centres."""
    rows = M.as_features(vectors(spark, sf).select("vec_id", "embedding"), "embedding").persist()
    try:
        model = M.fit_kmeans(rows, 10)
    finally:
        rows.unpersist()
    assigned = model.transform(M.as_features(vectors(spark, sf).select("vec_id", "embedding"), "embedding"))
    scored = own_center(assigned, "embedding", "cluster_id", CenterMatrix.of_model(model))
    return scored.select("vec_id", "cluster_id", F.round("own_similarity", 4).alias("similarity"))


@query("k_sweep")
def k_sweep(spark, sf):
    """Silhouette and sizes of every candidate K on the given vectors."""
    return M.sweep_k(vectors(spark, sf), "embedding").stats


@query("centroid_terms")
def centroid_terms(spark, sf):
    """Heaviest terms of the centres of a TF-IDF clustering of the documents."""
    docs = I.document_conversations(spark, sf).select("conversation_id", "customer_text")
    rows, tfidf = D.tfidf_vectors(docs)
    features = rows.select(F.col("features").alias("_features")).persist()
    try:
        model = M.fit_kmeans(features, 8)
    finally:
        features.unpersist()
    terms = K.centroid_terms(CenterMatrix.of_model(model), tfidf.terms, spark)
    return terms.withColumn("weight", F.round("weight", 6))


def encoder(spark, sf):
    return X.LexicalEncoder.fit(table(spark, sf, "documents"), "text")


_BUCKETS = 384
_BUCKET_SQL = f"CAST(('0x' || substr(md5(t), 1, 8))::BIGINT % {_BUCKETS} AS INTEGER)"
_ENCODER_SQL = f"""dt AS (SELECT DISTINCT doc_id, unnest(list_transform(regexp_extract_all(lower(text), '{I.TOKEN_RE}'), lambda t: {_BUCKET_SQL})) AS b
    FROM documents),
  idf AS (SELECT b, ln((SELECT count(*) + 1.0 FROM documents) / (1.0 + count(*))) + 1.0 AS idf FROM dt GROUP BY b)"""
_CHUNK = 256 - 2 - C.TOKEN_MARGIN  # words of a chunk under the default limit
#: A bucket that no document fills has the highest idf.
_NO_IDF = "(SELECT ln(count(*) + 1.0) + 1.0 FROM documents)"


@query("encode_texts", f"""WITH {_ENCODER_SQL},
  tt AS (SELECT conv_id, turn, unnest(list_transform(regexp_extract_all(lower(text), '{I.TOKEN_RE}'), lambda t: {_BUCKET_SQL})) AS b FROM conversations),
  w AS (SELECT conv_id, turn, tt.b, count(*) * coalesce(any_value(idf), {_NO_IDF}) AS w FROM tt LEFT JOIN idf ON idf.b = tt.b GROUP BY ALL)
  SELECT conv_id, turn, b AS position, round((w / sqrt(sum(w * w) OVER (PARTITION BY conv_id, turn)))::FLOAT::DOUBLE, 4) AS value FROM w""")
def encode_texts(spark, sf):
    """Lexical vectors of the turns, encoded as they are; norm and share of filled positions."""
    turns = encoder(spark, sf).encode(table(spark, sf, "conversations"), "text")
    values = turns.select("conv_id", "turn", F.posexplode("embedding").alias("position", "value"))
    return values.where("value <> 0").select(
        "conv_id", "turn", "position", F.round(F.col("value").cast("double"), 4).alias("value")
    )


def document_vectors(spark, sf, lexical=None):
    docs = I.document_conversations(spark, sf).select("conversation_id", "customer_text")
    encoded = D.embedding_vectors(
        docs, lexical or encoder(spark, sf), table_path=new_path(spark, "document-vectors"), strict=False
    )
    return D.split_vectors(encoded)[0]


@query("encode_long_texts", f"""WITH {_ENCODER_SQL},
  words AS (SELECT CAST(doc_id AS VARCHAR) AS conversation_id, list_filter(regexp_split_to_array(text, '{I.WS_RE}+'), lambda x: x <> '') AS t
    FROM documents),
  cut AS (SELECT conversation_id, t[start + 1 : start + {_CHUNK}] AS piece, start FROM (
    SELECT conversation_id, t, unnest(range(0, len(t), {_CHUNK})) AS start FROM words)),
  sizes AS (SELECT conversation_id, sum(len(piece)) AS total FROM cut GROUP BY ALL),
  tt AS (SELECT conversation_id, start, len(piece) AS n,
    unnest(list_transform(regexp_extract_all(lower(array_to_string(piece, ' ')), '{I.TOKEN_RE}'), lambda t: {_BUCKET_SQL})) AS b FROM cut),
  w AS (SELECT conversation_id, start, n, tt.b, count(*) * coalesce(any_value(idf), {_NO_IDF}) AS w FROM tt LEFT JOIN idf ON idf.b = tt.b GROUP BY ALL),
  u AS (SELECT *, (w / sqrt(sum(w * w) OVER (PARTITION BY conversation_id, start)))::FLOAT::DOUBLE AS v FROM w),
  p AS (SELECT conversation_id, b, sum(v * n) / any_value(total) AS v FROM u JOIN sizes USING (conversation_id) GROUP BY ALL)
  SELECT conversation_id, b AS position, round((v / sqrt(sum(v * v) OVER (PARTITION BY conversation_id)))::FLOAT::DOUBLE, 4) AS value FROM p""")
def encode_long_texts(spark, sf):
    """One pooled vector per document, whatever its length."""
    docs = I.document_conversations(spark, sf).select("conversation_id", "customer_text")
    encoded = E.encode_long_texts(docs, "customer_text", encoder(spark, sf), strict=False)
    rows = encoded.select("conversation_id", F.posexplode("embedding").alias("position", "value"))
    return rows.where("value <> 0").select(
        "conversation_id", "position", F.round(F.col("value").cast("double"), 4).alias("value")
    )


@query("issue_clusters")
def issue_clusters(spark, sf):
    """What the rule says of each K for the documents' issue statements; texts and statements that cannot be
    clustered are rows with their reason and a count."""
    docs = I.document_conversations(spark, sf)
    spoken, silent = U.blank_texts(docs.select("conversation_id", "domain", "customer_text"))
    issues = U.extract_issues(spoken)
    issues, bad = split_by_reason(issues, issue_problem())
    vectors_of, empty = D.split_vectors(D.statement_vectors(
        issues, encoder(spark, sf), table_path=new_path(spark, "statement-vectors"), strict=False
    ))
    shown = K.candidate_verdicts(M.sweep_k(vectors_of, "embedding").stats)
    rejects = silent.select("reason").unionByName(bad.select(F.col("reject_reason").alias("reason"))).unionByName(
        empty.select(F.lit("no vector").alias("reason"))).groupBy("reason").agg(F.count("*").alias("n"))
    return shown.withColumn("n", F.lit(None).cast("long")).unionByName(
        rejects.select(F.col("reason").alias("verdict"), "n"), allowMissingColumns=True)


def vector_texts(spark, sf, how="left"):
    """The given vectors with their documents; empty texts for vectors without one, or only those with one."""
    given = vectors(spark, sf).select(F.col("vec_id").cast("string").alias("conversation_id"), "embedding")
    texts = given.join(I.document_conversations(spark, sf), "conversation_id", how)
    return texts.withColumn("customer_text", F.coalesce("customer_text", F.lit("")))


@query("representation_compare")
def representation_compare(spark, sf):
    """The chosen clusterings of the same documents by their given vectors, their lexical vectors and their TF-IDF."""
    texts = written(vector_texts(spark, sf, "inner"), "vector-texts")
    lexical, _ = D.split_vectors(D.embedding_vectors(
        texts.select("conversation_id", "customer_text"), encoder(spark, sf), table_path=new_path(spark, "document-vectors"), strict=False))
    tfidf, _ = D.tfidf_vectors(texts.select("conversation_id", "customer_text"))
    sweeps = {"given": (texts, "embedding"), "lexical": (lexical, "embedding"), "tfidf": (tfidf, "features")}
    return D.compare_representations({name: M.sweep_k(df, column).stats for name, (df, column) in sweeps.items()})


def analyzer(spark, sf, k=16):
    docs = I.document_conversations(spark, sf).select("conversation_id", "customer_text", "domain")
    lexical = encoder(spark, sf)
    vectors_of_docs = document_vectors(spark, sf, lexical)
    features = M.as_features(vectors_of_docs, "embedding").select("_features").persist()
    try:
        model = M.fit_kmeans(features, k)
    finally:
        features.unpersist()
    labels = D.assign(model, vectors_of_docs, "embedding").select("conversation_id", "cluster_id")
    ranked = K.descriptive_terms(X.tfidf_weights(docs), labels)
    return A.Analyzer(
        document_classifier(spark, sf), lexical, CenterMatrix.of_model(model), K.terms_table(ranked, k)
    )


@query("analyze")
def analyze(spark, sf):
    """Domain, confidence, cluster, similarity and terms of every conversation."""
    result = analyzer(spark, sf).analyze(customer_texts(spark, sf))
    return result.select(
        "conversation_id", "domain", F.round("domain_confidence", 4).alias("domain_confidence"),
        "semantic_cluster", F.round("cluster_similarity", 4).alias("cluster_similarity"),
        F.array_join("cluster_descriptive_terms", "|").alias("terms"),
        F.col("analysis_metadata.embedding_model").alias("embedding_model"),
    )


@query("cluster_metadata")
def cluster_metadata(spark, sf):
    """Terms, size and top domain per cluster with the manifest of the model they describe, as written and read back:
    one discovery on the given vectors, described by the texts of the same documents."""
    texts = written(vector_texts(spark, sf), "vector-texts")
    found = D.discover(texts, "embedding")
    told = D.describe(texts, found, "embedding", domain_limit=1)
    path = new_path(spark, "cluster-model")
    artifacts.write_cluster_model(found.model, told["terms"], path, GIVEN_VECTORS, texts.count())
    _, terms, manifest = artifacts.read_cluster_model(spark, path, GIVEN_VECTORS)
    rows = terms.join(told["sizes"], "cluster_id").join(told["domains"].select("cluster_id", "domain"), "cluster_id")
    return rows.select(
        "cluster_id", "n", "domain", F.array_join("descriptive_terms", "|").alias("terms"),
        *[F.lit(manifest[key]).alias(key) for key in sorted(manifest)],
    )


@query("live_analyze", f"""SELECT conv_id, turn, CASE WHEN len(list_filter(regexp_split_to_array(text, '{I.WS_RE}+'), lambda x: x <> '')) <= {_CHUNK}
    THEN true END AS as_batch FROM conversations""")
def live_analyze(spark, sf):
    """Every turn scored as a stream, and whether each result is that of the batch job on the same texts."""
    ready = analyzer(spark, sf)
    turns = table(spark, sf, "conversations").select(
        "conv_id", "turn", F.concat_ws("/", "conv_id", "turn").alias("conversation_id"), F.col("text").alias("customer_text"))
    folder, out = new_path(spark, "live-texts"), new_path(spark, "live-results")
    turns.write.parquet(folder)
    source = spark.readStream.schema(turns.schema).parquet(folder).select("conversation_id", "customer_text")
    A.write_analysis(ready, source, out, new_path(spark, "live-log")).awaitTermination()
    live = spark.read.parquet(out)
    batch = ready.analyze(spark.read.parquet(folder).select("conversation_id", "customer_text"))
    said = ("domain", "semantic_cluster", "cluster_descriptive_terms", "analysis_metadata", "domain_confidence", "cluster_similarity")
    a, b = (x.select("conversation_id", F.struct(*said).alias(name)) for x, name in ((live, "live"), (batch, "batch")))
    both = spark.read.parquet(folder).join(a, "conversation_id", "left").join(b, "conversation_id", "left")
    same = F.lit(True)
    for c in said[:4]:
        same = same & (F.col(f"live.{c}") == F.col(f"batch.{c}"))
    for c in said[4:]:
        same = same & (F.abs(F.col(f"live.{c}") - F.col(f"batch.{c}")) < 1e-4)
    # a text of more than one chunk is pooled by the batch job only
    fits = F.size(T.words("customer_text")) <= _CHUNK
    return both.select("conv_id", "turn", F.when(fits, F.coalesce(same, F.lit(False))).alias("as_batch"))
