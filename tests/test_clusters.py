import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from parley.functions import vectors as N
from parley.operators import clusters as K
from parley.operators import encoding as E
from parley.operators import features as X
from parley.operators import kmeans as M
from parley.operators import quality as Q
from parley.operators import centers as centers_module
from parley.operators.centers import CenterMatrix, cosine_silhouette, mean_centers, nearest_center, nearest_center_of, own_center
from parley.operators.pooling import pool_chunks
from parley.plans import discover as D
from parley.functions import text as T
from parley.sources import artifacts as R


def points(spark, rows):
    return spark.createDataFrame(rows, "id int, c int, v array<float>")


GROUPS = [(10, 4, [2.0, 0.2, 0.0]), (11, 4, [3.0, 0.0, 0.3]), (12, 7, [0.0, 0.0, 5.0]), (13, 7, [0.2, 0.1, 4.0]),
          (14, 9, [0.0, 1.0, 0.1]), (15, 9, [0.1, 2.0, 0.0]), (16, 9, [0.0, 3.0, 0.2])]


def test_cosine(spark):
    df = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0]), ([2.0, -1.0], [-4.0, 2.0]), ([0.5, 1.0], [2.0, -1.0])], "a array<double>, b array<double>")
    assert [r.s for r in df.select(N.cosine_similarity("a", "b").alias("s")).collect()] == pytest.approx([24 / 25, -1, 0])
    zero = spark.createDataFrame([([7.0, 2.0], [0.0, 0.0])], "a array<double>, b array<double>")
    with pytest.raises(PySparkException):
        zero.select(N.cosine_similarity("a", "b")).collect()


def brute_silhouette(vectors, labels):
    v, labels = np.asarray(vectors, float), np.asarray(labels)
    size = np.linalg.norm(v, axis=1)
    unit = v / np.where(size == 0, 1, size)[:, None]
    dist = 1 - unit @ unit.T
    np.fill_diagonal(dist, 0)
    scores = []
    for i, own in enumerate(labels):
        same = labels == own
        if same.sum() == 1:
            scores.append(0.0)
            continue
        a = dist[i, same].sum() / (same.sum() - 1)
        b = min(dist[i, labels == c].mean() for c in set(labels) - {own})
        scores.append((b - a) / max(a, b) if max(a, b) else 0.0)
    return float(np.mean(scores))


def test_silhouette_equals_brute_force_with_a_zero_row_and_a_lone_row(spark):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(60, 5))
    vectors[7] = 0
    labels = [3] + [int(x) for x in rng.integers(0, 3, 59)]
    rows = [(i, c, [float(x) for x in v]) for i, (v, c) in enumerate(zip(vectors, labels))]
    dense = points(spark, rows)
    assert cosine_silhouette(dense, "v", "c").first().silhouette == pytest.approx(
        brute_silhouette(np.float32(vectors), labels), abs=1e-9
    )
    mixed = spark.createDataFrame(
        [(i, c, Vectors.sparse(5, [(j, x) for j, x in enumerate(v) if x]) if i % 3 else Vectors.dense(v)) for i, c, v in rows],
        ["id", "c", "v"],
    )
    assert cosine_silhouette(mixed, "v", "c").first().silhouette == pytest.approx(brute_silhouette(vectors, labels), abs=1e-9)
    sparse = mixed.where("id % 3 <> 0")
    keep = [i for i in range(60) if i % 3]
    assert cosine_silhouette(sparse, "v", "c").first().silhouette == pytest.approx(
        brute_silhouette(vectors[keep], [labels[i] for i in keep]), abs=1e-9
    )


def test_silhouette_equals_the_evaluator_and_needs_two_clusters(spark):
    df = M.as_features(points(spark, GROUPS), "v")
    expected = ClusteringEvaluator(
        featuresCol="_features", predictionCol="c", distanceMeasure="cosine"
    ).evaluate(df.withColumn("c", F.col("c").cast("double")))
    assert cosine_silhouette(df, "v", "c").first().silhouette == pytest.approx(expected)
    assert cosine_silhouette(df.where("c = 9"), "v", "c").first().silhouette is None


def test_sizes_keep_empty_clusters(spark):
    labels = spark.createDataFrame([(5,), (3,), (3,), (0,), (3,)], "cluster_id int")
    assert [r.n for r in K.cluster_sizes(labels, 7).orderBy("cluster_id").collect()] == [1, 0, 0, 3, 0, 1, 0]


def test_choice_of_k(spark):
    stats = [(8, .310, 6, 40, .12), (12, .338, 5, 33, .20), (16, .342, 9, 20, .08), (20, .360, 4, 50, .10), (24, .341, 5, 31, .21)]
    row = K.require_k(K.select_k(spark.createDataFrame(stats, M.STATS)))
    assert (row.k, row.best_silhouette) == (12, .342)
    row = K.require_k(K.select_k(spark.createDataFrame(stats, M.STATS), min_size=4, tolerance=.03))
    assert (row.k, row.best_silhouette) == (12, .360)
    with pytest.raises(ValueError):
        K.require_k(K.select_k(spark.createDataFrame(stats[3:], M.STATS)))


def test_representatives(spark):
    df = points(spark, [(5, 2, [3.0, 0.1, 0.0]), (6, 2, [2.0, 0.0, 0.0]), (7, 2, [2.0, 2.0, 0.0]), (8, 2, [2.0, 0.0, 0.0]), (9, 5, [0.0, 0.0, 7.0])])
    centers = CenterMatrix([2, 3, 5], [[2, 0, 0], [0, 9, 0], [0, 0, 1]])
    wanted = {K.representatives_by_cosine: [6, 8, 5], K.representatives_by_distance: [6, 8, 5]}
    for pick, ids in wanted.items():
        rows = pick(df, "v", "c", centers, "id", 3).orderBy("cluster_id", "rank").collect()
        assert [(r.cluster_id, r.id) for r in rows] == [(2, i) for i in ids] + [(5, 9)]
    with pytest.raises(ValueError):
        K.representatives_by_cosine(df, "v", "c", CenterMatrix([2, 5], [[1, 1, 1], [0, 0, 0]]), "id")
    plan = K.representatives_by_cosine(df, "v", "c", centers, "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_centers(spark):
    df = points(spark, GROUPS)
    model = CenterMatrix.collect(mean_centers(df, "c", "v"))
    by_hand = [np.mean([v for _, c, v in GROUPS if c == k], axis=0) for k in (4, 7, 9)]
    assert list(model.ids) == [4, 7, 9] and np.allclose(model.values, by_hand, atol=1e-6)
    rows = nearest_center(df, "v", model).orderBy("id").collect()
    assert [r.cluster_id for r in rows] == [r.c for r in rows]
    three = CenterMatrix([1, 2, 3], 2 * np.eye(3))
    pair = points(spark, [(0, 3, [1.0, 2.0, 2.0]), (1, 1, [6.0, 2.0, 3.0])])
    assert sorted(r.own_similarity for r in own_center(pair, "v", "c", three).collect()) == pytest.approx([2 / 3, 6 / 7])
    zero = nearest_center(points(spark, [(0, 0, [0.0, 0.0, 0.0])]), "v", three).first()
    assert zero.similarity is None and zero.distance == 2 and zero.cluster_id == 1
    with pytest.raises(PySparkException):
        nearest_center(points(spark, [(0, 0, [1.0, 0.0])]), "v", three).collect()
    with pytest.raises(PySparkException):
        own_center(points(spark, [(0, 8, [1.0, 0.0, 0.0])]), "v", "c", three).collect()
    with pytest.raises(ValueError):
        CenterMatrix([0], [[float("nan")]])


@pytest.mark.parametrize("sparse", [False, True])
def test_models_that_stay_a_table(spark, monkeypatch, sparse):
    """Blocks of centres give what the one matrix gives: ties, a zero row, a row that names a lone cluster."""
    rng = np.random.default_rng(12)
    vectors = np.round(rng.normal(size=(150, 6)), 1)
    vectors[3], vectors[7] = 0, vectors[8]
    labels = [int(x) for x in rng.integers(0, 40, 150)]
    rows = [(i, c, [float(x) for x in v]) for i, (v, c) in enumerate(zip(vectors, labels))]
    if sparse:
        rows = [(i, c, Vectors.sparse(6, [(j, x) for j, x in enumerate(v) if x])) for i, c, v in rows]
        df = spark.createDataFrame(rows, ["id", "c", "v"])
    else:
        df = spark.createDataFrame(rows, "id int, c int, v array<double>")
    centers = spark.createDataFrame([(int(i), [float(x) for x in np.round(v, 1)]) for i, v in enumerate(rng.normal(size=(90, 6)))] + [(200, [0.0] * 6)],
                                    "cluster_id int, center array<double>")
    centers = centers.union(centers.where("cluster_id = 5").selectExpr("cluster_id + 300", "center"))  # a tie goes to the smaller id
    order = lambda x: x.drop("v").orderBy("id").collect()
    small = order(nearest_center_of(df, "v", centers))
    score = cosine_silhouette(df, "v", "c").first()
    monkeypatch.setattr(centers_module, "MAX_MODEL_VALUES", 100)
    monkeypatch.setattr(centers_module, "BLOCK_VALUES", 60)
    monkeypatch.setattr(centers_module, "GROUP_VALUES", 120)
    with pytest.raises(ValueError, match="nearest_center_of"):
        CenterMatrix.collect(centers)
    large = order(nearest_center_of(df, "v", centers))
    assert len(large) == 150
    for a, b in zip(small, large):
        assert (a.id, a.c, a.cluster_id) == (b.id, b.c, b.cluster_id) and b.distance == pytest.approx(a.distance)
        assert b.similarity == (a.similarity if a.similarity is None else pytest.approx(a.similarity))
    again = cosine_silhouette(df, "v", "c").first()
    assert (again.rows, again.clusters) == (150, score.clusters) and again.silhouette == pytest.approx(score.silhouette, abs=1e-12)
    assert score.silhouette == pytest.approx(brute_silhouette(vectors, labels), abs=1e-9)


def test_pooling(spark):
    parts = spark.createDataFrame(
        [("p", 5, [0.0, 2.0, 0.0]), ("p", 2, [1.0, 0.0, 1.0]), ("q", 9, [0.0, 0.0, 0.5])], "owner string, w int, v array<float>"
    )
    got = {r.owner: r.embedding for r in pool_chunks(parts, "owner", "v", "w").collect()}
    mean = np.array([2, 10, 2]) / 7
    assert got["p"] == pytest.approx(list(mean / np.linalg.norm(mean))) and got["q"] == pytest.approx([0, 0, 1])
    zero = spark.createDataFrame([("z", 2, [1.0, -3.0]), ("z", 3, [0.0, 0.0]), ("z", 2, [-1.0, 3.0])], "owner string, w int, v array<float>")
    with pytest.raises(PySparkException):
        pool_chunks(zero, "owner", "v", "w").collect()
    good, rejects = D.split_vectors(pool_chunks(zero, "owner", "v", "w", strict=False))
    assert good.count() == 0 and [r.owner for r in rejects.collect()] == ["z"]


TEXTS = [("k1", 0, "kettle lid kettle handle"), ("k2", 0, "kettle spout"), ("g1", 2, "garden hose nozzle"), ("g2", 2, "garden rake")]


def test_descriptive_terms(spark):
    docs = spark.createDataFrame(TEXTS, "conversation_id string, cluster_id int, customer_text string")
    weights = X.tfidf_weights(docs, T.tokens("customer_text"), min_df=1, max_df=1.0)
    top = K.terms_table(K.descriptive_terms(weights, docs, limit=3), 3)
    got = {r.cluster_id: r.descriptive_terms for r in top.collect()}
    # two of kettle against one; garden in both texts; ties by term; an id without texts
    assert got == {0: ["kettle", "spout", "handle"], 1: [], 2: ["garden", "rake", "hose"]}


def test_relational_tfidf_equals_the_ml_form(spark):
    rng = np.random.default_rng(1)
    words = [f"word{i}" for i in range(30)]
    rows = [(str(i), " ".join(rng.choice(words, 12))) for i in range(40)] + [("none", "the of")]
    docs = spark.createDataFrame(rows, "conversation_id string, customer_text string")
    table = {(r.conversation_id, r.term): r.weight for r in X.tfidf_weights(docs, max_features=None).collect()}
    tfidf = X.fit_tfidf(docs)
    vectors = tfidf.transform(docs).collect()
    terms = tfidf.terms
    ml = {(r.conversation_id, terms[i]): w for r in vectors for i, w in zip(r.features.indices, r.features.values)}
    assert ml.keys() == table.keys()
    assert all(abs(ml[k] - table[k]) < 1e-9 for k in ml)


def test_ml_form_keeps_terms_of_every_document(spark):
    docs = spark.createDataFrame([("1", "seat bb"), ("2", "seat cc")], "conversation_id string, customer_text string")
    assert "seat" in X.fit_tfidf(docs, min_df=1, max_df=1.0).terms
    assert "seat" not in X.fit_tfidf(docs, min_df=1, max_df=0.85).terms


def test_a_capped_vocabulary_keeps_the_most_used_terms(spark):
    docs = spark.createDataFrame([("1", "bb bb aa cc"), ("2", "aa cc dd")], "conversation_id string, customer_text string")
    w = X.tfidf_weights(docs, T.tokens("customer_text"), min_df=1, max_df=1.0, max_features=2)
    assert {r.term for r in w.collect()} == {"aa", "bb"}


def test_kmeans_is_the_best_start_and_repeats(spark):
    rng = np.random.default_rng(3)
    rows = [(i, 0, [float(x) for x in rng.normal(size=4)]) for i in range(80)]
    features = M.as_features(points(spark, rows), "v").persist()
    best = M.fit_kmeans(features, 6)
    single = [M.fit_kmeans(features, 6, seed=42 + n, restarts=1).summary.trainingCost for n in range(5)]
    assert best.summary.trainingCost <= min(single) + 1e-9
    again = M.fit_kmeans(features, 6)
    assert np.allclose(best.clusterCenters(), again.clusterCenters())
    features.unpersist()


def test_sweep_and_discovery(spark, tmp_path):
    rng = np.random.default_rng(4)
    base = np.eye(8)
    rows = [(str(i), "d", [float(x) for x in base[i % 8] + rng.normal(scale=.05, size=8)]) for i in range(160)]
    df = spark.createDataFrame(rows, "conversation_id string, domain string, embedding array<float>")
    found = D.discover(df, "embedding", candidates=(4, 8, 12))
    assert found.k == 8
    sizes = K.cluster_sizes(found.assigned, 8).collect()
    assert sum(r.n for r in sizes) == 160 and {r.n for r in sizes} == {20}
    texts = df.select("conversation_id", "domain", F.lit("kettle lid lamp shade").alias("customer_text"))
    report = D.describe(texts, found, "embedding", domain_limit=4)
    assert report["representatives"].count() == 24 and report["domains"].first().share == 1.0
    path = str(tmp_path / "model")
    R.write_cluster_model(found.model, report["terms"], path, "lexical", 160)
    model, terms, manifest = R.read_cluster_model(spark, path, "lexical")
    assert manifest["cluster_count"] == 8 and terms.count() == 8
    for bad in (terms.where("cluster_id > 0"), terms.union(terms.limit(1))):
        with pytest.raises(R.ArtifactInvalid):
            R.check_cluster_metadata(manifest, bad, 8, 8, "lexical")
    with pytest.raises(R.ArtifactInvalid):
        R.read_cluster_model(spark, path, "another encoder")
    with pytest.raises(Q.DataQualityError):
        D.discover(df.limit(12), "embedding", candidates=(4, 12))
    side_by_side = D.compare_representations({"x": found.stats, "y": found.stats}).collect()
    assert [(r.representation, r.k) for r in side_by_side] == [("x", 8), ("y", 8)]


def test_pluggable_encoder_pools_whole_texts(spark):
    def letters():
        import numpy

        return lambda texts: numpy.array([[t.count("a"), t.count("b"), 1e-3] for t in texts])

    docs = spark.createDataFrame([("1", "a " * 9 + "b " * 3), ("2", "b b")], "id string, t string")
    encoded = E.encode_long_texts(docs, "t", letters, limit=16, special_tokens=2, id_col="id", batch_size=2)
    got = {r.id: r.embedding for r in encoded.collect()}
    chunk1, chunk2 = np.array([6, 0, 1e-3]), np.array([3, 3, 1e-3])
    mean = (6 * chunk1 / np.linalg.norm(chunk1) + 6 * chunk2 / np.linalg.norm(chunk2)) / 12
    assert got["1"] == pytest.approx(mean / np.linalg.norm(mean), abs=1e-6)
    assert np.linalg.norm(got["2"]) == pytest.approx(1)
    with pytest.raises(ValueError):
        E.text_chunks(docs, "t", 10, id_col="id")


def test_sanity_triple(spark):
    """An encoder that sees what is spoken of puts the like sentence closer; one that sees the length does not."""

    def things():
        import numpy

        return lambda texts: numpy.array([["oven" in t, "door" in t or "shut" in t, "taxi" in t, 0.1] for t in texts], float)

    def lengths():
        import numpy

        return lambda texts: numpy.array([[len(t) - 25.0, 3.0] for t in texts])

    good, bad = (E.sanity_check(spark, e).first() for e in (things, lengths))
    assert good.close_wins and good.close > 0.9 > 0.1 > good.far
    assert not bad.close_wins and bad.close < bad.far


def test_vector_problems_and_statement_texts(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0]), (2, [float("nan"), 0.0]), (3, [0.0, 0.0]), (4, None)]
    df = spark.createDataFrame(rows, "id int, v array<double>")
    got = [r.p for r in df.orderBy("id").select(N.vector_problem("v", 2).alias("p")).collect()]
    assert got == [None, "wrong dimension", "not finite", "zero norm", "missing"]
    issues = spark.createDataFrame([("1", "raw words", " ")], "conversation_id string, customer_text string, issue_statement string")
    with pytest.raises(PySparkException):
        Q.clustering_texts(issues).collect()
    assert "customer_text" not in Q.clustering_texts(issues).columns


def test_terms_are_counted_once_and_in_one_row(spark, monkeypatch):
    texts = [("1", "aa bb aa bb aa"), ("2", "aa"), ("3", ""), ("4", None), ("5", "bb aa cc bb")]
    docs = spark.createDataFrame(texts, "conversation_id string, customer_text string").coalesce(1)
    said = {"aa": (3, 5), "bb": (2, 4), "cc": (1, 1), "aa bb": (1, 2), "bb aa": (2, 3), "aa cc": (1, 1), "cc bb": (1, 1)}
    for tokens in (X.PIECE_TOKENS, 1):
        monkeypatch.setattr(X, "PIECE_TOKENS", tokens)
        counts = X.term_frequencies(docs)
        assert {r.term: (r.df, r.total) for r in counts.collect()} == said
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and plan.count("MapInArrow") == 1


@pytest.mark.parametrize("sparse", [False, True])
def test_fits_side_by_side_are_those_of_sparks_estimator(spark, sparse, monkeypatch):
    rng = np.random.default_rng(5)
    values = rng.normal(size=(300, 6)) * (rng.random((300, 6)) < (0.5 if sparse else 2))
    features = M.as_features(points(spark, [(i, 0, [float(x) for x in v]) for i, v in enumerate(values)]), "v").select("_features")
    if sparse:
        from pyspark.ml.linalg import Vectors
        features = spark.createDataFrame([(Vectors.sparse(6, [(j, float(x)) for j, x in enumerate(v) if x]),) for v in values], ["_features"])
    features = features.persist()
    passes, jobs = [], [(3, 42), (5, 42), (5, 43)]
    step = M._step
    monkeypatch.setattr(M, "_step", lambda blocks, stacks: passes.append(len(stacks)) or step(blocks, stacks))
    own = [M.KMeans(k=k, seed=s, maxIter=200, featuresCol="_features", predictionCol="cluster_id").fit(features) for k, s in jobs]
    made = M._fit_all(features, jobs, 200, 2)
    for a, b in zip(own, made):
        assert np.allclose(a.clusterCenters(), b.clusterCenters()) and b.getMaxIter() == 200
        assert abs(a.summary.trainingCost - b.summary.trainingCost) < 1e-9 and a.summary.numIter == b.summary.numIter
        assert a.transform(features).collect() == b.transform(features).collect()
    assert len(passes) == max(m.summary.numIter for m in own) and passes[0] == 3 and passes[-1] < 3
    cut = M._fit_all(features, jobs[:1], 2, 1)[0]
    assert cut.summary.numIter == 2
    monkeypatch.setattr(M, "STACK_VALUES", 1)  # one fit at a time
    assert all(np.allclose(a.clusterCenters(), b.clusterCenters()) for a, b in zip(own, M._fit_all(features, jobs, 200, 2)))
    features.unpersist()


def test_a_batch_of_any_size_is_packed_a_block_at_a_time(monkeypatch):
    import pyarrow as pa
    from parley.operators import blocks as B

    seen, rows = [], B._rows
    monkeypatch.setattr(B, "BLOCK_VALUES", 10)
    monkeypatch.setattr(B, "_rows", lambda batch: seen.append(batch.num_rows) or rows(batch))
    values = [[float(i)] * (1 + i % 4) for i in range(9)] + [[1.0] * 15, []]
    batch = pa.record_batch({
        "_p": pa.array([{"indices": None if i % 3 else list(range(len(v))), "values": v} for i, v in enumerate(values)],
                       pa.struct([("indices", pa.list_(pa.int32())), ("values", pa.list_(pa.float64()))])),
        "_label": pa.array(range(11), pa.int32())})
    made = [B.in_blocks(b, 0) for b in B.as_blocks([batch])]
    assert max(seen) < 11 and sum(seen) == 11
    assert np.concatenate([m[1] for m in made]).tolist() == sum(values, [])
    assert np.concatenate([m[2] for m in made]).tolist() == [len(v) for v in values]
    assert np.concatenate([m[0] for m in made]).tolist() == sum((list(range(len(v))) for v in values), [])
    assert np.concatenate([m[3] for m in made]).tolist() == list(range(11))


def test_small_batches_are_counted_together(monkeypatch):
    import pyarrow as pa

    batches = [pa.record_batch([pa.array([t], pa.list_(pa.string()))], ["t"]) for t in (["a", "b"], None, ["c"], ["d"] * 5, [])]
    monkeypatch.setattr(X, "PIECE_TOKENS", 3)
    assert [p.to_pylist() for p in X._gathered(batches)] == [[["a", "b"], None, ["c"]], [["d"] * 5], [[]]]
