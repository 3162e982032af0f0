import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from parley.functions import display as D
from parley.functions import vectors as N
from parley.operators import evaluation as S
from parley.operators import features as X
from parley.operators import softmax as M
from parley.operators.centers import CenterMatrix
from parley.operators.quality import DataQualityError
from parley.operators.ranking import hash_order, rank_by_hash
from parley.plans import analyze as A
from parley.plans import classify as L
from parley.sources import artifacts as R

SHAPE = "conversation_id string, customer_text string, domain string"
ROWS = [
    (str(i), f"{w} number {i} {w} again", d)
    for i, (w, d) in enumerate([("modem internet", "telecom"), ("flight seat", "travel")] * 20)
]


@pytest.fixture(scope="module")
def trained(spark):
    return L.train_classifier(spark.createDataFrame(ROWS, SHAPE))


def test_split_keeps_shares_and_is_disjoint(spark):
    rows = [(str(i), "text", "ab"[i % 2]) for i in range(8)]
    parts = S.stratified_split(spark.createDataFrame(rows, SHAPE), test_share=0.5)
    counts = {(r.domain, r.part): r["count"] for r in parts.groupBy("domain", "part").count().collect()}
    assert set(counts.values()) == {2} and len(counts) == 4
    assert S.split_overlap(parts.where("part = 'train'"), parts.where("part = 'test'")).count() == 0


def test_rank_of_a_hot_group_equals_a_plain_sort(spark):
    rows = spark.range(3000).select(F.col("id").cast("string").alias("conversation_id"), F.when(F.col("id") < 2900, "hot").otherwise("cold").alias("domain"))
    ranked = rank_by_hash(rows, "domain", "conversation_id", 7).withColumn("h", hash_order(7, "conversation_id"))
    for label, size in (("hot", 2900), ("cold", 100)):
        got = [(r.rn, r.h, r.group_size) for r in ranked.where(F.col("domain") == label).orderBy("rn").collect()]
        assert [g[0] for g in got] == list(range(1, size + 1))
        assert [g[1] for g in got] == sorted(g[1] for g in got) and got[0][2] == size


def test_training_guards(spark):
    with pytest.raises(DataQualityError):
        L.train_classifier(spark.createDataFrame(ROWS + [("0", "text", "travel")], SHAPE))
    with pytest.raises(DataQualityError):
        L.train_classifier(spark.createDataFrame(ROWS + [("x", " ", "travel")], SHAPE))


def test_another_number_of_predictions_is_an_error(spark, monkeypatch):
    predict = L.predict
    monkeypatch.setattr(L, "predict", lambda model, df: predict(model, df).limit(3))
    with pytest.raises(DataQualityError, match="another number of rows"):
        L.train_classifier(spark.createDataFrame(ROWS, SHAPE))


def test_softmax_and_label(spark):
    rows = spark.createDataFrame([([0.0, 0.0],), ([900.0, 1.0],), ([-1.0, 2.0],)], "s array<double>").withColumn("p", N.softmax("s"))
    label, confidence = N.label_and_confidence("p", ["x", "y"])
    got = [(r.l, round(r.c, 6)) for r in rows.select(label.alias("l"), confidence.alias("c")).collect()]
    assert got == [("x", 0.5), ("x", 1.0), ("y", round(1 / (1 + 2.718281828459045 ** -3), 6))]


def test_classifier_learns_from_train_only_and_round_trips(spark, trained, tmp_path):
    rows = trained.predictions.collect()
    assert len(rows) == 8 and all(r.actual == r.predicted for r in rows)
    assert all(abs(sum(r.probabilities) - 1) < 1e-9 and r.confidence == max(r.probabilities) for r in rows)
    seen = {r.conversation_id for r in trained.train.collect()}
    vocabulary = [s.vocabulary for s in trained.model.stages if hasattr(s, "vocabulary")][0]
    held_out = {r.conversation_id for r in rows if len(r.conversation_id) > 1}
    assert not seen & held_out and not held_out & set(vocabulary)
    path = str(tmp_path / "classifier")
    with pytest.raises(R.ArtifactMissing):
        R.read_classifier(spark, path)
    R.write_classifier(trained.model, path, spark)
    again = L.predict(R.read_classifier(spark, path), trained.test).select("conversation_id", "predicted", "confidence")
    assert sorted(again.collect()) == sorted(trained.predictions.select("conversation_id", "predicted", "confidence").collect())
    R.write_classifier(trained.model, path, spark, input_mode="both_sides")
    with pytest.raises(R.ArtifactInvalid):
        R.read_classifier(spark, path)


def softmax_rows(spark, n=400, d=60, classes=3):
    """Rows of very unequal features, some rare, a few dense vectors among the sparse ones."""
    draw = np.random.default_rng(7)
    rows = []
    for i in range(n):
        label = int(draw.integers(0, classes))
        found = sorted(set((draw.pareto(0.7, 6) * 2).astype(int) % d) | {3 * label + int(draw.integers(0, 4))})
        values = draw.uniform(0.1, 1, len(found))
        vector = Vectors.sparse(d, [int(j) for j in found], [float(x) for x in values])
        rows.append((Vectors.dense(vector.toArray()) if i % 50 == 0 else vector, float(label)))
    return spark.createDataFrame(rows, ["features", "_label"])


def test_the_solver_finds_what_sparks_own_finds(spark):
    rows = softmax_rows(spark).repartition(3).persist()
    fit = M.fit_softmax(rows, 3, 60, 1 / 400, tol=1e-8)
    own = LogisticRegression(featuresCol="features", labelCol="_label", family="multinomial", regParam=1 / 400, standardization=False,
                             maxIter=3000, tol=1e-13).fit(rows)
    assert fit.converged and fit.passes < 60
    assert np.allclose(fit.coefficients, own.coefficientMatrix.toArray(), atol=2e-4)
    assert np.allclose(fit.intercepts, own.interceptVector.toArray(), atol=2e-4)
    assert fit.objective <= own.summary.objectiveHistory[-1] + 1e-9
    model = M.as_model(spark, fit)
    a, b = (m.transform(rows).select("probability", "prediction").collect() for m in (model, own))
    assert [r.prediction for r in a] == [r.prediction for r in b]
    assert max(np.abs(x.probability.toArray() - y.probability.toArray()).max() for x, y in zip(a, b)) < 1e-3


def test_the_solver_goes_on_from_an_earlier_fit(spark):
    rows = softmax_rows(spark).persist()
    rough = M.fit_softmax(rows, 3, 60, 1 / 400, tol=1e-3)
    fine = M.fit_softmax(rows, 3, 60, 1 / 400, tol=1e-6)
    warm = M.fit_softmax(rows, 3, 60, 1 / 400, tol=1e-6, start=rough)
    assert rough.passes < fine.passes and warm.passes < fine.passes and warm.converged
    assert np.allclose(warm.coefficients, fine.coefficients, atol=1e-3)
    short = M.fit_softmax(rows, 3, 60, 1 / 400, tol=1e-6, max_passes=4)
    assert not short.converged and short.passes <= 5
    with pytest.raises(ValueError):
        M.fit_softmax(rows.limit(0), 3, 60, 1 / 400)


def test_a_classifier_that_does_not_converge_is_an_error(spark):
    with pytest.raises(RuntimeError, match="did not converge"):
        L.fit_classifier(spark.createDataFrame(ROWS, SHAPE), max_passes=3)


PAIRS = [("a", "a")] * 3 + [("a", "b")] * 2 + [("b", "b")] + [("b", "a")] + [("c", "a")]


def test_scores(spark):
    p = spark.createDataFrame(PAIRS, "actual string, predicted string")
    got = {r.label: r for r in S.class_scores(p).collect()}
    assert (got["a"].precision, got["a"].recall) == (0.6, 0.6)
    assert got["b"].precision == pytest.approx(1 / 3) and got["b"].recall == 0.5
    assert (got["c"].precision, got["c"].recall, got["c"].f1, got["c"].support) == (0, 0, 0, 1)
    macro = S.macro_scores(p).first()
    assert macro.accuracy == 0.5 and macro.macro_recall == pytest.approx((0.6 + 0.5 + 0) / 3)
    assert [(r.actual, r.predicted, r.n) for r in S.top_confusions(p).collect()] == [("a", "b", 2), ("b", "a", 1), ("c", "a", 1)]


def test_confusion_matrix_keeps_unseen_classes(spark):
    p = spark.createDataFrame(PAIRS, "actual string, predicted string")
    labels = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "label string")
    matrix = S.confusion_matrix(p, labels)
    assert matrix.count() == 16 and matrix.agg(F.sum("n")).first()[0] == len(PAIRS)
    table = S.confusion_table(matrix, ["a", "b", "c", "d"]).collect()
    assert [tuple(r) for r in table] == [("a", 3, 2, 0, 0), ("b", 1, 1, 0, 0), ("c", 1, 0, 0, 0), ("d", 0, 0, 0, 0)]


def analyzer(spark, trained):
    docs = spark.createDataFrame(ROWS, SHAPE)
    encoder = X.LexicalEncoder.fit(docs, "customer_text", 32)
    rows = encoder.encode(docs, "customer_text").where("conversation_id < '2'").orderBy("conversation_id")
    two = [r.embedding for r in rows.collect()[:2]]
    terms = spark.createDataFrame([(0, ["modem"]), (1, ["seat"])], "cluster_id int, descriptive_terms array<string>")
    return A.Analyzer(trained.model, encoder, CenterMatrix([0, 1], two), terms)


def test_analysis_of_many_texts(spark, trained, tmp_path):
    texts = spark.createDataFrame(
        [("x", "my modem internet"), ("y", "my flight seat"), ("z", "flight seat " * 400)], "conversation_id string, customer_text string"
    )
    ready = analyzer(spark, trained)
    rows = {r.conversation_id: r for r in ready.analyze(texts).collect()}
    assert rows["x"].domain == "telecom" and rows["y"].domain == "travel" and len(rows) == 3
    assert 0 < rows["x"].cluster_similarity <= 1 + 1e-9 and rows["x"].analysis_metadata.semantic_cluster_count == 2
    short = {r.conversation_id: r for r in ready.analyze_stateless(texts.where("conversation_id <> 'z'")).collect()}
    for key in ("x", "y"):
        assert short[key].semantic_cluster == rows[key].semantic_cluster
        assert short[key].cluster_similarity == pytest.approx(rows[key].cluster_similarity, abs=1e-5)
    with pytest.raises(PySparkException):
        ready.analyze_stateless(spark.createDataFrame([("b", " ")], texts.schema)).collect()
    with pytest.raises(PySparkException):
        ready.analyze(spark.createDataFrame([("b", " \n")], texts.schema)).collect()
    with pytest.raises(ValueError):
        A.Analyzer(trained.model, ready.encoder, ready.centers, ready.terms, input_mode="agent_text")
    # The same transform on a stream.
    texts.write.parquet(str(tmp_path / "in"))
    live = spark.readStream.schema(texts.schema).parquet(str(tmp_path / "in"))
    query = (
        ready.analyze_stateless(live).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "log"))
        .trigger(availableNow=True).start(str(tmp_path / "out"))
    )
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_display(spark):
    df = spark.createDataFrame([("TELECOM", 1.005), ("unknown", float("nan")), (None, None)], "c string, x double")
    rows = df.select(D.domain_label("c").alias("c"), D.decimals("x", 4).alias("x"), D.ratio("x").alias("r")).collect()
    assert [(r.c, r.x) for r in rows] == [("Telekomünikasyon", "1.0050"), ("unknown", "—"), ("—", "—")]
    assert rows[1].r == "—"


def test_a_pass_reads_packed_blocks_of_whole_rows(spark, monkeypatch):
    rows = softmax_rows(spark).persist()
    seen, blocks = [], M.block_sums
    monkeypatch.setattr(M, "block_sums", lambda data, add, size: seen.append(data) or blocks(data, add, size))
    M.fit_softmax(rows, 3, 60, 1 / 400, tol=1e-2)
    kinds = {f.name: f.dataType.simpleString() for f in seen[0].schema}
    assert kinds == {"at": "binary", "flat": "binary", "lengths": "binary", "labels": "binary"}
    assert seen[0].count() < 40  # blocks, not rows
    assert len({id(d) for d in seen}) == 1


def test_examples_and_predictions_are_worked_out_once(trained):
    for df in (trained.train, trained.predictions):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "UDF" not in plan


def test_the_split_does_not_bring_the_texts_of_a_label_together(spark, monkeypatch):
    rows = spark.createDataFrame([(str(i), "text", "ab"[i % 2] if i % 5 else None) for i in range(40)], SHAPE)
    auto = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        parts = S.stratified_split(rows, test_share=0.25)
        assert "SortMergeJoin" not in parts._jdf.queryExecution().executedPlan().toString()
        got = sorted((r.conversation_id, r.part) for r in parts.collect())
        monkeypatch.setattr(S, "FEW_LABELS", 1)
        assert got == sorted((r.conversation_id, r.part) for r in S.stratified_split(rows, test_share=0.25).collect())
        assert sum(p == "test" for _, p in got) == 10
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", auto)


def test_the_shuffle_of_all_terms_goes_before_the_fit(spark, monkeypatch):
    """What the counts of all terms have shuffled is not kept beside the vectors."""
    import gc
    import time

    jvm = spark.sparkContext._jvm
    blocks = lambda: spark.sparkContext._jsc.sc().env().mapOutputTracker().shuffleStatuses().size()
    gc.collect()
    jvm.System.gc()
    time.sleep(2)
    before = blocks()
    X.tfidf_stages(spark.createDataFrame(ROWS, SHAPE), "customer_text")
    for _ in range(50):
        if blocks() <= before:
            break
        time.sleep(0.2)
    assert blocks() <= before
