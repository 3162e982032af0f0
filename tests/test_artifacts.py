"""Artifacts are published whole or not at all."""

import os

import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.linalg import Vectors

from parley.operators.quality import DataQualityError
from parley.schemas import ISSUE
from parley.sources import artifacts as R


def issues(spark, words):
    return spark.createDataFrame([(str(i), "shop", f"text {w}", w, "fallback", False) for i, w in enumerate(words)], ISSUE)


def statements(df):
    return sorted(r.issue_statement for r in df.collect())


def test_a_run_that_fails_half_way_leaves_the_old_artifact(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "issues")
    R.write_issues(issues(spark, ["lid is gone", "late parcel"]), path)
    with pytest.raises(DataQualityError):  # the new records are on disk, but they are not good
        R.write_issues(issues(spark, ["fine", " "]), path)
    assert statements(R.read_issues(spark, path)) == ["late parcel", "lid is gone"]

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(R, "_publish", killed)
        with pytest.raises(KeyboardInterrupt):
            R.write_issues(issues(spark, ["three", "new", "records"]), path)
    assert R.read_manifest(spark, path)["conversation_count"] == 2
    assert statements(R.read_issues(spark, path)) == ["late parcel", "lid is gone"]
    R.write_issues(issues(spark, ["three", "new", "records"]), path)
    assert statements(R.read_issues(spark, path)) == ["new", "records", "three"]


def test_a_pointer_that_is_only_half_written_is_not_seen(spark, tmp_path):
    path = str(tmp_path / "issues")
    R.write_issues(issues(spark, ["kept"]), path)
    started = os.path.join(path, R.POINTERS, "_temporary", "0")
    os.makedirs(started)
    with open(os.path.join(started, "part-0.txt"), "w") as f:
        f.write('{"number": 9, "ver')
    assert statements(R.read_issues(spark, path)) == ["kept"]
    with open(os.path.join(path, R.POINTERS, "part-x.txt"), "w") as f:
        f.write("no pointer\n")
    with pytest.raises(R.ArtifactInvalid):
        R.read_issues(spark, path)


def test_old_versions_go_when_asked(spark, tmp_path):
    path = str(tmp_path / "issues")
    for words in (["one"], ["two"], ["three"]):
        R.write_issues(issues(spark, words), path)
    folders = lambda: sorted(f for f in os.listdir(path) if f.startswith("version-"))
    assert len(folders()) == 3
    gone = R.drop_old_versions(spark, path, keep=2)
    assert len(gone) == 1 and gone[0] not in folders() and len(folders()) == 2
    assert statements(R.read_issues(spark, path)) == ["three"] and R.drop_old_versions(spark, path, keep=0) == []


def test_model_and_terms_change_together(spark, tmp_path):
    path = str(tmp_path / "model")
    for k in (2, 3):
        rows = spark.createDataFrame([(Vectors.dense([float(i % k) * 9, float(i)]),) for i in range(12)], ["features"])
        terms = spark.createDataFrame([(c, [f"word{c}"]) for c in range(k)], "cluster_id int, descriptive_terms array<string>")
        R.write_cluster_model(KMeans(k=k, seed=1).fit(rows), terms, path, "lexical", 12)
        model, read, manifest = R.read_cluster_model(spark, path, "lexical")
        assert len(model.clusterCenters()) == read.count() == manifest["cluster_count"] == k
    with pytest.raises(R.ArtifactMissing):
        R.read_cluster_model(spark, str(tmp_path / "nothing"), "lexical")
