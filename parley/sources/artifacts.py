"""Tables with a manifest: written together, checked when read back.

Every write goes to a version folder of its own and is published last, by a line in a list of pointers; a reader
takes the newest. So a reader never sees data of one run under the manifest of another, and a run that is
killed half-way leaves the artifact before it readable.
"""

import json
import os
import uuid

from pyspark.errors import PySparkException
from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeansModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley import constants as C
from parley.operators.alerts import alert_json
from parley.operators.quality import DataQualityError, issue_record_rejects, require_none
from parley.schemas import ALERT, CLUSTER_TERMS, ISSUE

ISSUE_PARAMETERS = {
    "schema_version": 1,
    "prompt_version": C.PROMPT_VERSION,
    "max_input_tokens": C.MAX_INPUT_TOKENS,
    "max_new_tokens": C.MAX_NEW_TOKENS,
    "generation": "greedy_do_sample_false",
}


POINTERS = "published"


class ArtifactMissing(FileNotFoundError):
    """Nothing was written at the path."""


class ArtifactInvalid(ValueError):
    """The artifact cannot be read, is incomplete, or belongs to other parameters."""


def _new_version(path) -> str:
    """A folder of its own for what is written now; what was published before stays as it is."""
    return os.path.join(path, f"version-{uuid.uuid4().hex}")


def _published(spark: SparkSession, path) -> list[dict]:
    """Everything that was published at the path, the newest last."""
    try:
        lines = spark.read.text(os.path.join(path, POINTERS)).collect()
    except PySparkException as error:
        raise ArtifactMissing(f"no artifact at {path}") from error
    try:
        found = [json.loads(r.value) for r in lines]
        if not found:
            raise ValueError("no line")
        return sorted(found, key=lambda x: (x["number"], x["version"]))
    except (KeyError, TypeError, ValueError) as error:
        raise ArtifactInvalid(f"the manifest at {path} cannot be read") from error


def _publish(spark: SparkSession, path, version, values: dict) -> None:
    """Point to a version that is complete: one more JSON line beside the others, which Spark's own commit
    shows at once or not at all. A run that ends before leaves the version before it in place."""
    try:
        number = _published(spark, path)[-1]["number"] + 1
    except ArtifactMissing:
        number = 0
    line = json.dumps({"number": number, "version": os.path.basename(version), "manifest": values}, sort_keys=True)
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("append").text(os.path.join(path, POINTERS))


def _current(spark: SparkSession, path):
    """(folder, manifest) of the newest version."""
    newest = _published(spark, path)[-1]
    return os.path.join(path, newest["version"]), newest["manifest"]


def read_manifest(spark: SparkSession, path) -> dict:
    return _current(spark, path)[1]


def drop_old_versions(spark: SparkSession, path, keep=2) -> list[str]:
    """Remove the folders of all but the last `keep` published versions, and return their names. Folders of
    runs that never published stay: one of them may still be at work."""
    old = [x["version"] for x in _published(spark, path)[:-keep]] if keep > 0 else []
    for name in old:
        folder = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(path, name))
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return old


def _require(manifest, expected, path):
    wrong = {k: manifest.get(k) for k, v in expected.items() if manifest.get(k) != v}
    if wrong:
        raise ArtifactInvalid(f"the artifact metadata at {path} does not match: {wrong}")


def write_issues(issues: DataFrame, path, **parameters) -> None:
    """Write issue records, validate what was written, then publish it.

    A run that failed leaves what was published before it. Checking the written table means that a
    generator is not run twice.
    """
    spark, version = issues.sparkSession, _new_version(path)
    data = os.path.join(version, "records")
    issues.select(*ISSUE.names).write.parquet(data)
    written = spark.read.schema(ISSUE).parquet(data)
    require_none(issue_record_rejects(written), "issue record is not valid")
    _publish(spark, path, version, {**ISSUE_PARAMETERS, **parameters, "conversation_count": written.count()})


def read_issues(spark: SparkSession, path, **parameters) -> DataFrame:
    folder, manifest = _current(spark, path)
    _require(manifest, {**ISSUE_PARAMETERS, **parameters}, path)
    try:
        records = spark.read.schema(ISSUE).parquet(os.path.join(folder, "records"))
        count = records.count()
    except PySparkException as error:
        raise ArtifactInvalid(f"the records at {path} cannot be read") from error
    if count != manifest.get("conversation_count"):
        raise ArtifactInvalid("the artifact has another number of records than its manifest says")
    try:
        require_none(issue_record_rejects(records), "issue record is not valid")
    except DataQualityError as error:
        raise ArtifactInvalid(str(error)) from error
    return records


def cluster_metadata(terms: DataFrame, embedding_model, cluster_count, dimension, conversation_count):
    """(manifest values, term table) that describe a fitted cluster model."""
    values = {
        "embedding_model": embedding_model,
        "cluster_count": int(cluster_count),
        "embedding_dimension": int(dimension),
        "conversation_count": int(conversation_count),
    }
    return values, terms.select("cluster_id", "descriptive_terms")


def write_cluster_model(model: KMeansModel, terms: DataFrame, path, embedding_model, conversation_count):
    centers = model.clusterCenters()
    values, table = cluster_metadata(
        terms, embedding_model, len(centers), len(centers[0]), conversation_count
    )
    version = _new_version(path)
    model.write().save(os.path.join(version, "model"))
    table.write.json(os.path.join(version, "terms"))
    _publish(terms.sparkSession, path, version, values)


def check_cluster_metadata(manifest, terms: DataFrame, cluster_count, dimension, embedding_model):
    """Model, manifest and terms must belong together: name, k, dimension, one row per id."""
    _require(manifest, {
        "embedding_model": embedding_model, "cluster_count": int(cluster_count),
        "embedding_dimension": int(dimension),
    }, "the cluster model")
    ids = terms.sparkSession.range(cluster_count).select(F.col("id").cast("int").alias("cluster_id"))
    missing = ids.join(terms, "cluster_id", "left_anti")
    extra = terms.where(
        ~F.coalesce(F.col("cluster_id").between(0, cluster_count - 1), F.lit(False))
        | F.col("descriptive_terms").isNull()
    ).select("cluster_id")
    twice = terms.groupBy("cluster_id").count().where("count > 1").select("cluster_id")
    if missing.unionByName(extra).unionByName(twice).limit(1).collect():
        raise ArtifactInvalid("the cluster terms do not match the model")


def read_cluster_model(spark: SparkSession, path, embedding_model):
    """(model, terms, manifest) of a cluster model, checked against each other."""
    folder, manifest = _current(spark, path)
    try:
        model = KMeansModel.load(os.path.join(folder, "model"))
        terms = spark.read.schema(CLUSTER_TERMS).json(os.path.join(folder, "terms"), mode="FAILFAST")
        centers = model.clusterCenters()
    except Exception as error:
        raise ArtifactInvalid(f"the cluster model at {path} cannot be read") from error
    check_cluster_metadata(manifest, terms, len(centers), len(centers[0]), embedding_model)
    return model, terms, manifest


def write_classifier(model: PipelineModel, path, spark, input_mode=C.INPUT_MODE):
    version = _new_version(path)
    model.write().save(os.path.join(version, "pipeline"))
    _publish(spark, path, version, {"input_mode": input_mode})


def read_classifier(spark, path, input_mode=C.INPUT_MODE) -> PipelineModel:
    """Saved classifier; refused unless it was trained on the same kind of input."""
    folder, manifest = _current(spark, path)
    _require(manifest, {"input_mode": input_mode}, path)
    try:
        return PipelineModel.load(os.path.join(folder, "pipeline"))
    except Exception as error:
        raise ArtifactInvalid(f"the classifier at {path} cannot be read") from error


def write_alerts(alerts: DataFrame, path, temporal_mode="event_time", is_real_time=False):
    """Alerts as JSON lines with ISO timestamps, and how their times came about."""
    version = _new_version(path)
    alert_json(alerts).write.text(os.path.join(version, "alerts"))
    _publish(alerts.sparkSession, path, version, {"temporal_mode": temporal_mode, "is_real_time": is_real_time})


def read_alerts(spark, path, temporal_mode="event_time", is_real_time=False) -> DataFrame:
    folder, manifest = _current(spark, path)
    _require(manifest, {"temporal_mode": temporal_mode, "is_real_time": is_real_time}, path)
    kinds = {f.name: f.dataType.simpleString() for f in ALERT.fields}
    kinds["timestamp"] = kinds.pop("bucket_ts")
    schema = ", ".join(f"`{n}` {k}" for n, k in kinds.items())
    try:
        rows = spark.read.schema(schema).json(os.path.join(folder, "alerts"), mode="FAILFAST")
    except PySparkException as error:
        raise ArtifactInvalid(f"the alerts at {path} cannot be read") from error
    return rows.withColumnRenamed("timestamp", "bucket_ts").withColumn(
        "temporal_mode", F.lit(temporal_mode)
    ).select(*ALERT.names, "temporal_mode")
