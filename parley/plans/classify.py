"""Topic classifier: TF-IDF and multinomial logistic regression in one Spark ML pipeline."""

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import IndexToString, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley import constants as C
from parley.operators.evaluation import stratified_split, split_overlap
from parley.operators.features import tfidf_stages
from parley.operators.softmax import as_model, fit_softmax
from parley.operators.quality import duplicate_ids, require_none, same_row_count, training_examples
from parley.sources.workspace import written


def fit_classifier(train: DataFrame, text_col="customer_text", label_col="domain",
                   max_features=C.CLASSIFIER_MAX_FEATURES, tol=1e-4, max_passes=200) -> PipelineModel:
    """L2-regularised multinomial regression with C = 1, unscaled input.

    The loss is a mean over the rows, hence the penalty of 1 / rows; `parley.operators.softmax` has the solver. A
    solver that does not converge within `max_passes` over the rows is an error.
    """
    stages, terms = tfidf_stages(train, text_col, "features", max_features=max_features)
    indexer = StringIndexer(
        inputCol=label_col, outputCol="_label", stringOrderType="alphabetAsc", handleInvalid="error"
    ).fit(train)
    vectors = indexer.transform(PipelineModel(stages).transform(train)).select("features", "_label")
    fit = fit_softmax(vectors, len(indexer.labels), len(terms), 1.0 / train.count(), tol=tol, max_passes=max_passes)
    if not fit.converged:
        raise RuntimeError(f"the classifier did not converge in {fit.passes} passes")
    regression = as_model(train.sparkSession, fit).setFeaturesCol("features").setPredictionCol("_class")
    names = IndexToString(inputCol="_class", outputCol="predicted", labels=indexer.labels)
    return PipelineModel(stages + [regression, names])


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add predicted label, confidence (largest class probability) and the probabilities."""
    scored = model.transform(df)
    return scored.withColumn("probabilities", vector_to_array("probability")).withColumn(
        "confidence", F.array_max("probabilities")
    ).drop("features", "rawPrediction", "probability", "_class")


@dataclass
class TrainedClassifier:
    model: PipelineModel
    train: DataFrame
    test: DataFrame
    predictions: DataFrame


def train_classifier(conversations: DataFrame, text_col="customer_text", label_col="domain",
                     id_col="conversation_id", strict=True, **fit_options) -> TrainedClassifier:
    """Check the examples, split them, learn from the train part only, predict the test part."""
    examples, rejects = training_examples(conversations, text_col, label_col, id_col)
    if strict:
        require_none(rejects, "example is not complete")
        require_none(duplicate_ids(examples, id_col), "id occurs more than once")
    # texts are read by every step of the fit, and scores by every figure of a report: both are worked out once
    parts = written(stratified_split(examples, label_col, id_col), "split-examples")
    train = parts.where("part = 'train'").drop("part")
    test = parts.where("part = 'test'").drop("part")
    if strict:
        require_none(split_overlap(train, test, id_col), "id is in both parts")
    model = fit_classifier(train, text_col, label_col, **fit_options)
    predictions = written(predict(model, test).withColumn("actual", F.col(label_col)), "predictions")
    if strict:
        same_row_count(test, predictions)
    return TrainedClassifier(model, train, test, predictions)
