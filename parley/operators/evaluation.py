"""Stratified split and evaluation of a prediction table (actual, predicted)."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley import constants as C
from parley.functions import text as T
from parley.operators.ranking import hash_order, rank_by_hash
from parley.sources.workspace import written

FEW_LABELS = 100_000


def split_thresholds(examples: DataFrame, label_col="domain", id_col="conversation_id",
                     test_share=C.TEST_SHARE, seed=C.SEED) -> DataFrame:
    """(label, threshold): the last hash of a label that still belongs to the test part.

    Only ids and labels are ranked; the texts stay where they are.
    """
    ranked = rank_by_hash(examples.select(label_col, id_col), label_col, id_col, seed)
    quota = F.floor(F.col("group_size") * F.lit(float(test_share)) + 0.5)
    return (
        ranked.where(F.col("rn") <= quota).groupBy(label_col)
        .agg(F.max(hash_order(seed, id_col)).alias("_threshold"))
    )


def stratified_split(examples: DataFrame, label_col="domain", id_col="conversation_id",
                     test_share=C.TEST_SHARE, seed=C.SEED) -> DataFrame:
    """Add `part` ('test' or 'train'): every label gives its rounded share to the test part.

    The thresholds, one short row per label, are joined to the rows, null-safe. They are written and counted: up to
    FEW_LABELS are broadcast, as a shuffle by label would bring all texts of a label to one task. The rows
    themselves are not ranked, so their texts are never sorted.
    """
    cut = written(split_thresholds(examples, label_col, id_col, test_share, seed).withColumnRenamed(label_col, "_label"), "split-thresholds")
    if cut.count() <= FEW_LABELS:
        cut = F.broadcast(cut)
    in_test = F.coalesce(hash_order(seed, id_col) <= F.col("_threshold"), F.lit(False))
    return examples.join(cut, F.col(label_col).eqNullSafe(F.col("_label")), "left").withColumn(
        "part", F.when(in_test, F.lit("test")).otherwise(F.lit("train"))
    ).drop("_threshold", "_label")


def split_overlap(train: DataFrame, test: DataFrame, id_col="conversation_id") -> DataFrame:
    """Ids found in both parts, each once."""
    return train.select(id_col).intersect(test.select(id_col))


def classes(df: DataFrame, *columns) -> DataFrame:
    """Distinct labels found in any of the columns."""
    found = F.array(*[F.col(c).cast("string") for c in columns])
    return df.select(F.explode(found).alias("label")).distinct()


def pair_counts(predictions: DataFrame, actual="actual", predicted="predicted") -> DataFrame:
    """(actual, predicted, n): all that the scores need; one row per pair of labels."""
    return predictions.groupBy(
        F.col(actual).cast("string").alias("actual"), F.col(predicted).cast("string").alias("predicted")
    ).agg(F.count("*").alias("n"))


def class_scores(predictions: DataFrame, actual="actual", predicted="predicted") -> DataFrame:
    """Precision, recall, F1 (0 where not defined) and support of every label seen on either side."""
    counts = pair_counts(predictions, actual, predicted)
    sides = counts.select(F.inline(F.array(
        F.struct(F.col("actual").alias("label"), F.col("n").alias("support"),
                 F.lit(0).cast("long").alias("named"),
                 F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0).alias("tp")),
        F.struct(F.col("predicted").alias("label"), F.lit(0).cast("long").alias("support"),
                 F.col("n").alias("named"), F.lit(0).cast("long").alias("tp")),
    )))
    per = sides.groupBy("label").agg(
        F.sum("support").alias("support"), F.sum("named").alias("named"), F.sum("tp").alias("tp")
    )
    ratio = lambda up, down: F.when(down > 0, up / down).otherwise(F.lit(0.0))
    return per.select(
        "label", "support", "tp",
        ratio(F.col("tp"), F.col("named")).alias("precision"),
        ratio(F.col("tp"), F.col("support")).alias("recall"),
        ratio(2 * F.col("tp"), F.col("named") + F.col("support")).alias("f1"),
    )


def macro_scores(predictions: DataFrame, actual="actual", predicted="predicted") -> DataFrame:
    return class_scores(predictions, actual, predicted).agg(
        (F.sum("tp") / F.sum("support")).alias("accuracy"),
        F.avg("precision").alias("macro_precision"),
        F.avg("recall").alias("macro_recall"),
        F.avg("f1").alias("macro_f1"),
    )


def classification_report(predictions: DataFrame, actual="actual", predicted="predicted") -> DataFrame:
    """One row per label, then the accuracy, the plain and the support-weighted average."""
    per = class_scores(predictions, actual, predicted)
    columns = ["label", "precision", "recall", "f1", "support"]
    support = F.sum("support").alias("support")
    accuracy = F.sum("tp") / F.sum("support")
    weighted = [
        (F.sum(F.col(c) * F.col("support")) / F.sum("support")).alias(c)
        for c in ("precision", "recall", "f1")
    ]
    summary = per.agg(
        support, accuracy.alias("accuracy"),
        F.struct(*[F.avg(c).alias(c) for c in ("precision", "recall", "f1")]).alias("macro"),
        F.struct(*weighted).alias("weighted"),
    )
    none = F.lit(None).cast("double")
    averages = summary.select(F.inline(F.array(
        F.struct(F.lit("accuracy").alias("label"), none.alias("precision"), none.alias("recall"),
                 F.col("accuracy").alias("f1"), F.col("support")),
        F.struct(F.lit("macro avg").alias("label"), F.col("macro.precision").alias("precision"),
                 F.col("macro.recall").alias("recall"), F.col("macro.f1").alias("f1"), F.col("support")),
        F.struct(F.lit("weighted avg").alias("label"), F.col("weighted.precision").alias("precision"),
                 F.col("weighted.recall").alias("recall"), F.col("weighted.f1").alias("f1"), F.col("support")),
    )))
    return per.select(*columns).unionByName(averages.select(*columns))


def confusion_matrix(predictions: DataFrame, labels: DataFrame, actual="actual", predicted="predicted"):
    """(actual, predicted, n) over all labels on both axes, zeros kept.

    `labels` holds the classes of the whole data, a short list that is unfolded against itself as
    an array; predictions are counted before they meet it.
    """
    axis = labels.agg(F.array_sort(F.collect_set("label")).alias("axis")).scalar()
    grid = labels.distinct().select(
        F.col("label").alias("actual"), F.explode(axis).alias("predicted")
    )
    return grid.join(pair_counts(predictions, actual, predicted), ["actual", "predicted"], "left").select(
        "actual", "predicted", F.coalesce("n", F.lit(0)).cast("long").alias("n")
    )


def confusion_table(matrix: DataFrame, axis) -> DataFrame:
    """Matrix for display: one row per actual label, one column per predicted label."""
    return matrix.groupBy("actual").pivot("predicted", list(axis)).agg(F.first("n")).orderBy("actual")


def top_confusions(predictions: DataFrame, limit=10, actual="actual", predicted="predicted") -> DataFrame:
    """Most frequent directed mistakes; ties by label."""
    return (
        pair_counts(predictions, actual, predicted)
        .where(F.col("actual") != F.col("predicted"))
        .orderBy(F.desc("n"), "actual", "predicted").limit(limit)
    )


def sample_predictions(predictions: DataFrame, id_col="conversation_id", text_col="customer_text",
                       limit=10, wrong_only=False, chars=160) -> DataFrame:
    """First rows by id, all or the wrong ones, with a one-line preview of the text."""
    rows = predictions.where(F.col("actual") != F.col("predicted")) if wrong_only else predictions
    return rows.orderBy(id_col).limit(limit).withColumn("preview", T.one_line(text_col, chars)).drop(text_col)
