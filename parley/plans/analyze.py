"""Score many texts at once: domain, confidence, cluster, similarity, terms."""

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from parley import constants as C
from parley.functions import text as T
from parley.operators.alerts import attach_terms
from parley.operators.centers import CenterMatrix, nearest_center
from parley.operators.encoding import encode_long_texts, encode_texts
from parley.operators.quality import prediction_problem
from parley.plans.classify import predict
from parley.sources.workspace import written


@dataclass
class Analyzer:
    """Fitted parts of the scoring job. They are checked here, before any text is read."""

    classifier: PipelineModel
    encoder: object
    centers: CenterMatrix
    terms: DataFrame
    embedding_model: str = C.LEXICAL_ENCODER_NAME
    input_mode: str = C.INPUT_MODE

    def __post_init__(self):
        if self.input_mode != C.INPUT_MODE:
            raise ValueError("the classifier was trained on another kind of input")

    def _finish(self, scored: DataFrame, id_col, text_col) -> DataFrame:
        k = len(self.centers.ids)
        problem = F.when(T.is_blank(text_col), F.lit("blank text")).otherwise(
            prediction_problem(F.col("probabilities"), F.col("cluster_id"), k)
        )
        problem = F.coalesce(problem, F.when(F.col("similarity").isNull(), F.lit("no similarity")))
        # A row that cannot be scored stops the job, as no partial answer is given for a batch.
        checked = F.when(problem.isNotNull(), F.raise_error(problem).cast("int")).otherwise(F.col("cluster_id"))
        metadata = F.struct(
            F.lit(C.DOMAIN_MODEL_NAME).alias("domain_model"),
            F.lit(self.input_mode).alias("domain_input_mode"),
            F.lit(self.embedding_model).alias("embedding_model"),
            F.lit(k).alias("semantic_cluster_count"),
        )
        rows = scored.select(
            id_col, F.col("predicted").alias("domain"), F.col("confidence").alias("domain_confidence"),
            checked.alias("semantic_cluster"), F.col("similarity").alias("cluster_similarity"),
            metadata.alias("analysis_metadata"),
        )
        return attach_terms(rows, self.terms, "semantic_cluster").withColumnRenamed(
            "descriptive_terms", "cluster_descriptive_terms"
        )

    def analyze(self, texts: DataFrame, id_col="conversation_id", text_col="customer_text", **encoding):
        """One result row per text. Long texts are cut into chunks and pooled."""
        # both branches read the same rows, worked out once
        texts = written(texts.select(id_col, text_col), "texts-to-analyze")
        labelled = predict(self.classifier, texts)
        vectors = encode_long_texts(texts, text_col, self.encoder, id_col=id_col, **encoding)
        placed = nearest_center(vectors, "embedding", self.centers).drop("embedding")
        # A left join: a text without a vector must be seen, and stop the job, not vanish.
        return self._finish(labelled.join(placed, id_col, "left"), id_col, text_col)

    def analyze_stateless(self, texts: DataFrame, id_col="conversation_id", text_col="customer_text"):
        """Same result for texts that fit the encoder, without any shuffle: also for streams."""
        labelled = predict(self.classifier, texts.select(id_col, text_col))
        if hasattr(self.encoder, "encode"):
            encoded = self.encoder.encode(labelled, text_col, "_embedding")
        else:
            encoded = encode_texts(labelled, text_col, self.encoder, "_embedding")
        return self._finish(nearest_center(encoded, "_embedding", self.centers), id_col, text_col)


def write_analysis(ready: Analyzer, texts: DataFrame, path, checkpoint, trigger=None, **columns) -> StreamingQuery:
    """Append the results of a stream of short texts to a Parquet table. The fitted parts go to the tasks once
    per micro-batch plan, and nothing is kept between batches."""
    return (
        ready.analyze_stateless(texts, **columns).writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start(path)
    )
