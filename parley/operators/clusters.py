"""Cluster sizes, choice of K, and description of clusters by terms, domains and representatives."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parley import constants as C
from parley.operators.centers import CenterMatrix, own_center
from parley.operators.ranking import top_per_group


def cluster_sizes(labels: DataFrame, k: int, cluster_col="cluster_id") -> DataFrame:
    """(cluster_id, n) for every id below k, 0 for an empty one."""
    counts = labels.groupBy(F.col(cluster_col).cast("int").alias("cluster_id")).agg(
        F.count("*").alias("n")
    )
    ids = labels.sparkSession.range(k).select(F.col("id").cast("int").alias("cluster_id"))
    return ids.join(counts, "cluster_id", "left").select(
        "cluster_id", F.coalesce("n", F.lit(0)).cast("long").alias("n")
    )


def cluster_size_stats(sizes: DataFrame) -> DataFrame:
    return sizes.agg(
        F.count("*").alias("k"),
        F.min("n").alias("min_size"),
        F.max("n").alias("max_size"),
        (F.max("n") / F.sum("n")).alias("max_share"),
    )


def candidate_verdicts(candidates: DataFrame, min_size=C.MIN_CLUSTER_SIZE, max_share=C.MAX_CLUSTER_SHARE,
                       tolerance=C.SILHOUETTE_TOLERANCE) -> DataFrame:
    """The candidates with what the rule says of each: 'chosen', or why not. With no viable candidate all rows
    say why, and none is chosen."""
    named = candidates.select([F.col(c) for c in candidates.columns])
    chosen = select_k(named, min_size, max_share, tolerance).select(F.col("k").alias("_k"), "best_silhouette")
    verdict = (
        F.when(F.col("min_size") < min_size, F.lit("a cluster is too small"))
        .when(F.col("max_share") > max_share, F.lit("a cluster is too large"))
        .when(F.col("k") == F.col("_k"), F.lit("chosen"))
        .when(F.col("silhouette") < F.col("best_silhouette") - tolerance, F.lit("silhouette too low"))
        .otherwise(F.lit("a smaller k is as good"))
    )
    # one row at most stands beside a handful of candidates
    return named.join(F.broadcast(chosen), F.lit(True), "left").withColumn("verdict", verdict).drop("_k", "best_silhouette")


def select_k(candidates: DataFrame, min_size=C.MIN_CLUSTER_SIZE, max_share=C.MAX_CLUSTER_SHARE,
             tolerance=C.SILHOUETTE_TOLERANCE) -> DataFrame:
    """Smallest viable k within `tolerance` of the best viable silhouette, with that best score.

    No row when no candidate is viable; `require_k` turns that into an error.
    """
    viable = candidates.where(
        (F.col("min_size") >= min_size) & (F.col("max_share") <= max_share)
    )
    best = viable.agg(F.max("silhouette").alias("best")).scalar()
    return (
        viable.withColumn("best_silhouette", best)
        .where(F.col("silhouette") >= F.col("best_silhouette") - tolerance)
        .orderBy("k").limit(1)
    )


def require_k(selected: DataFrame):
    row = selected.first()
    if row is None:
        raise ValueError("no candidate passed the size checks; no K was chosen")
    return row


def cluster_domains(labels: DataFrame, cluster_col="cluster_id", domain_col="domain", limit=None) -> DataFrame:
    """Domains of every cluster, most frequent first, with their share of the cluster."""
    counts = labels.groupBy(cluster_col, domain_col).agg(F.count("*").alias("n"))
    w = Window.partitionBy(cluster_col)
    ranked = counts.withColumn("share", F.col("n") / F.sum("n").over(w)).withColumn(
        "rank", F.row_number().over(w.orderBy(F.desc("n"), domain_col))
    )
    return ranked if limit is None else ranked.where(F.col("rank") <= limit)


def descriptive_terms(weights: DataFrame, labels: DataFrame, id_col="conversation_id",
                      cluster_col="cluster_id", limit=8) -> DataFrame:
    """Terms of highest mean TF-IDF weight in every cluster, zeros counted, ties by term.

    The sum per (cluster, term) is combined in every task before it is shuffled.
    """
    labelled = labels.select(id_col, F.col(cluster_col).alias("cluster_id"))
    sizes = labelled.groupBy("cluster_id").agg(F.count("*").alias("size"))
    sums = (
        weights.join(labelled, id_col).groupBy("cluster_id", "term")
        .agg(F.sum("weight").alias("total")).where("total > 0")
    )
    means = sums.join(sizes, "cluster_id").select(
        "cluster_id", "term", (F.col("total") / F.col("size")).alias("weight")
    )
    # Rounding keeps the order of equal means independent of the order of addition.
    return top_per_group(means, ["cluster_id"], [F.desc(F.round("weight", 12)), F.asc("term")], limit)


def terms_table(ranked: DataFrame, k=None) -> DataFrame:
    """(cluster_id, descriptive_terms) in rank order; with k, also the clusters without terms."""
    lists = ranked.groupBy("cluster_id").agg(
        F.array_sort(F.collect_list(F.struct("rank", "term"))).alias("_t")
    ).select(
        F.col("cluster_id").cast("int").alias("cluster_id"),
        F.transform("_t", lambda t: t["term"]).alias("descriptive_terms"),
    )
    if k is None:
        return lists
    ids = ranked.sparkSession.range(k).select(F.col("id").cast("int").alias("cluster_id"))
    return ids.join(lists, "cluster_id", "left").withColumn(
        "descriptive_terms", F.coalesce("descriptive_terms", F.array().cast("array<string>"))
    )


def centroid_terms(model: CenterMatrix, terms, spark, limit=8) -> DataFrame:
    """Terms of highest weight in every centre; ties by term, zero weights kept.

    Works on the k x vocabulary numbers of a fitted model only.
    """
    named = spark.createDataFrame([(i, t) for i, t in enumerate(terms)], "position int, term string")
    weights = model.to_dataframe(spark).select(
        "cluster_id", F.posexplode("center").alias("position", "weight")
    )
    return top_per_group(
        weights.join(named, "position").select("cluster_id", "term", "weight"),
        ["cluster_id"], [F.desc("weight"), F.asc("term")], limit,
    )


def representatives_by_distance(df: DataFrame, vector_col, cluster_col, model: CenterMatrix,
                                id_col="conversation_id", limit=3) -> DataFrame:
    """Rows nearest to their centre by Euclidean distance, ties by id."""
    scored = own_center(df, vector_col, cluster_col, model).select(
        F.col(cluster_col).alias("cluster_id"), id_col, F.col("own_distance").alias("distance")
    )
    return top_per_group(scored, ["cluster_id"], [F.col("distance"), F.col(id_col)], limit)


def representatives_by_cosine(df: DataFrame, vector_col, cluster_col, model: CenterMatrix,
                              id_col="conversation_id", limit=3) -> DataFrame:
    """Rows nearest to their centre by cosine, ties by id. A zero centre is an error."""
    if not (model.values != 0).any(axis=1).all():
        raise ValueError("cosine similarity is not defined for a zero centre")
    scored = own_center(df, vector_col, cluster_col, model).select(
        F.col(cluster_col).alias("cluster_id"), id_col, F.col("own_similarity").alias("similarity")
    )
    return top_per_group(scored, ["cluster_id"], [F.desc("similarity"), F.col(id_col)], limit)
