"""Ranks inside groups of any size."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKET_HEX_DIGITS = 4


def hash_order(seed, id_col):
    """Reproducible pseudo-random order of ids: the same in every engine that has md5."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


def rank_by_hash(df: DataFrame, group_col, id_col, seed, digits=BUCKET_HEX_DIGITS) -> DataFrame:
    """Add `rn`, the 1-based place of a row inside its group by hash order, and `group_size`.

    A window over the group would sort a large group in one task. The rows are cut by the first
    digits of the hash instead; a row's place is the number of rows in the buckets before its own
    plus its place inside the bucket. The offsets have at most 16**digits rows per group, and both
    steps share one partitioning by (group, bucket).
    """
    keyed = df.withColumn("_h", hash_order(seed, id_col)).withColumn(
        "_b", F.substring("_h", 1, digits)
    )
    by_group = Window.partitionBy(group_col)
    before = by_group.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        keyed.groupBy(group_col, "_b").agg(F.count("*").alias("_n"))
        .withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .withColumn("group_size", F.sum("_n").over(by_group))
        .drop("_n")
    )
    inside = Window.partitionBy(group_col, "_b").orderBy("_h", id_col)
    # null-safe: rows of the null group, and rows without an id, have a place too
    offsets = offsets.withColumnsRenamed({group_col: "_group", "_b": "_bucket"})
    return (
        keyed.withColumn("_rn", F.row_number().over(inside))
        .join(offsets, F.col(group_col).eqNullSafe(F.col("_group")) & F.col("_b").eqNullSafe(F.col("_bucket")))
        .withColumn("rn", F.col("_off") + F.col("_rn"))
        .drop("_h", "_b", "_off", "_rn", "_group", "_bucket")
    )


def top_per_group(df: DataFrame, group_cols, order, limit, rank_col="rank") -> DataFrame:
    """First `limit` rows of every group.

    Comparing the row number with a constant lets Spark keep only `limit` rows per group in every
    task before the shuffle, so a large group is never moved as a whole.
    """
    w = Window.partitionBy(*group_cols).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= limit)
