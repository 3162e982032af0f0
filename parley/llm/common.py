"""Helpers shared by the operators of this subpackage."""

from pyspark.sql import Column, DataFrame, functions as F

from parley.sources.workspace import written

#: ASCII white space that parts words, as a pattern for Spark and for Python.
SPACE = r"[\x20\x09-\x0D]+"
#: A table of at most so many rows of a few numbers each may be broadcast; it is counted first.
SMALL_ROWS = 20_000
SALTS = 64

__all__ = ["SPACE", "words_of", "attach_small", "written"]


def words_of(text: Column) -> Column:
    """Words of a text; none for an empty or null one."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def attach_small(left: DataFrame, right: DataFrame, keys, salts: int = SALTS) -> DataFrame:
    """Left join, null-safe, on `keys`, which name a row of `right` (a written table). A counted, small
    `right` is broadcast. A larger one is repeated `salts` times and joined on a salt too, so that a
    key that holds a third of `left` is dealt over many tasks."""
    if right.count() <= SMALL_ROWS:
        r = right.select([F.col(k).alias(f"_r_{k}") for k in keys]
                         + [c for c in right.columns if c not in keys])
        on = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
        return left.join(F.broadcast(r), on, "left").drop(*[f"_r_{k}" for k in keys])
    r = right.select([F.col(k).alias(f"_r_{k}") for k in keys]
                     + [c for c in right.columns if c not in keys]
                     + [F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_r_salt")])
    salted = left.withColumn("_salt", F.pmod(F.xxhash64(*left.columns), F.lit(salts)).cast("int"))
    on = [F.col("_salt") == F.col("_r_salt")] + [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return salted.join(r, on, "left").drop("_salt", "_r_salt", *[f"_r_{k}" for k in keys])
