"""Vectors against the centres of a cluster model.

A model has k centres of d numbers. Up to MAX_MODEL_VALUES of them go to the tasks as one matrix, and every row
meets all of them in one matrix product over an Arrow batch; the row table is neither joined nor shuffled.

A larger model stays a table. Its centres are dealt to blocks and the rows to groups; a group meets a block in one
task, which gives each row its best centre of the block, and the best of all blocks is a minimum per row. Neither
the driver nor a task ever holds more than a block. No row is paired with another row in either form.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.operators.blocks import small_batches
from parley.sources.workspace import written

MAX_MODEL_VALUES = 50_000_000  # 400 MB of doubles
_BLOCK = 200_000


class CenterMatrix:
    """Ids and values of the centres, held on the driver and sent with the tasks."""

    def __init__(self, ids, values):
        self.ids = np.asarray(ids, dtype=np.int32)
        self.values = np.atleast_2d(np.asarray(values, dtype=float))
        if len(self.ids) != len(self.values) or not np.isfinite(self.values).all():
            raise ValueError("centres are not valid")

    @classmethod
    def collect(cls, centers: DataFrame, id_col="cluster_id", center_col="center"):
        """The matrix of a table of centres, whose size is looked at first."""
        rows = _center_rows(centers, id_col, center_col).persist()  # looked at twice, worked out once
        try:
            k, d = model_size(rows)
            if k == 0:
                raise ValueError("there are no centres")
            if k * d > MAX_MODEL_VALUES:
                raise ValueError(f"{k} centres of {d} values are a table, see nearest_center_of")
            got = sorted(rows.collect(), key=lambda r: r.cluster_id)
        finally:
            rows.unpersist()
        return cls([r.cluster_id for r in got], [r.center for r in got])

    @classmethod
    def of_model(cls, model):
        values = np.array(model.clusterCenters())
        return cls(range(len(values)), values)

    def to_dataframe(self, spark) -> DataFrame:
        rows = [(int(i), [float(x) for x in v]) for i, v in zip(self.ids, self.values)]
        return spark.createDataFrame(rows, "cluster_id int, center array<double>")

    @property
    def dimension(self):
        return self.values.shape[1]


def _center_rows(centers: DataFrame, id_col, center_col) -> DataFrame:
    return centers.select(F.col(id_col).cast("int").alias("cluster_id"), F.col(center_col).cast("array<double>").alias("center"))


def model_size(centers: DataFrame) -> tuple[int, int]:
    """(centres, values of one) of a table of centres."""
    size = centers.agg(F.count("*").alias("k"), F.max(F.size("center")).alias("d")).first()
    return size.k, size.d or 0


def mean_centers(df: DataFrame, cluster_col, vector_col) -> DataFrame:
    """(cluster_id, center, n): mean vector of every given cluster, combined before the shuffle."""
    vector = _as_vector(df, vector_col)
    return df.groupBy(F.col(cluster_col).cast("int").alias("cluster_id")).agg(
        F.count("*").alias("n"), Summarizer.mean(vector).alias("_m")
    ).select("cluster_id", "n", _as_array("_m").alias("center"))


def _as_vector(df, vector_col):
    if isinstance(df.schema[vector_col].dataType, VectorUDT):
        return F.col(vector_col)
    return array_to_vector(F.col(vector_col).cast("array<double>"))


def _as_array(c):
    from pyspark.ml.functions import vector_to_array

    return vector_to_array(c)


def _parts(df, vector_col):
    """Struct (indices, values) of a vector column; no indices means every position."""
    if isinstance(df.schema[vector_col].dataType, VectorUDT):
        raw = F.unwrap_udt(F.col(vector_col))
        return F.struct(raw["indices"].alias("indices"), raw["values"].alias("values"))
    return F.struct(
        F.lit(None).cast("array<int>").alias("indices"),
        F.col(vector_col).cast("array<double>").alias("values"),
    )


def _products(batch: pa.StructArray, matrix):
    """(dot products n x k, squared norms n) of a batch of dense or sparse rows with k centres."""
    values = batch.field("values")
    flat = values.flatten().to_numpy(zero_copy_only=False)
    lengths = values.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    n, (k, d) = len(batch), matrix.shape
    if batch.field("indices").null_count == n:
        if n and (lengths != d).any():
            raise ValueError(f"a vector does not have {d} values")
        dense = flat.reshape(n, d)
        return dense @ matrix.T, np.einsum("ij,ij->i", dense, dense)
    where = batch.field("indices")
    if where.null_count:  # dense and sparse rows side by side: spell the dense ones out
        index = np.concatenate([
            np.asarray(i, dtype=np.int64) if i is not None else np.arange(m)
            for i, m in zip(where.to_pylist(), lengths)
        ]) if n else np.empty(0, np.int64)
    else:
        index = where.flatten().to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(n), lengths)
    dots, squares = np.zeros((n, k)), np.bincount(owner, flat * flat, minlength=n)
    columns = np.ascontiguousarray(matrix.T)
    ends = np.concatenate([[0], np.cumsum(lengths)])
    row = 0
    while row < n:  # blocks of whole rows keep the scratch matrix small
        stop = max(row + 1, int(np.searchsorted(ends, ends[row] + _BLOCK, side="right")) - 1)
        lo, hi = ends[row], ends[stop]
        if hi > lo:
            np.add.at(dots, owner[lo:hi], flat[lo:hi, None] * columns[index[lo:hi]])
        row = stop
    return dots, squares


_SCORE = "struct<cluster_id:int,distance:double,similarity:double>"


def _score_column(df, vector_col, model: CenterMatrix, own_cluster=None):
    small_batches(df.sparkSession)
    ids, matrix = model.ids, model.values
    center_squares = np.einsum("ij,ij->i", matrix, matrix)

    def score(parts, chosen):
        dots, squares = _products(parts, matrix)
        distance2 = np.maximum(squares[:, None] - 2 * dots + center_squares[None, :], 0.0)
        at = distance2.argmin(axis=1) if chosen is None else np.searchsorted(ids, chosen)
        if chosen is not None and len(chosen) and (
            (at >= len(ids)).any() or (ids[np.minimum(at, len(ids) - 1)] != chosen).any()
        ):
            raise ValueError("a row names a cluster without a centre")
        rows = np.arange(len(dots))
        size = np.sqrt(squares * center_squares[at])
        with np.errstate(divide="ignore", invalid="ignore"):
            similarity = np.where(size > 0, dots[rows, at] / size, np.nan)
        return pa.StructArray.from_arrays(
            [pa.array(ids[at]), pa.array(np.sqrt(distance2[rows, at])),
             pa.array(similarity, mask=np.isnan(similarity))],
            names=["cluster_id", "distance", "similarity"],
        )

    if own_cluster is None:
        @F.arrow_udf(_SCORE)
        def nearest(parts: pa.Array) -> pa.Array:
            return score(parts, None)

        return nearest(_parts(df, vector_col))

    @F.arrow_udf(_SCORE)
    def own(parts: pa.Array, cluster: pa.Array) -> pa.Array:
        return score(parts, cluster.to_numpy(zero_copy_only=False))

    return own(_parts(df, vector_col), F.col(own_cluster).cast("int"))


def nearest_center(df: DataFrame, vector_col, model: CenterMatrix, prefix="") -> DataFrame:
    """Add cluster_id, distance and similarity of the nearest centre; the smaller id wins a tie.

    The similarity is null where it is not defined, that is for a zero vector or centre.
    """
    return _unpack(df.withColumn("_score", _score_column(df, vector_col, model)), prefix)


def own_center(df: DataFrame, vector_col, cluster_col, model: CenterMatrix, prefix="own_") -> DataFrame:
    """Add distance and similarity of every row to the centre of the cluster it belongs to."""
    scored = df.withColumn("_score", _score_column(df, vector_col, model, cluster_col))
    return _unpack(scored, prefix).drop(f"{prefix}cluster_id")


def _unpack(scored, prefix):
    return scored.select(
        *[c for c in scored.columns if c != "_score"],
        *[F.col(f"_score.{f}").alias(f"{prefix}{f}") for f in ("cluster_id", "distance", "similarity")],
    )


# ---- models that stay a table ----

BLOCK_VALUES = 4_000_000  # numbers of a block of centres: 32 MB
GROUP_VALUES = 8_000_000  # numbers of a group of rows


def _matrix(blocks: pa.Table, dimension):
    """(ids, counts, matrix) of a block of centres, by id."""
    ids, flat = blocks["_id"].to_numpy(), blocks["_center"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    if len(flat) != len(ids) * dimension or not np.isfinite(flat).all():
        raise ValueError("centres are not valid")
    order = np.argsort(ids)
    return ids[order], blocks["_n"].to_numpy()[order], flat.reshape(len(ids), dimension)[order]


def _by_blocks(rows: DataFrame, vector_col, keep, centers: DataFrame, score, schema) -> DataFrame:
    """`score(rows of a group, block)` of every group of rows against every block of centres.

    rows: written, with `_row`; centers: written (_id, _n, _center). A row goes to every block, a block to every
    group of rows, both of bounded size.
    """
    k, d = centers.count(), centers.agg(F.max(F.size("_center"))).first()[0]
    blocks = max(1, math.ceil(k * d / BLOCK_VALUES))
    groups = max(1, math.ceil(rows.count() * d / GROUP_VALUES))
    every = lambda n, kind: F.explode(F.sequence(F.lit(0).cast(kind), F.lit(n - 1).cast(kind)))
    left = rows.select("_row", *keep, _parts(rows, vector_col).alias("_p"), F.pmod(F.xxhash64("_row"), F.lit(groups)).alias("_g"), every(blocks, "int").alias("_b"))
    right = centers.select("_id", "_n", "_center", F.pmod(F.xxhash64("_id"), F.lit(blocks)).cast("int").alias("_b"), every(groups, "long").alias("_g"))

    def meet(some: pa.Table, block: pa.Table) -> pa.Table:
        if not some.num_rows or not block.num_rows:
            return kind.empty_table()
        return score(some, _matrix(block, d)).cast(kind)

    kind = pa.schema([(name, {"long": pa.int64(), "int": pa.int32(), "double": pa.float64()}[t]) for name, t in (c.split() for c in schema.split(", "))])
    return left.groupBy("_b", "_g").cogroup(right.groupBy("_b", "_g")).applyInArrow(meet, schema)


def _kept_rows(df: DataFrame) -> DataFrame:
    """The rows with a number that stays theirs."""
    return written(df.withColumn("_row", F.monotonically_increasing_id()), "center-rows")


def nearest_center_of(df: DataFrame, vector_col, centers: DataFrame, id_col="cluster_id", center_col="center", prefix="") -> DataFrame:
    """As `nearest_center`, of a table of centres of any size."""
    model = written(_center_rows(centers, id_col, center_col), "centers")
    k, d = model_size(model)
    if k * d <= MAX_MODEL_VALUES:
        return nearest_center(df, vector_col, CenterMatrix.collect(model), prefix)
    rows = _kept_rows(df)

    def score(some, block):
        ids, _, matrix = block
        dots, squares = _products(some["_p"].combine_chunks(), matrix)
        center_squares = np.einsum("ij,ij->i", matrix, matrix)
        distance2 = np.maximum(squares[:, None] - 2 * dots + center_squares[None, :], 0.0)
        at = distance2.argmin(axis=1)
        here = np.arange(len(at))
        size = np.sqrt(squares * center_squares[at])
        with np.errstate(divide="ignore", invalid="ignore"):
            similarity = np.where(size > 0, dots[here, at] / size, np.nan)
        return pa.table({"_row": some["_row"], "d2": distance2[here, at], "id": ids[at], "s": pa.array(similarity, mask=np.isnan(similarity))})

    table = model.select(F.col("cluster_id").alias("_id"), F.lit(1).cast("long").alias("_n"), F.col("center").alias("_center"))
    found = _by_blocks(rows, vector_col, [], table, score, "_row long, d2 double, id int, s double")
    best = found.groupBy("_row").agg(F.min(F.struct("d2", "id", "s")).alias("_best"))
    score_of = F.struct(F.col("_best.id").alias("cluster_id"), F.sqrt("_best.d2").alias("distance"), F.col("_best.s").alias("similarity"))
    return _unpack(rows.join(best, "_row").withColumn("_score", score_of).drop("_row", "_best"), prefix)


def _widths(a, b, mine):
    """Silhouette of rows from the mean distance to their own cluster, to the nearest other, and the own size."""
    top = F.greatest(a, b)
    return F.when((mine > 1) & (top != 0), (b - a) / top).otherwise(F.lit(0.0))


def _silhouette_by_blocks(unit: DataFrame, sums: DataFrame) -> DataFrame:
    """Per row the distance to its own cluster and the least one to another, over blocks of cluster sums."""
    rows = _kept_rows(unit)

    def score(some, block):
        ids, counts, matrix = block
        dots, squares = _products(some["_p"].combine_chunks(), matrix)
        away = 1 - dots / counts[None, :]
        own = some["_c"].to_numpy()
        at = np.minimum(np.searchsorted(ids, own), len(ids) - 1)
        here = ids[at] == own
        line = np.arange(len(own))
        a = np.where(here, (counts[at] - 1 - (dots[line, at] - squares)) / np.maximum(counts[at] - 1, 1), np.nan)
        away[line[here], at[here]] = np.inf
        b = away.min(axis=1)
        return pa.table({"_row": some["_row"], "a": pa.array(a, mask=~here), "b": pa.array(b, mask=np.isinf(b)), "mine": pa.array(counts[at], mask=~here)})

    found = _by_blocks(rows, "_u", ["_c"], sums, score, "_row long, a double, b double, mine long")
    return found.groupBy("_row").agg(F.max("a").alias("a"), F.min("b").alias("b"), F.max("mine").alias("mine")).select(
        _widths(F.col("a"), F.col("b"), F.col("mine")).alias("w"))


def cosine_silhouette(df: DataFrame, vector_col, cluster_col) -> DataFrame:
    """Exact mean cosine silhouette in one pass over the rows: (silhouette, rows, clusters).

    The mean distance of a unit row x to a cluster is 1 - x.S/n with S the sum of the cluster's
    unit rows, so k sums replace all pairs. A zero vector has distance 1 to every other row; a
    cluster of one row scores 0; with less than two clusters the score is null. The sums are
    collected only if they are no more than a model that is sent to every task.
    """
    from pyspark.ml.feature import Normalizer

    rows = df.select(
        _as_vector(df, vector_col).alias("_v"), F.col(cluster_col).cast("int").alias("_c")
    )
    unit = Normalizer(p=2.0, inputCol="_v", outputCol="_u").transform(rows).select("_u", "_c")
    sums = unit.groupBy("_c").agg(F.count("*").alias("_n"), Summarizer.sum(F.col("_u")).alias("_s"))
    sums = sums.select(F.col("_c").alias("_id"), "_n", _as_array("_s").alias("_center")).persist()
    try:
        size = sums.agg(F.count("*").alias("k"), F.max(F.size("_center")).alias("d"), F.coalesce(F.sum("_n"), F.lit(0)).alias("n")).first()
        if size.k < 2:
            return df.sparkSession.createDataFrame([(None, size.n, size.k)], "silhouette double, rows long, clusters int")
        if size.k * size.d > MAX_MODEL_VALUES:
            widths = _silhouette_by_blocks(unit, written(sums, "cluster-sums"))
        else:
            widths = _silhouette_at_once(unit, sums)
    finally:
        sums.unpersist()
    return widths.agg(F.avg("w").alias("silhouette"), F.count("*").alias("rows"), F.lit(size.k).alias("clusters"))


def _silhouette_at_once(unit: DataFrame, sums: DataFrame) -> DataFrame:
    small_batches(unit.sparkSession)
    got = sorted(sums.collect(), key=lambda r: r._id)
    matrix = np.array([r._center for r in got])
    ids = np.array([r._id for r in got])
    counts = np.array([r._n for r in got], dtype=float)

    @F.arrow_udf("double")
    def width(parts: pa.Array, cluster: pa.Array) -> pa.Array:
        dots, squares = _products(parts, matrix)
        at = np.searchsorted(ids, cluster.to_numpy(zero_copy_only=False))
        rows_at = np.arange(len(dots))
        mine = counts[at]
        others = np.maximum(mine - 1, 1)
        a = (mine - 1 - (dots[rows_at, at] - squares)) / others
        away = 1 - dots / counts[None, :]
        away[rows_at, at] = np.inf
        b = away.min(axis=1)
        top = np.maximum(a, b)
        with np.errstate(divide="ignore", invalid="ignore"):
            s = np.where((mine > 1) & (top != 0), (b - a) / top, 0.0)
        return pa.array(s)

    return unit.select(width(_parts(unit, "_u"), F.col("_c")).alias("w"))
