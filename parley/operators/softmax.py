"""Multinomial logistic regression with an L2 penalty on the coefficients as they are.

Spark's own estimator solves in coordinates scaled by a feature's deviation; with a penalty on unscaled coefficients
that is badly conditioned for rare terms, and takes many hundred passes. Here a pass is one Spark job that sums
loss and gradient over the rows, and the coordinates are scaled by the penalty and the mean square of a feature,
in which the problem is nearly even. The result is an ordinary model of Spark ML.

The driver holds the coefficients, as many numbers as a model has (classes x vocabulary); rows stay where they are. A
task sums its gradient, the sums of all tasks meet in slices of the model, and only their totals come to the driver.
"""

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import DenseMatrix, DenseVector
from pyspark.ml.wrapper import JavaWrapper
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.operators.blocks import BLOCK, as_blocks, block_sums, small_batches
from parley.sources.workspace import written

MEMORY = 12  # steps that the solver remembers


@dataclass
class Fit:
    coefficients: np.ndarray  # classes x features
    intercepts: np.ndarray
    objective: float
    passes: int
    converged: bool


def _direction(g, steps):
    """The L-BFGS direction from the last steps and changes of gradient."""
    q, used = -g, []
    for s, y in reversed(steps):
        a = (s @ q) / (s @ y)
        used.append(a)
        q = q - a * y
    if steps:
        s, y = steps[-1]
        q = q * ((s @ y) / (y @ y))
    for (s, y), a in zip(steps, reversed(used)):
        q = q + s * (a - (y @ q) / (s @ y))
    return q


def minimise(evaluate: Callable, start: np.ndarray, tol: float, max_passes: int):
    """(x, value, passes, converged): the minimum of a convex function by L-BFGS with halving of steps. It is
    reached where the gradient is `tol` of the one at zero."""
    x, passes, steps = start, 1, []
    f, g = evaluate(x)
    goal = tol * np.linalg.norm(g)
    if x.any():
        goal, passes = tol * np.linalg.norm(evaluate(np.zeros_like(x))[1]), 2
    while np.linalg.norm(g) > goal and passes < max_passes:
        d = _direction(g, steps)
        slope = g @ d
        if slope >= 0:  # what is remembered is no help
            steps, d = [], -g
            slope = g @ d
        step = 1.0 if steps else min(1.0, 1.0 / np.linalg.norm(g))
        while True:
            f2, g2 = evaluate(x + step * d)
            passes += 1
            if f2 <= f + 1e-4 * step * slope or passes >= max_passes:
                break
            step /= 2
        s, y = step * d, g2 - g
        if s @ y > 1e-12 * (y @ y):
            steps = [*steps, (s, y)][-MEMORY:]
        if f2 >= f and np.linalg.norm(g2) >= np.linalg.norm(g):
            break  # no more to gain at this precision
        x, f, g = x + s, f2, g2
    return x, f, passes, bool(np.linalg.norm(g) <= goal)


def fit_softmax(rows: DataFrame, classes: int, dimension: int, penalty: float, features_col="features",
                label_col="_label", tol=1e-4, max_passes=200, start: Fit = None) -> Fit:
    """Minimum of mean log loss + penalty / 2 * squared coefficients; intercepts are free, and sum to 0.

    rows: vectors of `dimension` numbers with labels 0..classes-1. `start` is an earlier fit to go on from.
    """
    small_batches(rows.sparkSession)
    raw = F.unwrap_udt(F.col(features_col))
    vectors = rows.select(F.struct(raw["indices"].alias("indices"), raw["values"].alias("values")).alias("_p"),
                          F.col(label_col).cast("int").alias("_label"))
    data = written(vectors.mapInArrow(as_blocks, BLOCK), "training-vectors")

    def squares(total, at, flat, lengths, labels):
        total += np.append(np.bincount(at, flat * flat, minlength=dimension), len(labels))

    total = block_sums(data, squares, dimension + 1)
    count = int(total[-1])
    if count == 0:
        raise ValueError("there are no rows to learn from")
    # in these coordinates the curvature is about one everywhere
    scale = np.sqrt(penalty + total[:-1] / count / classes)

    def evaluate(u):
        w, b = u[:-classes].reshape(dimension, classes) / scale[:, None], u[-classes:]

        columns = np.ascontiguousarray(w.T)

        def add(sums, at, flat, lengths, labels):
            n, filled = len(labels), lengths > 0
            starts = (np.cumsum(lengths, dtype=np.int64) - lengths)[filled]
            scores = np.tile(b, (n, 1))
            for k in range(classes if len(starts) else 0):
                scores[filled, k] += np.add.reduceat(flat * columns[k][at], starts)
            scores -= scores.max(axis=1, keepdims=True)
            odds = np.exp(scores)
            total = odds.sum(axis=1)
            line = np.arange(n)
            loss = float((np.log(total) - scores[line, labels]).sum())
            away = odds / total[:, None]
            away[line, labels] -= 1
            g = np.stack([np.bincount(at, flat * np.repeat(away[:, k], lengths), minlength=dimension) for k in range(classes)], axis=1)
            sums += np.concatenate((g.ravel(), away.sum(axis=0), [loss]))

        total = block_sums(data, add, dimension * classes + classes + 1) / count
        value = total[-1] + penalty / 2 * float((w * w).sum())
        g = total[:-classes - 1].reshape(dimension, classes) + penalty * w
        return value, np.concatenate(((g / scale[:, None]).ravel(), total[-classes - 1:-1]))

    if start is None:
        u = np.zeros(dimension * classes + classes)
    else:
        u = np.concatenate(((start.coefficients.T * scale[:, None]).ravel(), start.intercepts))
    u, value, passes, converged = minimise(evaluate, u, tol, max_passes)
    w, b = u[:-classes].reshape(dimension, classes) / scale[:, None], u[-classes:]
    return Fit(np.ascontiguousarray(w.T), b - b.mean(), value, passes + 1, converged)


def as_model(spark: SparkSession, fit: Fit) -> LogisticRegressionModel:
    """The fit as a model of Spark ML, which transforms, saves and loads like one that Spark has fitted."""
    k, d = fit.coefficients.shape
    sc = spark.sparkContext
    java = JavaWrapper._new_java_obj(
        "org.apache.spark.ml.classification.LogisticRegressionModel", "logreg_softmax",
        _py2java(sc, DenseMatrix(k, d, fit.coefficients.ravel(order="F").tolist())),
        _py2java(sc, DenseVector(fit.intercepts.tolist())), k, True)
    return LogisticRegressionModel(java)
