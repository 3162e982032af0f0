"""Vector expressions on array columns."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def dot(a, b) -> Column:
    products = F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def norm(a) -> Column:
    return F.sqrt(dot(a, a))


def cosine_similarity(a, b) -> Column:
    """Cosine of two arrays; a zero vector is an error."""
    size = norm(a) * norm(b)
    return F.when(
        size == 0, F.raise_error(F.lit("cosine similarity is not defined for a zero vector")).cast("double")
    ).otherwise(dot(a, b) / size)


def vector_problem(v, dimension) -> Column:
    """Why a vector cannot be used; null when it can."""
    v = _col(v)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        F.when(v.isNull(), F.lit("missing"))
        .when(F.size(v) != dimension, F.lit("wrong dimension"))
        .when(~finite, F.lit("not finite"))
        .when(norm(v) == 0, F.lit("zero norm"))
    )


def softmax(scores) -> Column:
    """Probabilities of an array of class scores. The largest score goes first, so none overflows."""
    scores = F.col(scores) if isinstance(scores, str) else scores

    def scaled(odds):
        return F.transform(odds, lambda x: x / F.aggregate(odds, F.lit(0.0), lambda a, b: a + b))

    odds = F.transform(scores, lambda x: F.exp(x - F.array_max(scores)))
    return F.transform(F.array(odds), scaled)[0]


def label_and_confidence(probabilities, labels) -> tuple[Column, Column]:
    """(label, confidence): the class of the largest probability, the first of equals, and that probability."""
    p = F.col(probabilities) if isinstance(probabilities, str) else probabilities
    at = F.array_position(p, F.array_max(p)).cast("int")
    return F.get(F.array(*[F.lit(x) for x in labels]), at - 1), F.array_max(p)
