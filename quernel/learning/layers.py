"""Linear and layered classifiers as SQL expressions, and a proof that a linear fit is optimal."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _affine(weights, bias) -> Callable[[Column], Column]:
    """``x -> W x + b`` over an array of doubles; W is a list of rows."""
    units = [{"w": [float(v) for v in row], "b": float(b)} for row, b in zip(weights, bias, strict=True)]
    constant = F.from_json(F.lit(json.dumps(units)), "array<struct<w:array<double>,b:double>>")

    def apply(x: Column) -> Column:
        def unit(u):
            return F.aggregate(F.zip_with(u["w"], x, lambda a, b: a * b), u["b"], lambda s, v: s + v)

        return F.transform(constant, unit)

    return apply


def softmax(scores: Column) -> Column:
    def shares(s):
        top = F.array_max(s)
        raised = F.transform(s, lambda v: F.exp(v - top))
        return let(raised, lambda e: F.transform(e, lambda v: v / F.aggregate(e, F.lit(0.0), lambda a, b: a + b)))

    return let(scores, shares)


def arg_max(scores: Column) -> Column:
    """Place of the largest, from 0; the first of equal ones."""
    return let(scores, lambda s: F.array_position(s, F.array_max(s)) - 1).cast("double")


def linear_scores(model, x: Column) -> Column:
    """Margins of a logistic model, one per class."""
    return _affine(model.coefficientMatrix.toArray().tolist(), model.interceptVector.toArray().tolist())(x)


def perceptron_layers(model) -> list[tuple[list, list]]:
    """(matrix, bias) per layer from the model's one vector of weights.

    Layer by layer it holds the matrix column by column, then the bias.
    """
    sizes, vector, layers, at = list(model.getLayers()), model.weights.toArray(), [], 0
    for inputs, outputs in zip(sizes, sizes[1:]):
        matrix = vector[at : at + inputs * outputs].reshape(inputs, outputs).T
        at += inputs * outputs
        layers.append((matrix.tolist(), vector[at : at + outputs].tolist()))
        at += outputs
    if at != len(vector):
        raise ValueError("the weights do not fit the layers")
    return layers


def perceptron_scores(model, x: Column) -> Column:
    """The output layer before its softmax; hidden layers are sigmoid."""
    *hidden, last = perceptron_layers(model)

    def forward(value: Column, rest) -> Column:
        if not rest:
            return _affine(*last)(value)
        active = F.transform(_affine(*rest[0])(value), lambda v: 1 / (1 + F.exp(-v)))
        return let(active, lambda a: forward(a, rest[1:]))

    return let(x, lambda v: forward(v, hidden))


def optimality(
    rows: DataFrame, model, features: Sequence[str], label: str, words: Sequence[str], tolerance: float = 1e-4
) -> DataFrame:
    """``word, feature, weight, slack, state, optimal`` of each coefficient of an elastic-net fit.

    One pass over the training rows sums the gradient of the mean log loss for every class
    and feature. With b the coefficient and g the gradient on the scale of the standardised
    feature, l1 and l2 the two penalties, a minimum has g + l2 b + l1 sign(b) = 0 where b is not
    zero and |g| <= l1 where it is; intercepts have g = 0. ``slack`` is by how much that fails. The loss is convex,
    so a fit that holds everywhere is a global minimum.
    """
    names = list(features)
    x = F.array(*[F.col(c).cast("double") for c in names])
    scored = rows.select(x.alias("x"), F.col(label).alias("y")).withColumn("p", softmax(linear_scores(model, F.col("x"))))
    off = [F.get("p", F.lit(k)) - (F.col("y") == k).cast("double") for k in range(len(words))]
    sums = [F.sum(off[k]).alias(f"g{k}_") for k in range(len(words))]
    sums += [F.sum(off[k] * F.get("x", F.lit(j))).alias(f"g{k}_{j}") for k in range(len(words)) for j in range(len(names))]
    spreads = [F.stddev_samp(F.get("x", F.lit(j))).alias(f"s{j}") for j in range(len(names))]
    state = scored.agg(F.count("*").alias("n"), *sums, *spreads).first()
    net, penalty = model.getElasticNetParam(), model.getRegParam()
    l1, l2 = penalty * net, penalty * (1 - net)
    weights = model.coefficientMatrix.toArray()
    out = []
    for k, word in enumerate(words):
        free = abs(state[f"g{k}_"]) / state.n
        out.append((word, "intercept", float(model.interceptVector[k]), free, "free", free <= tolerance))
        for j, name in enumerate(names):
            spread = state[f"s{j}"] or 0.0
            b = float(weights[k][j]) * spread
            g = state[f"g{k}_{j}"] / state.n / spread if spread else 0.0
            sign = (b > 0) - (b < 0)
            slack = abs(g + l2 * b + l1 * sign) if sign else max(0.0, abs(g) - l1)
            kind = ("negative", "zero", "positive")[sign + 1]
            out.append((word, name, float(weights[k][j]), slack, kind, slack <= tolerance))
    schema = "word string, feature string, weight double, slack double, state string, optimal boolean"
    return rows.sparkSession.createDataFrame(out, schema)
