"""Colour-word classifier on RGB or LAB features."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.feature import (
    IndexToString,
    SQLTransformer,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernel.functions.colour import COLOUR_RGB, lab_grid, lab_statement, rgb_to_lab
from quernel.learning import evaluate, layers
from quernel.session import cached, spread

# The hidden layer and the share of the absolute penalty.
HIDDEN, ABSOLUTE = 30, 0.5


@dataclass
class Fitted:
    model: PipelineModel
    accuracy: float


def classifier(
    kind: str, inputs: int, labels: int, seed: int = 1, max_iter: int = 100, penalty: float = 0.0, tolerance: float = 1e-6
):
    """``perceptron`` with one hidden layer, or ``logistic`` with an elastic net of weight ``penalty``."""
    columns = {"featuresCol": "features", "labelCol": "label_index"}
    if kind == "perceptron":
        return MultilayerPerceptronClassifier(
            layers=[inputs, HIDDEN, labels], seed=seed, maxIter=max_iter, tol=tolerance, **columns
        )
    if kind == "logistic":
        return LogisticRegression(
            elasticNetParam=ABSOLUTE, regParam=penalty, maxIter=max_iter, tol=tolerance, **columns
        )
    raise ValueError(f"unknown classifier {kind!r}")


def pipeline(
    space: str = "rgb",
    kind: str = "perceptron",
    labels: int = len(COLOUR_RGB),
    features=("R", "G", "B"),
    label: str = "word",
    unseen: str = "error",
    width: int | None = None,
    **settings,
) -> Pipeline:
    """Channels, or LAB made from them by a SQL stage, then label index and classifier.

    A label met only after training is an error; with ``unseen="keep"`` it is
    one more class. ``width`` is the number of inputs where a feature is a vector.
    """
    stages = []
    columns = list(features)
    if space == "lab":
        r, g, b = features
        stages.append(SQLTransformer(statement=lab_statement(keep=[label], r=r, g=g, b=b)))
        columns = ["labL", "labA", "labB"]
    elif space != "rgb":
        raise ValueError(f"unknown colour space {space!r}")
    stages.append(VectorAssembler(inputCols=columns, outputCol="features"))
    stages.append(StringIndexer(inputCol=label, outputCol="label_index", handleInvalid=unseen))
    outputs = labels + (unseen == "keep")
    stages.append(classifier(kind, width or len(columns), outputs, **settings))
    return Pipeline(stages=stages)


def accuracy(predictions: DataFrame) -> float:
    return evaluate.accuracy(predictions, "label_index")


def train(rows: DataFrame, validation: DataFrame, **settings) -> Fitted:
    """Fit on ``rows`` and score ``validation``; both are spread over all cores, and cached for many passes."""
    with cached(spread(rows)) as a, cached(spread(validation)) as b:
        model = pipeline(**settings).fit(a)
        return Fitted(model, accuracy(model.transform(b)))


def words_of(model: PipelineModel) -> list[str]:
    """Labels in index order, most frequent first."""
    for stage in model.stages:
        if isinstance(stage, StringIndexerModel):
            return list(stage.labels)
    raise TypeError("the model has no label index")


def with_words(model: PipelineModel, predictions: DataFrame, out: str = "predicted_word") -> DataFrame:
    """Predicted index to predicted word."""
    labels = [*words_of(model), "unknown"]
    return IndexToString(inputCol="prediction", outputCol=out, labels=labels).transform(predictions)


def inputs_of(df: DataFrame, space: str = "rgb", features=("R", "G", "B")) -> tuple[DataFrame, list[str]]:
    """``df`` with the columns the classifier sees, and their names."""
    if space == "lab":
        return rgb_to_lab(df, *features), ["labL", "labA", "labB"]
    return df, list(features)


def sql_index(model: PipelineModel, x: Column) -> Column:
    """The class that the fitted weights give an array of inputs, worked out in SQL expressions."""
    fitted = model.stages[-1]
    scores = layers.linear_scores if hasattr(fitted, "coefficientMatrix") else layers.perceptron_scores
    return layers.arg_max(scores(fitted, x))


def scored_grid(
    model: PipelineModel, spark, lum: float = 70, resolution: int = 256, label: str = "word"
) -> DataFrame:
    """The model's word, and that word's display colour, for each cell of a LAB slice."""
    grid = lab_grid(spark, lum, resolution)
    # A SQL stage keeps only the channels and the label; the label, which scoring does not need, carries the cell.
    scored = grid.select("R", "G", "B", F.concat_ws(" ", "row", "column").alias(label))
    for stage in model.stages:
        if not isinstance(stage, StringIndexerModel):
            scored = stage.transform(scored)
    cell = F.split(label, " ")
    return with_words(model, scored).select(
        cell[0].cast("int").alias("row"), cell[1].cast("int").alias("column"), "R", "G", "B", "prediction", "predicted_word"
    )
