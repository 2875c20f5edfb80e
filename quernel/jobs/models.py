"""Jobs that fit, score and apply models."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession

from quernel import sources
from quernel.learning import colours, temperature
from quernel.learning.split import random_split
from quernel.sources import schemas


def train_colours(
    spark: SparkSession, inputs: str, kind: str = "perceptron", seed: int | None = None, grid: str | None = None
) -> DataFrame:
    """Validation accuracy of the RGB and the LAB classifier, one row each.

    With ``grid`` the scored slices of LAB space are written below that path.
    """
    rows = sources.colour_rows(spark, inputs)
    labels = rows.select("word").distinct().count()
    train, validation = random_split(rows, seed=seed)
    scores = []
    for space in ("rgb", "lab"):
        fitted = colours.train(train, validation, space=space, kind=kind, labels=labels)
        scores.append((space, fitted.accuracy))
        if grid:
            cells = colours.scored_grid(fitted.model, spark)
            cells.write.mode("overwrite").parquet(f"{grid}/{space}")
    return spark.createDataFrame(scores, "space string, accuracy double")


def _score_row(spark, scores) -> DataFrame:
    return spark.createDataFrame([(scores.r2, scores.rmse)], "r2 double, rmse double")


def train_tmax(
    spark: SparkSession, inputs: str, model_path: str, yesterday: bool = True, **settings
) -> DataFrame:
    """Fit and save the next-day model; one row of validation scores."""
    model, scores = temperature.train(sources.tmax_series(spark, inputs), yesterday, **settings)
    temperature.save(model, model_path)
    return _score_row(spark, scores)


def test_tmax(spark: SparkSession, model_path: str, inputs: str) -> tuple[DataFrame, DataFrame]:
    """Scores of a saved model on other data, and its feature importances."""
    model = temperature.load(model_path)
    scores = temperature.score(model.transform(sources.tmax_series(spark, inputs)))
    return _score_row(spark, scores), temperature.importances(model)


def predict_next_day(
    spark: SparkSession,
    model_path: str,
    day: datetime.date,
    latitude: float,
    longitude: float,
    elevation: float,
    tmax: float,
    station: str = "here",
) -> DataFrame:
    """Prediction for the day after ``day``, whose maximum was ``tmax``.

    The second row's own maximum is unknown and is not a feature.
    """
    place = (latitude, longitude, elevation)
    rows = [
        (station, day, *place, tmax),
        (station, day + datetime.timedelta(days=1), *place, 0.0),
    ]
    series = sources.literal_rows(spark, rows, schemas.TMAX)
    scored = temperature.load(model_path).transform(series)
    return scored.where(scored.date > day).select("station", "date", "prediction")
