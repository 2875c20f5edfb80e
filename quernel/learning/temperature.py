"""Next-day temperature: previous-day feature, boosted trees, scores."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame

from quernel.learning import evaluate, trees
from quernel.learning.split import exact_split
from quernel.session import cached, materialize, spread

PLACE = ("latitude", "longitude", "elevation")

# Each day takes the maximum that was filed under it from the day before, at one
# station; a day without one is left out. Both sides meet on equal keys.
WITH_YESTERDAY = """
SELECT station, date, dayofyear(date) AS dayofyear, latitude, longitude, elevation, tmax, yesterday_tmax
FROM __THIS__
JOIN (SELECT station, date_add(date, 1) AS date, tmax AS yesterday_tmax FROM __THIS__)
  USING (station, date)
"""

WITHOUT_YESTERDAY = """
SELECT station, date, dayofyear(date) AS dayofyear, latitude, longitude, elevation, tmax
FROM __THIS__
"""


@dataclass
class Scores:
    r2: float
    rmse: float


def feature_names(yesterday: bool = True) -> list[str]:
    return ["dayofyear", *PLACE, *(["yesterday_tmax"] if yesterday else [])]


def score(predictions: DataFrame, label: str = "tmax") -> Scores:
    """Both scores from one aggregate; nan without rows."""
    found = evaluate.regression_scores(predictions, label).first()
    return Scores(*(float("nan") if v is None else v for v in (found.r2, found.rmse)))


def train(
    series: DataFrame,
    yesterday: bool = True,
    share: float = 0.75,
    max_iter: int = 20,
    max_depth: int = 10,
    seed: int = 1,
) -> tuple[PipelineModel, Scores]:
    """Fit on part of the days and score the others.

    The previous-day feature is made from the whole series before the split, so
    no day loses its feature because the day before fell on the other side.
    The model still takes raw rows: the SQL stage is its first stage. Every level of
    every tree passes over all days, so they are spread over all cores.
    """
    prepare = SQLTransformer(statement=WITH_YESTERDAY if yesterday else WITHOUT_YESTERDAY)
    assemble = VectorAssembler(inputCols=feature_names(yesterday), outputCol="features")
    trees = GBTRegressor(
        featuresCol="features", labelCol="tmax", maxIter=max_iter, maxDepth=max_depth, seed=seed
    )
    # Written once, so that counting the days does not join them again.
    days = spread(materialize(prepare.transform(series), "days"))
    # Boosting keeps errors by place: a partition that is made again has its rows in the same order.
    days = days.sortWithinPartitions(*days.columns)
    with cached(assemble.transform(days)) as ready:
        train_rows, validation = exact_split(ready, ["station", "date"], share)
        fitted = trees.fit(train_rows)
        scores = score(fitted.transform(validation))
    return PipelineModel(stages=[prepare, assemble, fitted]), scores


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def importances(model: PipelineModel) -> DataFrame:
    """``feature, importance`` rows of a fitted tree model, from the gains of its splits."""
    return trees.importances(trees.nodes(model.stages[-1]), model.stages[-2].getInputCols())


def sql_prediction(model: PipelineModel):
    """The fitted trees as a SQL expression over the feature columns."""
    return trees.score(trees.nodes(model.stages[-1]), model.stages[-2].getInputCols())
