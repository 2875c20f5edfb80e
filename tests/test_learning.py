import datetime
import hashlib

import pytest
from pyspark.sql import functions as F

from quernel.learning import colours, evaluate, layers, split, temperature, trees
from quernel.learning.split import hash_split, random_split
from quernel.plans import models


@pytest.fixture(scope="module")
def colour_data(spark):
    """Three colour words on separate thirds of the red axis; a third of rows is red."""
    return spark.range(300).select(
        "id",
        (F.col("id") % 256).cast("int").alias("R"),
        (F.col("id") * 7 % 30).cast("int").alias("G"),
        (F.col("id") * 3 % 30).cast("int").alias("B"),
    ).withColumn("word", F.when(F.col("R") > 150, "red").when(F.col("R") > 60, "brown").otherwise("black"))


def test_splits(spark):
    df = spark.range(4000)
    for train, rest in (hash_split(df, ["id"]), random_split(df, seed=3)):
        assert train.count() + rest.count() == 4000
        assert 0.7 < train.count() / 4000 < 0.8
        assert train.join(rest, "id").count() == 0
    again = hash_split(df.repartition(7), ["id"])[0]
    assert sorted(again.collect()) == sorted(hash_split(df, ["id"])[0].collect())


@pytest.mark.parametrize("space,kind", [("rgb", "logistic"), ("lab", "logistic"), ("lab", "perceptron")])
def test_classifier_learns(spark, colour_data, space, kind):
    train, validation = hash_split(colour_data, ["id"])
    fitted = colours.train(train, validation, space=space, kind=kind, labels=3, max_iter=60)
    assert fitted.accuracy > 0.8
    assert set(colours.words_of(fitted.model)) == {"red", "brown", "black"}
    words = colours.with_words(fitted.model, fitted.model.transform(validation))
    assert {r.predicted_word for r in words.collect()} <= {"red", "brown", "black", "unknown"}
    cells, names = colours.inputs_of(colours.scored_grid(fitted.model, spark, resolution=8), space)
    x = F.array(*[F.col(c).cast("double") for c in names])
    found = cells.withColumn("again", colours.sql_index(fitted.model, x)).collect()
    assert {(r.row, r.column) for r in found} == {(i, j) for i in range(8) for j in range(8)}
    assert all(r.prediction == r.again for r in found)


@pytest.fixture
def fitted_on(monkeypatch):
    """Partitions of the rows that an estimator is fitted on, one number per fit."""
    seen = []

    def watch(estimator):
        fit = estimator.fit

        def counting(self, rows, *more):
            seen.append(rows.rdd.getNumPartitions())
            return fit(self, rows, *more)

        monkeypatch.setattr(estimator, "fit", counting)
        return seen

    return watch


@pytest.mark.parametrize("kind", ["perceptron", "logistic"])
@pytest.mark.parametrize("parts", [1, 20])
def test_classifier_is_fitted_on_all_cores(spark, colour_data, fitted_on, kind, parts):
    """One small file is one task, a shuffle may be hundreds; a fit passes over its rows a hundred times."""
    seen = fitted_on(colours.Pipeline)
    rows = colour_data.coalesce(1) if parts == 1 else colour_data.repartition(parts)
    fitted = colours.train(rows, rows, kind=kind, labels=3, max_iter=2)
    assert seen == [spark.sparkContext.defaultParallelism]
    assert fitted.model.transform(rows).count() == 300


@pytest.mark.parametrize("n,share", [(4000, 0.75), (9001, 0.5), (3, 0.75), (1, 0.75), (0, 0.75), (10, 1.0), (10, 0.0)])
def test_exact_split(spark, monkeypatch, n, share):
    monkeypatch.setattr(split, "LAST_ROWS", 50)
    df = spark.range(n).withColumn("other", F.lit("x"))
    train, rest = split.exact_split(df, ["id", "other"], share, seed=4)
    order = sorted(range(n), key=lambda i: hashlib.md5(f"4|{i}|x".encode()).hexdigest())
    taken = int(share * n)
    assert {r.id for r in train.collect()} == set(order[:taken])
    assert {r.id for r in rest.collect()} == set(order[taken:])


def test_exact_split_keeps_equal_keys_together(spark, monkeypatch):
    """A third of the rows has one key, others are null; all of one key go to one side."""
    monkeypatch.setattr(split, "LAST_ROWS", 5)
    df = spark.range(300).select(F.when(F.col("id") % 3 > 0, F.when(F.col("id") % 3 > 1, F.col("id")).otherwise(7)).alias("k"))
    train, rest = split.exact_split(df, ["k"])
    sides = [{r.k for r in side.collect()} for side in (train, rest)]
    assert not sides[0] & sides[1]
    assert train.count() + rest.count() == 300 and train.count() <= 225


def test_evaluation_equals_the_evaluators(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator

    df = spark.range(500).select(
        (F.col("id") % 4).cast("double").alias("y"), (F.pmod(F.xxhash64("id"), F.lit(5))).cast("double").alias("p")
    )
    mine = evaluate.regression_scores(df, "y", "p").first()
    for name in ("r2", "rmse", "mae"):
        theirs = RegressionEvaluator(predictionCol="p", labelCol="y", metricName=name).evaluate(df)
        assert mine[name] == pytest.approx(theirs)
    rows = {r.word: r for r in evaluate.class_scores(evaluate.confusion(df, "y", "p")).collect()}
    judge = MulticlassClassificationEvaluator(predictionCol="p", labelCol="y")
    assert rows[0.0].accuracy == pytest.approx(judge.evaluate(df, {judge.metricName: "accuracy"}))
    assert evaluate.accuracy(df, "y", "p") == pytest.approx(rows[0.0].accuracy)
    for name, metric in (("precision", "precisionByLabel"), ("recall", "recallByLabel"), ("f1", "fMeasureByLabel")):
        for word in (0.0, 3.0):
            params = {judge.metricName: metric, judge.metricLabel: word}
            assert rows[word][name] == pytest.approx(judge.evaluate(df, params))
    assert rows[4.0].support == 0 and rows[4.0].recall == 0
    empty = evaluate.regression_scores(df.limit(0), "y", "p").first()
    assert (empty.n, empty.r2) == (0, None)
    nulls = evaluate.regression_scores(df.withColumn("p", F.when(F.col("y") > 0, F.col("p"))), "y", "p").first()
    assert nulls.n == 375


def test_optimum_is_proved_and_a_wrong_one_refused(spark, colour_data):
    settings = dict(kind="logistic", labels=3, max_iter=1000, tolerance=1e-12)
    fitted = colours.pipeline(penalty=0.02, **settings).fit(colour_data)
    indexed = fitted.transform(colour_data)
    words = colours.words_of(fitted)
    found = layers.optimality(indexed, fitted.stages[-1], "RGB", "label_index", words).collect()
    assert len(found) == 12 and all(r.optimal for r in found)
    assert {r.state for r in found} >= {"free", "zero"}
    other = colours.pipeline(penalty=0.02, **(settings | {"max_iter": 2})).fit(colour_data)
    refused = layers.optimality(indexed, other.stages[-1], "RGB", "label_index", words)
    assert not all(r.optimal for r in refused.collect())


def test_probabilities_in_sql(spark, colour_data):
    from pyspark.ml.functions import vector_to_array

    for kind, scores in (("logistic", layers.linear_scores), ("perceptron", layers.perceptron_scores)):
        model = colours.pipeline(kind=kind, labels=3, max_iter=20).fit(colour_data)
        x = F.array(*[F.col(c).cast("double") for c in "RGB"])
        both = model.transform(colour_data).select(
            vector_to_array("probability").alias("theirs"), layers.softmax(scores(model.stages[-1], x)).alias("mine")
        )
        for r in both.collect():
            assert r.mine == pytest.approx(r.theirs, abs=1e-9)


def test_trees_as_a_table(spark, tmax):
    model, _ = temperature.train(tmax, max_iter=3, max_depth=4)
    table = trees.nodes(model.stages[-1])
    rows = table.collect()
    assert len({r.tree for r in rows}) == 3
    assert all((r.left is None) == (r.feature is None) == (r.gain is None) for r in rows)
    scored = model.transform(tmax).withColumn("again", temperature.sql_prediction(model))
    assert all(r.prediction == pytest.approx(r.again, abs=1e-9) for r in scored.collect())
    # Another value in one leaf is seen.
    first = F.when((F.col("tree") == 0) & F.col("left").isNull(), F.col("value") + 1).otherwise(F.col("value"))
    moved = scored.withColumn("moved", trees.score(table.withColumn("value", first), model.stages[-2].getInputCols()))
    assert all(r.moved == pytest.approx(r.prediction + 1) for r in moved.collect())
    own = model.stages[-1].featureImportances.toArray()
    found = {r.feature: r.importance for r in temperature.importances(model).collect()}
    assert [found[name] for name in temperature.feature_names()] == pytest.approx(list(own))


def test_unknown_settings():
    with pytest.raises(ValueError):
        colours.pipeline("hsv")
    with pytest.raises(ValueError):
        colours.classifier("forest", 3, 3)


@pytest.fixture(scope="module")
def tmax(spark):
    day = F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int") % 365)
    year = F.sin(F.col("id") % 365 / 58.0) * 15
    return spark.range(365 * 4).select(
        F.concat(F.lit("s"), F.floor(F.col("id") / 365)).alias("station"),
        day.alias("date"),
        (F.floor(F.col("id") / 365) * 5 + 40).cast("float").alias("latitude"),
        F.lit(-120).cast("float").alias("longitude"),
        F.lit(100).cast("float").alias("elevation"),
        (year + F.pmod(F.xxhash64("id"), F.lit(5))).cast("float").alias("tmax"),
    )


@pytest.mark.parametrize("yesterday", [True, False])
def test_temperature(spark, tmax, tmp_path, yesterday):
    model, scores = temperature.train(tmax, yesterday, max_iter=4, max_depth=4)
    assert scores.r2 > 0.8 and scores.rmse < 5
    temperature.save(model, str(tmp_path / "m"))
    temperature.save(model, str(tmp_path / "m"))
    loaded = temperature.load(str(tmp_path / "m"))
    scored = loaded.transform(tmax)
    assert scored.count() == 4 * (364 if yesterday else 365)
    again = temperature.score(scored)
    assert again.r2 > 0.8
    weights = {r.feature: r.importance for r in temperature.importances(loaded).collect()}
    assert set(weights) == set(temperature.feature_names(yesterday))
    assert sum(weights.values()) == pytest.approx(1)


@pytest.mark.parametrize("parts", [1, 20])
def test_trees_are_fitted_on_all_cores(spark, tmax, fitted_on, parts):
    seen = fitted_on(temperature.GBTRegressor)
    series = tmax.coalesce(1) if parts == 1 else tmax.repartition(parts)
    model, _ = temperature.train(series, max_iter=1, max_depth=2)
    assert seen == [spark.sparkContext.defaultParallelism]
    assert model.transform(series).count() == 4 * 364


def test_saved_model_is_fitted_on_all_cores(spark, small, fitted_on):
    """The fit that next_day_regressor and feature_importances share, on the days that a shuffle gives."""
    seen = fitted_on(temperature.GBTRegressor)
    _series, model, _scores = models._saved_model(spark, small, max_iter=1, max_depth=2)
    assert seen == [spark.sparkContext.defaultParallelism]
    own = model.stages[-1].featureImportances.toArray()
    found = {r.feature: r.importance for r in temperature.importances(model).collect()}
    assert [found[name] for name in temperature.feature_names()] == pytest.approx(list(own))


def test_no_training_row_loses_its_day_before(tmax):
    """The split comes after the previous-day join, so both sides keep all their days."""
    from pyspark.ml.feature import SQLTransformer

    ready = SQLTransformer(statement=temperature.WITH_YESTERDAY).transform(tmax)
    train, rest = hash_split(ready, ["station", "date"])
    assert train.count() + rest.count() == 4 * 364


def test_next_day(spark, tmax, tmp_path):
    from quernel.jobs import models

    model, _ = temperature.train(tmax, max_iter=2, max_depth=3)
    temperature.save(model, str(tmp_path / "m"))
    day = datetime.date(2020, 10, 8)
    got = models.predict_next_day(spark, str(tmp_path / "m"), day, 45.0, -120.0, 100.0, 12.0).collect()
    assert [(r.station, r.date) for r in got] == [("here", datetime.date(2020, 10, 9))]
