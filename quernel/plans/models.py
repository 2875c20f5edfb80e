"""Fitted models on the given tables, with the operators' own settings.

A fitted number is not for SQL to repeat. What SQL can state is which rows were
held out, the order of the labels, and that the fit passes its own proof: the
same predictions from the exported weights or trees, scores above a bound,
conditions of a minimum.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import SQLTransformer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from quernel.functions.colour import COLOUR_RGB, RGB_TO_XYZ, WHITE
from quernel.learning import colours, evaluate, layers, temperature
from quernel.learning.split import exact_split
from quernel.plans.colours import channels
from quernel.plans.series import daily_maximum
from quernel.plans.tables import table
from quernel.session import scratch_path, spread

#: Bounds that the scores must reach on tables of any size, and how far two ways to one number may differ.
#: The smallest tables have 150 colours and 250 days to learn from: accuracy 0.62, r2 0.78 there.
LEAST_ACCURACY, LEAST_R2, CLOSE = 0.5, 0.7, 1e-9
#: Penalty of the fit whose optimum is proved; without one, separable words have no finite optimum.
PENALTY = 0.01


def _nearest(among):
    """The colour word whose display colour is nearest in some of the channels; the first in order of equal ones."""
    distance = [
        F.struct(
            sum((F.col(c) - v) * (F.col(c) - v) for c, v in zip("RGB", rgb) if c in among).alias("d"),
            F.lit(word).alias("word"),
        )
        for word, rgb in COLOUR_RGB.items()
    ]
    return F.array_min(F.array(*distance))["word"]


def labelled_colours(spark, folder):
    """Part channels with the colour word whose display colour is nearest."""
    return channels(spark, folder).withColumn("word", _nearest("RGB"))


def _train(spark, folder, space, kind="logistic", **settings):
    rows = labelled_colours(spark, folder)
    train, validation = exact_split(rows, ["p_partkey"])
    labels = train.select("word").distinct().count()
    fitted = colours.train(train, validation, space=space, kind=kind, labels=labels, unseen="keep", **settings)
    return fitted, train, validation


def _same_index(model, scored, names):
    x = F.array(*[F.col(c).cast("double") for c in names])
    return scored.withColumn("same_prediction", F.col("prediction") == colours.sql_index(model, x))


def _classified(space, kind):
    def query(spark, folder):
        fitted, _, validation = _train(spark, folder, space, kind)
        scored = fitted.model.transform(spread(validation)).drop("labL", "labA", "labB")
        scored, names = colours.inputs_of(scored, space)
        return _same_index(fitted.model, scored, names).select(
            "R", "G", "B", "word", F.col("label_index").cast("bigint").alias("label_index"), "same_prediction",
            F.lit(fitted.accuracy >= LEAST_ACCURACY).alias("accurate"),
        )

    return query


def elastic_net_optimum(spark, folder):
    """The conditions of a minimum, for every coefficient of a penalised fit."""
    fitted, train, _ = _train(spark, folder, "rgb", penalty=PENALTY, max_iter=2000, tolerance=1e-12)
    indexed = fitted.model.transform(train)
    words = colours.words_of(fitted.model)
    # With unseen labels kept there may be one more class than words; no row has it.
    model = fitted.model.stages[-1]
    names = [*words, "unknown"][: model.numClasses]
    found = layers.optimality(indexed, model, ("R", "G", "B"), "label_index", names)
    return found.where("word <> 'unknown'").select("word", "feature", "optimal")


def embedding_classifier(spark, folder):
    """The same pipeline on whole embeddings; those of another length than most are left out."""
    vectors = table(spark, folder, "embeddings").where(F.size("embedding") > 0)
    width = vectors.agg(F.mode(F.size("embedding"), True)).first()[0] or 0
    rows = vectors.where(F.size("embedding") == width).select(
        "vec_id", "embedding", array_to_vector("embedding").alias("vector"), F.col("label").cast("string").alias("word")
    )
    train, validation = exact_split(rows, ["vec_id"])
    labels = train.select("word").distinct().count()
    fitted = colours.train(
        train, validation, kind="perceptron", labels=labels, features=["vector"], width=width, unseen="keep"
    )
    scored = fitted.model.transform(validation)
    same = F.col("prediction") == colours.sql_index(fitted.model, F.col("embedding").cast("array<double>"))
    return scored.select(
        "vec_id", "word", F.col("label_index").cast("bigint").alias("label_index"), same.alias("same_prediction")
    )


def scored_grid(spark, folder):
    """The slice of LAB space is coloured by a model fitted on the parts."""
    fitted, _, _ = _train(spark, folder, "lab")
    cells, names = colours.inputs_of(colours.scored_grid(fitted.model, spark), "lab")
    shown = [F.round(c, 6).alias(c) for c in ("R", "G", "B")]
    return _same_index(fitted.model, cells, names).select("row", "column", *shown, "same_prediction")


def tmax_series(spark, folder):
    """Daily maxima per user; place columns come from the user's key."""
    user = F.col("user_id")
    return daily_maximum(spark, folder).select(
        user.cast("string").alias("station"),
        "date",
        (user % 90).cast("float").alias("latitude"),
        (user * 7 % 180).cast("float").alias("longitude"),
        (user * 13 % 1000).cast("float").alias("elevation"),
        F.col("tmax").cast("float").alias("tmax"),
    )


def seasonal_series(spark, folder):
    """The same days with a wave over the year, warmer near latitude 0; the events are its noise."""
    wave = 18 * F.cos((F.dayofyear("date") - 200) * (2 * math.pi / 365)) - F.col("latitude") / 6 + 25
    return tmax_series(spark, folder).withColumn("tmax", (wave + F.col("tmax") / 200).cast("float"))


def next_day_features(spark, folder):
    """What the model's SQL stage makes of the daily series."""
    stage = SQLTransformer(statement=temperature.WITH_YESTERDAY)
    days = stage.transform(tmax_series(spark, folder))
    return days.select(
        "station",
        F.date_format("date", "yyyy-MM-dd").alias("date"),
        F.col("dayofyear").cast("bigint").alias("dayofyear"),
        *[F.round(F.col(c).cast("double"), 2).alias(c) for c in ("latitude", "longitude", "elevation")],
        F.round(F.col("tmax").cast("double"), 2).alias("tmax"),
        F.round(F.col("yesterday_tmax").cast("double"), 2).alias("yesterday_tmax"),
    )


def _saved_model(spark, folder, **settings):
    series = seasonal_series(spark, folder)
    model, scores = temperature.train(series, **settings)
    path = scratch_path(spark, "tmax-model")
    temperature.save(model, path)
    return series, temperature.load(path), scores


def next_day_regressor(spark, folder):
    """Fitted, saved, loaded, and applied to raw rows; the exported trees must give the same."""
    series, model, scores = _saved_model(spark, folder)
    predictions = model.transform(series).withColumn("from_trees", temperature.sql_prediction(model))
    same = F.abs(F.col("prediction") - F.col("from_trees")) < CLOSE
    return predictions.select(
        "station",
        F.date_format("date", "yyyy-MM-dd").alias("date"),
        same.alias("same_prediction"),
        F.lit(scores.r2 >= LEAST_R2).alias("r2_reached"),
    )


def feature_importances(spark, folder):
    """Importances from the gains of all splits against the model's own."""
    _series, model, _scores = _saved_model(spark, folder)
    own = model.stages[-1].featureImportances.toArray().tolist()
    names = model.stages[-2].getInputCols()
    theirs = spark.createDataFrame(list(zip(names, own)), "feature string, theirs double")
    found = temperature.importances(model)
    total = found.agg(F.sum("importance").alias("total"))
    return found.join(F.broadcast(theirs), "feature").join(F.broadcast(total)).select(
        "feature",
        (F.abs(F.col("importance") - F.col("theirs")) < CLOSE).alias("same_importance"),
        (F.abs(F.col("total") - 1) < CLOSE).alias("sums_to_one"),
    )


def exact_sides(spark, folder):
    """Which side of the split each event is on."""
    events = table(spark, folder, "events").select("event_id")
    first, rest = exact_split(events, ["event_id"])
    return first.withColumn("side", F.lit("train")).unionByName(rest.withColumn("side", F.lit("validation")))


def persistence_scores(spark, folder):
    """How well a day's maximum is foretold by the day before: n, r2, rmse and mae."""
    days = SQLTransformer(statement=temperature.WITH_YESTERDAY).transform(tmax_series(spark, folder))
    doubles = days.select(*[F.round(F.col(c).cast("double"), 2).alias(c) for c in ("tmax", "yesterday_tmax")])
    scores = evaluate.regression_scores(doubles, "tmax", "yesterday_tmax")
    return scores.select("n", *[F.round(c, 6).alias(c) for c in ("r2", "rmse", "mae")])


def two_channel_scores(spark, folder):
    """How well red and green alone name a colour: support, precision, recall, f1 per word, and accuracy."""
    rows = labelled_colours(spark, folder).withColumn("guess", _nearest("RG"))
    scores = evaluate.class_scores(evaluate.confusion(rows, "word", "guess"))
    return scores.select("word", "support", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1", "accuracy")])


QUERIES = {
    "colour_classifier_rgb": _classified("rgb", "logistic"),
    "colour_classifier_lab": _classified("lab", "logistic"),
    "colour_perceptron": _classified("rgb", "perceptron"),
    "elastic_net_optimum": elastic_net_optimum,
    "embedding_classifier": embedding_classifier,
    "next_day_features": next_day_features,
    "scored_grid": scored_grid,
    "next_day_regressor": next_day_regressor,
    "feature_importances": feature_importances,
    "exact_sides": exact_sides,
    "persistence_scores": persistence_scores,
    "two_channel_scores": two_channel_scores,
}


def _sides(rows, key):
    """SQL: rows with their place by hash, the number of rows, and so the side."""
    return f"""
sides AS (
  SELECT *, row_number() OVER (ORDER BY md5('1|' || {key})) <= floor(0.75 * count(*) OVER ()) AS first FROM {rows}),
ranks AS (
  SELECT word, row_number() OVER (ORDER BY count(*) DESC, word) - 1 AS label_index FROM sides WHERE first GROUP BY word),
held AS (
  SELECT s.*, CAST(coalesce(label_index, (SELECT count(*) FROM ranks)) AS BIGINT) AS label_index
  FROM sides AS s LEFT JOIN ranks USING (word) WHERE NOT first)
"""


def _words(among="RGB", name="word"):
    squares = [
        f"{{'d': {' + '.join(f'({c} - {v}) * ({c} - {v})' for c, v in zip('RGB', rgb) if c in among)}, 'w': '{word}'}}"
        for word, rgb in COLOUR_RGB.items()
    ]
    return f"list_min([{', '.join(squares)}]).w AS {name}"


_NAMED = f"""
WITH channels AS (
  SELECT p_partkey, p_partkey * 7 % 256 AS R, p_partkey * 13 % 256 AS G, p_partkey * 29 % 256 AS B FROM part),
named AS (SELECT *, {_words()} FROM channels)
"""
_COLOURS = f"""{_NAMED}, {_sides("named", "p_partkey")}
SELECT CAST(R AS INT) AS R, CAST(G AS INT) AS G, CAST(B AS INT) AS B, word, label_index, true AS same_prediction,
       true AS accurate FROM held
"""
# Linear RGB from the grid's XYZ by Cramer's rule.
(_A, _B_, _C), (_D, _E, _F), (_G, _H, _I) = RGB_TO_XYZ
_DET = f"({_A} * ({_E} * {_I} - {_F} * {_H}) - {_B_} * ({_D} * {_I} - {_F} * {_G}) + {_C} * ({_D} * {_H} - {_E} * {_G}))"


def _shown(c):
    return (
        f"round(255 * least(greatest(CASE WHEN {c} > 3.1308e-3 THEN 1.055e0 * pow({c}, 1 / 2.4e0) - 5.5e-2 "
        f"ELSE {c} * 1.292e1 END, 0e0), 1e0), 6)"
    )


def _xyz(f, white):
    return f"{white}e0 * CASE WHEN {f} > 2.068966e-1 THEN pow({f}, 3) ELSE ({f} - 16 / 116e0) / 7.787e0 END"


_GRID = f"""
WITH cells AS (
  SELECT CAST(r AS INT) AS row, CAST(c AS INT) AS col, c * (200 / 255e0) - 100 AS a, r * (200 / 255e0) - 100 AS b,
         86 / 116e0 AS fy
  FROM range(256) AS rows(r), range(256) AS columns(c)),
xyz AS (
  SELECT row, col, {_xyz('(fy + a / 500)', WHITE[0])} AS x, {_xyz('fy', WHITE[1])} AS y,
         {_xyz('greatest(fy - b / 200, 0)', WHITE[2])} AS z FROM cells),
lin AS (
  SELECT row, col,
    (x * ({_E} * {_I} - {_F} * {_H}) - {_B_} * (y * {_I} - {_F} * z) + {_C} * (y * {_H} - {_E} * z)) / {_DET} AS lr,
    ({_A} * (y * {_I} - {_F} * z) - x * ({_D} * {_I} - {_F} * {_G}) + {_C} * ({_D} * z - y * {_G})) / {_DET} AS lg,
    ({_A} * ({_E} * z - y * {_H}) - {_B_} * ({_D} * z - y * {_G}) + x * ({_D} * {_H} - {_E} * {_G})) / {_DET} AS lb
  FROM xyz)
SELECT row, col AS "column", {_shown('lr')} AS R, {_shown('lg')} AS G, {_shown('lb')} AS B, true AS same_prediction FROM lin
"""
_DAYS = """
days AS (SELECT user_id, CAST(ts AS DATE) AS date, max(value) AS tmax FROM events GROUP BY ALL)
"""

ORACLES = {
    "colour_classifier_rgb": _COLOURS,
    "colour_classifier_lab": _COLOURS,
    "colour_perceptron": _COLOURS,
    "elastic_net_optimum": f"""{_NAMED}, {_sides("named", "p_partkey")}
SELECT word, feature, true AS optimal FROM ranks, (VALUES ('intercept'), ('R'), ('G'), ('B')) AS f(feature)
""",
    "embedding_classifier": f"""
WITH vectors AS (SELECT vec_id, CAST(label AS VARCHAR) AS word, len(embedding) AS n FROM embeddings WHERE len(embedding) > 0),
same AS (
  SELECT vec_id, word FROM vectors
  WHERE n = (SELECT n FROM vectors GROUP BY n ORDER BY count(*) DESC, n LIMIT 1)), {_sides("same", "vec_id")}
SELECT vec_id, word, label_index, true AS same_prediction FROM held
""",
    "next_day_features": """
WITH days AS (
  SELECT user_id, CAST(ts AS DATE) AS date, max(value) AS tmax FROM events GROUP BY ALL)
SELECT CAST(t.user_id AS VARCHAR) AS station, strftime(t.date, '%Y-%m-%d') AS date,
       CAST(dayofyear(t.date) AS BIGINT) AS dayofyear, CAST(t.user_id % 90 AS DOUBLE) AS latitude,
       CAST(t.user_id * 7 % 180 AS DOUBLE) AS longitude, CAST(t.user_id * 13 % 1000 AS DOUBLE) AS elevation,
       round(t.tmax, 2) AS tmax, round(y.tmax, 2) AS yesterday_tmax
FROM days AS t JOIN days AS y ON t.user_id = y.user_id AND t.date - 1 = y.date
""",
    "scored_grid": _GRID,
    "next_day_regressor": f"""
WITH {_DAYS}
SELECT CAST(t.user_id AS VARCHAR) AS station, strftime(t.date, '%Y-%m-%d') AS date, true AS same_prediction,
       true AS r2_reached
FROM days AS t JOIN days AS y ON t.user_id = y.user_id AND t.date - 1 = y.date
""",
    "feature_importances": """
SELECT feature, true AS same_importance, true AS sums_to_one
FROM (VALUES ('dayofyear'), ('latitude'), ('longitude'), ('elevation'), ('yesterday_tmax')) AS f(feature)
""",
    "exact_sides": """
SELECT event_id, CASE WHEN row_number() OVER (ORDER BY md5('1|' || event_id)) <= floor(0.75 * count(*) OVER ())
       THEN 'train' ELSE 'validation' END AS side
FROM events
""",
    "persistence_scores": f"""
WITH {_DAYS},
pairs AS (
  SELECT round(t.tmax, 2) AS y, round(p.tmax, 2) AS p
  FROM days AS t JOIN days AS p ON t.user_id = p.user_id AND t.date - 1 = p.date)
SELECT count(*) AS n, round(1 - sum(pow(y - p, 2)) / sum(pow(y - m, 2)), 6) AS r2,
       round(sqrt(avg(pow(y - p, 2))), 6) AS rmse, round(avg(abs(y - p)), 6) AS mae
FROM pairs, (SELECT avg(y) AS m FROM pairs)
""",
    "two_channel_scores": f"""{_NAMED},
guessed AS (SELECT *, {_words("RG", "guess")} FROM named),
words AS (SELECT word FROM guessed UNION SELECT guess FROM guessed),
sums AS (
  SELECT w.word, count(*) FILTER (g.word = w.word) AS support, count(*) FILTER (guess = w.word) AS taken,
         count(*) FILTER (g.word = w.word AND guess = w.word) AS hits
  FROM words AS w, guessed AS g GROUP BY w.word),
rates AS (
  SELECT *, CASE WHEN taken > 0 THEN hits / taken ELSE 0e0 END AS p, CASE WHEN support > 0 THEN hits / support ELSE 0e0 END AS r
  FROM sums)
SELECT word, support, round(p, 6) AS precision, round(r, 6) AS recall,
       round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0e0 END, 6) AS f1,
       round((SELECT avg(CAST(word = guess AS INT)) FROM guessed), 6) AS accuracy
FROM rates
""",
}
