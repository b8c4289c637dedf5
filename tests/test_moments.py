"""Grids from sums of products, and least squares with many levels, against Spark's own fits."""

import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from tallyloom.operators import absorbed, metrics, models, moments, split, tuning, wrangle
from tallyloom.plans import linear
from tallyloom.sources import cars


def _same_as_cross_validator(rows, numeric, categories, model, points, folds):
    mine = tuning.linear_grid_search(numeric, categories, model, points, rows, "fold", folds)
    theirs = tuning.grid_search(tuning.stages_of(numeric, categories, model), model, points, RegressionEvaluator(labelCol=model.getLabelCol()), rows, "fold", folds, 8)
    assert np.allclose(mine.mean_metrics, theirs.mean_metrics, rtol=1e-6, atol=0)
    assert np.allclose(mine.fold_metrics, theirs.fold_metrics, rtol=1e-6, atol=0) and mine.best == theirs.best


def test_duration_grid_equals_cross_validation(spark, sf_dir):
    model = models.least_squares("duration", tol=1e-12, maxIter=1000)
    points = tuning.grid({model.regParam: [0.0, 0.1, 10.0], model.elasticNetParam: [0.0, 0.5, 1.0]})
    rows = split.with_fold(linear.flown(spark, sf_dir).select("trip_id", "duration", "km", "org", "dow"), "trip_id", 3)
    _same_as_cross_validator(rows, ["km"], ["org", "dow"], model, points, 3)


def test_fuel_grid_equals_cross_validation(spark, mid_dir):
    df = cars(spark, mid_dir).transform(wrangle.car_units).transform(wrangle.fuel_use).select("car_id", "weight_kg", "cyl", "type", "consumption")
    model = models.least_squares("consumption", tol=1e-12, maxIter=2000)
    points = tuning.grid({model.fitIntercept: [True, False], model.regParam: [0.001, 0.1, 10.0], model.elasticNetParam: [0.0, 0.25, 1.0]})
    _same_as_cross_validator(split.with_fold(df, "car_id", 3), ["weight_kg", "cyl"], ["type"], model, points, 3)


def test_column_that_does_not_vary_and_ties(spark):
    rows = spark.createDataFrame([(float(k % 7), 3.0, "ab"[k % 2], float(k % 5 + k % 2), k % 2) for k in range(40)], "x double, flat double, c string, y double, fold int")
    model = models.least_squares("y", tol=1e-12)
    points = tuning.grid({model.regParam: [0.0, 0.5], model.elasticNetParam: [0.0, 1.0]})
    found = moments.linear_grid_metrics(rows, ["x", "flat"], [], model, points, "fold", 2)
    theirs = tuning.grid_search(tuning.stages_of(["x"], [], model), model, points, RegressionEvaluator(labelCol="y"), rows, "fold", 2)
    assert np.allclose(found, theirs.fold_metrics, rtol=1e-6)


def test_refusals(spark):
    rows = spark.createDataFrame([(float(k), f"l{k}", float(k), k % 2) for k in range(40)], "x double, c string, y double, fold int")
    model = models.least_squares("y")
    with pytest.raises(ValueError, match="held-out"):
        moments.linear_grid_metrics(rows, ["x"], ["c"], model, tuning.grid({}), "fold", 2)
    with pytest.raises(ValueError, match="more than 5 levels"):
        moments.linear_grid_metrics(rows, ["x"], ["c"], model, tuning.grid({}), "fold", 2, most_levels=5)
    with pytest.raises(ValueError, match="maxIter"):
        tuning.linear_grid_search(["x"], [], model, tuning.grid({model.maxIter: [1, 2]}), rows, "fold", 2)


def test_absorbed_fit_equals_dummies(spark, sf_dir):
    df = linear.flown(spark, sf_dir).withColumn("effect", F.lit(1)).withColumn("hour", F.col("dow") * 2.5 + F.col("km") % 7)
    fit = absorbed.absorbed_least_squares(df, ["km", "hour"], "org", "duration")
    dummies = models.tabular_regression(["km", "hour"], ["org"], models.least_squares("duration")).fit(df)
    want = dummies.transform(df).select("trip_id", "prediction")
    got = fit.predict(df, F.col("trip_id")).select("trip_id", "effect", F.col("prediction").alias("own"))
    gaps = got.join(want, "trip_id").agg(F.max(F.abs(F.col("own") - F.col("prediction"))), F.sum("effect"), F.count("*")).first()
    assert gaps[0] < 1e-6 and gaps[1] == gaps[2] == df.count()
    assert list(fit.slopes.values()) == pytest.approx(list(dummies.stages[-1].coefficients)[:2], rel=1e-8)


def test_absorbed_fit_of_odd_rows(spark):
    rows = [("a", 1.0, 2.0), ("a", 3.0, 6.0), (None, 1.0, 1.0), ("b", None, 1.0), ("b", 5.0, 0.0), ("c", 1.0, None)]
    df = spark.createDataFrame(rows, "l string, x double, y double")
    fit = absorbed.absorbed_least_squares(df, ["x"], "l", "y")
    assert fit.slopes["x"] == pytest.approx(2.0)
    assert {(r.level, r.n_rows): r.effect for r in fit.levels.collect()} == pytest.approx({("a", 2): 0.0, ("b", 1): -10.0})
    told = {(r.l, r.x, r.y): r.prediction for r in fit.predict(df, F.col("y")).collect()}
    assert len(told) == 6 and told["a", 3.0, 6.0] == pytest.approx(6.0) and told[None, 1.0, 1.0] is None and told["c", 1.0, None] is None
    none = absorbed.absorbed_least_squares(df.limit(0), ["x"], "l", "y")
    assert none.slopes == {"x": 0.0} and none.levels.isEmpty()
    means = absorbed.absorbed_least_squares(df, [], "l", "y")
    assert {r.level: r.effect for r in means.levels.collect()} == {"a": 4.0, "b": 0.5}
    assert metrics.regression_report(means.predict(df, F.col("y")).where("prediction IS NOT NULL AND y IS NOT NULL"), "y").first().n_rows == 4


def test_grid_refits_a_winner_with_its_parameters(spark, sf_dir):
    rows = split.with_fold(linear.flown(spark, sf_dir), "trip_id", 3)
    model = models.least_squares("duration")
    found = tuning.linear_grid_search(["km"], ["org"], model, tuning.grid({model.regParam: [0.01, 50.0]}), rows, "fold", 3)
    assert found.best == 0 and isinstance(found.best_model.stages[-1].coefficients.size, int) and found.best_model.stages[-1].getRegParam() == 0.01
