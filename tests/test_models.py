import math

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassificationModel, LogisticRegressionModel
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import functions as F

from tallyloom.operators import coding, metrics, models, reports, split, wrangle
from tallyloom.plans import linear, searches, trees
from tallyloom.sources import trips


@pytest.fixture(scope="module")
def late(spark, sf_dir):
    df = trips(spark, sf_dir).transform(wrangle.delay_labels)
    return coding.assemble_stage(["mon", "depart", "duration"]).transform(df).cache()


def test_step_by_step_equals_the_pipeline(spark, sf_dir):
    df = linear.flown(spark, sf_dir)
    train, test = split.stable_split(df, "trip_id")
    piped = models.tabular_regression(["km"], ["org"], models.least_squares("duration")).fit(train)
    by_hand_train, by_hand_test = train, test
    for stage in models.category_stages(["km"], ["org"]):
        fitted = stage.fit(by_hand_train) if hasattr(stage, "fit") else stage
        by_hand_train, by_hand_test = fitted.transform(by_hand_train), fitted.transform(by_hand_test)
    model = models.least_squares("duration").fit(by_hand_train)
    stage = reports.stage_of(piped, LinearRegressionModel)
    assert list(model.coefficients) == list(stage.coefficients) and model.intercept == stage.intercept
    error = lambda scored: metrics.regression_report(scored, "duration").first().rmse
    assert math.isclose(error(model.transform(by_hand_test)), error(piped.transform(test)), rel_tol=1e-12)


def test_kept_leading_stages_give_the_same_model(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = documents.select("text", (F.col("lang") == "en").cast("int").alias("label"))
    pipeline = models.text_classification("text")
    kept, plain = models.fit_kept(pipeline, rows, ["text_hash", "label"]), pipeline.fit(rows)
    assert len(kept.stages) == len(plain.stages)
    assert list(kept.stages[-1].coefficients) == pytest.approx(list(plain.stages[-1].coefficients), rel=1e-6, abs=1e-9)
    total = lambda model: model.transform(rows).agg(F.sum(coding.dense("probability")[1])).first()[0]
    assert math.isclose(total(kept), total(plain), rel_tol=1e-9)


def test_same_seed_same_forest(late):
    one, two = (models.forest(seed=5, trees=4).fit(late).toDebugString.split("\n")[1:] for _ in range(2))
    assert one == two


def test_forest_and_boosting_need_a_seed():
    with pytest.raises(TypeError):
        models.forest()
    with pytest.raises(TypeError):
        models.boosted()


def test_probabilities_and_importances_sum_to_one(late):
    for model in (models.tree(), models.forest(seed=1, trees=3), models.boosted(seed=1, rounds=3)):
        fitted = model.fit(late)
        chance = coding.dense("probability")
        off = fitted.transform(late).where(F.abs(chance[0] + chance[1] - 1) > 1e-9).count()
        total = reports.importance_table(fitted, late).agg(F.sum("importance")).first()[0]
        assert off == 0 and math.isclose(total, 1.0)


def test_stacked_scores_equal_single_scores(late):
    fitted = {"tree": models.tree().fit(late), "line": models.logistic().fit(late)}
    stacked = models.stack_scores(fitted, late)
    for name, model in fitted.items():
        mine = stacked.where(F.col("model") == name).groupBy("label", "prediction").count()
        assert sorted(mine.collect()) == sorted(model.transform(late).groupBy("label", "prediction").count().collect())
    single = models.stack_scores({"tree": fitted["tree"]}, late).agg(F.sum("probability")).first()[0]
    expected = fitted["tree"].transform(late).agg(F.sum(coding.dense("probability")[1])).first()[0]
    assert math.isclose(single, expected)


def test_lasso_removes_coefficients_and_report_counts_them(spark, sf_dir):
    rows = coding.assemble_stage(["km", "dow"]).transform(linear.flown(spark, sf_dir)).select("features", "duration")
    model = models.lasso("duration", 30.0).fit(rows)
    assert tuple(reports.zero_coefficients(model, rows).first()) == (1, 2)


def test_travel_speed_on_a_known_line(spark):
    """Two minutes per ten kilometres after ten minutes on the ground, fifteen from B."""
    df = spark.range(400).select(
        F.col("id").cast("double").alias("km"), F.when(F.col("id") % 4 == 0, "B").otherwise("A").alias("org")
    ).withColumn("duration", F.col("km") * 0.2 + F.when(F.col("org") == "B", 15.0).otherwise(10.0))
    fitted = models.tabular_regression(["km"], ["org"], models.least_squares("duration")).fit(df)
    rows = {r.level: r for r in reports.travel_speed(reports.stage_of(fitted, LinearRegressionModel), fitted.transform(df)).collect()}
    assert set(rows) == {"(base)", "org_dummy_A"}
    assert all(math.isclose(r.km_per_hour, 300.0, rel_tol=1e-6) for r in rows.values())
    assert math.isclose(rows["(base)"].ground_minutes, 15.0, rel_tol=1e-6)
    assert math.isclose(rows["org_dummy_A"].ground_minutes, 10.0, rel_tol=1e-6)


def test_reports_of_a_fit(spark, late):
    model = models.lasso("duration", 0.5).fit(coding.assemble_stage(["mon", "km"], "v").transform(late).withColumn("features", F.col("v")))
    assert reports.fit_report(model, spark).first().n_rows == late.count()
    history = reports.objective_table(model, spark).orderBy("iteration").collect()
    assert [r.objective for r in history] == sorted((r.objective for r in history), reverse=True)
    params = {r.param: r for r in reports.parameter_table(model, spark).collect()}
    assert params["regParam"].value == "0.5" and not params["regParam"].is_default and params["maxIter"].is_default
    assert "number of iterations" in params["maxIter"].doc


def test_stage_lookup_is_by_class(late):
    fitted = Pipeline(stages=[models.tree(seed=1)]).fit(late)
    assert isinstance(reports.stage_of(fitted, DecisionTreeClassificationModel), DecisionTreeClassificationModel)
    with pytest.raises(ValueError):
        reports.stage_of(fitted, LogisticRegressionModel)


def test_rules_name_the_features(spark, sf_dir):
    rules = " ".join(r.rule for r in trees.tree_rules(spark, sf_dir).collect())
    assert "depart" in rules and "feature " not in rules


def test_cache_is_released_also_after_an_error(spark):
    df = spark.range(10)
    with pytest.raises(ZeroDivisionError), models.cached(df):
        1 / 0
    assert not df.storageLevel.useMemory


def test_cache_of_the_caller_stays(spark):
    df = spark.range(10).persist()
    with models.cached(df):
        pass
    assert df.storageLevel.useMemory
    df.unpersist()


def test_quality_floors_on_late_trips(spark, mid_dir):
    floor = {"accuracy": 0.87, "auc": 0.94}
    rows = trees.model_compare(spark, mid_dir).collect()
    assert len(rows) == 6 and all(r.value >= floor[r.metric] for r in rows)
    logit = {r.metric: r.value for r in linear.logit_delay_report(spark, mid_dir).collect()}
    assert logit["accuracy"] >= 0.87 and logit["auc"] >= 0.95


def test_quality_floors_on_origin_and_fuel(spark, mid_dir):
    origin = {r.model: r.value for r in trees.origin_report(spark, mid_dir).collect() if r.metric == "accuracy"}
    assert all(v >= 0.85 for v in origin.values()) and len(origin) == 4
    fuel = {r.model: r for r in linear.fuel_models(spark, mid_dir).collect()}
    assert fuel["plain"].r2 > 0.9 and fuel["lasso"].n_zero > 0 and fuel["plain"].rmse < fuel["ridge"].rmse < fuel["lasso"].rmse


def test_quality_floor_of_the_text_classifier(spark, mid_dir):
    found = {r.metric: r.value for r in searches.text_classifier(spark, mid_dir).collect()}
    assert found["accuracy"] >= 0.94 and found["auc"] >= 0.97 and found["accuracy"] == found["weighted_recall"]


def test_remaining_reports_have_rows(spark, sf_dir):
    assert trees.importances(spark, sf_dir).count() == 9
    assert trees.tree_sizes(spark, sf_dir).where("model = 'forest'").count() == 20
    assert trees.delay_tree_report(spark, sf_dir).count() == 7
    assert linear.fit_history(spark, sf_dir).count() >= 2


def test_importances_of_nodes_equal_the_models(late):
    for model, per_tree in ((models.tree(), True), (models.forest(seed=1, trees=3), True), (models.boosted(seed=1, rounds=3), False)):
        fitted = model.fit(late)
        nodes = reports.node_table(fitted, late)
        told = {r.feature: r.importance for r in reports.importance_table(fitted, late).where("importance > 0").collect()}
        assert {r.feature: r.importance for r in reports.importances_of_nodes(nodes, per_tree).collect()} == pytest.approx(told)
        sizes = {r.tree: r["count"] for r in nodes.groupBy("tree").count().collect()}
        assert sizes == {r.tree: r.nodes for r in reports.tree_table(fitted, late.sparkSession).collect()}
