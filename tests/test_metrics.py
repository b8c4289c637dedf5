import math

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.sql import functions as F

from tallyloom.operators import metrics


@pytest.fixture(scope="module")
def scored(spark):
    df = spark.range(4_000).select(
        (F.col("id") % 3).cast("double").alias("label"),
        F.when(F.col("id") % 5 == 0, 0.0).otherwise((F.col("id") % 2).cast("double")).alias("prediction"),
    )
    return df.cache()


@pytest.mark.parametrize(
    "mine, theirs",
    [("accuracy", "accuracy"), ("weighted_precision", "weightedPrecision"), ("weighted_recall", "weightedRecall"), ("f1", "f1")],
)
def test_weighted_report_equals_the_evaluator(scored, mine, theirs):
    """Three classes, one of them never predicted."""
    expected = MulticlassClassificationEvaluator(labelCol="label", metricName=theirs).evaluate(scored)
    assert math.isclose(metrics.weighted_report(scored).first()[mine], expected, abs_tol=1e-12)


def test_weighted_recall_is_accuracy(scored):
    row = metrics.weighted_report(scored).first()
    assert math.isclose(row.accuracy, row.weighted_recall)


def test_four_counts_and_ratios(spark):
    df = spark.sql("SELECT * FROM VALUES (0, 0D), (0, 1D), (1, 1D), (1, 1D), (1, 0D) AS t(label, prediction)")
    row = metrics.binary_report(df).first()
    assert (row.tn, row.fp, row.tp, row.fn) == (1, 1, 2, 1)
    assert (row.accuracy, row.precision, row.recall) == (0.6, 2 / 3, 2 / 3)


def test_ratios_without_a_base_are_null(spark):
    df = spark.sql("SELECT * FROM VALUES (0, 0D), (0, 0D) AS t(label, prediction)")
    row = metrics.binary_report(df).first()
    assert row.accuracy == 1.0 and row.precision is None and row.recall is None


def test_wide_confusion_shows_absent_classes(spark):
    df = spark.sql("SELECT * FROM VALUES (0, 0D), (1, 0D) AS t(label, prediction)")
    assert [tuple(r) for r in metrics.confusion_wide(df, [0, 1]).orderBy("label").collect()] == [(0, 1, 0, 0), (1, 1, 0, 0)]


def test_wide_confusion_counts_every_row(spark):
    df = spark.sql("SELECT * FROM VALUES (0, 0D), (0, 7D), (0, CAST(NULL AS DOUBLE)), (1, 1D) AS t(label, prediction)")
    assert [tuple(r) for r in metrics.confusion_wide(df, [0, 1]).orderBy("label").collect()] == [(0, 1, 0, 2), (1, 0, 1, 0)]


def test_regression_report_equals_the_evaluator(spark):
    df = spark.range(500).select(F.col("id").cast("double").alias("y"), (F.col("id") * 1.01 + F.sin("id")).alias("prediction"))
    row = metrics.regression_report(df, "y").first()
    for name in ("rmse", "mae", "r2"):
        assert math.isclose(row[name], RegressionEvaluator(labelCol="y", metricName=name).evaluate(df), rel_tol=1e-9)


@pytest.mark.parametrize("distinct", [1, 2, 7, 4_000])
def test_auc_equals_the_evaluator(spark, distinct):
    """From all rows on one score to all scores different; a third of the rows share one score."""
    df = spark.range(4_000).select(
        F.pmod(F.xxhash64("id"), F.lit(2)).cast("int").alias("label"),
        F.when(F.col("id") % 3 == 0, 0.0).otherwise(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(distinct)).cast("double")).alias("s"),
    )
    expected = metrics.auc_value(df, score="s", exact=True)
    assert math.isclose(metrics.auc_table(df, F.col("s")).first().auc, expected, abs_tol=1e-9)
    assert math.isclose(metrics.auc_table(df, F.col("s"), slices=3).first().auc, expected, abs_tol=1e-9)


def test_auc_of_one_class_is_null(spark):
    assert metrics.auc_table(spark.range(5).select(F.lit(1).alias("label"), "id"), F.col("id")).first().auc is None


def test_auc_per_group_equals_one_by_one(spark):
    df = spark.range(3_000).select(
        (F.col("id") % 4).alias("g"), F.pmod(F.xxhash64("id"), F.lit(2)).cast("int").alias("label"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(50)) + F.col("id") % 4 * 40).cast("double").alias("s"),
    )
    grouped = {r.g: r.auc for r in metrics.auc_table(df, F.col("s"), by=["g"]).collect()}
    for g in range(4):
        assert math.isclose(grouped[g], metrics.auc_value(df.where(F.col("g") == g), score="s", exact=True), abs_tol=1e-9)


def test_scores_report_equals_the_single_reports(spark):
    rows = [("a", y, float(p), s) for y, p, s in [(0, 0, 0.1), (1, 1, 0.9), (1, 0, 0.4), (0, 1, 0.6), (1, 1, 0.6), (1, 1, 0.6), (0, 0, 0.4)]]
    odd = [("a", 2, 1.0, 0.9), ("a", None, 1.0, 0.9), ("a", 1, 1.0, None), ("b", 1, 1.0, 0.5)]
    df = spark.createDataFrame(rows + odd, "model string, label int, prediction double, probability double")
    got = {(r.model, r.metric): r.value for r in metrics.scores_report(df).collect()}
    whole = spark.createDataFrame(rows, df.schema)
    want = {(("a"), r.metric): r.value for r in metrics.as_rows(metrics.binary_report(whole)).collect()}
    want["a", "auc"] = metrics.auc_value(whole, score="probability")
    assert {k: v for k, v in got.items() if k[0] == "a"} == pytest.approx(want)
    assert got["b", "auc"] is None and got["b", "tp"] == 1.0 and got["b", "accuracy"] == 1.0
    assert metrics.scores_report(df.limit(0)).isEmpty()
    area = metrics.auc_table(df.where("model = 'a'"), F.col("probability")).first().auc
    assert area == pytest.approx(want["a", "auc"])
