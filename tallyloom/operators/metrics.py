"""Scores of predictions. Each report is one pass over the rows and a small lazy DataFrame."""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyloom.sources.scratch import scratch_path


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows per (label, prediction) pair; pairs that do not occur give no row."""
    return df.groupBy(label, prediction).agg(F.count("*").alias("n_rows"))


def confusion_wide(
    df: DataFrame, classes: list, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """One row per label and one count per predicted class, zeros included.

    ``predicted_other`` has the rest, nulls too, so that the counts add up to the label's rows.
    """
    counts = [F.count_if(F.col(prediction) == F.lit(c)).alias(f"predicted_{c}") for c in classes]
    known = F.coalesce(F.col(prediction).isin(classes), F.lit(False))
    return df.groupBy(label).agg(*counts, F.count_if(~known).alias("predicted_other"))


def pair_listing(
    df: DataFrame, label: str, prediction: str = "prediction", digits: int = 4
) -> DataFrame:
    """Observed and predicted real values with their multiplicity."""
    return df.groupBy(F.col(label), F.round(prediction, digits).alias(prediction)).agg(
        F.count("*").alias("n_rows")
    )


def binary_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """The four counts, accuracy, precision and recall; a ratio without a base is null."""
    y, p = F.col(label), F.col(prediction)
    counted = df.agg(
        F.count_if((p == 0) & (y == 0)).alias("tn"),
        F.count_if((p == 1) & (y == 1)).alias("tp"),
        F.count_if((p == 0) & (y == 1)).alias("fn"),
        F.count_if((p == 1) & (y == 0)).alias("fp"),
    )
    tn, tp, fn, fp = (F.col(c) for c in ("tn", "tp", "fn", "fp"))
    return counted.select(
        "tn", "tp", "fn", "fp",
        F.try_divide(tn + tp, tn + tp + fn + fp).alias("accuracy"),
        F.try_divide(tp, tp + fp).alias("precision"),
        F.try_divide(tp, tp + fn).alias("recall"),
    )


def weighted_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy and class-share-weighted precision, recall and F1.

    All come from the pair counts, one row per class pair; a class that is
    never predicted has precision 0, as in Spark's evaluator.
    """
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    n, hit = F.col("n_rows"), F.when(y == p, F.col("n_rows")).otherwise(0)
    sides = F.array(
        F.struct(y.alias("class"), n.alias("actual"), F.lit(0).cast("bigint").alias("predicted"), hit.alias("hit")),
        F.struct(p.alias("class"), F.lit(0).cast("bigint").alias("actual"), n.alias("predicted"), F.lit(0).cast("bigint").alias("hit")),
    )
    per_class = (
        confusion(df, label, prediction).select(F.inline(sides)).groupBy("class")
        .agg(F.sum("actual").alias("actual"), F.sum("predicted").alias("predicted"), F.sum("hit").alias("hit"))
    )
    precision = F.coalesce(F.try_divide("hit", "predicted"), F.lit(0.0))
    recall = F.coalesce(F.try_divide("hit", "actual"), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0))
    total = F.sum("actual")
    return per_class.agg(
        F.try_divide(F.sum("hit"), total).alias("accuracy"),
        F.try_divide(F.sum(F.col("actual") * precision), total).alias("weighted_precision"),
        F.try_divide(F.sum(F.col("actual") * recall), total).alias("weighted_recall"),
        F.try_divide(F.sum(F.col("actual") * f1), total).alias("f1"),
    )


def regression_report(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """Rows, root mean squared error, mean absolute error and r² in one pass."""
    y, error = F.col(label), F.col(label) - F.col(prediction)
    return df.agg(
        F.count("*").alias("n_rows"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (1 - F.try_divide(F.sum(error * error), F.var_pop(y) * F.count(y))).alias("r2"),
    )


def auc_value(
    df: DataFrame, label: str = "label", score: str = "rawPrediction", exact: bool = True
) -> float:
    """Area under the ROC curve by Spark's evaluator.

    ``exact=False`` merges the scores into about 1000 bins. For a
    single tree pass ``score='probability'``: its raw prediction is a row count
    of the leaf and does not rank rows.
    """
    return BinaryClassificationEvaluator(
        labelCol=label, rawPredictionCol=score, metricName="areaUnderROC", numBins=0 if exact else 1000
    ).evaluate(df)


def auc_table(
    df: DataFrame, score: Column, label: str = "label", by: list[str] | None = None, slices: int | None = None, weight: str | None = None
) -> DataFrame:
    """Exact area under the ROC curve, lazily and for several models at once.

    Rows are first summed up per distinct score, which removes ties and any
    hot score. The distinct scores are range-partitioned into ``slices`` (by
    default as many as the session's shuffles have partitions); each slice gives its positive and negative rows and the pairs it orders right
    within itself, and the pairs across slices follow from those totals. So no
    task sees all scores, and only one row per model and slice is put in order.
    With ``weight`` a row counts as often as that column says. Rows whose label is neither 0 nor 1 are left out, and so are null scores.
    """
    by, times = by or [], F.col(weight) if weight else F.lit(1)
    of = lambda y: F.coalesce(F.sum(F.when(F.col(label) == y, times)), F.lit(0)).cast("bigint")
    per_score = (
        df.where(F.col(label).isin(0, 1) & score.isNotNull())
        .groupBy(*by, score.cast("double").alias("_score"))
        .agg(of(1).alias("_pos"), of(0).alias("_neg"))
    )
    ranges = [slices, "_score"] if slices else ["_score"]
    sliced = per_score.repartitionByRange(*ranges).withColumn("_slice", F.spark_partition_id())
    inside = Window.partitionBy(*by, "_slice").orderBy("_score").rowsBetween(Window.unboundedPreceding, -1)
    ranked = sliced.withColumn("_lower", F.coalesce(F.sum("_neg").over(inside), F.lit(0)))
    per_slice = ranked.groupBy(*by, "_slice").agg(
        F.sum(F.col("_pos") * (F.col("_lower") + F.col("_neg") / 2)).alias("_wins"),
        F.sum("_pos").alias("_pos"),
        F.sum("_neg").alias("_neg"),
    )
    earlier = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    placed = per_slice.withColumn("_below", F.coalesce(F.sum("_neg").over(earlier), F.lit(0)))
    pairs = F.sum("_pos").cast("double") * F.sum("_neg")
    return placed.groupBy(*by).agg(
        F.try_divide(F.sum(F.col("_wins") + F.col("_pos").cast("double") * F.col("_below")), pairs).alias("auc")
    )


def scores_report(scored: DataFrame, by: str = "model", label: str = "label", prediction: str = "prediction", score: str = "probability") -> DataFrame:
    """(by, metric, value): the four counts, accuracy, precision, recall and the exact area, for each of several models.

    The rows are read once: they are summed up per model, score, prediction and label, and both the counts and the area come from
    these sums, which are written to the session's working folder. Labels and predictions other than 0 and 1, and null scores, are
    left out of all of them, so that the counts add up to the rows of the area.
    """
    pairs = scored.where(F.col(label).isin(0, 1) & F.col(prediction).isin(0, 1) & F.col(score).isNotNull())
    summed = pairs.groupBy(by, F.col(score).alias("_score"), F.col(prediction).cast("int").alias("_p"), F.col(label).cast("int").alias("_y"))
    path = scratch_path(scored.sparkSession, "scores")
    summed.agg(F.count("*").alias("_n")).write.parquet(path)
    sums = scored.sparkSession.read.parquet(path)
    of = lambda y, p: F.coalesce(F.sum(F.when((F.col("_y") == y) & (F.col("_p") == p), F.col("_n"))), F.lit(0)).cast("double")
    counts = sums.groupBy(by).agg(of(0, 0).alias("tn"), of(1, 1).alias("tp"), of(1, 0).alias("fn"), of(0, 1).alias("fp"))
    tn, tp, fn, fp = (F.col(c) for c in ("tn", "tp", "fn", "fp"))
    wide = counts.select(
        by, "tn", "tp", "fn", "fp", F.try_divide(tn + tp, tn + tp + fn + fp).alias("accuracy"),
        F.try_divide(tp, tp + fp).alias("precision"), F.try_divide(tp, tp + fn).alias("recall"),
    )
    area = auc_table(sums, F.col("_score"), "_y", [by], weight="_n").select(by, F.lit("auc").alias("metric"), F.col("auc").alias("value"))
    return wide.unpivot([by], wide.columns[1:], "metric", "value").unionByName(area)


def as_rows(report: DataFrame) -> DataFrame:
    """A one-row report as (metric, value) rows, so that reports can be put below each other."""
    doubles = report.select(*[F.col(c).cast("double").alias(c) for c in report.columns])
    return doubles.unpivot([], doubles.columns, "metric", "value")
