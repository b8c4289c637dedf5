"""Evaluation of given predictions: pair counts, ratios, areas under the curve."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.operators import metrics
from tallyloom.operators.wrangle import delay_labels
from tallyloom.plans.checks import DELAYS
from tallyloom.sources import table, trips


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents with a length rule as prediction and the length as score."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return documents.join(labels, "doc_id").select(
        "source", "label", (F.col("n_chars") >= 1500).cast("double").alias("prediction"),
        F.col("n_chars").cast("double").alias("score"),
    )


def _timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips with a late label, a rule on the departure hour as prediction and the hour as score."""
    late = trips(spark, sf_dir).transform(delay_labels)
    rule = F.when(F.col("depart") >= 14, 1.0).otherwise(0.0)
    return late.select("org", "carrier", "label", rule.alias("prediction"), F.col("depart").alias("score"))


def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.confusion(_judged(spark, sf_dir))


def confusion_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.confusion_wide(_timed(spark, sf_dir), [0, 1])


def binary_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = metrics.binary_report(_judged(spark, sf_dir))
    return report.select("tn", "tp", "fn", "fp", *[F.round(c, 6).alias(c) for c in ("accuracy", "precision", "recall")])


def weighted_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = metrics.weighted_report(_judged(spark, sf_dir))
    return report.select(*[F.round(c, 6).alias(c) for c in report.columns])


def weighted_metrics_many_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve classes, some never predicted."""
    df = trips(spark, sf_dir).select(F.col("mon").alias("label"), F.col("dow").cast("double").alias("prediction"))
    report = metrics.weighted_report(df)
    return report.select(*[F.round(c, 6).alias(c) for c in report.columns])


def auc_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.auc_table(_judged(spark, sf_dir), F.col("score")).select(F.round("auc", 6).alias("auc"))


def auc_by_carrier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One curve per carrier, all in the same job."""
    areas = metrics.auc_table(_timed(spark, sf_dir), F.col("score"), by=["carrier"])
    return areas.select("carrier", F.round("auc", 6).alias("auc"))


def auc_evaluator(spark: SparkSession, sf_dir: str) -> DataFrame:
    area = metrics.auc_value(_timed(spark, sf_dir), score="score", exact=True)
    return spark.createDataFrame([("areaUnderROC", round(area, 6))], "metric string, value double")


QUERIES = {
    f.__name__: f
    for f in (
        confusion, confusion_wide, binary_metrics, weighted_metrics, weighted_metrics_many_classes,
        auc_exact, auc_by_carrier, auc_evaluator,
    )
}

_JUDGED = """judged AS (SELECT source, quality AS label, CASE WHEN n_chars >= 1500 THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction,
    n_chars::DOUBLE AS score FROM documents JOIN labels USING (doc_id))"""
_TIMED = f"""{DELAYS}, timed AS (SELECT org, carrier, label,
    CASE WHEN depart >= 14 THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction, depart AS score FROM delays)"""


def auc_sql(view: str, by: str = "", label: str = "label", score: str = "score") -> str:
    """CTE areas: rank-sum form of the area, ties at their mean rank."""
    part = f"PARTITION BY {by}" if by else ""
    keep = f"{by}," if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""ranked AS (SELECT {keep} {label} AS label, rank() OVER ({part} ORDER BY {score})
            + (count(*) OVER ({part + ',' if part else 'PARTITION BY'} {score}) - 1) / 2.0::DOUBLE AS r FROM {view}),
        areas AS (SELECT {keep} (sum(r) FILTER (WHERE label = 1)
            - sum(label::DOUBLE) * (sum(label::DOUBLE) + 1) / 2) / (sum(label::DOUBLE) * sum(1 - label::DOUBLE)) AS auc
            FROM ranked {group})"""


def weighted_sql(view: str) -> str:
    """The four class-weighted metrics of (label, prediction) rows, rounded to 6 places."""
    return f"""pairs AS (SELECT label::DOUBLE AS y, prediction AS p FROM {view}),
        actual AS (SELECT y AS c, count(*)::DOUBLE AS a FROM pairs GROUP BY y),
        guessed AS (SELECT p AS c, count(*)::DOUBLE AS g FROM pairs GROUP BY p),
        hits AS (SELECT y AS c, count(*)::DOUBLE AS h FROM pairs WHERE y = p GROUP BY y),
        per_class AS (SELECT a, coalesce(h, 0) AS hit, coalesce(h / g, 0) AS pr, coalesce(h, 0) / a AS re
            FROM actual LEFT JOIN guessed USING (c) LEFT JOIN hits USING (c))
        SELECT round(sum(hit) / sum(a), 6) AS accuracy, round(sum(a * pr) / sum(a), 6) AS weighted_precision,
        round(sum(a * re) / sum(a), 6) AS weighted_recall,
        round(sum(a * CASE WHEN pr + re > 0 THEN 2 * pr * re / (pr + re) ELSE 0 END) / sum(a), 6) AS f1 FROM per_class"""


ORACLES = {
    "confusion": f"WITH {_JUDGED} SELECT label, prediction, count(*) AS n_rows FROM judged GROUP BY ALL",
    "confusion_wide": f"""WITH {_TIMED} SELECT label, count(*) FILTER (WHERE prediction = 0) AS predicted_0,
        count(*) FILTER (WHERE prediction = 1) AS predicted_1,
        count(*) FILTER (WHERE prediction NOT IN (0, 1)) AS predicted_other FROM timed GROUP BY label""",
    "binary_metrics": f"""WITH {_JUDGED}, counted AS (SELECT count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn,
        count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp,
        count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn,
        count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp FROM judged)
        SELECT *, round((tn + tp) / (tn + tp + fn + fp), 6) AS accuracy, round(tp / (tp + fp), 6) AS precision,
        round(tp / (tp + fn), 6) AS recall FROM counted""",
    "weighted_metrics": f"WITH {_JUDGED}, {weighted_sql('judged')}",
    "weighted_metrics_many_classes": f"""WITH {DELAYS},
        classes AS (SELECT mon AS label, dow::DOUBLE AS prediction FROM trips), {weighted_sql('classes')}""",
    "auc_exact": f"WITH {_JUDGED}, {auc_sql('judged')} SELECT round(auc, 6) AS auc FROM areas",
    "auc_by_carrier": f"WITH {_TIMED}, {auc_sql('timed', 'carrier')} SELECT carrier, round(auc, 6) AS auc FROM areas",
    "auc_evaluator": f"""WITH {_TIMED}, {auc_sql('timed')} SELECT 'areaUnderROC' AS metric, round(auc, 6) AS value FROM areas""",
}
