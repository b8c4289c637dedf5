"""What a fitted model says about itself, as DataFrames.

A model is small and already on the driver; no data row passes through here.
"""

from __future__ import annotations

import re

from pyspark.ml import Model, PipelineModel, Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Params
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructField

from tallyloom.sources.scratch import scratch_path


def stage_of(pipeline: PipelineModel, kind: type) -> Transformer:
    """The one fitted stage of a class, wherever it stands in the pipeline."""
    found = [s for s in pipeline.stages if isinstance(s, kind)]
    if len(found) != 1:
        raise ValueError(f"{len(found)} stages of class {kind.__name__}")
    return found[0]


def slot_names(field: StructField) -> list[str]:
    """Names of the slots of an assembled vector column, in slot order."""
    groups = field.metadata["ml_attr"]["attrs"].values()
    slots = sorted((a for group in groups for a in group), key=lambda a: a["idx"])
    return [a.get("name", str(a["idx"])) for a in slots]


def _features_of(model: Model, scored: DataFrame) -> list[str]:
    return slot_names(scored.schema[model.getFeaturesCol()])


def coefficient_table(model: Model, scored: DataFrame) -> DataFrame:
    """(feature, coefficient) by slot name, with the intercept as '(intercept)'."""
    rows = [(n, float(c)) for n, c in zip(_features_of(model, scored), model.coefficients.toArray())]
    rows.append(("(intercept)", float(model.intercept)))
    return scored.sparkSession.createDataFrame(rows, "feature string, coefficient double")


def zero_coefficients(model: Model, scored: DataFrame) -> DataFrame:
    slots = coefficient_table(model, scored).where(F.col("feature") != "(intercept)")
    return slots.agg(
        F.count_if(F.col("coefficient") == 0).alias("n_zero"), F.count("*").alias("n_features")
    )


def travel_speed(model: Model, scored: DataFrame, distance: str = "km") -> DataFrame:
    """Speed in km/h and minutes on the ground, from a regression of minutes on kilometres.

    The slope is minutes per kilometre, so the speed is 60 / slope. Ground time is
    the intercept, plus the coefficient of a level where the model has dummies;
    the level without a dummy is listed as '(base)'.
    """
    table = coefficient_table(model, scored)
    slope = F.max(F.when(F.col("feature") == distance, F.col("coefficient")))
    base = F.max(F.when(F.col("feature") == "(intercept)", F.col("coefficient")))
    level = F.when(F.col("feature") == "(intercept)", F.lit("(base)")).otherwise(F.col("feature"))
    levels = F.collect_list(F.when(F.col("feature") != distance, F.struct(level.alias("level"), "coefficient")))
    summary = table.agg(slope.alias("slope"), base.alias("base"), levels.alias("levels"))
    each = summary.select("slope", "base", F.inline("levels"))
    own = F.when(F.col("level") == "(base)", F.lit(0.0)).otherwise(F.col("coefficient"))
    return each.select(
        "level",
        F.try_divide(F.lit(60.0), F.col("slope")).alias("km_per_hour"),
        (F.col("base") + own).alias("ground_minutes"),
    )


def coefficient_report(model: Model, scored: DataFrame) -> DataFrame:
    """``coefficient_table`` with the training metrics repeated on each row."""
    s = model.summary
    return coefficient_table(model, scored).withColumns(
        {
            "n_rows": F.lit(int(s.numInstances)).cast("bigint"),
            "rmse": F.lit(float(s.rootMeanSquaredError)),
            "r2": F.lit(float(s.r2)),
        }
    )


def fit_report(model: Model, spark: SparkSession) -> DataFrame:
    """Training metrics of a linear regression: one row."""
    s = model.summary
    rows = [(int(s.numInstances), float(s.rootMeanSquaredError), float(s.r2), int(s.totalIterations))]
    return spark.createDataFrame(rows, "n_rows bigint, rmse double, r2 double, iterations int")


def objective_table(model: Model, spark: SparkSession) -> DataFrame:
    """(iteration, objective) of the fit."""
    rows = [(i, float(v)) for i, v in enumerate(model.summary.objectiveHistory)]
    return spark.createDataFrame(rows, "iteration int, objective double")


def objective_of(model: Model, scored: DataFrame) -> DataFrame:
    """(objective): what a penalized linear regression minimizes, computed over the rows from the model's coefficients.

    Features and label are scaled by their deviations and the penalty by the label's. One pass; features that don't vary count nothing.
    """
    label, weights = F.col(model.getLabelCol()).cast("double"), model.coefficients.toArray().tolist()
    values = vector_to_array(model.getFeaturesCol())
    spread = F.stddev_pop(label)
    sizes = [F.lit(abs(b)) * F.stddev_pop(values[i]) / spread for i, b in enumerate(weights)]
    strength, mix = model.getRegParam(), model.getElasticNetParam()
    l1, l2 = sum(sizes, F.lit(0.0)), sum((x * x for x in sizes), F.lit(0.0))
    error = F.avg((label - F.col(model.getPredictionCol())) ** 2) / (2 * spread * spread)
    return scored.agg((error + strength / spread * (mix * l1 + (1 - mix) / 2 * l2)).alias("objective"))


def residuals(scored: DataFrame, label: str, prediction: str = "prediction", name: str = "residual") -> DataFrame:
    return scored.withColumn(name, F.col(label) - F.col(prediction))


def importance_table(model: Model, scored: DataFrame) -> DataFrame:
    """(feature, importance) of a tree model; importances sum to 1."""
    weights = model.featureImportances.toArray()
    rows = [(n, float(w)) for n, w in zip(_features_of(model, scored), weights)]
    return scored.sparkSession.createDataFrame(rows, "feature string, importance double")


def tree_table(model: Model, spark: SparkSession) -> DataFrame:
    """(tree, depth, nodes) of every member of an ensemble, or of a single tree."""
    members = getattr(model, "trees", None) or [model]
    rows = [(i, int(t.depth), int(t.numNodes)) for i, t in enumerate(members)]
    return spark.createDataFrame(rows, "tree int, depth int, nodes int")


def node_table(model: Model, scored: DataFrame) -> DataFrame:
    """(tree, node, feature, threshold, gain, n_rows, weight, prediction, is_leaf) of every node of a tree model or ensemble.

    The saved model is read as a table, so that an ensemble of any size stays off the driver. Inner nodes have a
    feature, and a threshold if it is no category; ``weight`` is what the rows weigh in the node's gain.
    """
    spark, path = scored.sparkSession, scratch_path(scored.sparkSession, "model")
    model.write().save(path)
    saved = spark.read.parquet(f"{path}/data")
    rows = saved.select(F.col("treeID").alias("tree"), "nodeData.*") if "nodeData" in saved.columns else saved.withColumn("tree", F.lit(0))
    names = spark.createDataFrame(list(enumerate(_features_of(model, scored))), "place int, feature string")
    members = getattr(model, "trees", None) or [model]
    stats = F.col("impurityStats")
    # the stats of a class label are weights per class, those of a number begin with the weight
    weight = stats[0] if members[0].getImpurity() == "variance" else F.aggregate(stats, F.lit(0.0), lambda a, b: a + b)
    inner, cut = F.col("leftChild") >= 0, F.col("split")
    joined = rows.join(F.broadcast(names), inner & (cut["featureIndex"] == F.col("place")), "left")
    threshold = F.when(inner & (cut["numCategories"] < 0), F.get(cut["leftCategoriesOrThreshold"], F.lit(0)))
    return joined.select(
        "tree", F.col("id").alias("node"), "feature", threshold.alias("threshold"), F.when(inner, F.col("gain")).alias("gain"),
        F.col("rawCount").alias("n_rows"), weight.alias("weight"), "prediction", (~inner).alias("is_leaf"),
    )


def importances_of_nodes(nodes: DataFrame, per_tree: bool = True) -> DataFrame:
    """(feature, importance) from a node table: the gains of each feature times the weights, as shares.

    With ``per_tree`` each tree counts the same, as in forests; boosted trees count by their gains. Features
    without a cut have no row.
    """
    gained = nodes.where(~F.col("is_leaf")).groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("weight")).alias("gained"))
    if per_tree:
        # one row per tree and feature
        gained = gained.withColumn("gained", F.try_divide("gained", F.sum("gained").over(Window.partitionBy("tree"))))
    summed = gained.groupBy("feature").agg(F.sum("gained").alias("gained"))
    total = summed.agg(F.sum("gained").alias("total"))
    return summed.select("feature", F.try_divide(F.col("gained"), total.scalar()).alias("importance"))


def rule_table(model: Model, scored: DataFrame) -> DataFrame:
    """The if/else listing of a tree model, one row per line, with slot names for slot numbers.

    The heading line is left out: it holds a model id that differs from run to run.
    """
    names = _features_of(model, scored)
    lines = model.toDebugString.rstrip("\n").split("\n")[1:]
    named = [re.sub(r"feature (\d+)", lambda m: names[int(m.group(1))], line) for line in lines]
    return scored.sparkSession.createDataFrame(list(enumerate(named, 1)), "line int, rule string")


def parameter_table(model: Params, spark: SparkSession) -> DataFrame:
    """(param, value, is_default, doc) for every parameter that has a value."""
    rows = [
        (p.name, str(v), not model.isSet(p), p.doc)
        for p, v in sorted(model.extractParamMap().items(), key=lambda item: item[0].name)
    ]
    return spark.createDataFrame(rows, "param string, value string, is_default boolean, doc string")
