"""Estimator factories. Every estimator with a random step needs an explicit seed."""

from __future__ import annotations

from contextlib import contextmanager
from collections.abc import Iterator

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.operators.coding import assemble_stage, bucket_stage, dummy_stage, index_stage
from tallyloom.operators.text import text_stages
from tallyloom.sources.scratch import scratch_path


def least_squares(label: str, features: str = "features", **params) -> LinearRegression:
    """Linear regression without penalty: one pass for the normal equations."""
    return LinearRegression(labelCol=label, featuresCol=features, **params)


def ridge(label: str, strength: float = 0.1, features: str = "features", **params) -> LinearRegression:
    return least_squares(label, features, elasticNetParam=0.0, regParam=strength, **params)


def lasso(label: str, strength: float = 1.0, features: str = "features", **params) -> LinearRegression:
    return least_squares(label, features, elasticNetParam=1.0, regParam=strength, **params)


def logistic(label: str = "label", strength: float = 0.0, features: str = "features", **params) -> LogisticRegression:
    return LogisticRegression(
        labelCol=label, featuresCol=features, regParam=strength, family="binomial", maxIter=params.pop("maxIter", 100), **params
    )


def tree(label: str = "label", seed: int = 0, features: str = "features", **params) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(labelCol=label, featuresCol=features, seed=seed, **params)


def forest(label: str = "label", *, seed: int, trees: int = 20, features: str = "features", **params) -> RandomForestClassifier:
    return RandomForestClassifier(labelCol=label, featuresCol=features, numTrees=trees, seed=seed, **params)


def boosted(label: str = "label", *, seed: int, rounds: int = 20, features: str = "features", **params) -> GBTClassifier:
    return GBTClassifier(labelCol=label, featuresCol=features, maxIter=rounds, seed=seed, **params)


def cut_forests(model: RandomForestClassificationModel, depths: list[int], spark: SparkSession) -> dict[int, RandomForestClassificationModel]:
    """The forests that the same fit gives with a smaller ``maxDepth``, from the saved model's table of nodes.

    Nodes at the depth become leaves with the class counts they have; as in a fit, two leaves of one prediction become one.
    Parameters are the given model's but for ``maxDepth``. A model is small and already on the driver.
    """
    path = scratch_path(spark, "forest")
    model.write().save(path)
    saved = spark.read.parquet(f"{path}/data")
    trees: dict[int, dict[int, dict]] = {}
    for row in saved.collect():
        node = row["nodeData"].asDict()
        trees.setdefault(row["treeID"], {})[node["id"]] = node

    def cut(nodes: dict[int, dict], at: int, depth: int, out: list[dict]) -> dict:
        """Adds the nodes from ``at`` down to ``out``, in the order of their new ids: a node, what is left of it, what is right of it."""
        own = dict(nodes[at], id=len(out), gain=-1.0, leftChild=-1, rightChild=-1)
        out.append(own)
        if depth and nodes[at]["leftChild"] >= 0:
            left = cut(nodes, nodes[at]["leftChild"], depth - 1, out)
            right = cut(nodes, nodes[at]["rightChild"], depth - 1, out)
            if left["leftChild"] < 0 and right["leftChild"] < 0 and left["prediction"] == right["prediction"]:
                del out[own["id"] + 1 :]
                own["prediction"] = left["prediction"]
            else:
                own.update(gain=nodes[at]["gain"], leftChild=left["id"], rightChild=right["id"])
        if own["leftChild"] < 0:
            own["split"] = (-1, [], -1)  # a leaf's, as the model is saved
        return own

    found = {}
    for depth in depths:
        rows = []
        for tree, nodes in trees.items():
            kept: list[dict] = []
            cut(nodes, 0, depth, kept)
            rows += [(tree, tuple(node[c] for c in saved.schema["nodeData"].dataType.names)) for node in kept]
        own = scratch_path(spark, "forest")
        spark.createDataFrame(rows, saved.select("treeID", "nodeData").schema).write.parquet(f"{own}/data")
        spark.read.parquet(f"{path}/treesMetadata").write.parquet(f"{own}/treesMetadata")
        spark.read.text(f"{path}/metadata").write.text(f"{own}/metadata")
        found[depth] = RandomForestClassificationModel.load(own)
        found[depth].set(found[depth].maxDepth, depth)
    return found


@contextmanager
def cached(*frames: DataFrame) -> Iterator[None]:
    """Keep frames that several jobs read (fits, scores), spilling to disk, and release them after.

    A frame that the caller already keeps is left as it is, also at the end.
    """
    kept = [df for df in frames if not (df.storageLevel.useMemory or df.storageLevel.useDisk)]
    for df in kept:
        df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield
    finally:
        for df in kept:
            df.unpersist()


def fit_kept(pipeline: Pipeline, rows: DataFrame, keep: list[str]) -> PipelineModel:
    """The same model as ``pipeline.fit(rows)``, with the leading stages run once.

    Stages before the first one that needs a fit (cleaning, tokens, hashing) are
    applied, and of their output only the columns ``keep`` are kept for the fits
    that follow; ``Pipeline.fit`` would run them again for every pass over the rows.
    """
    stages = pipeline.getStages()
    first = next(i for i, stage in enumerate(stages) if isinstance(stage, Estimator))
    prepared = PipelineModel(stages[:first]).transform(rows).select(*keep)
    with cached(prepared):
        fitted = Pipeline(stages=stages[first:]).fit(prepared)
    return PipelineModel([*stages[:first], *fitted.stages])


def stack_scores(fitted: dict[str, Model], rows: DataFrame, label: str = "label") -> DataFrame:
    """(model, label, prediction, probability of class 1) of several binary classifiers.

    All models score a row in the same pass; the rows are unfolded afterwards,
    so the input is read once and not once per model.
    """
    scored = rows
    for i, model in enumerate(fitted.values()):
        named = {
            model.rawPredictionCol: f"_raw{i}", model.probabilityCol: f"_probability{i}", model.predictionCol: f"_prediction{i}",
        }
        scored = model.copy(named).transform(scored)
    each = [
        F.struct(
            F.lit(name).alias("model"),
            F.col(label),
            F.col(f"_prediction{i}").alias("prediction"),
            vector_to_array(f"_probability{i}")[1].alias("probability"),
        )
        for i, name in enumerate(fitted)
    ]
    return scored.select(F.inline(F.array(*each)))


def category_stages(
    numeric: list[str], categories: list[str], features: str = "features", handle_invalid: str = "error"
) -> list:
    """Codes, dummies and the feature vector: numeric columns first, then each category's dummies.

    ``handle_invalid`` holds for unseen and null levels: ``error``, ``skip`` (the row goes) or ``keep`` (a level of its own).
    """
    indexer = index_stage(categories, handle_invalid=handle_invalid)
    dummies = dummy_stage(indexer.getOutputCols(), [f"{c}_dummy" for c in categories])
    return [indexer, dummies, assemble_stage([*numeric, *dummies.getOutputCols()], features)]


def hour_stages(hour: str = "depart", raw: list[str] | None = None, handle_invalid: str = "error") -> list:
    """Three-hour bucket of ``hour`` with dummies, and dummies of integer columns as they are.

    ``handle_invalid`` holds for hours outside the day and nulls.
    """
    bucket = bucket_stage(hour, f"{hour}_bucket", handle_invalid=handle_invalid)
    columns = [bucket.getOutputCol(), *(raw or [])]
    return [bucket, dummy_stage(columns, [f"{hour}_dummy", *[f"{c}_dummy" for c in raw or []]])]


def tabular_regression(
    numeric: list[str], categories: list[str], model: LinearRegression, handle_invalid: str = "error"
) -> Pipeline:
    return Pipeline(stages=[*category_stages(numeric, categories, model.getFeaturesCol(), handle_invalid), model])


def text_classification(text: str, label: str = "label", strength: float = 0.2, buckets: int = 1024) -> Pipeline:
    """Text stages and a penalized logistic model; codes and weights are fitted on training rows only."""
    return Pipeline(stages=[*text_stages(text, "features", buckets), logistic(label, strength)])
