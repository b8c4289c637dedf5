"""Parameter grids and k-fold cross-validation.

``grid_search`` differs from Spark's ``CrossValidator`` in how often it reads the data:

* the stages before the model are fitted once per fold instead of once per fold
  and grid point, still on that fold's training rows only;
* folds are plain filters on a fold column, without a Python check per row;
* random forests that differ only in ``maxDepth`` are one fit, the deepest, cut at each depth, and subset rules
  that choose as many of the features are one rule.

The metrics are the same; a test compares the two.
"""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.operators.coding import assemble_stage
from tallyloom.operators.metrics import auc_table
from tallyloom.operators.models import cached, category_stages, cut_forests
from tallyloom.operators.moments import linear_grid_metrics
from tallyloom.operators.reports import parameter_table, stage_of


def grid(axes: dict) -> list[dict]:
    """Cartesian product of parameter values; no axes give the one empty point."""
    builder = ParamGridBuilder()
    for param, values in axes.items():
        builder = builder.addGrid(param, values)
    return builder.build()


def cross_validator(
    estimator: Estimator, points: list[dict], evaluator: Evaluator, folds: int, seed: int,
    fold_column: str = "", parallelism: int = 4,
) -> CrossValidator:
    """Spark's own cross-validator; with ``fold_column`` the folds do not depend on partitioning."""
    return CrossValidator(
        estimator=estimator, estimatorParamMaps=points, evaluator=evaluator,
        numFolds=folds, seed=seed, foldCol=fold_column, parallelism=parallelism,
    )


@dataclass
class GridResult:
    """Metrics per grid point and fold, and the winner refitted on all rows."""

    points: list[dict]
    fold_metrics: list[list[float]]
    metric: str
    larger_is_better: bool
    best_model: PipelineModel

    @property
    def mean_metrics(self) -> list[float]:
        return [sum(m) / len(m) for m in self.fold_metrics]

    @property
    def best(self) -> int:
        means = self.mean_metrics
        return means.index(max(means) if self.larger_is_better else min(means))

    def table(self, spark: SparkSession) -> DataFrame:
        return grid_table(spark, self.points, self.mean_metrics, self.metric, self.larger_is_better)


def grid_table(
    spark: SparkSession, points: list[dict], means: list[float], metric: str, larger_is_better: bool
) -> DataFrame:
    """One row per grid point: its parameter values, metric name, mean metric and rank (1 = best).

    Means that agree in nine places are a tie, and the earlier point is ranked before.
    """
    names = sorted({p.name for point in points for p in point})
    order = sorted(range(len(points)), key=lambda i: (-round(means[i], 9) if larger_is_better else round(means[i], 9), i))
    rank = {i: r + 1 for r, i in enumerate(order)}
    rows = []
    for i, point in enumerate(points):
        values = {p.name: str(v) for p, v in point.items()}
        rows.append((i, {n: values.get(n, "") for n in names}, metric, float(means[i]), rank[i]))
    table = spark.createDataFrame(
        rows, "point int, params map<string,string>, metric string, mean_metric double, rank int"
    )
    return table.select(
        "point", *[F.col("params")[n].alias(n) for n in names], "metric", "mean_metric", "rank"
    )


def best_point(table: DataFrame) -> DataFrame:
    """The winning row of a grid table."""
    return table.where(F.col("rank") == 1)


def grid_size(table: DataFrame) -> DataFrame:
    return table.agg(F.count("*").alias("n_models"))


#: Features that a tree's subset rule chooses from n.
_CHOSEN = {
    "all": lambda n: n, "onethird": lambda n: math.ceil(n / 3), "sqrt": lambda n: math.ceil(math.sqrt(n)), "log2": lambda n: max(1, math.ceil(math.log2(n))),
}


def same_fits(model: Estimator, points: list[dict], rows: DataFrame) -> list[dict[int, list[int]]]:
    """The points (by number) that one fit serves, by maximal depth; 0 stands for the depth of an estimator that is no forest.

    A forest grows level by level, and its draws of rows and features do not depend on the levels to come, as long as each level
    is grown in one pass: where its widest one might not fit ``maxMemoryInMB`` the point has a fit of its own.
    """
    if not isinstance(model, RandomForestClassifier):
        return [{0: [i]} for i in range(len(points))]
    n = rows.schema[model.getFeaturesCol()].metadata.get("ml_attr", {}).get("num_attrs", 0)
    fits: dict[tuple, dict[int, list[int]]] = {}
    for i, point in enumerate(points):
        own = model.copy(point)
        rule, depth = own.getFeatureSubsetStrategy(), own.getMaxDepth()
        # a node sums up, of two classes, the bins of each feature; twice that, to be safe
        widest = own.getNumTrees() * 2 ** max(0, depth - 1) * n * own.getMaxBins() * 2 * 8 * 2
        alone = i if not n or widest > own.getMaxMemoryInMB() << 20 else -1
        others = tuple(sorted((p.name, str(v)) for p, v in point.items() if p.name not in ("maxDepth", "featureSubsetStrategy")))
        key = (alone, others, _CHOSEN[rule](n) if rule in _CHOSEN else rule)
        fits.setdefault(key, {}).setdefault(depth, []).append(i)
    return list(fits.values())


def grid_search(
    stages: list, model: Estimator, points: list[dict], evaluator: Evaluator,
    rows: DataFrame, fold_column: str, folds: int, parallelism: int = 4,
) -> GridResult:
    """k-fold cross-validation of ``model`` over ``points`` behind the feature ``stages``.

    ``rows`` carries the fold number (0..folds-1) of each row. The winner is
    refitted, with its feature stages, on all rows.
    """
    features = Pipeline(stages=stages)
    needed = [model.getFeaturesCol(), model.getLabelCol()]
    metrics: list[list[float]] = [[] for _ in points]
    in_session = inheritable_thread_target(rows.sparkSession)
    with cached(rows), ThreadPoolExecutor(parallelism) as pool:
        for fold in range(folds):
            held_out = F.col(fold_column) == fold
            prepared = features.fit(rows.where(~held_out))
            train = prepared.transform(rows.where(~held_out)).select(*needed)
            held = prepared.transform(rows.where(held_out)).select(*needed)
            with cached(train, held):

                def run(depths: dict[int, list[int]]) -> dict[int, float]:
                    """The metric of each point that this fit serves."""
                    deepest = max(depths)
                    fitted = {deepest: model.fit(train, points[depths[deepest][0]])}
                    if len(depths) > 1:
                        fitted |= cut_forests(fitted[deepest], [d for d in depths if d != deepest], rows.sparkSession)
                    return {i: value for d, own in depths.items() for value in [evaluator.evaluate(fitted[d].transform(held))] for i in own}

                for found in pool.map(in_session(run), same_fits(model, points, train)):
                    for i, value in found.items():
                        metrics[i].append(value)
        result = GridResult(points, metrics, evaluator.getMetricName(), evaluator.isLargerBetter(), None)
        winner = Pipeline(stages=[*stages, model.copy(points[result.best])])
        result.best_model = winner.fit(rows)
    return result


def linear_grid_search(
    numeric: list[str], categories: list[str], model: LinearRegression, points: list[dict], rows: DataFrame, fold_column: str, folds: int,
) -> GridResult:
    """``grid_search`` of a linear regression by its error, from one pass over the rows for all points and folds (see ``moments``).

    The points may set fitIntercept, regParam and elasticNetParam. The winner is refitted by Spark on all rows behind
    the category stages.
    """
    if other := {p.name for point in points for p in point} - {"fitIntercept", "regParam", "elasticNetParam"}:
        raise ValueError(f"not solved from sums: {sorted(other)}; use grid_search")
    with cached(rows):
        found = linear_grid_metrics(rows, numeric, categories, model, points, fold_column, folds)
        result = GridResult(points, found, "rmse", False, None)
        result.best_model = Pipeline(stages=[*stages_of(numeric, categories, model), model.copy(points[result.best])]).fit(rows)
    return result


def stages_of(numeric: list[str], categories: list[str], model: LinearRegression) -> list:
    if categories:
        return category_stages(numeric, categories, model.getFeaturesCol())
    return [assemble_stage(numeric, model.getFeaturesCol())]


def winner_report(result: GridResult, test: DataFrame, kind: type, params: list[str], score: str = "probability") -> DataFrame:
    """(name, value, is_default, doc): held-out area and mean metric of a classifier grid's winner, the grid's size and the winner's parameters.

    The held-out rows are scored in the job that shows the report; ``score`` is the winner's column that ranks rows.
    """
    spark = test.sparkSession
    model = stage_of(result.best_model, kind)
    area = auc_table(result.best_model.transform(test), vector_to_array(score)[1]).select(F.round("auc", 6).cast("string").alias("value"))
    text = lambda c: F.lit(c)
    none = F.lit(None).cast("boolean")
    held = area.select(text(result.metric).alias("name"), "value", none.alias("is_default"), text("held-out rows").alias("doc"))
    way = "larger" if result.larger_is_better else "smaller"
    table = result.table(spark)
    mean = best_point(table).select(
        text(f"mean {result.metric}").alias("name"), F.round("mean_metric", 6).cast("string").alias("value"),
        none.alias("is_default"), text(f"best of the grid, {way} is better").alias("doc"),
    )
    size = grid_size(table).select(
        text("n_models").alias("name"), F.col("n_models").cast("string").alias("value"), none.alias("is_default"), text("points of the grid").alias("doc")
    )
    told = parameter_table(model, spark).where(F.col("param").isin(params)).select(F.col("param").alias("name"), "value", "is_default", "doc")
    return held.unionByName(mean).unionByName(size).unionByName(told)
