import math

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.sql import functions as F

from tallyloom.operators import coding, models, reports, split, tuning, wrangle
from tallyloom.plans import linear
from tallyloom.sources import dealt, trips


@pytest.fixture(scope="module")
def folded(spark, sf_dir):
    return split.with_fold(linear.flown(spark, sf_dir), "trip_id", 3).cache()


def test_grid_search_equals_the_cross_validator(spark, folded):
    """Feature stages are fitted once per fold here and once per fold and point there: same metrics."""
    model = models.least_squares("duration")
    points = tuning.grid({model.regParam: [0.01, 10.0], model.elasticNetParam: [0.0, 1.0]})
    stages, evaluator = models.category_stages(["km"], ["org"]), RegressionEvaluator(labelCol="duration")
    mine = tuning.grid_search(stages, model, points, evaluator, folded, "fold", 3)
    theirs = tuning.cross_validator(Pipeline(stages=[*stages, model]), points, evaluator, 3, 13, "fold").fit(folded)
    assert all(math.isclose(a, b, rel_tol=1e-9) for a, b in zip(mine.mean_metrics, theirs.avgMetrics))
    best = theirs.bestModel.stages[-1]
    assert list(mine.best_model.stages[-1].coefficients) == pytest.approx(list(best.coefficients))
    assert mine.best_model.stages[-1].getRegParam() == best.getRegParam()


def test_no_axes_give_one_point(folded, spark):
    model = models.least_squares("duration")
    found = tuning.grid_search([coding.assemble_stage(["km"])], model, tuning.grid({}), RegressionEvaluator(labelCol="duration"), folded, "fold", 3)
    table = found.table(spark)
    assert table.columns == ["point", "metric", "mean_metric", "rank"] and tuning.grid_size(table).first()[0] == 1


@pytest.fixture(scope="module")
def late_vectors(spark, sf_dir):
    late = trips(spark, sf_dir).transform(wrangle.delay_labels)
    rows = dealt(late.select("trip_id", "mon", "depart", "duration", "label"), "trip_id", 3)
    return coding.assemble_stage(["mon", "depart", "duration"]).transform(rows).select("trip_id", "features", "label").cache()


def test_cut_forest_is_the_shallower_fit(spark, late_vectors):
    model = models.forest(seed=3, trees=4, featureSubsetStrategy="sqrt")
    deepest = model.copy({model.maxDepth: 7}).fit(late_vectors)
    for depth, cut in models.cut_forests(deepest, [0, 2, 4], spark).items():
        own = model.copy({model.maxDepth: depth, model.featureSubsetStrategy: "log2"}).fit(late_vectors)
        assert cut.getMaxDepth() == depth and cut.toDebugString.split("\n")[1:] == own.toDebugString.split("\n")[1:]
        raw = lambda m: [r[0] for r in m.transform(late_vectors).orderBy("trip_id").select("rawPrediction").collect()]
        assert raw(cut) == raw(own)


def test_forest_grid_fits_each_forest_once(spark, late_vectors, monkeypatch):
    """Three rules, one of them under two names, by two depths: one fit a fold for each rule, and the metrics of fits of their own."""
    model = models.forest(seed=3, trees=3)
    points = tuning.grid({model.featureSubsetStrategy: ["onethird", "sqrt", "log2"], model.maxDepth: [1, 4]})
    fits, fit = [], type(model).fit
    monkeypatch.setattr(type(model), "fit", lambda self, rows, params=None: fits.append(params) or fit(self, rows, params))
    rows = split.with_fold(late_vectors.withColumnRenamed("features", "given"), "trip_id", 2)
    evaluator, stages = BinaryClassificationEvaluator(numBins=0), [coding.assemble_stage(["given"])]
    found = tuning.grid_search(stages, model, points, evaluator, rows, "fold", 2)
    assert len(fits) == 2 * 2 + 1  # and the winner
    for i, point in enumerate(points):
        for fold in range(2):
            train, held = (stages[0].transform(rows.where(c)) for c in (F.col("fold") != fold, F.col("fold") == fold))
            assert found.fold_metrics[i][fold] == evaluator.evaluate(fit(model, train, point).transform(held))


def test_only_forests_of_known_width_share_a_fit(late_vectors):
    model = models.forest(seed=3, trees=3)
    points = tuning.grid({model.numTrees: [3, 5], model.maxDepth: [1, 4]})
    assert tuning.same_fits(model, points, late_vectors) == [{1: [0], 4: [1]}, {1: [2], 4: [3]}]
    own = [{1: [0]}, {4: [1]}, {1: [2]}, {4: [3]}]
    assert tuning.same_fits(model.copy({model.maxMemoryInMB: 0}), points, late_vectors) == own
    single = models.tree()
    assert tuning.same_fits(single, tuning.grid({single.maxDepth: [1, 4]}), late_vectors) == [{0: [0]}, {0: [1]}]


def test_larger_area_wins(spark, sf_dir):
    late = trips(spark, sf_dir).transform(wrangle.delay_labels).select("trip_id", "depart", "mon", "label")
    model = models.forest(seed=3, trees=3)
    points = tuning.grid({model.maxDepth: [1, 4]})
    found = tuning.grid_search(
        [coding.assemble_stage(["depart", "mon"])], model, points, BinaryClassificationEvaluator(),
        split.with_fold(late, "trip_id", 3), "fold", 3,
    )
    winner = tuning.best_point(found.table(spark)).first()
    assert winner.mean_metric == max(found.mean_metrics) and winner.metric == "areaUnderROC"
    chosen = reports.parameter_table(found.best_model.stages[-1], spark).where(F.col("param") == "maxDepth").first()
    assert chosen.value == winner.maxDepth


def test_smaller_error_wins_and_rank_follows_direction(spark):
    model = models.least_squares("y")
    points = tuning.grid({model.regParam: [1.0, 2.0, 3.0]})
    ranks = lambda larger: [r.rank for r in tuning.grid_table(spark, points, [0.5, 0.1, 0.9], "m", larger).orderBy("point").collect()]
    assert ranks(False) == [2, 1, 3] and ranks(True) == [2, 3, 1]


def test_grid_is_the_product_of_its_axes():
    model = models.least_squares("y")
    points = tuning.grid({model.fitIntercept: [True, False], model.regParam: [0.1, 1.0, 10.0]})
    assert len(points) == 6 and len({tuple(p.values()) for p in points}) == 6
