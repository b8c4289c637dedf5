"""Cross-validation and parameter grids, and the text classifier."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.operators import coding, metrics, models, reports, split, tuning, wrangle
from tallyloom.plans.checks import KM_TRIPS, METRIC_CARS, bucket, in_train
from tallyloom.plans.linear import flown
from tallyloom.plans.trees import SEED
from tallyloom.sources import cars, dealt, table, trips

# Axes of the duration grid: strength and mix of the penalty.
STRENGTHS = [0.01, 0.1, 1.0, 10.0]
MIXES = [0.0, 0.5, 1.0]
# Axes of the fuel grid.
FUEL_STRENGTHS = [0.001, 0.01, 0.1, 1.0, 10.0]
FUEL_MIXES = [0.0, 0.25, 0.5, 0.75, 1.0]


def cv_rmse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five folds over all line items, with no parameter to choose: the mean error."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_extendedprice")
    rows = split.with_fold(lines, "l_orderkey", 5)
    found = tuning.grid_search(
        [coding.assemble_stage(["l_quantity"])], models.least_squares("l_extendedprice"), tuning.grid({}),
        RegressionEvaluator(labelCol="l_extendedprice"), rows, "fold", 5,
    )
    return found.table(spark).select("point", "metric", F.round("mean_metric", 4).alias("mean_metric"), "rank")


def _duration_search(spark: SparkSession, sf_dir: str, numeric: list[str], categories: list[str]) -> tuple[tuning.GridResult, DataFrame]:
    df = flown(spark, sf_dir).select("trip_id", "duration", *numeric, *categories)
    train, test = split.stable_split(df, "trip_id")
    model = models.least_squares("duration", tol=1e-12)
    points = tuning.grid({model.regParam: STRENGTHS, model.elasticNetParam: MIXES})
    return tuning.linear_grid_search(numeric, categories, model, points, split.with_fold(train, "trip_id", 5), "fold", 5), test


def cv_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve penalties by five folds: mean error and rank of each."""
    found, _ = _duration_search(spark, sf_dir, ["km"], [])
    return found.table(spark).select(
        "point", F.col("regParam").cast("double").alias("strength"), F.col("elasticNetParam").cast("double").alias("mix"),
        F.round("mean_metric", 5).alias("mean_metric"), "rank",
    )


def _winner(found: tuning.GridResult, test: DataFrame, spark: SparkSession, label: str, *params: str) -> DataFrame:
    """Held-out error of the refitted winner next to its parameters, looked up by name."""
    model = reports.stage_of(found.best_model, LinearRegressionModel)
    chosen = reports.parameter_table(model, spark).where(F.col("param").isin(*params))
    score = metrics.as_rows(metrics.regression_report(found.best_model.transform(test), label).select("rmse"))
    size = metrics.as_rows(tuning.grid_size(found.table(spark)))
    value = F.when(F.col("value").isin("True", "False"), (F.col("value") == "True").cast("double")).otherwise(F.col("value").try_cast("double"))
    return (
        chosen.select(F.col("param").alias("metric"), value.alias("value"))
        .unionByName(score).unionByName(size)
        .withColumn("value", F.round("value", 5))
    )


_PENALTY = ("regParam", "elasticNetParam")


def grid_winner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _winner(*_duration_search(spark, sf_dir, ["km"], []), spark, "duration", *_PENALTY)


def duration_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same grid behind coded airport and weekday."""
    return _winner(*_duration_search(spark, sf_dir, ["km"], ["org", "dow"]), spark, "duration", *_PENALTY)


def _fuel_search(spark: SparkSession, sf_dir: str) -> tuple[tuning.GridResult, DataFrame]:
    df = cars(spark, sf_dir).transform(wrangle.car_units).transform(wrangle.fuel_use)
    train, test = split.stable_split(df.select("car_id", "weight_kg", "cyl", "type", "consumption"), "car_id")
    model = models.least_squares("consumption", tol=1e-12, maxIter=1000)
    points = tuning.grid({model.fitIntercept: [True, False], model.regParam: FUEL_STRENGTHS, model.elasticNetParam: FUEL_MIXES})
    rows = split.with_fold(train, "car_id", 10)
    return tuning.linear_grid_search(["weight_kg", "cyl"], ["type"], model, points, rows, "fold", 10), test


def fuel_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fuel use: intercept, strength and mix, 50 points by ten folds."""
    found, _ = _fuel_search(spark, sf_dir)
    return found.table(spark).select(
        "point", (F.col("fitIntercept") == "True").alias("intercept"), F.col("regParam").cast("double").alias("strength"),
        F.col("elasticNetParam").cast("double").alias("mix"), "metric", F.round("mean_metric", 5).alias("mean_metric"), "rank",
    )


def fuel_winner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The winner of ``fuel_grid`` on the held-out cars, and its parameters by name."""
    return _winner(*_fuel_search(spark, sf_dir), spark, "consumption", *_PENALTY, "fitIntercept", "maxIter")


def history_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The objective of a lasso fit: first and last value, that of its coefficients over the rows, and whether it only falls, a step each."""
    rows = coding.assemble_stage(["km", "dow"]).transform(flown(spark, sf_dir).select("km", "dow", "duration"))
    with models.cached(rows):
        model = models.lasso("duration", 1.0, tol=1e-12).fit(rows)
    history = reports.objective_table(model, spark)
    earlier = history.select((F.col("iteration") + 1).alias("iteration"), F.col("objective").alias("before"))
    told = history.join(earlier, "iteration", "left").agg(
        F.max(F.when(F.col("iteration") == 0, F.col("objective"))).alias("first"), F.min_by("objective", -F.col("iteration")).alias("last"),
        F.bool_and(F.coalesce(F.col("objective") <= F.col("before") + 1e-12, F.lit(True))).alias("never_rises"),
        (F.count("*") - 1 == reports.fit_report(model, spark).select("iterations").scalar()).alias("a_value_per_step"),
    )
    own = reports.objective_of(model, model.transform(rows)).select(F.round("objective", 7).alias("of_coefficients"))
    return told.select(F.round("first", 7).alias("first"), F.round("last", 7).alias("last"), own.scalar().alias("of_coefficients"), "never_rises", "a_value_per_step")


def forest_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late trips: feature subset rule by depth, ranked by the area under the curve."""
    late = trips(spark, sf_dir).transform(wrangle.delay_labels)
    columns = dealt(late.select("trip_id", "mon", "depart", "duration", "label"), "trip_id")
    train, _ = split.stable_split(columns, "trip_id")
    model = models.forest(seed=SEED)
    points = tuning.grid(
        {model.featureSubsetStrategy: ["all", "onethird", "sqrt", "log2"], model.maxDepth: [2, 5, 10]}
    )
    found = tuning.grid_search(
        [coding.assemble_stage(["mon", "depart", "duration"])], model, points, BinaryClassificationEvaluator(numBins=0),
        split.with_fold(train, "trip_id", 5), "fold", 5,
    )
    return found.table(spark)


def _english(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", "text", (F.col("lang") == "en").cast("int").alias("label")
    )
    return split.stable_split(dealt(documents, "doc_id"), "doc_id")


def _classifier(train: DataFrame) -> PipelineModel:
    return models.fit_kept(models.text_classification("text"), train, ["text_hash", "label"])


def text_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Is a document English? Held-out ratios and area under the curve."""
    train, test = _english(spark, sf_dir)
    scored = _classifier(train).transform(test)
    # only what the metrics read is kept, not texts and vectors
    judged = scored.select("label", "prediction", coding.dense("probability")[1].alias("score"))
    with models.cached(judged):
        area = metrics.as_rows(metrics.auc_table(judged, F.col("score")))
        found = metrics.as_rows(metrics.weighted_report(judged)).unionByName(area).collect()
    return spark.createDataFrame([(r.metric, round(r.value, 4)) for r in found], "metric string, value double")


def text_classifier_calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The intercept carries no penalty, so over the training rows the mean probability is the share of the label."""
    train, _ = _english(spark, sf_dir)
    fitted = _classifier(train)
    model = reports.stage_of(fitted, LogisticRegressionModel)
    chance = coding.dense(model.getProbabilityCol())[1]
    return fitted.transform(train).agg(F.count("*").alias("n_rows"), F.round(F.avg(chance), 2).alias("probability"))


QUERIES = {
    f.__name__: f
    for f in (
        cv_rmse, cv_grid, grid_winner, duration_grid, fuel_grid, fuel_winner, history_summary, forest_grid, text_classifier, text_classifier_calibration,
    )
}

_POINTS = ", ".join(
    f"({i}, {s}::DOUBLE, {m}::DOUBLE)" for i, (s, m) in enumerate((s, m) for s in STRENGTHS for m in MIXES)
)

# Closed form of the one-feature fit on every fold's training rows and penalty.
_SEARCH = f"""{KM_TRIPS},
    train AS (SELECT duration, km, {bucket('trip_id', 5, 'fold')} AS fold FROM flown WHERE {in_train('trip_id')}),
    points AS (SELECT * FROM (VALUES {_POINTS}) AS p(point, strength, mix)),
    folds AS (SELECT unnest(range(5)) AS held),
    moments AS (SELECT held, corr(duration, km) AS r, stddev_pop(duration) AS sy, stddev_pop(km) AS sx,
        avg(duration) AS my, avg(km) AS mx FROM train JOIN folds ON fold <> held GROUP BY held),
    slopes AS (SELECT *, sign(r) * greatest(abs(r) - mix * strength / sy, 0) / (1 + (1 - mix) * strength / sy) * sy / sx AS b
        FROM moments, points),
    errors AS (SELECT point, held, sqrt(avg((duration - my - b * (km - mx)) ** 2)) AS rmse
        FROM train JOIN slopes ON fold = held GROUP BY ALL),
    means AS (SELECT point, strength, mix, avg(rmse) AS mean_metric FROM errors JOIN points USING (point) GROUP BY ALL)"""



def _penalized_sql(base: str, numeric: list[str], categories: list[str], points: list[tuple], folds: int, sweeps: int) -> str:
    """CTEs up to errors(point, held, rmse): each point's optimum on the training rows of each fold, by coordinate descent.

    ``sweeps`` must be enough for the descent to arrive: more of them no longer change the rounded result.
    ``base`` has id, fold, y and the columns; its rows of fold -1 are the test part, and their error is that of the fit on all folds.
    """
    rows = ", ".join(f"({i}, {ic}, {s}::DOUBLE, {m}::DOUBLE)" for i, (ic, s, m) in enumerate(points))
    numbers = " UNION ALL ".join(f"SELECT id, fold, y, '{c}' AS feature, {c}::DOUBLE AS v FROM base" for c in numeric)
    kinds = " UNION ALL ".join(f"SELECT id, fold, '{c}' AS kind, {c}::VARCHAR AS level FROM base" for c in categories) or "SELECT id, fold, '' AS kind, '' AS level FROM base WHERE false"
    return f"""RECURSIVE {base},
    folds AS (SELECT unnest(range(-1, {folds})) AS held),
    points AS (SELECT * FROM (VALUES {rows}) AS p(point, ic, strength, mix)),
    kinds AS ({kinds}),
    levels AS (SELECT held, kind, level, row_number() OVER (PARTITION BY held, kind ORDER BY count(*) DESC, level) AS place,
        count(*) OVER (PARTITION BY held, kind) AS n_levels FROM kinds JOIN folds ON fold <> held AND fold >= 0 GROUP BY held, kind, level),
    long AS ({numbers} UNION ALL SELECT id, fold, y, kind || '=' || level, 1 FROM kinds JOIN base USING (id, fold)),
    features AS MATERIALIZED (SELECT held, feature, row_number() OVER (PARTITION BY held ORDER BY feature) AS j FROM (
        SELECT held, unnest({numeric}) AS feature FROM folds
        UNION ALL SELECT held, kind || '=' || level FROM levels WHERE place < n_levels)),
    wide AS (SELECT held, id, y, v, j FROM long JOIN folds ON fold <> held AND fold >= 0 JOIN features USING (held, feature)),
    own AS (SELECT held, count(*)::DOUBLE AS n, avg(y) AS my, stddev_pop(y) AS sy FROM base JOIN folds ON fold <> held AND fold >= 0 GROUP BY held),
    single AS (SELECT held, j, n, my, sy, sum(v) / n AS m, sqrt(sum(v * v) / n - (sum(v) / n) ** 2) AS s, sum(v * y) / n AS vy
        FROM wide JOIN own USING (held) GROUP BY held, j, n, my, sy),
    paired AS (SELECT a.held, a.j AS i, b.j, sum(a.v * b.v) AS total FROM wide a JOIN wide b USING (held, id) GROUP BY ALL),
    cells AS (SELECT ic, a.held, a.j AS i, b.j, (coalesce(total, 0) / a.n - CASE WHEN ic THEN a.m * b.m ELSE 0 END) / (a.s * b.s) AS g
        FROM single a JOIN single b USING (held) LEFT JOIN paired p ON p.held = a.held AND p.i = a.j AND p.j = b.j, (VALUES (true), (false)) AS f(ic)),
    lines AS (SELECT ic, held, i, list(g ORDER BY j) AS line FROM cells GROUP BY ALL),
    mats AS MATERIALIZED (SELECT ic, lines.held AS held, list(line ORDER BY i) AS g, list((vy - CASE WHEN ic THEN m * my ELSE 0 END) / (s * sy) ORDER BY i) AS t, any_value(sy) AS sy
        FROM lines JOIN single ON lines.held = single.held AND lines.i = single.j GROUP BY ic, lines.held),
    tasks AS MATERIALIZED (SELECT held, point, g, t, len(t) AS p, mix * strength / sy AS l1, (1 - mix) * strength / sy AS l2 FROM mats JOIN points USING (ic)),
    steps AS (SELECT held, point, 0 AS k, list_transform(t, lambda x: 0.0::DOUBLE) AS b FROM tasks
        UNION ALL SELECT held, point, k + 1, list_concat(list_append(b[:k % p], sign(pull) * greatest(abs(pull) - l1, 0) / (g[k % p + 1][k % p + 1] + l2)), b[k % p + 2:])
        FROM (SELECT *, t[k % p + 1] - list_dot_product(g[k % p + 1], b) + g[k % p + 1][k % p + 1] * b[k % p + 1] AS pull
            FROM steps JOIN tasks USING (held, point) WHERE k < p * {sweeps})),
    fitted AS (SELECT held, point, j, b[j] * sy / s AS beta, m, my FROM steps JOIN tasks USING (held, point) JOIN single USING (held) WHERE k = p * {sweeps}),
    bases AS (SELECT held, point, any_value(CASE WHEN ic THEN my ELSE 0 END) - sum(CASE WHEN ic THEN beta * m ELSE 0 END) AS a FROM fitted JOIN points USING (point) GROUP BY held, point),
    parts AS (SELECT held, point, id, sum(beta * v) AS part FROM fitted JOIN features USING (held, j) JOIN long USING (feature) WHERE fold = held GROUP BY held, point, id),
    errors AS (SELECT point, held, sqrt(avg((y - a - part) ** 2)) AS rmse FROM parts JOIN bases USING (held, point) JOIN base USING (id) GROUP BY point, held),
    means AS (SELECT point, ic, strength, mix, avg(rmse) AS mean_metric FROM errors JOIN points USING (point) WHERE held >= 0 GROUP BY ALL),
    best AS (SELECT * FROM means ORDER BY round(mean_metric, 9), point LIMIT 1)"""


def _fold_or_test(key: str, folds: int) -> str:
    return f"CASE WHEN {in_train(key)} THEN {bucket(key, folds, 'fold')} ELSE -1 END"


_DURATION = _penalized_sql(
    f"{KM_TRIPS}, base AS (SELECT trip_id AS id, {_fold_or_test('trip_id', 5)} AS fold, duration::DOUBLE AS y, km, org, dow FROM flown)",
    ["km"], ["org", "dow"], [("true", s, m) for s in STRENGTHS for m in MIXES], 5, 400,
)
_FUEL = _penalized_sql(
    f"""{METRIC_CARS}, base AS (SELECT car_id AS id, {_fold_or_test('car_id', 10)} AS fold,
        round(378.5411784::DOUBLE / (avg_mpg * 1.609344::DOUBLE), 2) AS y, weight_kg, cyl, type FROM metric)""",
    ["weight_kg", "cyl"], ["type"], [(ic, s, m) for ic in ("true", "false") for s in FUEL_STRENGTHS for m in FUEL_MIXES], 10, 2500,
)
# the same rows as training and as test part, so that the error is that of the training rows
_LASSO = _penalized_sql(
    f"{KM_TRIPS}, base AS (SELECT trip_id AS id, unnest([0, -1]) AS fold, duration::DOUBLE AS y, km, dow FROM flown)", ["km", "dow"], [], [("true", 1.0, 1.0)], 0, 200,
)
_BEST = """SELECT 'regParam' AS metric, round(strength, 5) AS value FROM best
        UNION ALL SELECT 'elasticNetParam', round(mix, 5) FROM best
        UNION ALL SELECT 'rmse', round(rmse, 5) FROM best JOIN errors USING (point) WHERE held = -1
        UNION ALL SELECT 'n_models', count(*)::DOUBLE FROM points"""

ORACLES = {
    "cv_rmse": f"""WITH folded AS (SELECT l_quantity AS x, l_extendedprice AS y, {bucket('l_orderkey', 5, 'fold')} AS fold
            FROM lineitem), folds AS (SELECT unnest(range(5)) AS held),
        lines AS (SELECT held, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM folded JOIN folds ON fold <> held
            GROUP BY held),
        errors AS (SELECT held, sqrt(avg((y - a - b * x) ** 2)) AS rmse FROM folded JOIN lines ON fold = held GROUP BY held)
        SELECT 0::INTEGER AS point, 'rmse' AS metric, round(avg(rmse), 4) AS mean_metric, 1::INTEGER AS rank FROM errors""",
    "cv_grid": f"""WITH {_SEARCH} SELECT point::INTEGER AS point, strength, mix, round(mean_metric, 5) AS mean_metric,
        row_number() OVER (ORDER BY round(mean_metric, 9), point)::INTEGER AS rank FROM means""",
    "grid_winner": f"""WITH {_SEARCH}, best AS (SELECT * FROM means ORDER BY mean_metric LIMIT 1),
        whole AS (SELECT corr(duration, km) AS r, stddev_pop(duration) AS sy, stddev_pop(km) AS sx,
            avg(duration) AS my, avg(km) AS mx FROM train),
        final AS (SELECT *, sign(r) * greatest(abs(r) - mix * strength / sy, 0)
            / (1 + (1 - mix) * strength / sy) * sy / sx AS b FROM whole, best),
        test AS (SELECT sqrt(avg((duration - my - b * (km - mx)) ** 2)) AS rmse FROM flown, final
            WHERE NOT {in_train('trip_id')})
        SELECT 'regParam' AS metric, round(strength, 5) AS value FROM best
        UNION ALL SELECT 'elasticNetParam', round(mix, 5) FROM best
        UNION ALL SELECT 'rmse', round(rmse, 5) FROM test
        UNION ALL SELECT 'n_models', count(*)::DOUBLE FROM points""",
    "duration_grid": f"WITH {_DURATION} {_BEST}",
    "fuel_grid": f"""WITH {_FUEL} SELECT point::INTEGER AS point, ic AS intercept, strength, mix, 'rmse' AS metric,
        round(mean_metric, 5) AS mean_metric, row_number() OVER (ORDER BY round(mean_metric, 9), point)::INTEGER AS rank FROM means""",
    "history_summary": f"""WITH {_LASSO}, pull AS (SELECT sum(abs(beta * s / sy)) / any_value(sy) AS l1, any_value(sy) AS sy FROM fitted JOIN single USING (held, j))
        SELECT 0.5::DOUBLE AS first, round(rmse ** 2 / (2 * sy * sy) + l1, 7) AS last, round(rmse ** 2 / (2 * sy * sy) + l1, 7) AS of_coefficients,
        true AS never_rises, true AS a_value_per_step FROM errors, pull""",
    "fuel_winner": f"""WITH {_FUEL} {_BEST} UNION ALL SELECT 'fitIntercept', ic::INTEGER::DOUBLE FROM best
        UNION ALL SELECT 'maxIter', 1000""",
    "text_classifier_calibration": f"""SELECT count(*) AS n_rows, round(avg((lang = 'en')::INTEGER), 2) AS probability
        FROM documents WHERE {in_train('doc_id')}""",
}
