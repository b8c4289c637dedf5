"""Linear and logistic models, checked by closed forms or by the equations of their optimum."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.functions import miles_to_km
from tallyloom.operators import absorbed, coding, metrics, models, reports, split, wrangle
from tallyloom.plans.checks import DELAYS, KM_TRIPS, TRIPS, in_train
from tallyloom.sources import cars, table, trips

# (elasticNetParam, regParam) of the penalized fits
PENALTIES = [(0.0, 0.1), (0.0, 10.0), (0.5, 5.0), (1.0, 0.75), (1.0, 1.0), (1.0, 60.0), (1.0, 100.0)]


def flown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips with kilometres: the input of the duration models."""
    df = trips(spark, sf_dir).select("trip_id", "mile", "org", "dow", "duration")
    return wrangle.replace_columns(df, {"km": miles_to_km("mile")}, drop=("mile",))


def _vector(df: DataFrame, columns: list[str], label: str, *keep: str) -> DataFrame:
    return coding.assemble_stage(columns).transform(df).select("features", label, *keep)


def _rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    # adding zero turns -0.0 into 0.0
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in columns})


def ols_one_feature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slope, intercept and training metrics of two one-feature regressions."""
    lines = table(spark, sf_dir, "lineitem")
    inputs = {
        "trips": _vector(flown(spark, sf_dir), ["km"], "duration"),
        "lineitem": _vector(lines, ["l_quantity"], "l_extendedprice"),
    }
    found = []
    for name, rows in inputs.items():
        model = models.least_squares(rows.columns[1]).fit(rows)
        found.append(reports.coefficient_report(model, rows).withColumn("source", F.lit(name)))
    return _rounded(reduce(DataFrame.unionByName, found), 6, "coefficient", "rmse", "r2")


def penalized_one_feature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ridge, lasso and mixed penalties, and which coefficients the lasso removes."""
    rows = _vector(flown(spark, sf_dir), ["km"], "duration")
    found = []
    with models.cached(rows):
        for alpha, strength in PENALTIES:
            model = models.least_squares("duration", elasticNetParam=alpha, regParam=strength, tol=1e-12).fit(rows)
            found.append(
                reports.coefficient_table(model, rows).select(
                    F.lit(alpha).alias("alpha"), F.lit(strength).alias("strength"), "feature", "coefficient",
                    (F.col("coefficient") == 0).alias("is_zero"),
                )
            )
    return _rounded(reduce(DataFrame.unionByName, found), 5, "coefficient")


def _org_model(spark: SparkSession, sf_dir: str, numeric: list[str]):
    df = flown(spark, sf_dir)
    coding.require_few_levels(df, ["org"])
    with models.cached(df):
        fitted = models.tabular_regression(numeric, ["org"], models.least_squares("duration")).fit(df)
    return reports.stage_of(fitted, LinearRegressionModel), fitted.transform(df)


def ols_with_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes, dummies, vector and least squares in one pipeline: coefficients by level name."""
    model, scored = _org_model(spark, sf_dir, ["km"])
    return _rounded(reports.coefficient_table(model, scored), 6, "coefficient")


def ols_group_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With dummies only, every prediction is the mean of its group."""
    _, scored = _org_model(spark, sf_dir, [])
    per_org = scored.groupBy("org").agg(F.count("*").alias("n_rows"), F.avg("prediction").alias("prediction"))
    return _rounded(per_org, 6, "prediction")


def travel_speed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Speed, and minutes on the ground per airport."""
    model, scored = _org_model(spark, sf_dir, ["km"])
    return _rounded(reports.travel_speed(model, scored), 6, "km_per_hour", "ground_minutes")


def _order_fit(spark: SparkSession, sf_dir: str, numeric: list[str]) -> tuple[absorbed.AbsorbedFit, DataFrame]:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_extendedprice")
    return absorbed.absorbed_least_squares(lines, numeric, "l_orderkey", "l_extendedprice"), lines


def order_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A coefficient for each order, of which there are as many as the table has: without other columns, its mean."""
    fit, _ = _order_fit(spark, sf_dir, [])
    return _rounded(fit.levels, 6, "effect").withColumn("level", F.col("level").cast("bigint"))


def order_effects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price by quantity and order: one slope, and an intercept per order."""
    fit, _ = _order_fit(spark, sf_dir, ["l_quantity"])
    found = _rounded(fit.levels, 3, "effect").withColumn("level", F.col("level").cast("bigint"))
    return found.withColumn("slope", F.round(F.lit(fit.slopes["l_quantity"]), 5))


def order_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors of price by quantity, discount and order, each line predicted by a join with the orders' coefficients."""
    fit, lines = _order_fit(spark, sf_dir, ["l_quantity", "l_discount"])
    scored = fit.predict(lines, F.struct("l_linenumber", "l_quantity", "l_extendedprice"))
    report = metrics.regression_report(scored, "l_extendedprice").select("n_rows", "rmse", "r2")
    slopes = {f"slope_{name}": F.lit(slope) for name, slope in fit.slopes.items()}
    return _rounded(report.withColumns(slopes), 4, "rmse", "r2", *slopes)


def ols_normal_equations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kilometres and two categories: residuals are orthogonal to every feature."""
    df = flown(spark, sf_dir).withColumn("day", F.col("dow").cast("string"))
    fitted = models.tabular_regression(["km"], ["org", "day"], models.least_squares("duration")).fit(df)
    left = reports.residuals(fitted.transform(df), "duration")
    on = F.array(
        F.struct(F.lit("km").alias("feature"), (F.col("residual") * F.col("km") / 1000).alias("part")),
        F.struct(F.concat(F.lit("org "), "org").alias("feature"), F.col("residual").alias("part")),
        F.struct(F.concat(F.lit("day "), "day").alias("feature"), F.col("residual").alias("part")),
    )
    sums = left.select(F.inline(on)).groupBy("feature").agg(
        F.count("*").alias("n_rows"), F.avg("part").alias("mean_residual")
    )
    return _rounded(sums, 6, "mean_residual")


def ols_residuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _vector(flown(spark, sf_dir), ["km"], "duration", "trip_id")
    scored = models.least_squares("duration").fit(rows).transform(rows)
    return _rounded(reports.residuals(scored, "duration"), 5, "residual").select("trip_id", "residual")


def _km_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held-out trips with the duration predicted from kilometres on the training part."""
    train, test = split.stable_split(flown(spark, sf_dir), "trip_id")
    fitted = Pipeline(stages=[coding.assemble_stage(["km"]), models.least_squares("duration")]).fit(train)
    return fitted.transform(test)


def rmse_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(metrics.regression_report(_km_test(spark, sf_dir), "duration"), 6, "rmse", "mae", "r2")


def pair_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.pair_listing(_km_test(spark, sf_dir), "duration", digits=2)


def _three_models(train: DataFrame, test: DataFrame, stages: list, label: str, lasso: float) -> DataFrame:
    """Plain, ridge and lasso fit of the same prepared rows: held-out error and coefficients set to zero."""
    found = []
    prepared = Pipeline(stages=stages).fit(train)
    fit_rows, test_rows = (prepared.transform(part).select("features", label) for part in (train, test))
    with models.cached(fit_rows, test_rows):
        for name, estimator in (
            ("plain", models.least_squares(label)),
            ("ridge", models.ridge(label, 0.1)),
            ("lasso", models.lasso(label, lasso)),
        ):
            model = estimator.fit(fit_rows)
            # one row each, of the size of the model
            score = metrics.regression_report(model.transform(test_rows), label).first()
            zeros = reports.zero_coefficients(model, fit_rows).first()
            found.append((name, score.n_rows, score.rmse, score.r2, zeros.n_zero, zeros.n_features))
    return train.sparkSession.createDataFrame(
        found, "model string, n_rows bigint, rmse double, r2 double, n_zero bigint, n_features bigint"
    )


def fuel_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fuel use from weight, cylinders, type and densities: plain, ridge and lasso on the same rows."""
    measured = cars(spark, sf_dir).transform(wrangle.car_units).transform(wrangle.fuel_use).transform(wrangle.densities)
    numeric = ["weight_kg", "cyl", "density", "density_area", "density_volume"]
    train, test = split.stable_split(measured.select("car_id", "type", "consumption", *numeric), "car_id")
    return _three_models(train, test, models.category_stages(numeric, ["type"]), "consumption", lasso=0.75)


def schedule_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duration from kilometres and the dummies of airport, hour bucket, month and weekday: plain, ridge and lasso."""
    df = trips(spark, sf_dir).select("trip_id", "mile", "org", "depart", "mon", "dow", "duration")
    df = wrangle.replace_columns(df, {"km": miles_to_km("mile")}, drop=("mile",))
    train, test = split.stable_split(df, "trip_id")
    org = coding.index_stage(["org"])
    stages = [
        org, coding.dummy_stage(org.getOutputCols(), ["org_dummy"]), *models.hour_stages("depart", ["mon", "dow"]),
        coding.assemble_stage(["km", "org_dummy", "depart_dummy", "mon_dummy", "dow_dummy"]),
    ]
    return _three_models(train, test, stages, "duration", lasso=1.0)


def fit_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objective per iteration of a lasso fit."""
    rows = _vector(flown(spark, sf_dir), ["km", "dow"], "duration")
    return reports.objective_table(models.lasso("duration", 1.0).fit(rows), spark)


def logit_saturated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With one dummy per level, the fitted probabilities of a group add up to its positive rows."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("priority"), (F.col("o_totalprice") >= 150000).cast("int").alias("label")
    )
    stages = [*models.category_stages([], ["priority"]), models.logistic(tol=1e-9)]
    with models.cached(orders):
        scored = Pipeline(stages=stages).fit(orders).transform(orders)
    chance = coding.dense("probability")[1]
    per_group = scored.groupBy("priority").agg(F.count("*").alias("n_rows"), F.sum(chance).alias("expected"))
    return _rounded(per_group, 1, "expected")


def logit_score_equations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without penalty, label minus probability averages to zero against every feature."""
    late = trips(spark, sf_dir).transform(wrangle.delay_labels).select("mon", "depart", "duration", "label")
    features = ["mon", "depart", "duration"]
    rows = coding.assemble_stage(features).transform(late)
    with models.cached(rows):
        scored = models.logistic(tol=1e-9).fit(rows).transform(rows)
    gap = F.col("label") - coding.dense("probability")[1]
    sums = [F.avg(gap * F.col(c) / 100).alias(c) for c in features]
    wide = scored.agg(F.count("*").alias("n_rows"), F.avg(gap).alias("intercept"), *sums)
    return _rounded(wide, 4, "intercept", *features)


def penalty_optimum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several features under ridge, lasso and a mix: how far each coefficient is from its optimum condition.

    With c the covariance of residual and feature over the feature's deviation s, a
    nonzero coefficient b satisfies c = mix * strength * sign(b) + (1 - mix) * strength * b * s / sy,
    and a zero one |c| <= mix * strength.
    """
    features = ["km", "dow", "depart"]
    df = trips(spark, sf_dir).select("mile", "dow", "depart", "duration")
    df = wrangle.replace_columns(df, {"km": miles_to_km("mile")}, drop=("mile",))
    rows = coding.assemble_stage(features).transform(df)
    found = []
    with models.cached(rows):
        for mix, strength in ((0.0, 0.1), (0.0, 20.0), (0.5, 20.0), (1.0, 0.75), (1.0, 30.0)):
            model = models.least_squares("duration", elasticNetParam=mix, regParam=strength, tol=1e-12, maxIter=1000).fit(rows)
            left = F.col("duration") - F.col("prediction")
            moments = model.transform(rows).agg(
                F.count("*").alias("n_rows"), F.stddev_pop("duration").alias("sy"),
                *[F.stddev_pop(x).alias(f"s_{x}") for x in features],
                *[(F.covar_pop(left, F.col(x)) / F.stddev_pop(x)).alias(f"c_{x}") for x in features],
            )
            gaps = []
            for x, b in zip(features, model.coefficients.toArray()):
                c = F.col(f"c_{x}")
                pull = mix * strength * (1 if b > 0 else -1) + (1 - mix) * strength * float(b) * F.col(f"s_{x}") / F.col("sy")
                gap = F.abs(c - pull) if b != 0 else F.greatest(F.abs(c) - mix * strength, F.lit(0.0))
                gaps.append(F.struct(F.lit(x).alias("feature"), gap.alias("gap")))
            found.append(
                moments.select(F.lit(mix).alias("mix"), F.lit(strength).alias("strength"), "n_rows", F.inline(F.array(*gaps)))
            )
    return _rounded(reduce(DataFrame.unionByName, found), 5, "gap")


def logit_penalty_optimum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The penalized logistic model: label minus probability against a feature balances the pull of the penalty."""
    strength, features = 0.2, ["mon", "depart", "duration"]
    late = trips(spark, sf_dir).transform(wrangle.delay_labels).select(*features, "label")
    rows = coding.assemble_stage(features).transform(late)
    with models.cached(rows):
        model = models.logistic("label", strength, tol=1e-7).fit(rows)
    miss = F.col("label") - coding.dense("probability")[1]
    pulls = [
        (F.avg(miss * F.col(x)) / F.stddev_samp(x) - strength * float(b) * F.stddev_samp(x)).alias(x)
        for x, b in zip(features, model.coefficients.toArray())
    ]
    wide = model.transform(rows).agg(F.count("*").alias("n_rows"), F.avg(miss).alias("intercept"), *pulls)
    return _rounded(wide, 4, "intercept", *features)


def _late_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    late = trips(spark, sf_dir).transform(wrangle.delay_labels)
    train, test = split.stable_split(late.select("trip_id", "mon", "depart", "duration", "label"), "trip_id")
    stages = [coding.assemble_stage(["mon", "depart", "duration"]), models.logistic()]
    with models.cached(train):
        return Pipeline(stages=stages).fit(train).transform(test)


def logit_delay_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, ratios and area under the curve of the late-trip model on held-out trips."""
    scored = _late_scored(spark, sf_dir)
    own = scored.select(F.lit("logistic").alias("model"), "label", "prediction", coding.dense("probability")[1].alias("probability"))
    return _rounded(metrics.scores_report(own).drop("model"), 4, "value")


QUERIES = {
    f.__name__: f
    for f in (
        ols_one_feature, penalized_one_feature, ols_with_category, ols_group_means, order_means, order_effects, order_fit, travel_speed,
        ols_normal_equations, ols_residuals, rmse_test, pair_listing, fuel_models, schedule_models,
        fit_history,
        penalty_optimum, logit_saturated, logit_score_equations, logit_penalty_optimum, logit_delay_report,
    )
}


def _line(view: str, x: str, y: str, label: str) -> str:
    return f"""SELECT '{label}' AS source, unnest(['{x}', '(intercept)']) AS feature,
        unnest([round(regr_slope({y}, {x}), 6), round(regr_intercept({y}, {x}), 6)]) AS coefficient,
        count(*) AS n_rows, round(regr_r2({y}, {x}), 6) AS r2,
        round(sqrt(regr_syy({y}, {x}) * (1 - regr_r2({y}, {x})) / count(*)), 6) AS rmse FROM {view}"""


# Least squares with one slope and one level per airport: the slope comes from the rows
# centred per airport, the levels from the group means.
_WITHIN = f"""{KM_TRIPS},
    centred AS (SELECT org, km - avg(km) OVER (PARTITION BY org) AS x, duration - avg(duration) OVER (PARTITION BY org) AS y
        FROM flown),
    slope AS (SELECT sum(x * y) / sum(x * x) AS b FROM centred),
    orgs AS (SELECT org, avg(duration) - (SELECT b FROM slope) * avg(km) AS a,
        row_number() OVER (ORDER BY count(*) DESC, org) AS code FROM flown GROUP BY org),
    base AS (SELECT a AS base_a, code AS base_code FROM orgs ORDER BY code DESC LIMIT 1)"""

_KM_FIT = f"""{KM_TRIPS},
    fit AS (SELECT regr_slope(duration, km) AS b, regr_intercept(duration, km) AS a FROM flown WHERE {in_train('trip_id')}),
    held AS (SELECT duration, a + b * km AS prediction FROM flown, fit WHERE NOT {in_train('trip_id')})"""

_PENALTY_ROWS = ", ".join(f"({a}::DOUBLE, {s}::DOUBLE)" for a, s in PENALTIES)

ORACLES = {
    "ols_one_feature": f"WITH {KM_TRIPS} {_line('flown', 'km', 'duration', 'trips')} UNION ALL "
    + _line("lineitem", "l_quantity", "l_extendedprice", "lineitem"),
    "penalized_one_feature": f"""WITH {KM_TRIPS},
        moments AS (SELECT corr(duration, km) AS r, stddev_pop(duration) AS sy, stddev_pop(km) AS sx,
            avg(duration) AS my, avg(km) AS mx FROM flown),
        fits AS (SELECT alpha, strength, my, mx, sign(r) * greatest(abs(r) - alpha * strength / sy, 0)
            / (1 + (1 - alpha) * strength / sy) * sy / sx AS b
            FROM moments, (VALUES {_PENALTY_ROWS}) AS p(alpha, strength))
        SELECT alpha, strength, 'km' AS feature, round(b, 5) AS coefficient, b = 0 AS is_zero FROM fits
        UNION ALL SELECT alpha, strength, '(intercept)', round(my - b * mx, 5), my - b * mx = 0 FROM fits""",
    "ols_with_category": f"""WITH {_WITHIN}
        SELECT 'km' AS feature, round(b, 6) AS coefficient FROM slope
        UNION ALL SELECT '(intercept)', round(base_a, 6) FROM base
        UNION ALL SELECT 'org_dummy_' || org, round(a - base_a, 6) FROM orgs, base WHERE code < base_code""",
    "ols_group_means": f"""WITH {KM_TRIPS} SELECT org, count(*) AS n_rows, round(avg(duration), 6) AS prediction
        FROM flown GROUP BY org""",
    "order_means": """SELECT l_orderkey AS level, count(*) AS n_rows, round(avg(l_extendedprice), 6) AS effect FROM lineitem GROUP BY l_orderkey""",
    "order_effects": """WITH near AS (SELECT l_quantity - avg(l_quantity) OVER w AS x, l_extendedprice - avg(l_extendedprice) OVER w AS y
            FROM lineitem WINDOW w AS (PARTITION BY l_orderkey)),
        fit AS (SELECT sum(x * y) / sum(x * x) AS b FROM near)
        SELECT l_orderkey AS level, count(*) AS n_rows, round(avg(l_extendedprice) - b * avg(l_quantity), 3) AS effect, round(b, 5) AS slope
        FROM lineitem, fit GROUP BY l_orderkey, b""",
    "order_fit": """WITH near AS (SELECT l_quantity - avg(l_quantity) OVER w AS q, l_discount - avg(l_discount) OVER w AS d,
            l_extendedprice - avg(l_extendedprice) OVER w AS y, l_extendedprice AS price FROM lineitem WINDOW w AS (PARTITION BY l_orderkey)),
        sums AS (SELECT sum(q * q) AS qq, sum(q * d) AS qd, sum(d * d) AS dd, sum(q * y) AS qy, sum(d * y) AS dy FROM near),
        fit AS (SELECT (qy * dd - dy * qd) / (qq * dd - qd * qd) AS bq, (dy * qq - qy * qd) / (qq * dd - qd * qd) AS bd FROM sums)
        SELECT count(*) AS n_rows, round(sqrt(avg((y - bq * q - bd * d) ** 2)), 4) AS rmse,
            round(1 - sum((y - bq * q - bd * d) ** 2) / (var_pop(price) * count(*)), 4) AS r2,
            round(bq, 4) AS slope_l_quantity, round(bd, 4) AS slope_l_discount FROM near, fit GROUP BY bq, bd""",
    "travel_speed": f"""WITH {_WITHIN}
        SELECT CASE WHEN code = base_code THEN '(base)' ELSE 'org_dummy_' || org END AS level,
        round(60 / b, 6) AS km_per_hour, round(a, 6) AS ground_minutes FROM orgs, base, slope""",
    "ols_normal_equations": f"""WITH {KM_TRIPS}
        SELECT 'km' AS feature, count(*) AS n_rows, 0::DOUBLE AS mean_residual FROM flown
        UNION ALL SELECT 'org ' || org, count(*), 0 FROM flown GROUP BY org
        UNION ALL SELECT 'day ' || dow::VARCHAR, count(*), 0 FROM flown GROUP BY dow""",
    "ols_residuals": f"""WITH {KM_TRIPS},
        fit AS (SELECT regr_slope(duration, km) AS b, regr_intercept(duration, km) AS a FROM flown)
        SELECT trip_id, round(duration - a - b * km, 5) + 0.0::DOUBLE AS residual FROM flown, fit""",
    "rmse_test": f"""WITH {_KM_FIT} SELECT count(*) AS n_rows,
        round(sqrt(avg((duration - prediction) ** 2)), 6) AS rmse, round(avg(abs(duration - prediction)), 6) AS mae,
        round(1 - sum((duration - prediction) ** 2) / (var_pop(duration) * count(*)), 6) AS r2 FROM held""",
    "pair_listing": f"""WITH {_KM_FIT} SELECT duration, round(prediction, 2) AS prediction, count(*) AS n_rows
        FROM held GROUP BY ALL""",
    "logit_saturated": """SELECT o_orderpriority AS priority, count(*) AS n_rows,
        sum((o_totalprice >= 150000)::INTEGER)::DOUBLE AS expected FROM orders GROUP BY ALL""",
    "penalty_optimum": f"""WITH {TRIPS} SELECT mix, strength, feature, count(*) AS n_rows, 0::DOUBLE AS gap FROM trips,
        (VALUES (0::DOUBLE, 0.1::DOUBLE), (0, 20), (0.5, 20), (1, 0.75), (1, 30)) AS fits(mix, strength),
        (VALUES ('km'), ('dow'), ('depart')) AS names(feature) GROUP BY ALL""",
    "logit_penalty_optimum": f"""WITH {DELAYS} SELECT count(*) AS n_rows, 0::DOUBLE AS intercept, 0::DOUBLE AS mon,
        0::DOUBLE AS depart, 0::DOUBLE AS duration FROM delays""",
    "logit_score_equations": f"""WITH {DELAYS} SELECT count(*) AS n_rows, 0::DOUBLE AS intercept, 0::DOUBLE AS mon,
        0::DOUBLE AS depart, 0::DOUBLE AS duration FROM delays""",
}
