"""Tree models: exact cases with a SQL answer, and held-out reports on the late-trip and origin labels."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Model, Pipeline
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.operators import coding, metrics, models, ordered, reports, split, tuning, wrangle
from tallyloom.plans.checks import DELAYS, TRIPS, bucket, in_train
from tallyloom.plans.growth import tree_sql
from tallyloom.plans.scores import auc_sql
from tallyloom.sources import cars, dealt, trips

SEED = 17


def _second_half(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips labelled by the half of the year: a label that one cut on the month explains."""
    df = trips(spark, sf_dir).select("trip_id", "mon", "dow", (F.col("mon") >= 6).cast("int").alias("label"))
    return coding.assemble_stage(["mon", "dow"]).transform(df)


def _exact(spark: SparkSession, sf_dir: str, estimator) -> DataFrame:
    rows = _second_half(spark, sf_dir)
    with models.cached(rows):
        return metrics.confusion(estimator.fit(rows).transform(rows))


def tree_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _exact(spark, sf_dir, models.tree(seed=SEED))


def forest_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _exact(spark, sf_dir, models.forest(seed=SEED, trees=5, featureSubsetStrategy="all"))


def boosted_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _exact(spark, sf_dir, models.boosted(seed=SEED, rounds=5))


def tree_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules of the exact tree, with feature names."""
    rows = _second_half(spark, sf_dir)
    rules = reports.rule_table(models.tree(seed=SEED).fit(rows), rows)
    return rules.select("line", F.trim("rule").alias("rule"))


def exact_importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _second_half(spark, sf_dir)
    model = models.tree(seed=SEED).fit(rows)
    both = reports.importance_table(model, rows).withColumn("depth", F.lit(model.depth))
    return both.withColumn("nodes", F.lit(model.numNodes))


def _late_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late label against two small integer features, so that every cut between values is tried."""
    late = trips(spark, sf_dir).transform(wrangle.delay_labels)
    df = late.select(F.floor("depart").cast("int").alias("hour"), "mon", "label")
    return coding.assemble_stage(["hour", "mon"]).transform(df)


def _stumps() -> dict[str, object]:
    return {
        "tree": models.tree(seed=SEED, maxDepth=1),
        "forest": models.forest(
            seed=SEED, trees=1, maxDepth=1, bootstrap=False, subsamplingRate=1.0, featureSubsetStrategy="all"
        ),
        "boosted": models.boosted(seed=SEED, rounds=1, maxDepth=1),
    }


def _stump_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _late_by_hour(spark, sf_dir)
    with models.cached(rows):
        fitted = {name: model.fit(rows) for name, model in _stumps().items()}
    return models.stack_scores(fitted, rows)


def tree_stump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-cut tree, forest of one such tree and one boosting round on a noisy label.

    All three choose the cut with the largest Gini gain; shown are the rows per
    label and prediction.
    """
    scored = _stump_scores(spark, sf_dir)
    return scored.groupBy("model", "label", "prediction").agg(F.count("*").alias("n_rows"))


def stump_leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and late share of the two leaves of the one-cut tree."""
    rows = _late_by_hour(spark, sf_dir)
    with models.cached(rows):
        scored = _stumps()["tree"].fit(rows).transform(rows)
    leaves = scored.select("label", F.round(coding.dense("probability")[1], 6).alias("late_share"))
    return leaves.groupBy("late_share").agg(F.count("*").alias("n_rows"))


def stump_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Area under the curve of the three one-cut models, in one job over their stacked scores."""
    areas = metrics.auc_table(_stump_scores(spark, sf_dir), F.col("probability"), by=["model"])
    return areas.select("model", F.round("auc", 6).alias("auc"))


def _fitted(spark: SparkSession, sf_dir: str, *names: str) -> tuple[dict[str, Model], DataFrame]:
    """Tree, forest and boosted trees for late trips (or those named), and the held-out rows."""
    late = trips(spark, sf_dir).transform(wrangle.delay_labels)
    rows = coding.assemble_stage(["mon", "depart", "duration"]).transform(
        dealt(late.select("trip_id", "mon", "depart", "duration", "label"), "trip_id")
    )
    train, test = split.stable_split(rows, "trip_id")
    with models.cached(train):
        estimators = {
            "tree": models.tree(seed=SEED),
            "forest": models.forest(seed=SEED),
            "boosted": models.boosted(seed=SEED, rounds=10),
        }
        fitted = {name: model.fit(train) for name, model in estimators.items() if not names or name in names}
    return fitted, test


def model_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy and area under the curve of three tree models on the same held-out trips."""
    fitted, test = _fitted(spark, sf_dir)
    report = metrics.scores_report(models.stack_scores(fitted, test)).where(F.col("metric").isin("accuracy", "auc"))
    return report.select("model", "metric", F.round("value", 4).alias("value"))


def importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    fitted, test = _fitted(spark, sf_dir)
    tables = [reports.importance_table(m, test).withColumn("model", F.lit(n)) for n, m in fitted.items()]
    return reduce(DataFrame.unionByName, tables)


def tree_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    fitted, _ = _fitted(spark, sf_dir)
    tables = [reports.tree_table(m, spark).withColumn("model", F.lit(n)) for n, m in fitted.items()]
    return reduce(DataFrame.unionByName, tables)


def tree_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    fitted, test = _fitted(spark, sf_dir, "tree")
    return reports.rule_table(fitted["tree"], test)


def delay_tree_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late trips from all columns, with coded carrier and airport kept as categories by the tree."""
    late = trips(spark, sf_dir).transform(wrangle.delay_labels)
    coding.require_few_levels(late, ["carrier", "org"], limit=32)
    train, test = split.stable_split(late, "trip_id")
    indexer = coding.index_stage(["carrier", "org"])
    columns = ["mon", "dom", "dow", *indexer.getOutputCols(), "km", "depart", "duration"]
    with models.cached(train):
        fitted = Pipeline(stages=[indexer, coding.assemble_stage(columns), models.tree(seed=SEED)]).fit(train)
    return metrics.as_rows(metrics.binary_report(fitted.transform(test)))


def origin_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Car origin by tree, forest, boosted trees and logistic regression: class-weighted metrics."""
    df = cars(spark, sf_dir).transform(wrangle.car_units)
    train, test = split.stable_split(df, "car_id")
    stages = [
        coding.index_stage(["origin"]),
        coding.assemble_stage(["eng_size", "cyl", "avg_mpg", "wheel_base", "weight"]),
    ]
    found = []
    with models.cached(train):
        prepared = Pipeline(stages=stages).fit(train)
        rows, held = prepared.transform(train), prepared.transform(test)
        for name, estimator in {
            "tree": models.tree("origin_idx", seed=SEED),
            "forest": models.forest("origin_idx", seed=SEED, trees=5),
            "boosted": models.boosted("origin_idx", seed=SEED, rounds=10),
            "logistic": models.logistic("origin_idx"),
        }.items():
            report = metrics.weighted_report(estimator.fit(rows).transform(held), "origin_idx")
            found.append(metrics.as_rows(report).withColumn("model", F.lit(name)))
    return reduce(DataFrame.unionByName, found)


#: Features of few values, so that every cut is tried: hour, month and length in half hours.
BINNED = ["hour", "mon", "halves"]
DEPTH = 3


def _binned(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Trips that are late and either long or late in the year, by binned features, in training and held-out part."""
    late = trips(spark, sf_dir).transform(wrangle.delay_labels)
    hour, halves = F.floor("depart").cast("int"), F.floor(F.col("duration") / 30).cast("int")
    costly = ((F.col("label") == 1) & ((F.col("duration") >= 150) | (F.col("mon") >= 9))).cast("int")
    return split.stable_split(late.select("trip_id", hour.alias("hour"), "mon", halves.alias("halves"), costly.alias("label")), "trip_id")


def _whole_forest(trees: int, depth: int) -> object:
    """Trees that all see every row and feature."""
    return models.forest(seed=SEED, trees=trees, maxDepth=depth, bootstrap=False, subsamplingRate=1.0, featureSubsetStrategy="all")


def _deep(spark: SparkSession, sf_dir: str) -> tuple[dict[str, Model], DataFrame, DataFrame]:
    train, test = (coding.assemble_stage(BINNED).transform(part) for part in _binned(spark, sf_dir))
    with models.cached(train):
        fitted = {name: e.fit(train) for name, e in (("tree", models.tree(seed=SEED, maxDepth=DEPTH)), ("forest", _whole_forest(3, DEPTH)))}
    return fitted, train, test


def deep_tree_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, ratios and area of a tree of three levels on held-out trips, from one pass over its scores."""
    fitted, _, test = _deep(spark, sf_dir)
    return metrics.scores_report(models.stack_scores(fitted, test)).select("model", "metric", F.round("value", 6).alias("value"))


def deep_tree_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the tree: its rows, cut, gain and prediction."""
    fitted, train, _ = _deep(spark, sf_dir)
    nodes = reports.node_table(fitted["tree"], train)
    return nodes.select("n_rows", "feature", F.floor("threshold").cast("int").alias("last_left"), F.round("gain", 8).alias("gain"), "prediction", "is_leaf")


def deep_tree_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Depth and nodes of each member of the ensembles."""
    fitted, _, _ = _deep(spark, sf_dir)
    tables = [reports.tree_table(m, spark).withColumn("model", F.lit(n)) for n, m in fitted.items()]
    return reduce(DataFrame.unionByName, tables)


def deep_tree_importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importances, as the model says and from its nodes."""
    fitted, train, _ = _deep(spark, sf_dir)
    found = []
    for name, model in fitted.items():
        told = reports.importance_table(model, train)
        summed = reports.importances_of_nodes(reports.node_table(model, train)).withColumnRenamed("importance", "of_nodes")
        found.append(told.join(summed, "feature", "left").withColumn("model", F.lit(name)))
    share = lambda c: F.round(F.coalesce(F.col(c), F.lit(0.0)), 6).alias(c)
    return reduce(DataFrame.unionByName, found).select("model", "feature", share("importance"), share("of_nodes"))


def _depth_search(spark: SparkSession, sf_dir: str) -> tuple[tuning.GridResult, DataFrame]:
    train, test = _binned(spark, sf_dir)
    model = _whole_forest(1, 1)
    points = tuning.grid({model.maxDepth: [1, 2, DEPTH]})
    found = tuning.grid_search(
        [coding.assemble_stage(BINNED)], model, points, BinaryClassificationEvaluator(numBins=0), split.with_fold(train, "trip_id", 3), "fold", 3
    )
    return found, test


def depth_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One tree that sees all rows and features, by its depth: mean area over three folds, and rank."""
    found, _ = _depth_search(spark, sf_dir)
    return found.table(spark).select("point", F.col("maxDepth").cast("int").alias("depth"), "metric", F.round("mean_metric", 6).alias("mean_metric"), "rank")


def depth_winner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The winner of ``depth_grid`` on held-out trips, and its parameters with what they mean."""
    found, test = _depth_search(spark, sf_dir)
    return tuning.winner_report(found, test, RandomForestClassificationModel, ["maxDepth", "bootstrap"])


#: The bin of the flight number, of which there are thousands, that of the airport, and the month.
ORDERED = ["flight_bin", "org_bin", "mon"]
ORDER_BINS = 32


def _long_trips(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = trips(spark, sf_dir).select("trip_id", "flight", "org", "mon", (F.col("duration") >= 150).cast("int").alias("label"))
    return split.stable_split(rows, "trip_id")


def flight_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flight numbers by their share of long trips, in bins of about equal numbers of trips."""
    train, _ = _long_trips(spark, sf_dir)
    return ordered.order_levels(train, "flight", "label", ORDER_BINS).levels.select("level", "n_rows", F.round("mean_label", 9).alias("mean_label"), "bin")


def _ordered_tree(spark: SparkSession, sf_dir: str) -> tuple[Model, DataFrame, DataFrame]:
    """The tree and both parts with their bins; the order of the levels is learned from training trips only."""
    parts = _long_trips(spark, sf_dir)
    for order in [ordered.order_levels(parts[0], c, "label", ORDER_BINS) for c in ("flight", "org")]:
        parts = [order.apply(part, F.col("trip_id"), f"{order.category}_bin") for part in parts]
    train, test = (coding.assemble_stage(ORDERED).transform(part) for part in parts)
    with models.cached(train):
        return models.tree(seed=SEED, maxDepth=DEPTH, maxBins=2 * ORDER_BINS).fit(train), train, test


def flight_tree_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of a tree over a category of thousands of levels."""
    fitted, train, _ = _ordered_tree(spark, sf_dir)
    nodes = reports.node_table(fitted, train)
    return nodes.select("n_rows", "feature", "threshold", F.round("gain", 8).alias("gain"), "prediction", "is_leaf")


def flight_tree_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, ratios and area of that tree on held-out trips, unseen flight numbers included."""
    fitted, _, test = _ordered_tree(spark, sf_dir)
    return metrics.scores_report(models.stack_scores({"tree": fitted}, test)).select("model", "metric", F.round("value", 6).alias("value"))


QUERIES = {
    f.__name__: f
    for f in (
        flight_levels, flight_tree_nodes, flight_tree_report,
        deep_tree_report, deep_tree_nodes, deep_tree_sizes, deep_tree_importances, depth_grid, depth_winner,
        tree_exact, forest_exact, boosted_exact, tree_shape, exact_importances, tree_stump, stump_leaves,
        stump_compare, model_compare, importances, tree_sizes, tree_rules, delay_tree_report, origin_report,
    )
}

_DIAGONAL = f"""WITH {TRIPS} SELECT (mon >= 6)::INTEGER AS label, (mon >= 6)::INTEGER::DOUBLE AS prediction,
    count(*) AS n_rows FROM trips GROUP BY ALL"""

_MID = f"""WITH {TRIPS}, cut AS (SELECT (max(mon) FILTER (WHERE mon < 6) + min(mon) FILTER (WHERE mon >= 6)) / 2.0::DOUBLE AS c
    FROM trips)"""

# Every cut between neighbouring values of both features, its Gini gain, and the best one.
_STUMP = f"""{DELAYS}, base AS (SELECT floor(depart)::INTEGER AS hour, mon, label FROM delays),
    stacked AS (SELECT 'hour' AS feature, hour AS v, label FROM base UNION ALL SELECT 'mon', mon, label FROM base),
    per_value AS (SELECT feature, v, count(*)::DOUBLE AS n, sum(label)::DOUBLE AS p FROM stacked GROUP BY ALL),
    cuts AS (SELECT feature, v, sum(n) OVER w AS nl, sum(p) OVER w AS pl, sum(n) OVER (PARTITION BY feature) AS nt,
        sum(p) OVER (PARTITION BY feature) AS pt FROM per_value WINDOW w AS (PARTITION BY feature ORDER BY v)),
    gains AS (SELECT *, 2 * (pt / nt) * (1 - pt / nt) - nl / nt * 2 * (pl / nl) * (1 - pl / nl)
        - (nt - nl) / nt * 2 * ((pt - pl) / (nt - nl)) * (1 - (pt - pl) / (nt - nl)) AS gain FROM cuts WHERE nl < nt),
    best AS (SELECT * FROM gains ORDER BY gain DESC LIMIT 1),
    leaves AS (SELECT label, CASE WHEN CASE feature WHEN 'hour' THEN hour ELSE mon END <= v
        THEN pl / nl ELSE (pt - pl) / (nt - nl) END AS share FROM base, best)"""

_BINNED = f"""{DELAYS}, binned AS (SELECT trip_id AS id, CASE WHEN {in_train('trip_id')} THEN {bucket('trip_id', 3, 'fold')} ELSE -1 END AS fold,
        (label = 1 AND (duration >= 150 OR mon >= 9))::INTEGER AS label, floor(depart)::INTEGER AS hour, mon, floor(duration / 30)::INTEGER AS halves FROM delays)"""
_DEEP = f"{_BINNED}, {tree_sql('binned', BINNED, DEPTH)}"


def _order_sql(column: str) -> str:
    """CTEs <column>_levels(level, n_rows, mean_label, bin) and <column>_other(bin), from the training rows of ``long_trips``."""
    return f"""{column}_means AS (SELECT {column}::VARCHAR AS level, count(*) AS n_rows, sum(label)::DOUBLE / count(*) AS mean_label FROM long_trips WHERE fold >= 0 GROUP BY 1),
    {column}_levels AS (SELECT level, n_rows, mean_label, (coalesce(sum(n_rows) OVER (ORDER BY mean_label, level ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
        * {ORDER_BINS} // (SELECT sum(n_rows) FROM {column}_means))::INTEGER AS bin FROM {column}_means),
    {column}_other AS (SELECT min(bin) AS bin FROM {column}_levels WHERE mean_label >= (SELECT sum(label)::DOUBLE / count(*) FROM long_trips WHERE fold >= 0))"""


_LONG = f"""{TRIPS}, long_trips AS (SELECT trip_id AS id, flight, org, mon, (duration >= 150)::INTEGER AS label, CASE WHEN {in_train('trip_id')} THEN 0 ELSE -1 END AS fold FROM trips),
    {_order_sql('flight')}, {_order_sql('org')}"""
_ORDERED = f"""{_LONG}, ordered AS (SELECT id, fold, label, coalesce(f.bin, (SELECT bin FROM flight_other)) AS flight_bin, coalesce(o.bin, (SELECT bin FROM org_other)) AS org_bin, mon
        FROM long_trips LEFT JOIN flight_levels f ON f.level = flight::VARCHAR LEFT JOIN org_levels o ON o.level = org), {tree_sql('ordered', ORDERED, DEPTH)}"""
_ORDERED_VALUES = " UNION ".join(f"SELECT '{c}' AS feature, {c}::DOUBLE AS v FROM ordered WHERE fold >= 0" for c in ORDERED)
_DEPTHS = ", ".join([_BINNED, *(tree_sql("binned", BINNED, d, 3, f"d{d}") for d in (1, 2, DEPTH))])
_STACKED = " UNION ALL ".join(f"SELECT {i} AS point, {d} AS depth, held, label, share AS score, held * 10 + {i} AS run FROM d{d}_reached" for i, d in enumerate((1, 2, DEPTH)))
_DEPTH_GRID = f"""{_DEPTHS}, stacked AS ({_STACKED}), {auc_sql('stacked', 'run')},
    runs AS (SELECT DISTINCT run, point, depth, held FROM stacked), means AS (SELECT point, depth, avg(auc) AS mean_metric FROM areas JOIN runs USING (run) WHERE held >= 0 GROUP BY ALL),
    best AS (SELECT * FROM means ORDER BY round(mean_metric, 9) DESC, point LIMIT 1)"""
# What Spark says of these parameters.
_DOCS = {
    "maxDepth": "Maximum depth of the tree. (>= 0) E.g., depth 0 means 1 leaf node; depth 1 means 1 internal node + 2 leaf nodes. Must be in range [0, 30].",
    "bootstrap": "Whether bootstrap samples are used when building trees.",
}

ORACLES = {
    "flight_levels": f"WITH {_LONG} SELECT level, n_rows, round(mean_label, 9) AS mean_label, bin FROM flight_levels",
    "flight_tree_report": f"""WITH {_ORDERED}, counts AS (SELECT count(*) FILTER (prediction = 0 AND label = 0)::DOUBLE AS tn, count(*) FILTER (prediction = 1 AND label = 1)::DOUBLE AS tp,
            count(*) FILTER (prediction = 0 AND label = 1)::DOUBLE AS fn, count(*) FILTER (prediction = 1 AND label = 0)::DOUBLE AS fp FROM t_reached),
        {auc_sql('t_reached', score='share')}, wide AS (SELECT counts.*, (tn + tp) / (tn + tp + fn + fp) AS accuracy, tp / (tp + fp) AS precision, tp / (tp + fn) AS recall, auc FROM counts, areas),
        tall AS (UNPIVOT wide ON COLUMNS(*) INTO NAME metric VALUE value)
        SELECT model, metric, round(value, 6) AS value FROM tall, (VALUES ('tree')) AS models(model)""",
    # a threshold is halfway to the next value that any training row has
    "flight_tree_nodes": f"""WITH {_ORDERED}, seen AS ({_ORDERED_VALUES})
        SELECT n::BIGINT AS n_rows, CASE WHEN NOT is_leaf THEN t.feature END AS feature,
            CASE WHEN NOT is_leaf THEN (cut + (SELECT min(v) FROM seen WHERE seen.feature = t.feature AND v > cut)) / 2 END AS threshold,
            CASE WHEN NOT is_leaf THEN round(gain, 8) END AS gain, prediction::DOUBLE AS prediction, is_leaf FROM t_nodes t""",
    "deep_tree_report": f"""WITH {_DEEP}, counts AS (SELECT count(*) FILTER (prediction = 0 AND label = 0)::DOUBLE AS tn, count(*) FILTER (prediction = 1 AND label = 1)::DOUBLE AS tp,
            count(*) FILTER (prediction = 0 AND label = 1)::DOUBLE AS fn, count(*) FILTER (prediction = 1 AND label = 0)::DOUBLE AS fp FROM t_reached),
        {auc_sql('t_reached', score='share')}, wide AS (SELECT counts.*, (tn + tp) / (tn + tp + fn + fp) AS accuracy, tp / (tp + fp) AS precision, tp / (tp + fn) AS recall, auc FROM counts, areas),
        tall AS (UNPIVOT wide ON COLUMNS(*) INTO NAME metric VALUE value)
        SELECT model, metric, round(value, 6) AS value FROM tall, (VALUES ('tree'), ('forest')) AS models(model)""",
    "deep_tree_nodes": f"""WITH {_DEEP} SELECT n::BIGINT AS n_rows, CASE WHEN NOT is_leaf THEN feature END AS feature, CASE WHEN NOT is_leaf THEN cut::INTEGER END AS last_left,
        CASE WHEN NOT is_leaf THEN round(gain, 8) END AS gain, prediction::DOUBLE AS prediction, is_leaf FROM t_nodes""",
    "deep_tree_sizes": f"""WITH {_DEEP}, size AS (SELECT max(level)::INTEGER AS depth, count(*)::INTEGER AS nodes FROM t_nodes)
        SELECT tree, depth, nodes, model FROM size, (VALUES ('tree', 0), ('forest', 0), ('forest', 1), ('forest', 2)) AS members(model, tree)""",
    "deep_tree_importances": f"""WITH {_DEEP}, gained AS (SELECT feature, sum(gain * n) AS gained FROM t_nodes WHERE NOT is_leaf GROUP BY feature),
        shares AS (SELECT name AS feature, round(coalesce(gained, 0) / (SELECT sum(gained) FROM gained), 6) AS share FROM (SELECT unnest({BINNED}) AS name) LEFT JOIN gained ON feature = name)
        SELECT model, feature, share AS importance, share AS of_nodes FROM shares, (VALUES ('tree'), ('forest')) AS models(model)""",
    "depth_grid": f"""WITH {_DEPTH_GRID} SELECT point::INTEGER AS point, depth::INTEGER AS depth, 'areaUnderROC' AS metric, round(mean_metric, 6) AS mean_metric,
        row_number() OVER (ORDER BY round(mean_metric, 9) DESC, point)::INTEGER AS rank FROM means""",
    "depth_winner": f"""WITH {_DEPTH_GRID} SELECT 'areaUnderROC' AS name, round(auc, 6)::VARCHAR AS value, NULL::BOOLEAN AS is_default, 'held-out rows' AS doc
            FROM best JOIN runs USING (point) JOIN areas USING (run) WHERE held = -1
        UNION ALL SELECT 'mean areaUnderROC', round(mean_metric, 6)::VARCHAR, NULL, 'best of the grid, larger is better' FROM best
        UNION ALL SELECT 'n_models', count(*)::VARCHAR, NULL, 'points of the grid' FROM means
        UNION ALL SELECT 'maxDepth', depth::VARCHAR, false, '{_DOCS["maxDepth"]}' FROM best
        UNION ALL SELECT 'bootstrap', 'False', false, '{_DOCS["bootstrap"]}' FROM best""",
    "tree_exact": _DIAGONAL,
    "forest_exact": _DIAGONAL,
    "boosted_exact": _DIAGONAL,
    "tree_shape": f"""{_MID} SELECT unnest([1, 2, 3, 4]) AS line, unnest(['If (mon <= ' || c || ')', 'Predict: 0.0',
        'Else (mon > ' || c || ')', 'Predict: 1.0']) AS rule FROM cut""",
    "exact_importances": f"""WITH {TRIPS}, halves AS (SELECT count(DISTINCT mon >= 6)::INTEGER AS n FROM trips)
        SELECT unnest(['mon', 'dow']) AS feature, unnest([1.0::DOUBLE, 0.0::DOUBLE]) AS importance,
        (n - 1)::INTEGER AS depth, (2 * n - 1)::INTEGER AS nodes FROM halves""",
    "tree_stump": f"""WITH {_STUMP}, shown AS (SELECT label, (share > 0.5)::INTEGER::DOUBLE AS prediction FROM leaves)
        SELECT model, label, prediction, count(*) AS n_rows FROM shown,
        (VALUES ('tree'), ('forest'), ('boosted')) AS models(model) GROUP BY ALL""",
    "stump_leaves": f"WITH {_STUMP} SELECT round(share, 6) AS late_share, count(*) AS n_rows FROM leaves GROUP BY ALL",
    "stump_compare": f"""WITH {_STUMP}, {auc_sql('leaves', score='share')}
        SELECT model, round(auc, 6) AS auc FROM areas, (VALUES ('tree'), ('forest'), ('boosted')) AS models(model)""",
}
