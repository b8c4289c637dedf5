"""Categories, dummies, buckets and feature vectors."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.operators import coding, wrangle
from tallyloom.operators.models import category_stages, hour_stages
from tallyloom.plans.checks import METRIC_CARS, TRIPS
from tallyloom.sources import cars, table, trips


def _lookup(df: DataFrame, column: str) -> DataFrame:
    """(value, index, dummy) per level: distinct first, so only the levels are encoded."""
    coding.require_few_levels(df, [column])
    indexer = coding.index_stage([column]).fit(df)
    levels = indexer.transform(df.select(column).distinct())
    dummies = coding.dummy_stage(indexer.getOutputCols(), ["vector"]).fit(levels).transform(levels)
    return dummies.select(column, f"{column}_idx", coding.dense("vector").alias("dummy"))


def dummy_lookup_org(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lookup(trips(spark, sf_dir), "org").orderBy("org_idx")


def dummy_lookup_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lookup(cars(spark, sf_dir), "type").orderBy("type_idx")


def distinct_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct rows that hold a feature vector."""
    df = trips(spark, sf_dir).select("org", "mon", "dow")
    vectors = coding.assemble_stage(["mon", "dow"]).transform(df).select("org", "features").distinct()
    return vectors.select("org", coding.dense("features").alias("features"))


def index_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of two categories joined to every row, whatever their number of levels."""
    coded = trips(spark, sf_dir).select("trip_id", "carrier", "org")
    for column in ("carrier", "org"):
        coded = coding.code_column(coded, column, f"{column}_idx", F.col("trip_id"))
    return coded


def unseen_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes learned without one carrier, applied to all trips: its rows get a code of their own (keep) or go (skip)."""
    df = trips(spark, sf_dir).select("trip_id", "mile", "carrier")
    coding.require_few_levels(df, ["carrier"])
    absent = df.agg(F.max("carrier")).scalar()
    seen = df.where(F.col("carrier") < absent)
    found = []
    for rule in ("keep", "skip"):
        coded = Pipeline(stages=category_stages(["mile"], ["carrier"], handle_invalid=rule)).fit(seen).transform(df)
        sizes = coded.groupBy("carrier", "carrier_idx", F.size(coding.dense("features")).alias("n_features"))
        found.append(sizes.agg(F.count("*").alias("n_rows")).withColumn("rule", F.lit(rule)))
    return found[0].unionByName(found[1])


def level_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of a category without a size limit, as a table."""
    return coding.level_codes(table(spark, sf_dir, "lineitem"), "l_partkey")


def code_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same codes joined to every row, with the rows of frequent levels spread."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return coding.code_column(orders, "o_custkey", "customer_code", F.col("o_orderkey"))


def event_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes joined to rows that have a column ``value`` of their own."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return coding.code_column(events, "event_type", "type_code", F.col("event_id"))


def onehot_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dummies of integer columns as they are, several columns in one stage."""
    df = trips(spark, sf_dir).select("trip_id", "mon", "dow")
    vectors = coding.dummy_stage(["mon", "dow"], ["mon_vec", "dow_vec"]).fit(df).transform(df)
    return vectors.select(
        "trip_id", coding.dense("mon_vec").alias("mon_dummy"), coding.dense("dow_vec").alias("dow_dummy")
    )


def hour_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    bucket = coding.bucket_stage("depart", "bucket")
    return bucket.transform(trips(spark, sf_dir).select("depart")).groupBy("bucket").agg(F.count("*").alias("n_rows"))


def hour_dummies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hour bucket, month and weekday as dummies, in one pipeline fitted and applied to the same frame."""
    df = trips(spark, sf_dir).select("trip_id", "depart", "mon", "dow")
    coded = Pipeline(stages=hour_stages("depart", ["mon", "dow"])).fit(df).transform(df)
    return coded.select(
        "trip_id", "depart_bucket",
        *[coding.dense(f"{c}_dummy").alias(f"{c}_dummy") for c in ("depart", "mon", "dow")],
    )


def assembled_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = cars(spark, sf_dir).transform(wrangle.car_units)
    vector = coding.assemble_stage(["eng_size", "cyl", "avg_mpg", "wheel_base", "weight"]).transform(df)
    return vector.select("car_id", coding.dense("features").alias("features"))


def category_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numeric columns and the dummies of two categories in one vector."""
    df = trips(spark, sf_dir).select("trip_id", "mile", "carrier", "org")
    vector = Pipeline(stages=category_stages(["mile"], ["carrier", "org"])).fit(df).transform(df)
    return vector.select("trip_id", coding.dense("features").alias("features"))


QUERIES = {
    f.__name__: f
    for f in (
        dummy_lookup_org, dummy_lookup_type, distinct_vectors, index_codes, unseen_levels, level_codes, code_column, event_codes, onehot_raw,
        hour_bucket, hour_dummies, assembled_features, category_features,
    )
}


def _codes(view: str, column: str, name: str) -> str:
    """CTE: level, its rows and its code."""
    return f"""{name} AS (SELECT {column}, count(*) AS n_rows,
        (row_number() OVER (ORDER BY count(*) DESC, {column}) - 1)::DOUBLE AS code,
        count(*) OVER () AS n_levels FROM {view} GROUP BY {column})"""


def _dummy(index: str, size: str) -> str:
    return f"list_transform(range(({size})::BIGINT), lambda j: (j = {index})::INTEGER::DOUBLE)"


_LOOKUP = "SELECT {c}, code AS {c}_idx, " + _dummy("code", "n_levels - 1") + " AS dummy FROM levels"

ORACLES = {
    "dummy_lookup_org": f"WITH {TRIPS}, {_codes('trips', 'org', 'levels')} " + _LOOKUP.format(c="org"),
    "dummy_lookup_type": f"WITH {METRIC_CARS}, {_codes('cars', 'type', 'levels')} " + _LOOKUP.format(c="type"),
    "distinct_vectors": f"""WITH {TRIPS} SELECT DISTINCT org, [mon::DOUBLE, dow::DOUBLE] AS features FROM trips""",
    "index_codes": f"""WITH {TRIPS}, {_codes('trips', 'carrier', 'carriers')}, {_codes('trips', 'org', 'orgs')}
        SELECT trip_id, carrier, org, carriers.code AS carrier_idx, orgs.code AS org_idx
        FROM trips JOIN carriers USING (carrier) JOIN orgs USING (org)""",
    # kept: one code more, whose dummies are all zeros as it is the last; skipped: the last known code has none
    "unseen_levels": f"""WITH {TRIPS}, {_codes("(SELECT * FROM trips WHERE carrier < (SELECT max(carrier) FROM trips))", "carrier", "known")},
        sizes AS (SELECT carrier, count(*) AS n_rows FROM trips GROUP BY carrier),
        n AS (SELECT count(*)::DOUBLE AS n FROM known)
        SELECT carrier, coalesce(code, n) AS carrier_idx, (n + 1)::INTEGER AS n_features, sizes.n_rows, 'keep' AS rule
        FROM sizes LEFT JOIN known USING (carrier), n
        UNION ALL SELECT carrier, code, n::INTEGER, sizes.n_rows, 'skip' FROM sizes JOIN known USING (carrier), n""",
    "level_codes": """SELECT l_partkey::VARCHAR AS value, count(*) AS n_rows,
        (row_number() OVER (ORDER BY count(*) DESC, l_partkey::VARCHAR) - 1)::DOUBLE AS code
        FROM lineitem GROUP BY l_partkey""",
    "code_column": """WITH levels AS (SELECT o_custkey,
        (row_number() OVER (ORDER BY count(*) DESC, o_custkey::VARCHAR) - 1)::DOUBLE AS customer_code
        FROM orders GROUP BY o_custkey)
        SELECT o_orderkey, o_custkey, customer_code FROM orders JOIN levels USING (o_custkey)""",
    "event_codes": """WITH levels AS (SELECT event_type,
        (row_number() OVER (ORDER BY count(*) DESC, event_type) - 1)::DOUBLE AS type_code
        FROM events GROUP BY event_type)
        SELECT event_id, event_type, value, type_code FROM events JOIN levels USING (event_type)""",
    "onehot_raw": f"""WITH {TRIPS}, tops AS (SELECT max(mon) AS m, max(dow) AS d FROM trips)
        SELECT trip_id, {_dummy('mon', 'm')} AS mon_dummy, {_dummy('dow', 'd')} AS dow_dummy FROM trips, tops""",
    "hour_bucket": f"""WITH {TRIPS} SELECT least(floor(depart / 3), 7)::DOUBLE AS bucket, count(*) AS n_rows
        FROM trips GROUP BY ALL""",
    "hour_dummies": f"""WITH {TRIPS},
        binned AS (SELECT *, least(floor(depart / 3), 7)::DOUBLE AS depart_bucket FROM trips),
        tops AS (SELECT max(mon) AS m, max(dow) AS d, max(depart_bucket) AS h FROM binned)
        SELECT trip_id, depart_bucket, {_dummy('depart_bucket', '7')} AS depart_dummy,
        {_dummy('mon', 'm')} AS mon_dummy, {_dummy('dow', 'd')} AS dow_dummy FROM binned, tops""",
    "assembled_features": f"""WITH {METRIC_CARS} SELECT car_id,
        [eng_size, cyl::DOUBLE, avg_mpg, wheel_base::DOUBLE, weight::DOUBLE] AS features FROM metric""",
    "category_features": f"""WITH {TRIPS}, {_codes('trips', 'carrier', 'carriers')}, {_codes('trips', 'org', 'orgs')}
        SELECT trip_id, [mile::DOUBLE] || {_dummy('carriers.code', 'carriers.n_levels - 1')}
        || {_dummy('orgs.code', 'orgs.n_levels - 1')} AS features
        FROM trips JOIN carriers USING (carrier) JOIN orgs USING (org)""",
}
