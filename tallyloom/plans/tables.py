"""Scans, inspection, samples and wrangling."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.functions.textual import clean_message
from tallyloom.operators import profile, wrangle
from tallyloom.plans.checks import CARS, DELAYS, METRIC_CARS, TRIPS, bucket
from tallyloom.sources import cars, read_delimited, scratch_path, table, trips, write_delimited


def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.row_count(trips(spark, sf_dir))


def condition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.count_where(
        trips(spark, sf_dir),
        {
            "no_delay_known": F.col("delay").isNull(),
            "delay_known": F.col("delay").isNotNull(),
            "late": F.col("delay") >= 15,
            "late_and_far": (F.col("delay") >= 15) & (F.col("mile") > 1000),
        },
    )


def column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = {"trips": trips(spark, sf_dir), "cars": cars(spark, sf_dir)}
    profiles = [profile.column_profile(df).withColumn("table", F.lit(name)) for name, df in both.items()]
    return reduce(DataFrame.unionByName, profiles)


def preview_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.preview(trips(spark, sf_dir), 20, ["depart", "trip_id"])


def bounded_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.bounded_sample(trips(spark, sf_dir), 12, "trip_id")


def bernoulli_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.bernoulli_sample(trips(spark, sf_dir), 0.25, seed=7, key="trip_id")


def small_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line item in 4,000, by the hash of its key."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    keyed = lines.withColumn("line", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    return profile.bernoulli_sample(keyed, 0.00025, seed=5, key="line").drop("line")


def csv_comma_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_delimited(trips(spark, sf_dir), scratch_path(spark, "trips-csv"), sep=",")
    return read_delimited(spark, path, sep=",")


def csv_pipe_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_delimited(cars(spark, sf_dir), scratch_path(spark, "cars-csv"), sep="|")
    return read_delimited(spark, path, sep="|")


def csv_semicolon_declared(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    one_line = F.regexp_replace(clean_message("text"), r"[\r\n]", " ")
    messages = documents.select("doc_id", one_line.alias("text"), (F.col("lang") == "en").cast("int").alias("label"))
    path = write_delimited(messages, scratch_path(spark, "messages-csv"), sep=";", header=False)
    return read_delimited(spark, path, sep=";", schema="id BIGINT, text STRING, label INT", header=False, null_value=None)


def csv_bad_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells that do not fit the declared type: null, and the raw line is kept."""
    documents = table(spark, sf_dir, "documents")
    label = F.when(F.col("lang") == "en", F.lit("1")).otherwise(F.col("lang"))
    path = write_delimited(
        documents.select("doc_id", "source", label), scratch_path(spark, "bad-csv"), sep=";", header=False
    )
    return read_delimited(
        spark, path, sep=";", schema="id BIGINT, source STRING, label INT, raw STRING",
        header=False, corrupt_column="raw",
    )


def delay_wrangle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrangle.delay_labels(trips(spark, sf_dir))


def delay_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        trips(spark, sf_dir).transform(wrangle.delay_labels).groupBy("carrier", "label")
        .agg(F.count("*").alias("n_rows"), F.sum("km").cast("bigint").alias("total_km"))
    )


def car_wrangle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrangle.car_units(cars(spark, sf_dir))


def car_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = cars(spark, sf_dir).transform(wrangle.car_units).transform(wrangle.fuel_use).transform(wrangle.densities)
    return measured.select("car_id", "consumption", "density", "density_area", "density_volume")


def complete_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows left after dropping nulls in any column and in chosen columns."""
    both = {"cars": (cars(spark, sf_dir), ["ncyl"]), "trips": (trips(spark, sf_dir), ["depart", "duration"])}
    counts = [
        part.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table"), F.lit(rule).alias("rule"), "n_rows")
        for name, (df, subset) in both.items()
        for rule, part in (("any", wrangle.keep_complete(df)), ("subset", wrangle.keep_complete(df, subset)))
    ]
    return reduce(DataFrame.unionByName, counts)


QUERIES = {
    f.__name__: f
    for f in (
        row_count, condition_counts, column_profile, preview_ordered, bounded_sample, bernoulli_sample, small_sample,
        csv_comma_inferred, csv_pipe_inferred, csv_semicolon_declared, csv_bad_cells,
        delay_wrangle, delay_rate, car_wrangle, car_measures, complete_rows,
    )
}

_TRIP_COLUMNS = ["trip_id", "mon", "dom", "dow", "carrier", "flight", "org", "mile", "depart", "duration", "delay"]
_CAR_COLUMNS = [
    "car_id", "name", "type", "origin", "ncyl", "weight", "length", "eng_size", "wheel_base", "city_mpg", "hwy_mpg",
]


def _profile_sql(view: str, columns: list[str]) -> str:
    # Parquet columns may hold nulls; the origin is a choice of two words and can't
    rows = [
        f"""SELECT '{view}' AS "table", {i}::INTEGER AS position, '{c}' AS "column",
        (SELECT CASE typeof({c}) WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string'
                WHEN 'DOUBLE' THEN 'double' END FROM {view} LIMIT 1) AS type,
        '{c}' <> 'origin' AS nullable, count(*)::BIGINT AS n_rows, (count(*) - count({c}))::BIGINT AS n_null FROM {view}"""
        for i, c in enumerate(columns)
    ]
    return " UNION ALL ".join(rows)


ORACLES = {
    "row_count": f"WITH {TRIPS} SELECT count(*) AS n_rows FROM trips",
    "condition_counts": f"""WITH {TRIPS} SELECT count(*) AS n_rows,
        count(*) FILTER (WHERE delay IS NULL) AS no_delay_known, count(delay) AS delay_known,
        count(*) FILTER (WHERE delay >= 15) AS late,
        count(*) FILTER (WHERE delay >= 15 AND mile > 1000) AS late_and_far FROM trips""",
    "column_profile": f"WITH {TRIPS}, {CARS} "
    + _profile_sql("trips", _TRIP_COLUMNS) + " UNION ALL " + _profile_sql("cars", _CAR_COLUMNS),
    "preview_ordered": f"WITH {TRIPS} SELECT * FROM trips ORDER BY depart, trip_id LIMIT 20",
    "bounded_sample": f"WITH {TRIPS} SELECT * FROM trips ORDER BY md5('0:' || trip_id::VARCHAR), trip_id LIMIT 12",
    "bernoulli_sample": f"""WITH {TRIPS} SELECT * FROM trips
        WHERE ('0x' || substr(md5('7:' || trip_id::VARCHAR), 1, 15))::BIGINT < 288230376151711744""",
    "small_sample": """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
        WHERE ('0x' || substr(md5('5:' || l_orderkey::VARCHAR || '-' || l_linenumber::VARCHAR), 1, 15))::BIGINT < 288230376151712""",
    "csv_comma_inferred": f"WITH {TRIPS} SELECT * REPLACE (trip_id::INTEGER AS trip_id) FROM trips",
    "csv_pipe_inferred": f"WITH {CARS} SELECT * REPLACE (car_id::INTEGER AS car_id) FROM cars",
    "csv_semicolon_declared": r"""SELECT doc_id AS id, CASE WHEN lang = 'en' THEN 1 ELSE 0 END AS label,
        regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '[_():;,.!?\-]', ' ', 'g'),
        '[0-9]', ' ', 'g'), ' +', ' ', 'g'), '[\r\n]', ' ', 'g') AS text FROM documents""",
    "csv_bad_cells": """SELECT doc_id AS id, source, CASE WHEN lang = 'en' THEN 1 END AS label,
        CASE WHEN lang <> 'en' THEN doc_id::VARCHAR || ';' || source || ';' || lang END AS raw FROM documents""",
    "delay_wrangle": f"WITH {DELAYS} SELECT * FROM delays",
    "delay_rate": f"""WITH {DELAYS} SELECT carrier, label, count(*) AS n_rows, sum(km)::BIGINT AS total_km
        FROM delays GROUP BY ALL""",
    "car_wrangle": f"WITH {METRIC_CARS} SELECT * FROM metric",
    "car_measures": f"""WITH {METRIC_CARS} SELECT car_id,
        round(378.5411784::DOUBLE / (avg_mpg * 1.609344::DOUBLE), 2) AS consumption,
        round(weight_kg / length_meters, 2) AS density,
        round(weight_kg / pow(length_meters, 2), 2) AS density_area,
        round(weight_kg / pow(length_meters, 3), 2) AS density_volume FROM metric""",
    "complete_rows": f"""WITH {TRIPS}, {CARS}
        SELECT 'cars' AS "table", 'any' AS rule, count(*) AS n_rows FROM cars WHERE ncyl IS NOT NULL
        UNION ALL SELECT 'cars', 'subset', count(ncyl) FROM cars
        UNION ALL SELECT 'trips', 'any', count(delay) FROM trips
        UNION ALL SELECT 'trips', 'subset', count(*) FROM trips WHERE depart IS NOT NULL AND duration IS NOT NULL""",
}
