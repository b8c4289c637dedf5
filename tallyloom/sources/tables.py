"""Parquet tables and the two working views built on them.

``trips`` has the shape of a flight log and ``cars`` that of a car catalogue.
Their column texts are valid in Spark SQL and in DuckDB, so that the SQL checks
start from exactly the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TRIPS_COLUMNS = [
    "event_id AS trip_id",
    "CAST(event_id % 12 AS INT) AS mon",
    "CAST(1 + event_id % 28 AS INT) AS dom",
    "CAST(event_id % 7 AS INT) AS dow",
    "event_type AS carrier",
    "CAST(event_id % 9000 AS INT) AS flight",
    "concat('A', CAST(user_id % 8 AS STRING)) AS org",
    "CAST(100 + (event_id * 37) % 2000 AS INT) AS mile",
    "round((hour(ts) * 60 + minute(ts)) / CAST(60 AS DOUBLE), 2) AS depart",
    "CAST(15 + floor(((100 + (event_id * 37) % 2000) * 12) / CAST(100 AS DOUBLE))"
    " + 5 * (user_id % 8) + (event_id * 7919) % 21 AS INT) AS duration",
    "CASE WHEN event_id % 17 = 0 THEN NULL"
    " ELSE CAST(hour(ts) * 2 + (event_id * 31) % 20 - 20 AS INT) END AS delay",
]

CARS_COLUMNS = [
    "p_name AS name",
    "p_type AS type",
    "CASE WHEN p_size + (p_partkey * 13) % 11 > 30 THEN 'USA' ELSE 'non-USA' END AS origin",
    "CASE WHEN p_partkey % 23 = 0 THEN NULL"
    " ELSE CAST(3 + floor(p_size / CAST(10 AS DOUBLE)) AS INT) END AS ncyl",
    "CAST(2000 + 40 * p_size + (p_partkey * 31) % 300 AS INT) AS weight",
    "CAST(140 + p_size + p_partkey % 9 AS INT) AS length",
    "(10 + p_size) / CAST(10 AS DOUBLE) AS eng_size",
    "CAST(90 + p_partkey % 25 AS INT) AS wheel_base",
    "CAST(40 - floor(p_size / CAST(2 AS DOUBLE)) + p_partkey % 5 AS INT) AS city_mpg",
    "CAST(46 - floor(p_size / CAST(2 AS DOUBLE)) + p_partkey % 7 AS INT) AS hwy_mpg",
]

# p_name repeats, so row-level checks carry the key of the source row as well.
CAR_KEY = "p_partkey AS car_id"

TRIPS_SQL = f"SELECT {', '.join(TRIPS_COLUMNS)} FROM events"
CARS_SQL = f"SELECT {', '.join([CAR_KEY, *CARS_COLUMNS])} FROM part"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*TRIPS_COLUMNS)


def cars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(CAR_KEY, *CARS_COLUMNS)


def dealt(df: DataFrame, key: str, parts: int = 16) -> DataFrame:
    """Rows in ``parts`` partitions by their key and in its order within them.

    For fits with a random step, whose result would otherwise follow the number of input splits or cores.
    """
    return df.repartition(parts, key).sortWithinPartitions(key)
