"""Train/test parts and folds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.operators import split
from tallyloom.plans.checks import TRIPS, bucket, in_train
from tallyloom.sources import table, trips


def stable_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = split.stable_split(trips(spark, sf_dir).select("trip_id", "duration"), "trip_id")
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


def split_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey")
    share = split.split_share(split.with_split(lines, "l_orderkey"))
    return share.select("part", "n_rows", F.round("share", 6).alias("share"))


def fold_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    folded = split.with_fold(trips(spark, sf_dir).select("trip_id"), "trip_id", 10)
    return folded.groupBy("fold").agg(F.count("*").alias("n_rows"))


def random_split_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The seeded random split has no row in both parts and none in neither; its share is near 80%."""
    train, test = split.random_split(trips(spark, sf_dir), seed=23)
    both = train.select("trip_id", F.lit(1).alias("in_train")).unionByName(
        test.select("trip_id", F.lit(0).alias("in_train"))
    )
    per_trip = both.groupBy("trip_id").agg(F.count("*").alias("n"), F.sum("in_train").alias("n_train"))
    return per_trip.agg(
        F.sum("n").alias("n_rows"),
        F.count_if(F.col("n") > 1).alias("n_in_both"),
        F.round(F.sum("n_train") / F.sum("n"), 1).alias("share"),
    )


QUERIES = {f.__name__: f for f in (stable_split, split_share, fold_sizes, random_split_parts)}

ORACLES = {
    "stable_split": f"""WITH {TRIPS} SELECT trip_id, duration,
        CASE WHEN {in_train('trip_id')} THEN 'train' ELSE 'test' END AS part FROM trips""",
    "split_share": f"""SELECT CASE WHEN {in_train('l_orderkey')} THEN 'train' ELSE 'test' END AS part,
        count(*) AS n_rows, round(count(*) / (SELECT count(*) FROM lineitem), 6) AS share FROM lineitem GROUP BY part""",
    "fold_sizes": f"""WITH {TRIPS} SELECT {bucket('trip_id', 10, 'fold')}::INTEGER AS fold, count(*) AS n_rows
        FROM trips GROUP BY ALL""",
    "random_split_parts": f"""WITH {TRIPS} SELECT count(*) AS n_rows, 0::BIGINT AS n_in_both,
        0.8::DOUBLE AS share FROM trips""",
}
