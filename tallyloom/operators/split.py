"""Train/test parts and cross-validation folds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyloom.functions.keys import fold_number, in_train


def stable_split(df: DataFrame, key: str, percent: int = 80, salt: str = "") -> tuple[DataFrame, DataFrame]:
    """Train and test part by key hash. Two filters over the same scan: no sort, no shuffle."""
    part = in_train(key, percent, salt)
    return df.where(part), df.where(~part)


def random_split(df: DataFrame, seed: int, weights: tuple[float, ...] = (0.8, 0.2)) -> list[DataFrame]:
    """Spark's seeded random split.

    It sorts every partition by all columns, and its outcome depends on columns
    and partitioning; prefer :func:`stable_split` where the table has a key.
    """
    return df.randomSplit(list(weights), seed=seed)


def with_split(df: DataFrame, key: str, percent: int = 80, name: str = "part", salt: str = "") -> DataFrame:
    return df.withColumn(name, F.when(in_train(key, percent, salt), "train").otherwise("test"))


def with_fold(df: DataFrame, key: str, folds: int, name: str = "fold") -> DataFrame:
    return df.withColumn(name, fold_number(key, folds))


def split_share(df: DataFrame, name: str = "part") -> DataFrame:
    """Rows per part and their share of all rows.

    The total is taken over the handful of already counted parts.
    """
    counted = df.groupBy(name).agg(F.count("*").alias("n_rows"))
    total = counted.agg(F.sum("n_rows")).scalar()
    return counted.select(name, "n_rows", (F.col("n_rows") / total).alias("share"))
