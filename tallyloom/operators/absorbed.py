"""Least squares with a category of any number of levels.

A dummy per level would need all levels, and a coefficient for each, on the driver. But the slopes of the numeric columns are
those of a regression on the rows' distances from their level's means, and a level's coefficient follows from its means.
So the levels stay a distributed table from one grouping (summed up before its shuffle), and the driver
sees one row of sums per pair of numeric columns.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.operators.keyed import fresh, join_by_frequency
from tallyloom.sources.scratch import scratch_path


@dataclass
class AbsorbedFit:
    """``slopes`` by column name and ``levels`` (level as text, n_rows, effect): the prediction at numeric columns of 0."""

    slopes: dict[str, float]
    levels: DataFrame
    category: str

    def predict(self, df: DataFrame, spread_by: Column, name: str = "prediction") -> DataFrame:
        """Add the prediction by one join that spreads frequent levels; null for null and unseen levels and null values.

        All columns of ``df`` keep their values, whatever they are called; a column ``name`` is replaced.
        """
        level, rows, effect = (fresh(c, df) for c in ("_level", "_level_rows", "_level_effect"))
        known = self.levels.select(F.col("level").alias(level), F.col("n_rows").alias(rows), F.col("effect").alias(effect))
        keyed = df.withColumn(level, F.col(f"`{self.category}`").cast("string"))
        joined = join_by_frequency(keyed, known, level, rows, spread_by, how="left")
        value = F.col(effect)
        for column, slope in self.slopes.items():
            value = value + F.lit(slope) * F.col(f"`{column}`")
        return joined.select(*(f"`{c}`" for c in df.columns if c != name), value.alias(name))


def absorbed_least_squares(df: DataFrame, numeric: list[str], category: str, label: str) -> AbsorbedFit:
    """The fit of ``label`` on ``numeric`` columns and one coefficient per level of ``category``.

    Rows with a null among these columns are left out. The level table is written once to the session's working folder.
    Numeric columns that don't vary within levels, or depend on each other there, get the solution of least norm. No
    rows: slopes of 0 and no levels.
    """
    columns = [label, *numeric]
    value = lambda i: F.col(f"`{columns[i]}`").cast("double")
    complete = df
    for c in (category, *columns):
        complete = complete.where(F.col(f"`{c}`").isNotNull())
    pairs = [(i, j) for i in range(1, len(columns)) for j in range(i + 1)]
    sums = [F.count("*").alias("n_rows"), *(F.avg(value(i)).alias(f"m{i}") for i in range(len(columns)))]
    sums += [(F.covar_pop(value(i), value(j)) * F.count("*")).alias(f"c{i}_{j}") for i, j in pairs]
    path = scratch_path(df.sparkSession, "levels")
    complete.groupBy(F.col(f"`{category}`").cast("string").alias("level")).agg(*sums).write.parquet(path)
    levels = df.sparkSession.read.parquet(path)
    slopes = np.zeros(len(numeric))
    if numeric:
        within = levels.agg(*(F.coalesce(F.sum(f"c{i}_{j}"), F.lit(0.0)).alias(f"c{i}_{j}") for i, j in pairs)).first()
        gram, target = np.zeros((len(numeric), len(numeric))), np.zeros(len(numeric))
        for i, j in pairs:
            if j == 0:
                target[i - 1] = within[f"c{i}_0"]
            else:
                gram[i - 1, j - 1] = gram[j - 1, i - 1] = within[f"c{i}_{j}"]
        slopes = np.linalg.lstsq(gram, target, rcond=None)[0]
    effect = F.col("m0")
    for i, slope in enumerate(slopes.tolist(), 1):
        effect = effect - F.lit(slope) * F.col(f"m{i}")
    return AbsorbedFit(dict(zip(numeric, slopes.tolist())), levels.select("level", "n_rows", effect.alias("effect")), category)
