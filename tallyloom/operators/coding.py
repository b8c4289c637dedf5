"""Categories to numbers: codes, dummies, hour buckets and feature vectors.

The builders return Spark ML stages, so that a pipeline fits them on training
rows only. Those stages keep their levels on the driver, which suits categories
of limited size: ``require_few_levels`` checks that first. ``level_codes`` and
``code_column`` give the same codes as a table for categories without a limit.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyloom.operators.keyed import fresh, join_by_frequency
from tallyloom.sources.scratch import ensure_checkpoint_dir

# Three-hour parts of the day.
HOUR_SPLITS = [0.0, 3.0, 6.0, 9.0, 12.0, 15.0, 18.0, 21.0, 24.0]

# monotonically_increasing_id() is (partition << 33) + row number in the partition.
_ROW_BITS = 33


def index_stage(columns: list[str], suffix: str = "_idx", handle_invalid: str = "error") -> StringIndexer:
    """Codes by falling frequency, ties by alphabet; all columns counted in one pass."""
    return StringIndexer(
        inputCols=columns,
        outputCols=[c + suffix for c in columns],
        handleInvalid=handle_invalid,
        stringOrderType="frequencyDesc",
    )


def dummy_stage(columns: list[str], names: list[str], handle_invalid: str = "error") -> OneHotEncoder:
    """Level k of n becomes the k-th unit vector of length n-1, the last level all zeros."""
    return OneHotEncoder(inputCols=columns, outputCols=names, handleInvalid=handle_invalid, dropLast=True)


def bucket_stage(
    column: str, name: str, splits: list[float] | None = None, handle_invalid: str = "error"
) -> Bucketizer:
    return Bucketizer(
        splits=HOUR_SPLITS if splits is None else splits,
        inputCol=column,
        outputCol=name,
        handleInvalid=handle_invalid,
    )


def assemble_stage(columns: list[str], name: str = "features", handle_invalid: str = "error") -> VectorAssembler:
    return VectorAssembler(inputCols=columns, outputCol=name, handleInvalid=handle_invalid)


def require_few_levels(df: DataFrame, columns: list[str], limit: int = 10_000) -> None:
    """Refuse categories whose levels would not fit a model on the driver.

    One pass with a fixed-size sketch per column; it runs before any level is
    moved to the driver.
    """
    sketches = [F.approx_count_distinct(c, 0.02).alias(c) for c in columns]
    found = df.agg(*sketches).first().asDict()
    too_many = {c: n for c, n in found.items() if n > limit}
    if too_many:
        raise ValueError(f"more than {limit} levels: {too_many}; use code_column for these")


def dense(vector: str) -> Column:
    return vector_to_array(F.col(vector))


def level_table(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-null values with their number of rows (counted before the shuffle)."""
    value = F.col(column).cast("string").alias("value")
    return df.where(F.col(column).isNotNull()).groupBy(value).agg(F.count("*").alias("n_rows"))


def level_codes(df: DataFrame, column: str) -> DataFrame:
    """(value, n_rows, code): the codes of ``index_stage`` for any number of levels.

    The levels are range-sorted across the cluster and written out once, which
    fixes their order; a code is then the number of levels in earlier
    partitions (one count per partition, so that table is small by
    construction) plus the row number within the partition.
    """
    ensure_checkpoint_dir(df.sparkSession)
    ordered = level_table(df, column).orderBy(F.desc("n_rows"), "value")
    fixed = ordered.withColumn("_row", F.monotonically_increasing_id()).checkpoint()
    placed = fixed.withColumn("_part", F.shiftright("_row", _ROW_BITS))
    # One row per partition: small enough for a window without a partition key.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("_part").agg(F.count("*").alias("n"))
    starts = sizes.select("_part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_start"))
    within = F.col("_row") - F.shiftleft("_part", _ROW_BITS)
    return placed.join(F.broadcast(starts), "_part").select(
        "value", "n_rows", (F.col("_start") + within).cast("double").alias("code")
    )


def code_column(df: DataFrame, column: str, name: str, spread_by: Column) -> DataFrame:
    """Add the code of ``column`` by one join that spreads frequent values and nulls; null stays null.

    All columns of ``df`` keep their values, whatever they are called; a column ``name`` is replaced.
    """
    key, rows, code = (fresh(c, df) for c in ("_level", "_level_rows", "_level_code"))
    codes = level_codes(df, column).select(F.col("value").alias(key), F.col("n_rows").alias(rows), F.col("code").alias(code))
    keyed = df.withColumn(key, F.col(f"`{column}`").cast("string"))
    coded = join_by_frequency(keyed, codes, key, rows, spread_by, how="left")
    return coded.select(*(f"`{c}`" for c in df.columns if c != name), F.col(code).alias(name))
