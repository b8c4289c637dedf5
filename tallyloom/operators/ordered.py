"""Categories of any number of levels as numbers that a tree can cut.

A tree keeps the levels of a category in its bins, of which there are few. For a label of two values (or a number) the best
cut of a category lies between levels in order of their mean label, so the levels are put in that order here and the order is
dealt into bins of about equal numbers of rows. The levels stay a distributed table; the driver sees one row of sums.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyloom.operators.keyed import fresh, join_by_frequency
from tallyloom.sources.scratch import ensure_checkpoint_dir

# monotonically_increasing_id() is (partition << 33) + row number in the partition.
_ROW_BITS = 33


@dataclass
class LevelOrder:
    """``levels`` (level as text, n_rows, mean_label, bin), and the bin ``other`` of null and unseen levels."""

    levels: DataFrame
    category: str
    other: int

    def apply(self, df: DataFrame, spread_by: Column, name: str) -> DataFrame:
        """Add each row's bin by one join that spreads frequent levels and nulls.

        All columns of ``df`` keep their values, whatever they are called; a column ``name`` is replaced.
        """
        level, rows, found = (fresh(c, df) for c in ("_level", "_level_rows", "_level_bin"))
        known = self.levels.select(F.col("level").alias(level), F.col("n_rows").alias(rows), F.col("bin").alias(found))
        keyed = df.withColumn(level, F.col(f"`{self.category}`").cast("string"))
        joined = join_by_frequency(keyed, known, level, rows, spread_by, how="left")
        return joined.select(*(f"`{c}`" for c in df.columns if c != name), F.coalesce(found, F.lit(self.other)).alias(name))


def order_levels(df: DataFrame, category: str, label: str, bins: int = 32) -> LevelOrder:
    """Levels of ``category`` by rising mean of ``label`` (ties by the level as text), dealt into at most ``bins`` bins.

    A level goes to the bin that its first row falls into, if the rows stood in order of their levels; a level of more rows
    than a bin leaves the bins after it empty. Null and unseen levels go where the first level stands whose mean is not below
    that of all rows. Rows with a null level or label are left out. No rows: no levels, and bin 0 for all.
    """
    if bins < 1:
        raise ValueError("bins must be at least 1")
    ensure_checkpoint_dir(df.sparkSession)
    value = F.col(f"`{label}`").cast("double")
    complete = df.where(F.col(f"`{category}`").isNotNull() & value.isNotNull())
    levels = complete.groupBy(F.col(f"`{category}`").cast("string").alias("level")).agg(F.count("*").alias("n_rows"), F.sum(value).alias("total"))
    levels = levels.withColumn("mean_label", F.col("total") / F.col("n_rows")).orderBy("mean_label", "level")
    # the checkpoint fixes the order: rows before a level are those of earlier partitions and those before it in its own
    fixed = levels.withColumn("_row", F.monotonically_increasing_id()).checkpoint()
    placed = fixed.withColumn("_part", F.shiftright("_row", _ROW_BITS))
    before = lambda w: F.coalesce(F.sum("n_rows").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # one row per partition: small enough for a window without a partition key
    starts = placed.groupBy("_part").agg(F.sum("n_rows").alias("n_rows")).select("_part", before(Window.orderBy("_part")).alias("_start"))
    ranged = placed.withColumn("_within", before(Window.partitionBy("_part").orderBy("_row"))).join(F.broadcast(starts), "_part")
    all_rows, all_labels = fixed.agg(F.sum("n_rows"), F.sum("total")).first()
    cut = F.floor((F.col("_start") + F.col("_within")) * bins / F.lit(all_rows or 1)).cast("int")
    binned = ranged.select("level", "n_rows", "mean_label", cut.alias("bin"))
    other = binned.where(F.col("mean_label") >= F.lit((all_labels or 0.0) / (all_rows or 1))).agg(F.min("bin")).first()[0]
    return LevelOrder(binned, category, other or 0)
