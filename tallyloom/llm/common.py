"""Small helpers of the corpus operators."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.sources import scratch_path


def per_worker(name: str, make: Callable[[], Any]) -> Any:
    """A value that a Python worker makes once and keeps over its tasks."""
    kept = sys.modules.setdefault("tallyloom_worker_values", types.ModuleType("tallyloom_worker_values"))
    if not hasattr(kept, name):
        setattr(kept, name, make())
    return getattr(kept, name)


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read again: lineage ends here, and Spark knows the size of what it reads."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stepwise(df: DataFrame, name: str) -> tuple[DataFrame, Callable[[], None]]:
    """As ``saved``, for chains of large steps: the shuffle files of this step go when it is written, and the second
    value deletes what was written, for when no later step reads it."""
    spark = df.sparkSession
    path, before = scratch_path(spark, name), spark.conf.get(_SHUFFLE_CLEANUP, None)
    spark.conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(_SHUFFLE_CLEANUP) if before is None else spark.conf.set(_SHUFFLE_CLEANUP, before)

    def discard() -> None:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)

    return spark.read.schema(df.schema).parquet(path), discard


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that the texts of each hold ``limit`` bytes at most, or one row."""
    for batch in batches:
        lengths = [n or 0 for n in pa.compute.binary_length(batch[column]).to_pylist()]
        start = held = 0
        for i, n in enumerate(lengths):
            if held and held + n > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < len(lengths):
            yield batch.slice(start)


#: Rows of a few numbers that make a task worthwhile.
ROWS_A_TASK = 10_000


def tasks_for(spark: SparkSession, rows: int, size: int = 0, bytes_a_task: int = 2 << 20) -> int:
    """Tasks for so many small rows that hold so many bytes: one for each core at least, and never more than an exchange has."""
    return max(1, min(partitions(spark), max(spark.sparkContext.defaultParallelism, rows // ROWS_A_TASK, size // bytes_a_task)))


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(node, root): connected components of an undirected edge list; the root is the smallest node.

    Alternates large-star and small-star steps. Each step sends a node's neighbours to the least of them, so
    the number of steps grows with the logarithm of the longest path, and each is one grouping and one join.
    A node with very many neighbours needs no list of them: its least neighbour is an aggregate, and the join
    that gives it to the others may be split by Spark. The parts of an exchange are read by as many tasks as the
    edges are worth: with a task for each of hundreds of parts, small graphs cost executors more than large ones.
    """
    spark = edges.sparkSession
    links, links_read = stepwise(edges.select(F.col(left).alias("u"), F.col(right).alias("v")).where("u <> v").distinct(), "links")
    state_of = lambda links: links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    before = state_of(links)
    while before[0]:
        tasks = tasks_for(spark, before[0])
        both = links.select("u", "v").union(links.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # large star: larger neighbours go to the least of the neighbourhood
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").coalesce(tasks).distinct().coalesce(tasks)
        # small star: smaller neighbours and the node itself go to the least
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").select(F.col("v").alias("a"), "m").where("a <> m").coalesce(tasks)
        after, after_read = stepwise(small.select(F.col("a").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")).coalesce(tasks)).distinct().coalesce(tasks), "links")
        links_read()
        links, links_read, state = after, after_read, state_of(after)
        if state == before:
            break
        before = state
    nodes = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.union(links.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
