"""Counts, null profile, previews and samples, each as one lazy DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.functions.keys import HASH_RANGE, key_hash


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"))


def count_where(df: DataFrame, predicates: dict[str, Column]) -> DataFrame:
    """Rows that satisfy each named predicate, all counted in the same scan."""
    counts = [F.count_if(p).alias(name) for name, p in predicates.items()]
    return df.agg(F.count("*").alias("n_rows"), *counts)


def column_profile(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, nullability, rows and nulls.

    A single aggregate whose one result row is unfolded, so the width of the
    table costs no extra scan.
    """
    counted = df.agg(
        F.count("*").alias("n_rows"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"null_{i}") for i, c in enumerate(df.columns)],
    )
    per_column = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.lit(f.nullable).alias("nullable"),
            F.col("n_rows").alias("n_rows"),
            F.col(f"null_{i}").alias("n_null"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return counted.select(F.inline(F.array(*per_column)))


def preview(df: DataFrame, n: int = 20, order_by: list[str] | None = None) -> DataFrame:
    """First n rows; with ``order_by`` the choice is repeatable (a per-task top-n, no full sort)."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def bounded_sample(df: DataFrame, n: int, key: str, seed: int = 0) -> DataFrame:
    """n rows in the order of a hash of the key: a repeatable random sample of fixed size."""
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return df.orderBy(order, F.col(key)).limit(n)


def bernoulli_sample(df: DataFrame, fraction: float, seed: int, key: str | None = None) -> DataFrame:
    """Each row with probability ``fraction``, without replacement.

    With a key the membership follows 60 bits of the key's hash and survives any
    re-partitioning; without one it is Spark's seeded sample. A null key counts as empty text.
    """
    if key is None:
        return df.sample(False, fraction, seed)
    return df.where(key_hash(key, salt=f"{seed}:") < F.lit(round(fraction * HASH_RANGE)))
