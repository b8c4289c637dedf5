"""Joining rows to a per-key table when a few keys hold most of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: A key is frequent if it has more than ``rows_per_task`` rows and more than one of this many parts of all rows.
_MOST_HOT_KEYS = 10_000


def fresh(name: str, *frames: DataFrame) -> str:
    """``name``, with underscores added until no column of the frames is called so (in any case)."""
    taken = {c.lower() for frame in frames for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def join_by_frequency(
    rows: DataFrame,
    per_key: DataFrame,
    key: str,
    weight: str,
    spread_by: Column,
    rows_per_task: int = 1_000_000,
    how: str = "inner",
) -> DataFrame:
    """Join of ``rows`` to ``per_key`` (one row per key, ``weight`` = its number of rows).

    A key of more than ``rows_per_task`` rows gets a salt for each ``rows_per_task`` of them (for each 1/10,000 of all rows,
    where that is more). Its rows are dealt to the salts and its entry is repeated once per salt, so that no
    salt has more rows than that but for chance. The list of such keys has fewer than 10,000 entries of fixed
    size, digests of the keys, and is broadcast. With ``how='left'`` rows of a null key stay, dealt as well.

    ``spread_by`` is any column expression that varies between the rows of a key.
    """
    marked, repeated, salt = salted(rows, per_key, key, weight, spread_by, rows_per_task)
    return marked.join(repeated, [key, salt], how).drop(salt)


def salted(
    rows: DataFrame, per_key: DataFrame, key: str, weight: str, spread_by: Column, rows_per_task: int
) -> tuple[DataFrame, DataFrame, str]:
    """``rows`` with a salt, ``per_key`` with an entry per salt, and the name of that column."""
    digest, salts, salt = (fresh(name, rows, per_key) for name in ("_key_digest", "_key_salts", "_key_salt"))
    most = F.greatest(
        F.lit(float(rows_per_task)), per_key.agg(F.sum(F.col(f"`{weight}`").cast("double")) / _MOST_HOT_KEYS).scalar()
    )
    of = lambda: F.sha2(F.col(f"`{key}`").cast("string"), 256)
    hot = per_key.select(of().alias(digest), F.ceil(F.col(f"`{weight}`") / most).cast("int").alias(salts)).where(
        F.col(salts) > 1
    )
    null_salts = F.when(F.col(f"`{key}`").isNull(), F.lit(64)).otherwise(F.lit(1))
    marked = rows.withColumn(digest, of()).join(F.broadcast(hot), digest, "left").withColumn(
        salt, F.pmod(F.xxhash64(spread_by), F.coalesce(F.col(salts), null_salts)).cast("int")
    )
    repeated = per_key.withColumn(digest, of()).join(F.broadcast(hot), digest, "left").withColumn(
        salt, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(salts), F.lit(1)) - 1))
    )
    return marked.drop(digest, salts), repeated.drop(digest, salts), salt
