"""Row assignment by key hash: the same key always lands in the same part.

Unlike a seeded random split this depends on nothing but the key: not on row
order, on partitioning, on the other columns or on a retried task.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


#: Number of different values of ``key_hash``.
HASH_RANGE = 1 << 60


def key_hash(key: Column | str, salt: str = "") -> Column:
    """The first 60 bits of the MD5 of the key's text, a number from 0 to HASH_RANGE - 1; a null key counts as empty text."""
    text = F.coalesce((F.col(key) if isinstance(key, str) else key).cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(F.concat(F.lit(salt), text)), 1, 15), 16, 10).cast("bigint")


def key_bucket(key: Column | str, buckets: int, salt: str = "") -> Column:
    """Bucket 0..buckets-1 from the first 32 bits of the MD5 of the key's text.

    A null key counts as the empty text, so that every row has a bucket.
    """
    text = F.coalesce((F.col(key) if isinstance(key, str) else key).cast("string"), F.lit(""))
    if salt:
        text = F.concat(F.lit(salt), text)
    head = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return (head % F.lit(buckets)).cast("int")


def in_train(key: Column | str, percent: int = 80, salt: str = "") -> Column:
    return key_bucket(key, 100, salt) < percent


def fold_number(key: Column | str, folds: int, salt: str = "fold") -> Column:
    """Cross-validation fold; salted, so that it is independent of the train/test split."""
    return key_bucket(key, folds, salt)
