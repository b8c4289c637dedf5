"""Sparse ML vectors as arrays, without a value for each empty slot."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _part(vector: str, field: str) -> Column:
    return F.unwrap_udt(F.col(vector))[field]


def filled(**vectors: str) -> Column:
    """Array of (slot, <name> of each vector) over the filled slots of sparse vector columns.

    The vectors of a row must be sparse with the same filled slots, as counts of ``HashingTF`` and their weights by ``IDF`` are.
    """
    slots = _part(next(iter(vectors.values())), "indices").alias("slot")
    return F.arrays_zip(slots, *(_part(v, "values").alias(name) for name, v in vectors.items()))


def filled_values(vector: str) -> Column:
    """The values of a sparse vector column's filled slots."""
    return _part(vector, "values")
