"""Cleaning and derived columns, for use with ``df.transform``.

Every job is one projection over the columns it needs, so that null filters and
column pruning reach the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.functions.units import (
    flag_at_least,
    inches_to_metres,
    litres_per_100km,
    mass_density,
    mean_of_two,
    miles_to_km,
    pounds_to_kg,
)


def replace_columns(df: DataFrame, new: dict[str, Column], drop: tuple[str, ...] = ()) -> DataFrame:
    """Add or overwrite columns, then drop the ones they were made from, in one projection."""
    return df.withColumns(new).drop(*drop)


def keep_complete(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Rows without a null in any column (of ``subset``).

    Without a subset every column must be read; name the needed ones on wide tables.
    """
    return df.na.drop("any", subset=subset)


def delay_labels(
    df: DataFrame, value: str = "delay", threshold: float = 15, label: str = "label", drop: tuple[str, ...] = ("flight",)
) -> DataFrame:
    """Trips with a known delay: kilometres for miles and a 0/1 label for 'late'."""
    known = keep_complete(df.drop(*drop).where(F.col(value).isNotNull()))
    return replace_columns(
        known, {"km": miles_to_km("mile"), label: flag_at_least(value, threshold)}, drop=("mile",)
    )


def car_units(df: DataFrame) -> DataFrame:
    """Complete car rows in metric units, with the mean mileage of city and highway."""
    return replace_columns(
        keep_complete(df).withColumnsRenamed({"ncyl": "cyl"}),
        {
            "length_meters": inches_to_metres("length"),
            "weight_kg": pounds_to_kg("weight"),
            "avg_mpg": mean_of_two("city_mpg", "hwy_mpg"),
        },
        drop=("city_mpg", "hwy_mpg"),
    )


def fuel_use(df: DataFrame, mpg: str = "avg_mpg", name: str = "consumption") -> DataFrame:
    return df.withColumn(name, litres_per_100km(mpg))


def densities(df: DataFrame, mass: str = "weight_kg", length: str = "length_meters") -> DataFrame:
    """Mass per metre, square metre and cubic metre."""
    return df.withColumns(
        {
            "density": mass_density(mass, length, 1),
            "density_area": mass_density(mass, length, 2),
            "density_volume": mass_density(mass, length, 3),
        }
    )
