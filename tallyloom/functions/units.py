"""Unit conversions and derived measures as column expressions.

All roundings are half-up on the decimal text of the double (``F.round``).
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Conversion factors.
KM_PER_MILE = 1.60934
METRES_PER_INCH = 0.0254
POUNDS_PER_KG = 2.205
# Litres per 100 gallons and kilometres per mile, for fuel use.
LITRES_PER_100_GALLONS = 378.5411784
KM_PER_MILE_FUEL = 1.609344


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def miles_to_km(miles: Column | str, digits: int = 0) -> Column:
    return F.round(_col(miles) * KM_PER_MILE, digits)


def inches_to_metres(inches: Column | str, digits: int = 3) -> Column:
    return F.round(_col(inches) * METRES_PER_INCH, digits)


def pounds_to_kg(pounds: Column | str, digits: int = 0) -> Column:
    return F.round(_col(pounds) / POUNDS_PER_KG, digits)


def mean_of_two(a: Column | str, b: Column | str, digits: int = 1) -> Column:
    return F.round((_col(a) + _col(b)) / 2, digits)


def litres_per_100km(mpg: Column | str, digits: int = 2) -> Column:
    """Fuel use from miles per gallon; null where the mileage is zero."""
    return F.round(
        F.try_divide(F.lit(LITRES_PER_100_GALLONS), _col(mpg) * KM_PER_MILE_FUEL), digits
    )


def mass_density(mass: Column | str, length: Column | str, power: int = 1, digits: int = 2) -> Column:
    """Mass per length, length² or length³; null where the length is zero."""
    size = _col(length) if power == 1 else F.pow(_col(length), F.lit(power))
    return F.round(F.try_divide(_col(mass), size), digits)


def flag_at_least(value: Column | str, threshold: float) -> Column:
    """1 where the value reaches the threshold, 0 below it, null where it is null."""
    return (_col(value) >= threshold).cast("int")
