from tallyloom.functions.keys import fold_number, in_train, key_bucket
from tallyloom.functions.textual import squeeze_spaces, strip_digits, strip_punctuation, terms, tokens
from tallyloom.functions.units import (
    flag_at_least,
    inches_to_metres,
    litres_per_100km,
    mass_density,
    mean_of_two,
    miles_to_km,
    pounds_to_kg,
)

__all__ = [
    "flag_at_least",
    "fold_number",
    "in_train",
    "inches_to_metres",
    "key_bucket",
    "litres_per_100km",
    "mass_density",
    "mean_of_two",
    "miles_to_km",
    "pounds_to_kg",
    "squeeze_spaces",
    "strip_digits",
    "strip_punctuation",
    "terms",
    "tokens",
]
