"""Building blocks of the checking SQL (DuckDB dialect)."""

from __future__ import annotations

from tallyloom.functions.stopwords import ENGLISH_STOP_WORDS
from tallyloom.sources.tables import CARS_SQL, TRIPS_SQL

TRIPS = f"trips AS ({TRIPS_SQL})"
CARS = f"cars AS ({CARS_SQL})"

# The working tables after cleaning, written independently of the Spark jobs.
KM_TRIPS = f"""{TRIPS}, flown AS (
  SELECT *, round(mile * 1.60934::DOUBLE, 0) AS km FROM trips)"""
DELAYS = f"""{TRIPS}, delays AS (
  SELECT trip_id, mon, dom, dow, carrier, org, depart, duration, delay,
         round(mile * 1.60934::DOUBLE, 0) AS km, CASE WHEN delay >= 15 THEN 1 ELSE 0 END AS label
  FROM trips WHERE delay IS NOT NULL)"""
METRIC_CARS = f"""{CARS}, metric AS (
  SELECT car_id, name, type, origin, ncyl AS cyl, weight, length, eng_size, wheel_base,
         round(length * 0.0254::DOUBLE, 3) AS length_meters, round(weight / 2.205::DOUBLE, 0) AS weight_kg,
         round((city_mpg + hwy_mpg) / 2::DOUBLE, 1) AS avg_mpg
  FROM cars WHERE ncyl IS NOT NULL)"""

STOP_WORDS = ", ".join("'" + w.replace("'", "''") + "'" for w in ENGLISH_STOP_WORDS)


def bucket(key: str, buckets: int, salt: str = "") -> str:
    return f"(('0x' || substr(md5('{salt}' || {key}::VARCHAR), 1, 8))::BIGINT % {buckets})"


def in_train(key: str) -> str:
    return f"({bucket(key, 100)} < 80)"


_CLEAN = {
    "message": r"""regexp_replace(regexp_replace(regexp_replace({0},
    '[_():;,.!?\-]', ' ', 'g'), '[0-9]', ' ', 'g'), ' +', ' ', 'g')""",
    "title": "replace(replace({0}, ',', ''), '-', ' ')",
}


def tokens_cte(table: str, key: str, text: str = "text", rule: str = "message") -> str:
    """CTEs clean(key, clean), token_lists(key, tokens), words(key, token) and kept(key, term)."""
    return rf"""
clean AS (SELECT {key}, {_CLEAN[rule].format(text)} AS clean FROM {table}),
token_lists AS (SELECT {key}, CASE WHEN regexp_full_match(clean, '\s+') THEN []::VARCHAR[]
    ELSE string_split_regex(regexp_replace(lower(clean), '\s+$', ''), '\s') END AS tokens FROM clean),
words AS (SELECT {key}, unnest(tokens) AS token FROM token_lists),
kept AS (SELECT {key}, token AS term FROM words WHERE token NOT IN ({STOP_WORDS}))"""
