"""Text cleaning, tokens, stop words and TF-IDF over whole documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.functions.textual import clean_message, clean_title, squeeze_spaces, strip_digits, strip_punctuation
from tallyloom.functions.vectors import filled_values
from tallyloom.operators import text
from tallyloom.plans.checks import STOP_WORDS, tokens_cte
from tallyloom.sources import table


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def clean_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Punctuation, digits and runs of blanks, each rule on its own."""
    return _documents(spark, sf_dir).select(
        "doc_id",
        strip_punctuation("text").alias("no_punctuation"),
        strip_digits("text").alias("no_digits"),
        squeeze_spaces("text").alias("squeezed"),
    )


def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select("doc_id", clean_message("text").alias("clean"))


def clean_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select("doc_id", clean_title("text").alias("clean"))


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = text.with_tokens(_documents(spark, sf_dir), "text")
    return split.select("doc_id", F.array_join("tokens", "|").alias("tokens"), F.size("tokens").alias("n_tokens"))


def terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = text.with_terms(_documents(spark, sf_dir), "text")
    return kept.select("doc_id", F.size("terms").cast("bigint").alias("n_terms"), F.array_join("terms", "|").alias("terms"))


def stop_word_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.stop_word_usage(text.with_tokens(_documents(spark, sf_dir), "text"))


def term_tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    weighed = text.term_tfidf(text.with_terms(_documents(spark, sf_dir), "text"), "doc_id")
    return weighed.select(
        "doc_id", "term", "tf", "df", F.round("idf", 6).alias("idf"), F.round("tfidf", 6).alias("tfidf")
    )


def hashed_term_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms per document by summing the hashed counts: collisions add, so nothing is lost."""
    hashed = text.hashed_counts(_documents(spark, sf_dir), "doc_id", "text", [32, 1024])
    total = lambda n: F.aggregate(filled_values(f"hash_{n}"), F.lit(0.0), lambda sofar, v: sofar + v).cast("bigint")
    both = [F.struct(F.lit(n).alias("buckets"), total(n).alias("n_terms")) for n in (32, 1024)]
    return hashed.select("doc_id", F.inline(F.array(*both)))


def _rounded_weights(weights: DataFrame, *keep: str) -> DataFrame:
    return weights.select("doc_id", *keep, "slot", F.col("tf").cast("bigint").alias("tf"), F.round("weight", 6).alias("weight"))


def hashed_tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, buckets, slot, tf, weight) of the filled slots of each document, for 32 and 1024 slots."""
    return _rounded_weights(text.hashed_weights(_documents(spark, sf_dir), "doc_id", "text", [32, 1024]), "buckets")


def title_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The title chain up to its terms: commas go, hyphens become blanks, stop words go."""
    kept = text.with_terms(_documents(spark, sf_dir), "text", clean=clean_title)
    return kept.select("doc_id", F.size("terms").cast("bigint").alias("n_terms"), F.array_join("terms", "|").alias("terms"))


def title_tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole title chain: cleaned as titles, hashed to 32 slots, weighed."""
    return _rounded_weights(text.hashed_weights(_documents(spark, sf_dir), "doc_id", "text", [32], rule="title"))


QUERIES = {
    f.__name__: f
    for f in (
        clean_steps, clean_text, clean_titles, tokens, terms, stop_word_usage,
        term_tfidf, hashed_term_totals, hashed_tfidf, title_terms, title_tfidf,
    )
}

_TOKENS = tokens_cte("documents", "doc_id")
_TITLE_TOKENS = tokens_cte("documents", "doc_id", rule="title")

# MurmurHash3 (x86, 32 bits, seed 42) of each distinct term, from its UTF-8 bytes in hex.
_TWO32 = "4294967296"
_SLOTS = f"""
spelled AS (SELECT DISTINCT term, hex(encode(term)) AS h, strlen(term) AS n FROM kept),
chunks AS (SELECT term, n, list_transform(range(((n + 3) // 4)::BIGINT), lambda i: ('0x0' ||
    substr(h, (8*i + 7)::BIGINT, 2) || substr(h, (8*i + 5)::BIGINT, 2) || substr(h, (8*i + 3)::BIGINT, 2) ||
    substr(h, (8*i + 1)::BIGINT, 2))::UBIGINT) AS ks FROM spelled),
mixed AS (SELECT term, n, list_transform(list_transform(list_transform(ks,
    lambda k: (k * 3432918353::UBIGINT) % {_TWO32}::UBIGINT),
    lambda k: (k * 32768::UBIGINT) % {_TWO32}::UBIGINT + k // 131072::UBIGINT),
    lambda k: (k * 461845907::UBIGINT) % {_TWO32}::UBIGINT) AS ks FROM chunks),
body AS (SELECT term, n, ks, list_reduce(list_prepend(42::UBIGINT, ks[1 : (n // 4)::BIGINT]), lambda h, k:
    (((xor(h, k) * 8192::UBIGINT) % {_TWO32}::UBIGINT + xor(h, k) // 524288::UBIGINT) * 5::UBIGINT + 3864292196::UBIGINT)
    % {_TWO32}::UBIGINT) AS h FROM mixed),
tail AS (SELECT term, xor(CASE WHEN n % 4 > 0 THEN xor(h, ks[-1]) ELSE h END, n::UBIGINT) AS h FROM body),
f1 AS (SELECT term, (xor(h, h // 65536::UBIGINT) * 2246822507::UBIGINT) % {_TWO32}::UBIGINT AS h FROM tail),
f2 AS (SELECT term, (xor(h, h // 8192::UBIGINT) * 3266489909::UBIGINT) % {_TWO32}::UBIGINT AS h FROM f1),
hashes AS (SELECT term, xor(h, h // 65536::UBIGINT) AS h FROM f2)"""

ORACLES = {
    "clean_steps": r"""SELECT doc_id, regexp_replace(text, '[_():;,.!?\-]', ' ', 'g') AS no_punctuation,
        regexp_replace(text, '[0-9]', ' ', 'g') AS no_digits, regexp_replace(text, ' +', ' ', 'g') AS squeezed
        FROM documents""",
    "clean_text": f"WITH {_TOKENS} SELECT doc_id, clean FROM clean",
    "clean_titles": "SELECT doc_id, replace(replace(text, ',', ''), '-', ' ') AS clean FROM documents",
    "tokens": f"""WITH {_TOKENS} SELECT doc_id, array_to_string(tokens, '|') AS tokens, len(tokens)::INTEGER AS n_tokens
        FROM token_lists""",
    "terms": f"""WITH {_TOKENS}, kept_lists AS (SELECT doc_id,
        list_filter(tokens, lambda t: NOT list_contains([{STOP_WORDS}], t)) AS terms FROM token_lists)
        SELECT doc_id, len(terms) AS n_terms, array_to_string(terms, '|') AS terms FROM kept_lists""",
    "stop_word_usage": f"""WITH {_TOKENS}, stop AS (SELECT token FROM words EXCEPT SELECT term FROM kept)
        SELECT token AS word, count(*) AS n_uses FROM words SEMI JOIN stop USING (token) GROUP BY token""",
    "term_tfidf": f"""WITH {_TOKENS}, m AS (SELECT count(*) AS m FROM documents),
        counts AS (SELECT doc_id, term, count(*) AS tf FROM kept GROUP BY ALL),
        spreads AS (SELECT term, count(*) AS df FROM counts GROUP BY term)
        SELECT doc_id, term, tf, df, round(ln((m + 1) / (df + 1)), 6) AS idf,
        round(tf * ln((m + 1) / (df + 1)), 6) AS tfidf FROM counts JOIN spreads USING (term), m""",
    "hashed_term_totals": f"""WITH {_TOKENS}, totals AS (SELECT doc_id, count(term) AS n_terms
        FROM documents LEFT JOIN kept USING (doc_id) GROUP BY doc_id)
        SELECT doc_id, buckets, n_terms FROM totals, (VALUES (32), (1024)) AS sizes(buckets)""",
    "hashed_tfidf": f"""WITH {_TOKENS}, {_SLOTS}, m AS (SELECT count(*) AS m FROM documents),
        counts AS (SELECT doc_id, buckets, (h % buckets::UBIGINT)::INTEGER AS slot, count(*) AS tf
            FROM kept JOIN hashes USING (term), (VALUES (32), (1024)) AS sizes(buckets) GROUP BY ALL),
        spreads AS (SELECT buckets, slot, count(*) AS df FROM counts GROUP BY ALL)
        SELECT doc_id, buckets, slot, tf, round(tf * ln((m + 1) / (df + 1)), 6) AS weight
        FROM counts JOIN spreads USING (buckets, slot), m""",
    "title_terms": f"""WITH {_TITLE_TOKENS}, kept_lists AS (SELECT doc_id,
        list_filter(tokens, lambda t: NOT list_contains([{STOP_WORDS}], t)) AS terms FROM token_lists)
        SELECT doc_id, len(terms) AS n_terms, array_to_string(terms, '|') AS terms FROM kept_lists""",
    "title_tfidf": f"""WITH {_TITLE_TOKENS}, {_SLOTS}, m AS (SELECT count(*) AS m FROM documents),
        counts AS (SELECT doc_id, (h % 32::UBIGINT)::INTEGER AS slot, count(*) AS tf FROM kept JOIN hashes USING (term) GROUP BY ALL),
        spreads AS (SELECT slot, count(*) AS df FROM counts GROUP BY ALL)
        SELECT doc_id, slot, tf, round(tf * ln((m + 1) / (df + 1)), 6) AS weight FROM counts JOIN spreads USING (slot), m""",
}
