"""Text cleaning and tokens as column expressions (no UDF)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tallyloom.functions.stopwords import ENGLISH_STOP_WORDS

# Character classes and their replacement.
MESSAGE_PUNCTUATION = r"[_():;,.!?\-]"
DIGITS = "[0-9]"
SPACES = " +"
MESSAGE_NOISE = r"[_():;,.!?\-0-9 ]+"
TITLE_COMMA = "[,]"
TITLE_HYPHEN = r"[\-]"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_punctuation(text: Column | str, pattern: str = MESSAGE_PUNCTUATION, by: str = " ") -> Column:
    return F.regexp_replace(_col(text), pattern, by)


def strip_digits(text: Column | str) -> Column:
    return F.regexp_replace(_col(text), DIGITS, " ")


def squeeze_spaces(text: Column | str) -> Column:
    """Runs of blanks become one blank; a leading blank is kept."""
    return F.regexp_replace(_col(text), SPACES, " ")


def clean_message(text: Column | str) -> Column:
    """``squeeze_spaces(strip_digits(strip_punctuation(text)))`` in one pass over the text:
    each run of punctuation, digits and blanks becomes one blank."""
    return F.regexp_replace(_col(text), MESSAGE_NOISE, " ")


def clean_title(text: Column | str) -> Column:
    return strip_punctuation(strip_punctuation(text, TITLE_COMMA, ""), TITLE_HYPHEN, " ")


def tokens(text: Column | str) -> Column:
    """Lower-case and cut at each whitespace character, as ``ml.feature.Tokenizer`` does.

    Inner and leading empty tokens stay, trailing ones go; a text of blanks only
    has no token and an empty text has one empty token. ``text`` is read twice:
    project an expensive expression to a column first.
    """
    c = _col(text)
    cut = F.split(F.regexp_replace(F.lower(c), r"\s+$", ""), r"\s")
    return F.when(c.rlike(r"^\s+$"), F.array().cast("array<string>")).otherwise(cut)


def terms(words: Column | str, stop_words: list[str] | None = None) -> Column:
    """Tokens that are not stop words; empty tokens and repeats stay."""
    stop = [w.lower() for w in (ENGLISH_STOP_WORDS if stop_words is None else stop_words)]
    return F.filter(_col(words), lambda w: ~F.lower(w).isin(stop))
