"""Text features: exact-term and hashed TF-IDF, and stop-word usage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, HashingTF, SQLTransformer, StopWordsRemover, Tokenizer
from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.functions.stopwords import ENGLISH_STOP_WORDS
from tallyloom.functions.textual import MESSAGE_NOISE, TITLE_COMMA, TITLE_HYPHEN, clean_message, terms, tokens
from tallyloom.functions.vectors import filled
from tallyloom.operators.keyed import fresh, join_by_frequency
from tallyloom.sources.scratch import scratch_path

#: The cleaning rules as SQL, for pipeline stages: of messages (``clean_message``) and of titles (``clean_title``).
CLEANING = {
    "message": "regexp_replace({0}, r'" + MESSAGE_NOISE + "', ' ')",
    "title": "regexp_replace(regexp_replace({0}, r'" + TITLE_COMMA + "', ''), r'" + TITLE_HYPHEN + "', ' ')",
}


def with_tokens(df: DataFrame, text: str, name: str = "tokens", clean: Callable[[str], Column] = clean_message) -> DataFrame:
    """Cleaned text as tokens. The cleaned text is a column of its own while both of its uses need it.

    All other columns stay, whatever they are called; a column ``name`` is replaced.
    """
    cleaned = fresh("_clean", df)
    return df.withColumn(cleaned, clean(f"`{text}`")).withColumn(name, tokens(cleaned)).drop(cleaned)


def with_terms(df: DataFrame, text: str, name: str = "terms", clean: Callable[[str], Column] = clean_message) -> DataFrame:
    """Cleaned, tokenized text without stop words."""
    words = fresh("_tokens", df)
    return with_tokens(df, text, words, clean).withColumn(name, terms(words)).drop(words)


def _unfold(df: DataFrame, words: str, name: str, *keep: str) -> DataFrame:
    # The outer form: explode() would add a size filter that evaluates the word list twice more.
    return df.select(*keep, F.explode_outer(words).alias(name)).where(F.col(name).isNotNull())


def stop_word_usage(df: DataFrame, words: str = "tokens", stop_words: list[str] | None = None) -> DataFrame:
    """How often each stop word occurs: at most one result row per list word, so counts
    are almost entirely made before the shuffle."""
    stop = ENGLISH_STOP_WORDS if stop_words is None else stop_words
    used = df.select(F.filter(words, lambda w: w.isin(stop)).alias("_used"))
    used = _unfold(used, "_used", "word")
    return used.groupBy("word").agg(F.count("*").alias("n_uses"))


def term_counts(df: DataFrame, key: str, words: str = "terms") -> DataFrame:
    """(key, term, tf): the tokens of a row are in one task, so they are summed up before the shuffle."""
    return _unfold(df, words, "term", key).groupBy(key, "term").agg(F.count("*").alias("tf"))


def row_term_counts(df: DataFrame, key: str, words: str = "terms") -> DataFrame:
    """``term_counts`` where no two rows have one key: the tokens of a row are sorted and counted in place, without a shuffle."""
    ordered, ends, found = (fresh(name, df) for name in ("_ordered", "_ends", "_found"))
    n = F.size(ordered)
    at = lambda i: F.get(ordered, i)
    runs = df.select(key, F.sort_array(F.array_compact(words)).alias(ordered))
    last = F.filter(F.sequence(F.lit(1), n), lambda i: ~at(i - 1).eqNullSafe(at(i)))
    runs = runs.withColumn(ends, F.when(n > 0, last))
    count = lambda end, k: F.struct(at(end - 1).alias("term"), (end - F.coalesce(F.get(ends, k - 1), F.lit(0))).cast("bigint").alias("tf"))
    counted = runs.select(key, F.transform(ends, count).alias(found))
    # The outer form: inline() would add a size filter that counts once more.
    return counted.select(key, F.inline_outer(found)).where(F.col("term").isNotNull())


def document_counts(counts: DataFrame) -> DataFrame:
    """(term, df): in how many rows each term occurs.

    Reading ``tf`` keeps the inner plan equal to ``term_counts``, so that a job
    which needs both shuffles those counts once and re-reads them.
    """
    return counts.groupBy("term").agg(F.count_if(F.col("tf") > 0).alias("df"))


def term_tfidf(df: DataFrame, key: str, words: str = "terms", rows_per_task: int = 1_000_000) -> DataFrame:
    """Exact-term TF-IDF, idf = ln((m + 1) / (df + 1)) over m rows; ``key`` is unique per row.

    Where a key does repeat, which is looked up at once, the terms of its rows are counted together; else they are counted
    within each row and not shuffled for it. Terms of more than ``rows_per_task`` rows are spread (see ``join_by_frequency``).
    """
    m = df.agg(F.count("*").alias("m"))
    repeats = not df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").isEmpty()
    counts = term_counts(df, key, words) if repeats else row_term_counts(df, key, words)
    joined = join_by_frequency(counts, document_counts(counts), "term", "df", F.col(key), rows_per_task)
    idf = F.log((m.scalar() + 1) / (F.col("df") + 1))
    return joined.select(key, "term", "tf", "df", idf.alias("idf"), (F.col("tf") * idf).alias("tfidf"))


def clean_stage(text: str, name: str, rule: str = "message") -> SQLTransformer:
    """A cleaning rule (see ``CLEANING``) as a pipeline stage."""
    return SQLTransformer(statement=f"SELECT *, {CLEANING[rule].format(f'`{text}`')} AS `{name}` FROM __THIS__")


def text_stages(text: str, name: str = "features", buckets: int = 1024, rule: str = "message") -> list:
    """Clean, tokenize, drop stop words, hash, weigh; each stage reads the previous one's output.

    Titles are cleaned by ``rule='title'`` and usually hashed to 32 slots.
    """
    clean = clean_stage(text, f"{text}_clean", rule)
    token = Tokenizer(inputCol=f"{text}_clean", outputCol=f"{text}_tokens")
    stop = StopWordsRemover(inputCol=token.getOutputCol(), outputCol=f"{text}_terms")
    tf = HashingTF(inputCol=stop.getOutputCol(), outputCol=f"{text}_hash", numFeatures=buckets)
    idf = IDF(inputCol=tf.getOutputCol(), outputCol=name, minDocFreq=0)
    return [clean, token, stop, tf, idf]


def hashed_tfidf(df: DataFrame, text: str, buckets: int = 1024, name: str = "features", rule: str = "message") -> DataFrame:
    """Fit the text stages on ``df`` and apply them. For model building put
    ``text_stages`` in a pipeline, so that the weights come from training rows only."""
    return Pipeline(stages=text_stages(text, name, buckets, rule)).fit(df).transform(df)


def hashed_counts(df: DataFrame, key: str, text: str, sizes: list[int], rule: str = "message") -> DataFrame:
    """(key, hash_<size> for each of the sizes): sparse hashed counts; the terms of a text are made once for all sizes."""
    clean, token, stop, *_ = text_stages(text, rule=rule)
    hashers = [HashingTF(inputCol=stop.getOutputCol(), outputCol=f"hash_{n}", numFeatures=n) for n in sizes]
    return PipelineModel([clean, token, stop, *hashers]).transform(df.select(key, text)).select(key, *(f"hash_{n}" for n in sizes))


def hashed_weights(df: DataFrame, key: str, text: str, sizes: list[int], rule: str = "message") -> DataFrame:
    """(key, buckets, slot, tf, weight) of the filled slots of each text; weights are fitted on all of ``df``.

    The counts are written once to the session's working folder. Fit and result both read them there, so texts
    are tokenized once. The vectors unfold from their filled slots alone, whatever their size.
    """
    path = scratch_path(df.sparkSession, "hashed-counts")
    hashed_counts(df, key, text, sizes, rule).write.parquet(path)
    counts = df.sparkSession.read.parquet(path)
    found = None
    for n in sizes:
        weighed = IDF(inputCol=f"hash_{n}", outputCol="weights", minDocFreq=0).fit(counts).transform(counts)
        unfolded = weighed.select(key, F.lit(n).alias("buckets"), F.inline(filled(tf=f"hash_{n}", weight="weights")))
        found = unfolded if found is None else found.unionByName(unfolded)
    return found
