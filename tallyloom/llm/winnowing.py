"""Benchmark decontamination by winnowing.

The fingerprint of a window of ``SPAN`` words is the least hash of the ``GRAM``-word runs inside it. Two texts that
share a window share its fingerprint, so joining the fingerprints of documents and benchmark items finds every shared
window. Consecutive windows mostly have the same fingerprint; a document sends each of its fingerprints once.
Fingerprints that meet are then extended: the document's windows with such a fingerprint are compared word for word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.llm.common import saved

#: Words of a window, and of the runs that are hashed; a window's fingerprint is chosen among SPAN - GRAM + 1 runs.
SPAN, GRAM = 10, 5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_NO_WORD_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words of 0-9, a-z and non-ASCII characters, A-Z lower-cased; none for null."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), _NO_WORD), "")


def _cased_words(text: Column) -> Column:
    """The same words in the case they are written in, which is cheaper."""
    return F.array_remove(F.split(text, _NO_WORD_ANY_CASE), "")


def _windows(words: str, span: int) -> Column:
    """The first places (from 1) of all windows of ``span`` words."""
    return F.when(F.size(words) >= span, F.sequence(F.lit(1), F.size(words) - (span - 1))).otherwise(F.array().cast("array<int>"))


def _run_hashes(hashes: str, gram: int) -> Column:
    """Hashes of all runs of ``gram`` words, given the hashes of the words."""
    return F.transform(_windows(hashes, gram), lambda i: F.xxhash64(*(F.get(hashes, i + (k - 1)) for k in range(gram))))


def _fingerprints(hashes: str) -> Column:
    """Per window of SPAN words the least hash of its runs, given the hashes of all runs."""
    runs = SPAN - GRAM + 1
    return F.transform(_windows(hashes, runs), lambda i: F.least(*(F.get(hashes, i + (k - 1)) for k in range(runs))))


def _printed(rows: DataFrame, words: str, *kept: str) -> DataFrame:
    """Adds ``prints``. Words that differ in the case of A-Z alone have one hash; others may, which only costs a comparison."""
    hashed = rows.select(*kept, F.transform(words, lambda w: F.xxhash64(F.lower(w))).alias("hashes"))
    return hashed.select(*kept, _run_hashes("hashes", GRAM).alias("runs")).select(*kept, _fingerprints("runs").alias("prints"))


def find_contamination(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", item_text_column: str = "text") -> DataFrame:
    """Words of each document that lie in a window of a benchmark item, and which items those are.

    A window is SPAN consecutive words of an item; an item of fewer words, but not none, is one window. Whole texts
    are compared. Null and wordless texts have no windows. Items without an id are not compared; rows that repeat an
    item count once. One row per input row (repeated rows and null ids stay): id, n_words, n_hit, n_items,
    items_sha256 (the ids as strings, sorted, comma-joined), items (those ids), contaminated.
    """
    known = (
        items.where(F.col(item_column).isNotNull())
        .select(F.col(item_column).cast("string").alias("item"), words_of(F.col(item_text_column)).alias("words"))
        .where(F.size("words") > 0)
        .select("*", F.least(F.size("words"), F.lit(SPAN)).alias("span"))
    )
    cut = F.transform(F.sequence(F.lit(1), F.size("words") - F.col("span") + 1), lambda i: F.array_join(F.slice("words", i, F.col("span")), " "))
    item_windows = saved(known.select("item", "span", F.explode(cut).alias("window")).distinct(), "item-windows")
    whole = item_windows.where(F.col("span") == SPAN).select(F.split("window", " ").alias("words"))
    prints = saved(_printed(whole, "words").select(F.explode_outer("prints").alias("print")).where(F.col("print").isNotNull()).distinct(), "item-prints")
    # items of fewer than SPAN words: at most SPAN - 1 lengths, each with windows of its own length
    short_spans = sorted(r["span"] for r in item_windows.where(F.col("span") < SPAN).select("span").distinct().collect())

    # what holds for a document follows from its text, which two 64-bit hashes stand for
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_column).alias("id"), text.alias("text")).select("*", F.xxhash64("text").alias("a"), F.xxhash64(F.lit("b"), "text").alias("b"))
    cased = rows.select("id", "a", "b", _cased_words(F.col("text")).alias("cased")).select("id", "a", "b", F.size("cased").cast("long").alias("n_words"), "cased")
    printed = saved(_printed(cased, "cased", "id", "a", "b", "n_words").withColumn("prints", F.array_distinct("prints")), "doc-prints")
    met = printed.select("a", "b", F.explode("prints").alias("print")).join(prints, "print").distinct()
    met = saved(met.groupBy("a", "b").agg(F.collect_set("print").alias("met")), "met-prints")  # per text: bounded by its windows

    def worded(texts: DataFrame, *kept: str) -> DataFrame:
        return texts.select("a", "b", *kept, words_of(F.col("text")).alias("words"))

    again = _printed(worded(rows.join(met, ["a", "b"]), "met"), "words", "a", "b", "met", "words")
    places = F.filter(F.sequence(F.lit(1), F.size("prints")), lambda i: F.array_contains("met", F.get("prints", i - 1)))
    # explode_outer: for explode, Spark would add a filter on the array and compute it inside its own lambda
    found = again.select("a", "b", "words", F.explode_outer(places).alias("at")).where(F.col("at").isNotNull()).select("a", "b", "at", F.lit(SPAN).alias("span"), F.array_join(F.slice("words", F.col("at"), SPAN), " ").alias("window"))
    for span in short_spans:
        each = worded(rows).select("a", "b", "words", F.explode_outer(_windows("words", span)).alias("at")).where(F.col("at").isNotNull())
        found = found.union(each.select("a", "b", "at", F.lit(span).alias("span"), F.array_join(F.slice("words", F.col("at"), span), " ").alias("window")))
    hits = saved(found.join(item_windows.select("window").distinct(), "window", "left_semi").distinct(), "hits")

    # one pass over the sorted windows of a text counts the words in any of them
    covered = F.aggregate(
        F.array_sort(F.collect_set(F.struct("at", "span"))),
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda acc, w: F.struct(
            F.greatest(acc["end"], w["at"] + w["span"]).alias("end"),
            (acc["n"] + F.greatest(F.lit(0), w["at"] + w["span"] - F.greatest(acc["end"], w["at"]))).alias("n"),
        ),
        lambda acc: acc["n"],
    )
    words_hit = hits.groupBy("a", "b").agg(covered.alias("n_hit"))
    named = hits.select("a", "b", "window").distinct().join(item_windows.select("window", "item"), "window").groupBy("a", "b").agg(F.array_sort(F.collect_set("item")).alias("items"))
    result = words_hit.join(named, ["a", "b"])
    own = F.coalesce(F.col("items"), F.array().cast("array<string>"))
    return printed.select("id", "a", "b", "n_words").join(result, ["a", "b"], "left").select(
        F.col("id").alias(id_column),
        "n_words",
        F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.size(own).cast("long").alias("n_items"),
        F.sha2(F.array_join(own, ","), 256).alias("items_sha256"),
        own.alias("items"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
    )


def clean_documents(docs: DataFrame, items: DataFrame, text_column: str = "text", item_column: str = "item_id") -> DataFrame:
    """The rows of ``docs`` whose text shares no window with an item, with all their columns."""
    judged = find_contamination(docs.select(F.xxhash64(F.coalesce(F.col(text_column), F.lit(""))).alias("key"), text_column), items, "key", text_column, item_column)
    bad = saved(judged.where("contaminated").select(F.col("key").alias("_contaminated_text")).distinct(), "contaminated")
    return docs.join(bad, F.xxhash64(F.coalesce(docs[text_column], F.lit(""))) == bad["_contaminated_text"], "left_anti")
