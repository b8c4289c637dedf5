"""Order MinHash fingerprints: minimal occurrence-numbered k-mers, kept in text order.

A k-mer is ``KMER`` consecutive words; the same k-mer's occurrences in a text are numbered, so that a text is a set of
(k-mer, number) pairs. One hash of a pair gives its bin, one of ``BINS``, and its order in it. For each bin the two least pairs
are taken, from the bins after it (in a circle) where it holds fewer, put back into text order and hashed as a tuple: moving or
editing text changes tuples even where the set of words stays, in short texts as well. Likeness is the share of equal tuples. Column functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyloom.llm.common import partitions
from tallyloom.operators.keyed import fresh

KMER, BINS, KEPT = 3, 64, 2
#: Layout of a long: a sign bit of 0, 6 bits of bin and 31 of hash above 26 of place. Words of a text are below 2 ** 26, which is 128 MB of
#: text at least; beyond that places start again from 0.
_PLACE_BITS = 26
_PLACE = (1 << _PLACE_BITS) - 1
_BIN_SHIFT = 57


def _hash(x: Column) -> Column:
    """Bin and hash of a pair, without its place."""
    return F.shiftrightunsigned(x, _PLACE_BITS)


def with_tuples(df: DataFrame, text: str, name: str) -> DataFrame:
    """Adds as ``name`` the tuples of the string column ``text`` (null: empty): per bin two hexadecimal
    digits of the bin and eight of its tuple's hash, in order of bin; nothing for a text without words.

    Words are cut at blanks, tabs and line ends. A text of fewer than KMER words, but not none, is one k-mer; the tuples of a
    text of one k-mer are that alone.
    """
    words_, kmers_, pairs_, least_, tuples_ = (fresh(c, df) for c in ("_words", "_kmers", "_pairs", "_least", "_tuples"))
    kept = [F.col(f"`{c}`") for c in df.columns]
    words = F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), "[ \t\r\n]+"), "")
    df = df.select(*kept, F.transform(words, lambda w: F.xxhash64(w)).alias(words_))

    def above(hashed: Column, place: Column) -> Column:
        return F.shiftleft(F.shiftrightunsigned(hashed, _PLACE_BITS + 1), _PLACE_BITS).bitwiseOR(place.cast("long"))

    none = F.array().cast("array<bigint>")
    last = F.size(words_) - KMER
    kmers = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: above(F.xxhash64(*(F.get(words_, i + k) for k in range(KMER))), i))
    short = F.when(F.size(words_) > 0, F.array(above(F.xxhash64(F.array_join(F.transform(words_, lambda w: w.cast("string")), " ")), F.lit(0)))).otherwise(none)
    # equal k-mers come together, in text order
    df = df.select(*kept, F.sort_array(F.when(last >= 0, kmers).otherwise(short)).alias(kmers_))

    def number(x: Column, i: Column) -> Column:
        """How many equal k-mers come before: found bit by bit, as equal ones stand together in the sorted array."""
        bits = F.array(*(F.lit(1 << b) for b in range(_PLACE_BITS - 1, -1, -1)))
        return F.aggregate(bits, F.lit(0), lambda n, bit: F.when((i >= n + bit) & (_hash(F.get(kmers_, i - n - bit)) == _hash(x)), n + bit).otherwise(n))

    def pair(x: Column, i: Column) -> Column:
        repeated = (i > 0) & (_hash(F.get(kmers_, i - 1)) == _hash(x))
        return above(F.xxhash64(_hash(x), F.when(repeated, number(x, i)).otherwise(F.lit(0))), x.bitwiseAND(_PLACE))

    df = df.select(*kept, F.sort_array(F.transform(kmers_, pair)).alias(pairs_))
    bin_of = lambda x: F.shiftright(x, _BIN_SHIFT)
    least = F.filter(pairs_, lambda x, i: (i < KEPT) | (bin_of(F.get(pairs_, i - KEPT)) != bin_of(x)))
    df = df.select(*kept, least.alias(least_))

    final = F.size(least_) - 1

    def joined(x: Column, i: Column) -> Column:
        """The tuple that begins with a pair, for its bin and the empty ones before it; nothing for the second pair of a bin."""
        other = F.get(least_, F.when(i < final, i + 1).otherwise(F.lit(0)))
        place = lambda v: v.bitwiseAND(_PLACE)
        hashed = (
            F.when(place(x) == place(other), F.xxhash64(_hash(x)))
            .when(place(x) < place(other), F.xxhash64(_hash(x), _hash(other)))
            .otherwise(F.xxhash64(_hash(other), _hash(x)))
        )
        before = F.when(i > 0, bin_of(F.get(least_, i - 1))).otherwise(F.lit(-1).cast("long"))
        return F.when(before < bin_of(x), F.struct((before + 1).alias("low"), bin_of(x).alias("high"), hashed.bitwiseAND((1 << 32) - 1).alias("hashed")))

    df = df.select(*kept, F.array_compact(F.transform(least_, joined)).alias(tuples_))

    def entries(low: Column, high: Column, hashed: Column) -> Column:
        return F.transform(F.sequence(low, high), lambda b: F.lpad(F.hex(F.shiftleft(b, 32).bitwiseOR(hashed)), 10, "0"))

    # bins after the last pair begin again with the first one
    filled = F.flatten(F.transform(tuples_, lambda t: entries(t["low"], t["high"], t["hashed"])))
    end = F.get(tuples_, F.size(tuples_) - 1)["high"]
    over = F.when(end < BINS - 1, entries(end + 1, F.lit(BINS - 1).cast("long"), F.get(tuples_, F.lit(0))["hashed"])).otherwise(F.array().cast("array<string>"))
    return df.select(*kept, F.when(F.size(tuples_) > 0, F.concat(filled, over)).otherwise(F.array().cast("array<string>")).alias(name))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal tuples; 1 if neither text has any."""
    most = F.greatest(F.size(a), F.size(b))
    return F.when(most == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / most)


def fingerprint(tuples: Column) -> Column:
    return F.array_join(tuples, ".")


def compare_with_next(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Fingerprints of each whole text and of its edited text, and likeness to that and to the next document.

    The edited text has the last half of the code points (rounded down) replaced by the first as many, or all, of the next document in
    ascending order of id (nulls first, rows of one id by text; after the last comes the first). A null text is empty. One row per
    input row. Documents are dealt by ranges of ids, whose bounds are approximate quantiles, so a next text is
    mostly at hand; the first document of each range is given to the range before.
    """
    spark = docs.sparkSession
    n = 4 * partitions(spark)
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    bounds = rows.agg(F.percentile_approx("id", [k / n for k in range(1, n)] or [0.5], 10_000).alias("bounds"))
    bound = F.coalesce(bounds.scalar(), F.array().cast("array<bigint>"))
    dealt = rows.select("id", "text", bound.alias("bounds")).select("id", "text", F.coalesce(F.size(F.filter("bounds", lambda b: b <= F.col("id"))), F.lit(0)).alias("range"))
    dealt = dealt.repartition(partitions(spark), "range")  # dear work follows: no fewer tasks for small ranges
    order = Window.partitionBy("range").orderBy("id", "text")
    placed = dealt.select("*", F.lead("text").over(order).alias("follower"), F.row_number().over(order).alias("place"))
    # one row per range
    across = Window.orderBy("range")
    heads = placed.where("place = 1").select("range", "text")
    heads = heads.select("range", F.lead("text").over(across).alias("after"), F.min_by("text", "range").over(Window.partitionBy()).alias("very_first"))
    heads = with_tuples(heads.select("range", F.coalesce("after", "very_first").alias("head")), "head", "head_tuples")
    half = F.floor(F.col("n_chars") / 2).cast("int")
    full = placed.join(heads, "range").select("range", "id", "text", F.coalesce("follower", "head").alias("next"), F.col("follower").isNull().alias("last"), "head_tuples", F.length("text").cast("long").alias("n_chars"))
    full = full.select("range", "id", "text", "last", "head_tuples", "n_chars", F.concat(F.col("text").substr(F.lit(1), F.col("n_chars").cast("int") - half), F.col("next").substr(F.lit(1), half)).alias("edited"))
    full = with_tuples(with_tuples(full, "text", "tuples"), "edited", "edited_tuples")
    following = F.when(F.col("last"), F.col("head_tuples")).otherwise(F.lead("tuples").over(order))
    full = full.select("*", following.alias("next_tuples"))
    return full.select(
        F.col("id").alias(id_column),
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("tuples")).alias("fingerprint"),
        fingerprint(F.col("edited_tuples")).alias("edited_fingerprint"),
        likeness(F.col("tuples"), F.col("edited_tuples")).alias("near_edited"),
        likeness(F.col("tuples"), F.col("next_tuples")).alias("near_next"),
    )
