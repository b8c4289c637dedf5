"""Lines that many documents share: kept in one document, dropped from all others.

Normalised lines are exploded and hashed, the documents of each hash are counted, and what goes is sent back to its
text as positions, so that no line travels as text.

1. Each row gives its distinct line hashes (two independent 64-bit hashes of the key). They are counted in the tasks that
   made them and then by hash: a hash in fewer rows than ``documents`` can't be in as many documents.
2. Only lines of the hashes left are looked at again, with their document and position, and written out. Their documents
   are counted exactly: the same id is one document, whatever its number of rows.
3. Positions of lines to drop go back to their text, which is put together again from the runs between them.

A text is known by its id and its hash, so results don't depend on partitions or retried tasks. A very common line is
spread over its rows (``join_by_frequency``); its count needs no list of its documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.llm.common import saved
from tallyloom.operators.keyed import join_by_frequency

#: What is stripped from both ends of a line, and the letters that are lower-cased.
_BLANKS = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lowered(line: Column) -> Column:
    """A-Z lower-cased: for a line of one-byte characters that is what lower() does, and faster."""
    return F.when(F.octet_length(line) == F.length(line), F.lower(line)).otherwise(F.translate(line, _UPPER, _LOWER))


def _hashes(value: Column) -> list[Column]:
    """128 bits: the second hash starts from another seed, so it is no function of the first."""
    return [F.xxhash64(value).alias("h1"), F.xxhash64(F.lit(7), value).alias("h2")]


def _without(text: Column, dropped: Column) -> Column:
    """The lines between the dropped positions (ascending, from 0), joined; linear in the number of lines."""
    lines = F.split(text, "\n", -1)
    ends = F.concat(F.array(F.lit(-1)), dropped, F.array(F.size(lines)))
    runs = F.transform(
        F.sequence(F.lit(1), F.size(ends) - 1),
        lambda i: F.slice(lines, F.element_at(ends, i) + 2, F.element_at(ends, i + 1) - F.element_at(ends, i) - 1),
    )
    return F.array_join(F.flatten(runs), "\n")


def drop_common_lines(docs: DataFrame, min_chars: int = 40, documents: int = 5, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(row, n_lines, n_dropped, kept) per row of ``docs``; ``row`` holds its columns as they are, whatever their names.

    A line's key is the line without blanks at both ends, A-Z lower-cased. A key of ``min_chars`` code points or more in
    ``documents`` documents or more stays in the document of the largest id that has it, in all its places there, and
    goes everywhere else. Null and empty texts are one empty line. Rows of one id are one document: they count once, and
    all of them keep the lines if that id is the largest. Rows without an id are one document as well, the smallest.
    Repeated rows get the same result each. No rows: no rows.
    """
    given = docs.select(F.struct("*").alias("row"), F.col(f"`{id_column}`").alias("id"), F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit("")).alias("text"))
    own = [h.alias(f"t{i}") for i, h in enumerate(_hashes(F.col("text")))]
    line = F.col("line")
    # Trimming only shortens a line, so short lines go before they are cleaned.
    lines = given.select("id", *own, F.posexplode(F.split("text", "\n", -1)).alias("pos", "line")).where(F.length(line) >= min_chars)
    trimmed = lines.select("id", "t0", "t1", "pos", F.btrim(line, F.lit(_BLANKS)).alias("line")).where(F.length(line) >= min_chars)
    keyed = trimmed.select("id", "t0", "t1", "pos", _lowered(line).alias("key"))

    # 1. rows of each hash; a line that a row repeats counts once for each place here, which only lets more through
    counted = keyed.select(*_hashes(F.col("key"))).groupBy("h1", "h2").agg(F.count("*").alias("n_rows"))
    # written, as the join below reads it more than once
    frequent = saved(counted.where(F.col("n_rows") >= documents), "frequent-lines")
    # 2. places of those hashes, and the exact number of their documents
    places = keyed.select("id", "t0", "t1", "pos", *_hashes(F.col("key")))
    known = frequent.select("h1", F.col("h2").alias("other"), "n_rows")
    found = saved(join_by_frequency(places, known, "h1", "n_rows", F.xxhash64("id", "t0", "pos")).where("h2 = other").drop("other", "n_rows"), "common-lines")
    per_document = found.groupBy("h1", "h2", "id").agg(F.count("*").alias("n"))
    judged_keys = per_document.groupBy("h1", "h2").agg(F.count("*").alias("n_documents"), F.max("id").alias("keeper"), F.sum("n").alias("n_rows"))
    shared = saved(judged_keys.where(F.col("n_documents") >= documents), "shared-lines")
    # 3. positions to drop per text
    judged = join_by_frequency(found, shared.withColumnRenamed("h2", "other"), "h1", "n_rows", F.xxhash64("id", "t0", "pos")).where("h2 = other")
    gone = judged.where(~F.col("id").eqNullSafe(F.col("keeper"))).groupBy("id", "t0", "t1").agg(F.array_sort(F.collect_set("pos")).alias("dropped"))
    renamed = gone.select(F.col("id").alias("of"), F.col("t0").alias("u0"), F.col("t1").alias("u1"), "dropped")
    texts = given.select("*", *own)
    joined = texts.join(renamed, texts["id"].eqNullSafe(renamed["of"]) & (F.col("t0") == F.col("u0")) & (F.col("t1") == F.col("u1")), "left")
    text = F.col("text")
    return joined.select(
        "row",
        (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("dropped").isNull(), text).otherwise(_without(text, F.col("dropped"))).alias("kept"),
    )
