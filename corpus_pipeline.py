"""A corpus pipeline: from documents to packed sequences, each stage over all that the one before kept.

Toxic documents go; one document of each near-duplicate class stays; byte strings that stand earlier are cut out of
texts; documents with benchmark windows go; what is left is packed. All stages but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.llm import near, packing, queries, repeats, toxicity, winnowing
from tallyloom.sources import scratch_path, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Labels are learned from the given documents that are not held out (see the query of the operator)."""
    learned = table(spark, sf_dir, "labels").where(F.crc32(F.col("doc_id").cast("string")) % 4 != queries.HELD_OUT)
    judged = toxicity.score(docs, toxicity.train(docs, learned))
    return judged.where("predicted = 0").select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class stays: that of least id, null first; of several texts of that id in a class, one."""
    return near.one_of_each_class(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated strings of 100 bytes; all documents stay, with ``n_chars`` of what is left."""
    cut = repeats.without_repeats(docs, 100, as_text=True)
    return cut.select(*(F.col("kept").alias("text") if c == "text" else F.length("kept").cast("long").alias(c) if c == "n_chars" else F.col(f"row.{c}").alias(c) for c in docs.columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return winnowing.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, public_tokenizers.path(queries.WORD_BPE), 4096)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_strings", cut_repeats),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: SQL can express neither the classifier nor the tokenizer; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
