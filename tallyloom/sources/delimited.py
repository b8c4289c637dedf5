"""Delimited text in and out.

The declared-schema form is the one for large inputs: it reads each byte once.
Without a schema Spark reads the input an extra time to infer the types;
``sampling_ratio`` bounds the share of rows that this extra pass parses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Quotes inside a quoted field are doubled on both sides.
_QUOTING = {"quote": '"', "escape": '"'}


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    sep: str = ",",
    schema: StructType | str | None = None,
    header: bool = True,
    null_value: str | None = "NA",
    mode: str = "PERMISSIVE",
    corrupt_column: str | None = None,
    sampling_ratio: float | None = None,
) -> DataFrame:
    """Read delimited text; a cell that does not fit its declared type becomes null.

    ``corrupt_column`` must also be a string field of ``schema``; it then holds
    the raw line of every row with a bad cell.
    """
    reader = spark.read.options(**_QUOTING).option("sep", sep).option("header", header)
    reader = reader.option("mode", mode)
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    if corrupt_column is not None:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    if schema is not None:
        return reader.schema(schema).csv(path)
    if sampling_ratio is not None:
        reader = reader.option("samplingRatio", sampling_ratio)
    return reader.option("inferSchema", True).csv(path)


def write_delimited(
    df: DataFrame,
    path: str,
    sep: str = ",",
    header: bool = True,
    null_value: str = "NA",
) -> str:
    """Write ``df`` as delimited text, one file per partition, and return ``path``."""
    (
        df.write.options(**_QUOTING)
        .option("sep", sep)
        .option("header", header)
        .option("nullValue", null_value)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path
