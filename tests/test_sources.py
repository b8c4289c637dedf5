import subprocess
import sys
from pathlib import Path

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyloom.sources import dealt, ensure_checkpoint_dir, read_delimited, scratch_path, write_delimited

SCHEMA = "id INT, text STRING, label INT"


def _file(tmp_path, text, name="in.csv"):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def test_inferred_types_and_null_token(spark, tmp_path):
    df = read_delimited(spark, _file(tmp_path, "a,b,c\n1,x,0.5\nNA,NA,2\n"))
    assert [f.dataType.simpleString() for f in df.schema] == ["int", "string", "double"]
    assert sorted(map(tuple, df.collect()), key=str) == [(1, "x", 0.5), (None, None, 2.0)]


def test_headerless_read_of_a_file_with_header_gives_a_null_row(spark, tmp_path):
    path = _file(tmp_path, "id;text;label\n7;hello;1\n")
    rows = read_delimited(spark, path, sep=";", schema=SCHEMA, header=False, null_value=None).collect()
    assert [tuple(r) for r in rows] == [(None, "text", None), (7, "hello", 1)]


def test_bad_cells_by_mode(spark, tmp_path):
    path = _file(tmp_path, "1;a;1\nx;b;0\n")
    read = lambda **kw: read_delimited(spark, path, sep=";", header=False, **kw)
    assert read(schema=SCHEMA).where("id IS NULL").count() == 1
    assert len(read(schema=SCHEMA, mode="DROPMALFORMED").collect()) == 1
    with pytest.raises((PySparkException, Py4JJavaError)):
        read(schema=SCHEMA, mode="FAILFAST").collect()
    kept = read(schema=SCHEMA + ", raw STRING", corrupt_column="raw")
    assert [r.raw for r in kept.orderBy("text").collect()] == [None, "x;b;0"]


@pytest.mark.parametrize("sep", [",", ";", "|"])
def test_round_trip_keeps_separators_quotes_and_blanks(spark, sep):
    rows = [(1, 'say "hi", ; | twice', 0.1), (2, "  padded  ", None), (3, "back\\slash", 1e-9)]
    df = spark.createDataFrame(rows, "id int, text string, x double")
    path = write_delimited(df, scratch_path(spark, "trip"), sep=sep)
    assert sorted(map(tuple, read_delimited(spark, path, sep=sep, schema=df.schema).collect())) == rows


def test_checkpoint_folder_is_set_once(spark):
    ensure_checkpoint_dir(spark)
    first = spark.sparkContext.getCheckpointDir()
    ensure_checkpoint_dir(spark)
    assert spark.sparkContext.getCheckpointDir() == first


def test_working_folder_is_gone_after_the_session(tmp_path):
    """In a session of its own: the folder is below the named one, and removed when the JVM has ended."""
    code = f"""
from pyspark.sql import SparkSession
from tallyloom.sources import ensure_checkpoint_dir, scratch_path
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", "{tmp_path}/shared").getOrCreate()
path = scratch_path(spark, "t")
spark.range(3).write.parquet(path)
assert path.startswith("file://{tmp_path}/shared/") and spark.read.parquet(path).count() == 3
spark.stop()
"""
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(__file__).resolve().parent.parent)
    assert not list((tmp_path / "shared").glob("_working*"))


def test_dealt_does_not_follow_the_input_splits(spark):
    one, other = (dealt(spark.range(500, numPartitions=n).toDF("k"), "k", 5) for n in (2, 9))
    rows = [df.withColumn("p", F.spark_partition_id()).collect() for df in (one, other)]
    assert rows[0] == rows[1]


def test_declared_schema_scan_prunes_columns(spark, tmp_path):
    df = read_delimited(spark, _file(tmp_path, "1;a;1\n"), sep=";", schema=SCHEMA, header=False)
    plan = df.where(F.col("label").isNotNull()).select("id")._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(label)" in plan and "text" not in plan.split("ReadSchema")[1]
