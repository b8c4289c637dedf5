"""Shared working folder for checkpoints and intermediate tables.

It is the folder named in ``spark.checkpoint.dir`` or, without one, a folder in the SQL warehouse. What is put there
is removed when the session's JVM ends.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession

_SETTING = "spark.checkpoint.dir"


def _shared_dir(spark: SparkSession) -> str:
    named = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING)
    return (named or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def _session_dir(spark: SparkSession) -> str:
    """The full URI of a folder of the session's own, which Hadoop's file system deletes when it is closed at the end of the JVM."""
    path = f"{_shared_dir(spark)}/_working-{spark.sparkContext.applicationId}"
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    store.mkdirs(where)
    store.deleteOnExit(where)
    return re.sub(r"^file:/(?!/)", "file:///", store.makeQualified(where).toString())


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the session's shared folder; it lasts as long as the session's JVM."""
    return f"{_session_dir(spark)}/{name}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Keep the checkpoint folder the session names; set one only where there is none."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_path(spark, "checkpoints"))
