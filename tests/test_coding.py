import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyloom.operators import coding
from tallyloom.operators.keyed import join_by_frequency, salted


def _skewed(spark, n=3_000):
    """A third of the rows share one value; many values tie; some are null."""
    value = F.expr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 101 = 1 THEN NULL ELSE concat('v', CAST(id % 97 AS STRING)) END")
    return spark.range(n).withColumn("v", value)


def test_level_codes_equal_the_indexer(spark):
    df = _skewed(spark)
    known = df.where("v IS NOT NULL")
    labels = coding.index_stage(["v"]).fit(known).labelsArray[0]
    codes = coding.level_codes(df.repartition(5), "v").orderBy("code").collect()
    assert [r.value for r in codes] == list(labels)
    assert [r.code for r in codes] == [float(i) for i in range(len(labels))]


def test_code_column_keeps_every_row_and_null(spark):
    df = _skewed(spark)
    coded = coding.code_column(df, "v", "code", F.col("id"))
    codes = {r.value: r.code for r in coding.level_codes(df, "v").collect()}
    rows = coded.collect()
    assert sorted(r.id for r in rows) == list(range(3_000))
    assert all(r.code == codes.get(r.v) for r in rows)


def test_frequency_join_spreads_long_and_many_hot_keys(spark):
    """1,100 frequent keys of 2,000 characters: no salt of any of them has many more rows than asked for."""
    df = spark.range(132_000).select("id", F.rpad(F.concat(F.lit("k"), (F.col("id") % 1_100).cast("string")), 2_000, "x").alias("v"))
    per_key = df.groupBy("v").agg(F.count("*").alias("n"))
    marked, _, salt = salted(df, per_key, "v", "n", F.col("id"), rows_per_task=30)
    sizes = marked.groupBy("v", salt).count()
    assert sizes.agg(F.max("count")).first()[0] <= 60 and sizes.groupBy("v").count().agg(F.min("count")).first()[0] == 4
    joined = join_by_frequency(df, per_key, "v", "n", F.col("id"), rows_per_task=30)
    assert joined.count() == df.count() and joined.where("n <> 120").isEmpty()


def test_code_column_keeps_columns_of_any_name(spark):
    rows = [(1, "a", 0.5, 7), (2, "a", 1.5, 8), (3, "b", 2.5, 9), (4, None, 3.5, 10)]
    df = spark.createDataFrame(rows, "id long, kind string, value double, n_rows long").withColumn("_key_salt", F.lit("s")).withColumn("_level", F.lit("l"))
    coded = coding.code_column(df, "kind", "code", F.col("id"))
    assert coded.columns == [*df.columns, "code"]
    assert sorted((r.id, r.value, r.n_rows, r._key_salt, r._level, r.code) for r in coded.collect()) == [
        (1, 0.5, 7, "s", "l", 0.0), (2, 1.5, 8, "s", "l", 0.0), (3, 2.5, 9, "s", "l", 1.0), (4, 3.5, 10, "s", "l", None),
    ]


def test_frequency_join_also_without_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        df = _skewed(spark).where("v IS NOT NULL")
        joined = join_by_frequency(df, df.groupBy("v").agg(F.count("*").alias("n")), "v", "n", F.col("id"))
        assert joined.count() == df.count() and joined.select("id").distinct().count() == df.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_too_many_levels_are_refused_before_a_fit(spark):
    df = spark.range(1_000).withColumn("v", F.col("id").cast("string"))
    coding.require_few_levels(df, ["v"], limit=1_100)
    with pytest.raises(ValueError, match="more than 100 levels"):
        coding.require_few_levels(df, ["v"], limit=100)


def test_unseen_and_null_levels_follow_handle_invalid(spark):
    train = spark.createDataFrame([("a",), ("a",), ("b",)], "v string")
    test = spark.createDataFrame([("a",), ("z",), (None,)], "v string")
    with pytest.raises((PySparkException, Py4JJavaError)):
        coding.index_stage(["v"]).fit(train).transform(test).collect()
    keep = coding.index_stage(["v"], handle_invalid="keep").fit(train).transform(test)
    assert [r.v_idx for r in keep.collect()] == [0.0, 2.0, 2.0]
    assert coding.index_stage(["v"], handle_invalid="skip").fit(train).transform(test).count() == 1


def test_dummies_leave_the_last_level_empty(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,)], "k double")
    vectors = coding.dummy_stage(["k"], ["d"]).fit(df).transform(df).select(coding.dense("d").alias("d")).collect()
    assert [r.d for r in vectors] == [[1.0, 0.0], [0.0, 1.0], [0.0, 0.0]]


def test_buckets_close_at_the_end_and_refuse_the_rest(spark):
    stage = coding.bucket_stage("h", "b")
    df = spark.createDataFrame([(0.0,), (2.99,), (3.0,), (24.0,)], "h double")
    assert [r.b for r in stage.transform(df).collect()] == [0.0, 0.0, 1.0, 7.0]
    with pytest.raises((PySparkException, Py4JJavaError)):
        stage.transform(spark.createDataFrame([(24.5,)], "h double")).collect()


def test_assembler_refuses_null_unless_told(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, 3.0)], "a double, b double")
    with pytest.raises((PySparkException, Py4JJavaError)):
        coding.assemble_stage(["a", "b"]).transform(df).collect()
    assert coding.assemble_stage(["a", "b"], handle_invalid="skip").transform(df).count() == 1
