import pytest
from pyspark.sql import functions as F

from tallyloom.functions import (
    flag_at_least, inches_to_metres, litres_per_100km, mass_density, mean_of_two, miles_to_km, pounds_to_kg,
)
from tallyloom.operators import profile, split, wrangle


def test_column_profile_counts_nulls_and_reports_nullability(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 'a'), (2, NULL), (3, NULL) AS t(`a.b`, c)")
    rows = profile.column_profile(df).orderBy("position").collect()
    assert [tuple(r) for r in rows] == [(0, "a.b", "int", False, 3, 0), (1, "c", "string", True, 3, 2)]


def test_column_profile_of_an_empty_table(spark):
    rows = profile.column_profile(spark.createDataFrame([], "a int")).collect()
    assert [(r.n_rows, r.n_null) for r in rows] == [(0, 0)]


def test_count_where_is_one_scan(spark, mid_dir):
    df = spark.read.parquet(f"{mid_dir}/orders.parquet")
    counted = profile.count_where(df, {"a": F.col("o_totalprice") > 1000, "b": F.col("o_custkey").isNull()})
    assert counted._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_bernoulli_sample_with_and_without_key(spark):
    df = spark.range(20_000)
    for sample in (profile.bernoulli_sample(df, 0.25, 3, "id"), profile.bernoulli_sample(df, 0.25, 3)):
        n = sample.count()
        assert 4_700 < n < 5_300 and sample.distinct().count() == n
    again = profile.bernoulli_sample(df.repartition(7), 0.25, 3, "id")
    assert again.exceptAll(profile.bernoulli_sample(df, 0.25, 3, "id")).count() == 0


def test_preview_and_sample_sizes(spark):
    df = spark.range(50)
    assert [r.id for r in profile.preview(df, 3, ["id"]).collect()] == [0, 1, 2]
    assert profile.bounded_sample(df, 12, "id").count() == 12
    assert profile.bounded_sample(df, 80, "id").count() == 50


def test_conversions_round_half_up(spark):
    row = spark.range(1).select(
        miles_to_km(F.lit(100)).alias("km"), inches_to_metres(F.lit(177.2)).alias("m"),
        pounds_to_kg(F.lit(2890)).alias("kg"), mean_of_two(F.lit(25), F.lit(32)).alias("mpg"),
        litres_per_100km(F.lit(28.5)).alias("use"), litres_per_100km(F.lit(0.0)).alias("no_use"),
        mass_density(F.lit(1311.0), F.lit(4.501), 3).alias("density"), mass_density(F.lit(1.0), F.lit(0.0)).alias("none"),
        F.round(F.lit(2.5), 0).alias("half"),
    ).first()
    assert tuple(row) == (161.0, 4.501, 1311.0, 28.5, 8.25, None, 14.38, None, 3.0)


def test_flag_keeps_null(spark):
    df = spark.sql("SELECT * FROM VALUES (14), (15), (CAST(NULL AS INT)) AS t(v)")
    assert [r[0] for r in df.select(flag_at_least("v", 15)).collect()] == [0, 1, None]


def test_delay_labels_drops_only_incomplete_rows(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 20, 100, NULL), (2, NULL, 100, 5), (3, 1, 50, 7) AS t(id, delay, mile, flight)")
    assert [tuple(r) for r in wrangle.delay_labels(df).orderBy("id").collect()] == [(1, 20, 161.0, 1), (3, 1, 80.0, 0)]


def test_drop_of_a_missing_column_changes_nothing(spark):
    assert wrangle.replace_columns(spark.range(1), {"x": F.lit(1)}, drop=("absent",)).columns == ["id", "x"]


def test_delay_wrangle_pushes_its_filter_and_prunes(spark, mid_dir):
    df = spark.read.parquet(f"{mid_dir}/events.parquet").withColumnsRenamed({"value": "delay", "user_id": "mile"})
    plan = wrangle.delay_labels(df.select("event_id", "delay", "mile"))._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(value)" in plan and "props" not in plan.split("ReadSchema")[1]


def test_stable_split_is_complete_disjoint_and_ignores_layout(spark):
    df = spark.range(5_000).withColumn("x", F.col("id") * 2)
    train, test = split.stable_split(df, "id")
    assert train.count() + test.count() == 5_000 and train.intersect(test).count() == 0
    other, _ = split.stable_split(df.select("x", "id").repartition(9), "id")
    assert other.select("id").exceptAll(train.select("id")).count() == 0


def test_rows_without_a_key_stay_in_one_part(spark):
    df = spark.sql("SELECT * FROM VALUES (1), (NULL), (NULL) AS t(k)")
    train, test = split.stable_split(df, "k")
    assert train.count() + test.count() == 3


def test_folds_cut_across_the_split(spark):
    df = split.with_fold(split.with_split(spark.range(20_000), "id"), "id", 5)
    counts = {(r.part, r.fold): r["count"] for r in df.groupBy("part", "fold").count().collect()}
    assert len(counts) == 10
    assert all(0.77 < counts["train", k] / (counts["train", k] + counts["test", k]) < 0.83 for k in range(5))


def test_random_split_needs_and_honours_its_seed(spark):
    df = spark.range(1_000)
    first = [p.count() for p in split.random_split(df, 23)]
    assert first == [p.count() for p in split.random_split(df, 23)] and sum(first) == 1_000
    with pytest.raises(TypeError):
        split.random_split(df)


def test_very_small_fractions_are_kept_as_they_are(spark):
    n = profile.bernoulli_sample(spark.range(10_000_000), 1e-6, 11, "id").count()
    assert 1 <= n <= 30
    assert abs(profile.bernoulli_sample(spark.range(2_000_000), 0.00016, 11, "id").count() - 320) < 100
