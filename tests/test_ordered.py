"""Categories of any number of levels in the order of their mean label."""

from collections import defaultdict

from pyspark.sql import functions as F

from tallyloom.operators import coding, models, ordered


def test_bins_against_brute_force(spark):
    rows = [(i, f"k{i * 7 % 90}", (i * 31 % 17 < i * 7 % 90 / 5) * 1) for i in range(2_000)] + [(5_000, None, 1), (5_001, "k1", None)]
    df = spark.createDataFrame(rows, "id long, key string, label int").repartition(7)
    order = ordered.order_levels(df, "key", "label", 16)
    per_level = defaultdict(list)
    for _, key, label in rows:
        if key is not None and label is not None:
            per_level[key].append(label)
    total, mean = 0, sum(map(sum, per_level.values())) / 2_000
    expected = {}
    for key in sorted(per_level, key=lambda k: (sum(per_level[k]) / len(per_level[k]), k)):
        expected[key] = total * 16 // 2_000
        total += len(per_level[key])
    assert {r["level"]: r["bin"] for r in order.levels.collect()} == expected
    assert order.other == min(b for k, b in expected.items() if sum(per_level[k]) / len(per_level[k]) >= mean)
    seen = order.apply(df.withColumn("_level", F.lit("mine")).withColumn("_level_bin", F.lit(-9)), F.col("id"), "bin")
    assert seen.columns == ["id", "key", "label", "_level", "_level_bin", "bin"] and seen.count() == len(rows)
    assert all(r["bin"] == expected.get(r["key"], order.other) and r["_level"] == "mine" and r["_level_bin"] == -9 for r in seen.collect())
    assert order.apply(spark.createDataFrame([(1, "new")], "id long, key string"), F.col("id"), "bin").first()["bin"] == order.other


def test_tree_equals_one_that_keeps_the_levels(spark):
    """With as many bins as rows a first cut is that of Spark's tree over the category itself."""
    rows = [(i, i * 13 % 20, int(i * 13 % 20 in (1, 4, 9, 16) or i % 11 == 0)) for i in range(1_000)]
    df = spark.createDataFrame(rows, "id long, key int, label int")
    order = ordered.order_levels(df, "key", "label", 1_000)
    binned = coding.assemble_stage(["bin"]).transform(order.apply(df, F.col("id"), "bin"))
    kept = coding.assemble_stage(["key_idx"]).transform(coding.index_stage(["key"]).fit(df).transform(df))
    left = [models.tree(seed=1, maxDepth=1, maxBins=1_000).fit(d).transform(d).select("id", "prediction").orderBy("id").collect() for d in (binned, kept)]
    assert left[0] == left[1]


def test_more_levels_than_a_tree_keeps_and_no_rows(spark):
    df = spark.range(40_000).select("id", F.concat(F.lit("k"), F.col("id") % 10_000).alias("key"), (F.col("id") % 10_000 % 2).alias("label"))
    order = ordered.order_levels(df, "key", "label")
    counts = {r["bin"]: r["n"] for r in order.levels.groupBy("bin").agg(F.sum("n_rows").alias("n")).collect()}
    assert sorted(counts) == list(range(32)) and max(counts.values()) - min(counts.values()) <= 8
    none = ordered.order_levels(df.limit(0), "key", "label")
    assert none.levels.count() == 0 and {r["bin"] for r in none.apply(df.limit(3), F.col("id"), "bin").collect()} == {0}
