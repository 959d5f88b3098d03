"""Joins with missing and heavy keys, bucketed blocks, mergeable sketches."""

import random

import pytest
from pyspark.sql import functions as F

from featureloom.operators.assemble import left_star
from featureloom.operators.sketches import RANK_ERROR, distinct_count, merge_sketches, quantile, sketch_groups
from featureloom.operators.skew import heavy_keys, skew_left_join
from featureloom.sources.bucketed import drop_tables, write_bucketed


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(1)
    rows = [(i, None if i % 2 else 7 if i % 3 == 0 else rng.randrange(500)) for i in range(6000)]
    return spark.createDataFrame(rows, "n long, k long").repartition(4)


def test_the_same_rows_as_a_plain_join(spark, skewed):
    right = spark.createDataFrame([(k, f"v{k}", k % 3) for k in range(0, 500, 2)] + [(7, "twice", 1), (None, "null", 0)], "k long, v string, _salt int")
    heavy = heavy_keys(skewed, "k", 0.05)
    assert heavy == [7]
    want = sorted(map(repr, skewed.join(right, "k", "left").select("n", "k", "v", "_salt").collect()))
    for keys in (None, heavy, [7, 2, 499]):
        got = skew_left_join(skewed, right, "k", keys, salts=5)
        assert got.columns == ["n", "k", "v", "_salt"] and sorted(map(repr, got.collect())) == want
    assert heavy_keys(skewed.limit(0), "k", 0.1) == []


def test_no_task_holds_the_missing_or_the_heavy_key(spark, skewed):
    right = spark.range(500).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    before = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    try:
        for c, v in zip(before, ("-1", "16", "false")):
            spark.conf.set(c, v)
        sizes = {}
        for name, df in (("plain", skewed.join(right, "k", "left")), ("split", skew_left_join(skewed, right, "k", [7]))):
            parts = df.groupBy(F.spark_partition_id()).count().toPandas()["count"]
            sizes[name] = parts.max() / parts.median()
        assert sizes["plain"] > 5 and sizes["split"] < 5
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)


def test_bucketed_blocks_join_without_an_exchange(spark, tmp_path):
    base = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("a"))
    block = spark.range(0, 1000, 3).select(F.col("id").alias("k"), F.lit(1).alias("b"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tables = [write_bucketed(df, f"bucketed_{n}", "k", 4, str(tmp_path / n)) for n, df in (("x", base), ("y", block), ("z", block))]
        joined = left_star(tables[0], "k", [tables[1], tables[2].withColumnRenamed("b", "c")])
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and plan.count("SortMergeJoin") == 2
        assert joined.count() == 1000 and joined.where("b = 1 and c = 1").count() == 334
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        drop_tables(spark, "bucketed_x", "bucketed_y", "bucketed_z")


def test_stored_sketches_merge_within_their_bounds(spark, tmp_path):
    rng = random.Random(2)
    rows = [("hot" if i % 3 else rng.choice("ab"), i % 5, rng.gauss(0, 1), rng.randrange(3000)) for i in range(20_000)] + [(None, 0, 1.0, 1)]
    df = spark.createDataFrame(rows, "g string, day int, x double, u int")
    sketch_groups(df, ["g", "day"], ["x"], ["u"]).write.parquet(str(tmp_path / "s"))
    got = {r.g: r for r in merge_sketches(spark.read.parquet(str(tmp_path / "s")), ["g"]).select(
        "g", "rows", quantile("x", 0.5).alias("m"), distinct_count("u").alias("d")).collect()}
    assert set(got) == {"hot", "a", "b"}
    for g, r in got.items():
        x = sorted(v for k, _, v, _ in rows if k == g)
        exact = len({u for k, _, _, u in rows if k == g})
        assert r.rows == len(x) and abs(sum(v <= r.m for v in x) / len(x) - 0.5) <= 2 * RANK_ERROR[200]
        assert abs(r.d - exact) <= 0.05 * exact
