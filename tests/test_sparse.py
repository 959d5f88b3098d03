"""Category features as rows and sparse vectors."""

import random
from collections import Counter

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from featureloom.operators.sparse import category_index, sparse_counts, sparse_vectors


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    out = [(rng.randrange(300) if k % 3 else 7, rng.choice(["a", "b=c", "", "nan", None]), rng.choice([1, 2, None])) for k in range(3000)]
    return out + [(None, "only", 9), (301, None, None)]


def test_counts_equal_a_plain_count(spark, rows):
    df = spark.createDataFrame(rows, "k long, `x.y` string, z int").repartition(4)
    index = category_index(df, ["x.y", "z"])
    at = {(r["name"], r["value"]): r["position"] for r in index.collect()}
    order = sorted(at, key=lambda p: (p[0], p[1] is not None, p[1] or ""))
    assert [at[p] for p in order] == list(range(len(order)))
    assert set(at) == {("x.y", r[1]) for r in rows} | {("z", None if r[2] is None else str(r[2])) for r in rows}
    want = {}
    for k, x, z in rows:
        if k is not None:
            want.setdefault(k, Counter()).update([at["x.y", x], at["z", None if z is None else str(z)]])
    got = sparse_counts(df, "k", ["x.y", "z"], index)
    assert {r.k: (r["rows"], list(zip(r.positions, r.counts))) for r in got.collect()} == \
        {k: (sum(c.values()) // 2, sorted(c.items())) for k, c in want.items()}


def test_unknown_values_have_no_position(spark):
    index = category_index(spark.createDataFrame([("a",)], "c string"), ["c"], missing=False)
    new = spark.createDataFrame([(1, "a"), (1, "z"), (2, "z"), (2, None)], "k long, c string")
    got = {r.k: r for r in sparse_vectors(sparse_counts(new, "k", ["c"], index), index).collect()}
    assert (got[1]["rows"], got[1].positions, got[1].counts) == (2, [0], [1]) and got[1].features.toArray().tolist() == [0.5]
    assert (got[2]["rows"], got[2].positions) == (2, []) and got[2].features.size == 1
    none = spark.createDataFrame([], "k long, c string")
    assert sparse_counts(none, "k", ["c"], category_index(none, ["c"])).collect() == []


def test_a_column_of_many_values_trains_without_a_pivot(spark):
    df = spark.range(60_000).select((F.col("id") % 40_000).alias("k"), F.concat(F.lit("v"), F.col("id") % 20_000).alias("c"),
                                    F.when(F.col("id") % 2 == 0, "even").otherwise("odd").alias("d"))
    index = category_index(df, ["c", "d"])
    vectors = sparse_vectors(sparse_counts(df, "k", ["c", "d"], index), index).withColumn("y", (F.col("k") % 2).cast("double"))
    first = vectors.first().features
    assert first.size == 20_004 and len(first.indices) == 2
    model = LogisticRegression(featuresCol="features", labelCol="y", maxIter=5).fit(vectors)
    at = {r["value"]: r["position"] for r in index.where("name = 'd'").collect()}
    assert model.coefficients[at["odd"]] > 0 > model.coefficients[at["even"]]
    assert vectors.columns == ["k", "rows", "positions", "counts", "features", "y"]
