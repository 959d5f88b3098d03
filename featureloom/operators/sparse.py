"""Category features as rows and sparse vectors, for columns with any number of values (survey E1, A13, L2).

``one_hot`` makes a column of each category. Here the categories are rows of an
index table (name, value, position); entities join it and hold only the positions
they have. No category reaches the driver, and no plan grows with them.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpoint_path
from ..sources.ordinal import file_ordinal


def _pairs(df: DataFrame, key: list, columns: Sequence[str]) -> DataFrame:
    """(key, name, value) of every row and column."""
    return df.select(*key, F.inline(F.array(*[
        F.struct(F.lit(c).alias("name"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns])))


def category_index(df: DataFrame, columns: Sequence[str], missing: bool = True, path: str | None = None) -> DataFrame:
    """(name, value, position) of every category, position 0, 1, 2, ... by name and value.

    With ``missing``, every column has the value NULL, first of its name, whether
    it occurs or not. The index is a table at ``path`` (default: the checkpoint
    folder), range-partitioned for one sort, numbered in file order; read it again
    to encode new rows, whose unknown values then have no position.
    """
    spark = df.sparkSession
    base = path or checkpoint_path(spark, f"categories-{uuid.uuid4().hex}")
    found = _pairs(df, [], columns).where("value is not null").distinct()
    if missing:
        found = found.unionByName(spark.createDataFrame([(c, None) for c in columns], "name string, value string"))
    found.repartitionByRange("name", "value").sortWithinPartitions("name", "value").write.parquet(f"{base}/values")
    file_ordinal(spark.read.parquet(f"{base}/values"), "position").write.parquet(f"{base}/index")
    return spark.read.parquet(f"{base}/index")


def sparse_counts(df: DataFrame, key: str, columns: Sequence[str], index: DataFrame) -> DataFrame:
    """(key, rows, positions, counts): the categories of each key's rows, by position, with their counts.

    Rows are counted by (key, name, value) with map-side combine before the index
    is joined, so a key or category with a third of the rows sends a row a task.
    The index is a written table: Spark broadcasts it while small; beyond that both
    sides are plain exchanges, where AQE splits a value that very many keys share.
    NULL keys are dropped; values without a position count as rows only.
    """
    counts = _pairs(df.where(F.col(key).isNotNull()), [F.col(key).alias("key")], columns) \
        .groupBy("key", "name", "value").agg(F.count(F.lit(1)).alias("n"))
    # one non-null text for the pair: a plain equi-join, NULL included
    pair = F.concat_ws("=", "name", F.col("value"))
    on = [F.length("name").alias("_w"), pair.alias("_pair"), F.col("value").isNull().alias("_none")]
    joined = counts.select("key", "name", "n", *on).join(index.select("position", *on), ["_w", "_pair", "_none"], "left")
    entry = F.when(F.col("position").isNotNull(), F.struct("position", "n"))
    got = joined.groupBy("key").agg(F.sum(F.when(F.col("name") == columns[0], F.col("n"))).alias("rows"),
                                    F.array_sort(F.collect_list(entry)).alias("entries"))
    return got.select(F.col("key").alias(key), "rows", F.col("entries.position").alias("positions"), F.col("entries.n").alias("counts"))


def sparse_vectors(counts: DataFrame, index: DataFrame, share: bool = True, out: str = "features") -> DataFrame:
    """``counts`` with a sparse ML vector: each category's share of the key's rows, or its count.

    The vector is made by Spark's own expressions; its size is the index's row count.
    """
    size = index.count()
    value = F.transform("counts", lambda n: (n / F.col("rows")) if share else n.cast("double"))
    parts = F.struct(F.struct(F.lit(0).cast("byte").alias("type"), F.lit(size).cast("int").alias("size"),
                              F.col("positions").cast("array<int>").alias("indices"), value.alias("values")).alias("v"))
    schema = T.StructType([T.StructField("v", VectorUDT())])
    return counts.withColumn(out, F.from_json(F.to_json(parts), schema)["v"])
