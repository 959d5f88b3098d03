"""Seeded, shuffled k-fold assignment as a column (survey L1).

The fold of a row is a function of its key and the seed only (an md5 of
``key#seed``), so it is reproducible, needs no driver-side index and is
stable when executors are lost and partitions recomputed.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def key_hash(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f"#{seed}")))


def kfold_column(key: str, k: int, seed: int = 47) -> Column:
    """Plain shuffled k-fold: first 32 bits of the hash, modulo k."""
    h = key_hash(key, seed)
    return F.pmod(F.conv(F.substring(h, 1, 8), 16, 10).cast("long"), F.lit(k)).cast("int")


def stratified_kfold_column(df: DataFrame, key: str, label: Column | str, k: int,
                            seed: int = 47, out_col: str = "fold",
                            hex_digits: int | None = None) -> DataFrame:
    """Exactly balanced (and, per label, stratified) folds.

    Within each label, rows are ranked by their hash and dealt round-robin
    into k folds, so fold sizes per label differ by at most one. The rank is
    computed without a single-partition window: rows are bucketed by the
    first ``hex_digits`` hex digits of the hash (16^hex_digits buckets of
    uniform size; by default more the more shuffle partitions there are), a bucket's offset is the count of the label's rows in
    lower buckets (a table of at most #labels x 16^hex_digits rows, cumulated in two
    steps, by the first half of the digits and inside it, so that no task gets
    more than the square root of a label's buckets), and the rank inside a bucket comes from a window partitioned by (label, bucket).
    """
    lab = F.col(label) if isinstance(label, str) else label
    if hex_digits is None:  # some hundred buckets for each shuffle partition
        partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        hex_digits = max(4, math.ceil(math.log(256 * partitions, 16)))
    # one non-null key for the label: the join and the window hash alike
    x = df.withColumns({"_h": key_hash(key, seed), "_lab": F.coalesce(F.concat(F.lit("="), lab.cast("string")), F.lit("null"))})
    x = x.withColumn("_b", F.substring("_h", 1, hex_digits))
    counts = x.groupBy("_lab", "_b").agg(F.count(F.lit(1)).alias("_cnt"))
    counts = counts.withColumn("_top", F.substring("_b", 1, math.ceil(hex_digits / 2)))
    before = lambda keys, order: F.coalesce(F.sum("_cnt").over(
        Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    tops = counts.groupBy("_lab", "_top").agg(F.sum("_cnt").alias("_cnt")) \
        .select("_lab", "_top", before(["_lab"], "_top").alias("_lower"))
    offsets = counts.select("_lab", "_top", "_b", before(["_lab", "_top"], "_b").alias("_inner")).join(tops, ["_lab", "_top"]) \
        .select("_lab", "_b", (F.col("_lower") + F.col("_inner")).alias("_off"))
    # a NULL label is its own stratum, never dropped
    x = x.join(offsets, ["_lab", "_b"])
    w = Window.partitionBy("_lab", "_b").orderBy("_h", key)
    fold = F.pmod(F.row_number().over(w) - 1 + F.col("_off"), F.lit(k)).cast("int")
    return x.withColumn(out_col, fold).select(*df.columns, out_col)
