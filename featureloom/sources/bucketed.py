"""Feature blocks stored bucketed by the entity key, so that later joins need no shuffle (survey S3, J3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str) -> DataFrame:
    """Write ``df`` as table ``name`` at ``path``, bucketed and sorted by ``key``; returns the table.

    Tables of one number of buckets join on the key without an exchange. The rows
    are dealt to the buckets' tasks first, so each bucket is one file.
    """
    df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key) \
        .option("path", path).option("compression", "zstd").saveAsTable(name)
    return df.sparkSession.table(name)


def drop_tables(spark: SparkSession, *names: str) -> None:
    """Forget tables written with a path; their files stay."""
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS `{name}`")
