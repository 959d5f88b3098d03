"""Loading the driver's TPC-H-ish tables and result-rounding helpers."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def round_doubles(df: DataFrame, digits: int = 6, exclude: tuple = ()) -> DataFrame:
    """Round every double column of a *result* for cross-engine comparison:
    aggregates summed in a different order differ in the last bits."""
    rep = {f.name: F.round(F.col(f.name), digits) for f in df.schema.fields
           if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and f.name not in exclude}
    return df.withColumns(rep) if rep else df


def rnd(c: Column | str, digits: int = 6) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, digits)
