"""Left equi-join that survives missing and heavy keys (survey J1, J2, F2).

A plain left join sends all rows of one key to one task: rows without a key match
nothing and yet meet in a single partition, and AQE cannot split a partition whose
other side is aggregated above its exchange. Here rows without a key bypass the
join, and keys found heavy by a sketch are salted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRACKED = 10_000  # items the sketch follows; counts are off by at most rows / (0.75 * TRACKED)


def heavy_keys(df: DataFrame, key: str, share: float, most: int = 256) -> list:
    """Keys that hold about ``share`` of the rows or more, by one pass with a frequent-items sketch.

    At most ``1 / share`` keys can; ``most`` bounds how many reach the driver.
    """
    k = max(1, min(most, int(1 / share) + 1))
    found = df.where(F.col(key).isNotNull()).agg(
        F.expr(f"approx_top_k(`{key}`, {k}, {TRACKED})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    return [t["item"] for t in found["top"] or [] if t["count"] >= share * found["n"]]


def skew_left_join(left: DataFrame, right: DataFrame, key: str, heavy: list | None = None, salts: int = 32) -> DataFrame:
    """``left`` LEFT JOIN ``right`` on ``key``, the same rows as a plain join, columns of ``left`` then of ``right``.

    Left rows with a NULL key are not shuffled. Left rows of the ``heavy`` keys
    (:func:`heavy_keys`; None: no salting) are dealt to ``salts`` tasks by a hash of
    the whole row, and the right rows of these keys, few by assumption, are repeated
    for each salt. Names clash as in a plain join on a column name: rename before.
    """
    more = [f for f in right.schema.fields if f.name != key]
    without = left.where(F.col(key).isNull()).select("*", *(F.lit(None).cast(f.dataType).alias(f.name) for f in more))
    keyed, other, on = left.where(F.col(key).isNotNull()), right, [key]
    if heavy:
        salt = "_salt"
        while salt in left.columns or salt in right.columns:
            salt += "_"
        plain = [F.col(f"`{c}`") for c in left.columns if not _has_map(left, c)]
        keyed = keyed.withColumn(salt, F.when(F.col(key).isin(heavy), F.pmod(F.xxhash64(*plain), F.lit(salts)).cast("int")).otherwise(0))
        every = F.when(F.col(key).isin(heavy), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
        other, on = right.withColumn(salt, F.explode(every)), [key, salt]
    joined = keyed.join(other, on, "left").select(*(F.col(f"`{c}`") for c in left.columns), *(F.col(f"`{f.name}`") for f in more))
    return joined.unionByName(without)


def _has_map(df: DataFrame, column: str) -> bool:
    return "map<" in df.schema[column].dataType.simpleString()
