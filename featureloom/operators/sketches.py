"""Mergeable sketches of groups: quantiles (KLL) and distinct counts (HLL), opt-in beside A8 and A9.

The exact operators stay the default. Sketches can be stored, one row a group,
and merged over days or partitions without the rows they were made from; a hot
group costs each task one sketch. Errors: the rank of a KLL quantile is off by
about 1.33 % of the rows at k = 200 (less for larger k), an HLL count by about
1.6 % at 12 bits (one standard deviation).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RANK_ERROR = {200: 0.0133, 400: 0.0068, 800: 0.0035}


def sketch_groups(df: DataFrame, keys: Sequence[str], quantiles: Sequence[str] = (), distincts: Sequence[str] = (),
                  k: int = 200, bits: int = 12) -> DataFrame:
    """One row a group: ``rows``, ``<c>_kll`` and ``<c>_hll`` binary sketches. NULL keys are dropped, NULL values ignored."""
    kept = df.where(F.lit(True))
    for key in keys:
        kept = kept.where(F.col(key).isNotNull())
    return kept.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"),
        *(F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(k)).alias(f"{c}_kll") for c in quantiles),
        *(F.hll_sketch_agg(c, F.lit(bits)).alias(f"{c}_hll") for c in distincts))


def merge_sketches(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Merge stored sketches (rows of :func:`sketch_groups`, any number a group) into one row for each value of ``keys``."""
    merged = [F.sum("rows").alias("rows")]
    for c in sketches.columns:
        if c.endswith("_kll"):
            merged.append(F.kll_merge_agg_double(c).alias(c))
        elif c.endswith("_hll"):
            merged.append(F.hll_union_agg(c).alias(c))
    return sketches.groupBy(*keys).agg(*merged)


def quantile(column: str, share: float) -> Column:
    """The value at ``share`` of the ordered values of a sketched column."""
    return F.kll_sketch_get_quantile_double(f"{column}_kll", F.lit(share))


def distinct_count(column: str) -> Column:
    return F.hll_sketch_estimate(f"{column}_hll")
