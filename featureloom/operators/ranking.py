"""Order-dependent operators that must not run in one partition.

* :func:`prefix_before` -- for every row, the total weight of the rows of its
  group that sort strictly before it. Global ``Window.orderBy`` would pull all
  data into one task, and a window per group would do the same for a hot
  group, so instead: range-partition on (group, order) -- which splits a hot
  group over many partitions --, cumulate inside each partition
  (``mapInPandas`` on sorted partitions), freeze the result with a reliable
  ``checkpoint()``, and add offsets for the groups that cross partition
  boundaries (at most 2 x #partitions rows, broadcast).
* :func:`exact_median` -- exact median per group on top of that (A8).
* :func:`top_k`, :func:`head` -- ordered limits (O1-O3, S2, S4).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir


def _num_slices(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return num_partitions
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


_NULL_KEY = "\x00<null>"


def _run_ids(pdf: pd.DataFrame, group_cols: list[str]) -> np.ndarray:
    """Ids of the runs of equal group key in a batch sorted by group."""
    change = np.zeros(len(pdf), dtype=bool)
    for g in group_cols:
        col = pdf[g].astype(object).where(pdf[g].notna(), _NULL_KEY)
        change |= (col != col.shift()).to_numpy()
    if len(change):
        change[0] = False
    return np.cumsum(change)


def _key_at(pdf: pd.DataFrame, group_cols: list[str], i: int) -> tuple:
    return tuple(_NULL_KEY if pd.isna(pdf[g].iloc[i]) else pdf[g].iloc[i] for g in group_cols)


def prefix_before(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str],
                  weight_cols: Sequence[str], num_partitions: int | None = None,
                  checkpoint: bool = True, with_totals: bool = False) -> DataFrame:
    """Add ``<w>_before`` = sum of ``w`` over rows of the same group with a
    strictly smaller order key, for each weight column ``w`` (and, with
    ``with_totals``, ``<w>_total`` = the group's sum).

    Order keys should be unique within a group (aggregate duplicates first);
    rows with equal keys are cumulated in an arbitrary but fixed order.

    Plan: range-partition on (group, order) and sort inside partitions; one
    ``mapInPandas`` pass adds, batch by batch, the running weight of each group
    inside the partition (one number per weight is carried from batch to batch,
    no partition is held); the result is checkpointed (partition ids stay fixed
    if executors are lost). Only a group that crosses a partition boundary
    needs an offset from earlier partitions, and range partitioning creates at
    most 2 x #partitions such (partition, group) pairs: that small table is
    broadcast (a proven bound) and the data itself is not shuffled again. Group
    totals have one row a group and join on (partition, group).
    """
    group_cols, order_cols, weight_cols = list(group_cols), list(order_cols), list(weight_cols)
    n = _num_slices(df, num_partitions)
    ranged = (df.repartitionByRange(n, *[F.col(c) for c in group_cols + order_cols])
              .sortWithinPartitions(*(group_cols + order_cols)))
    local_names = [f"_{w}_local" for w in weight_cols]
    part_names = [f"_{w}_ptotal" for w in weight_cols]
    out_schema = T.StructType(
        list(ranged.schema.fields)
        + [T.StructField("_pid", T.IntegerType(), False)]
        + [T.StructField(n_, T.DoubleType(), False) for n_ in local_names])

    def local_cumulate(batches):
        # Rows arrive sorted by (group, order). Every batch is emitted as it
        # comes; the group still open at its end leaves one number per weight.
        from pyspark import TaskContext
        pid = TaskContext.get().partitionId()
        open_key, carried = None, [0.0] * len(weight_cols)
        for pdf in batches:
            if pdf.empty:
                continue
            pdf = pdf.reset_index(drop=True)
            runs = _run_ids(pdf, group_cols)
            go_on = _key_at(pdf, group_cols, 0) == open_key
            out = pdf.assign(_pid=pid)
            for k, (w, ln) in enumerate(zip(weight_cols, local_names)):
                wv = pdf[w].astype("float64").fillna(0.0)
                start = np.where((runs == 0) & go_on, carried[k], 0.0)
                upto = wv.groupby(runs, sort=False).cumsum() + start
                out[ln] = upto - wv
                carried[k] = float(upto.iloc[-1])
            open_key = _key_at(pdf, group_cols, len(pdf) - 1)
            yield out

    local = ranged.mapInPandas(local_cumulate, out_schema)
    if checkpoint:
        ensure_checkpoint_dir(df.sparkSession)
        local = local.checkpoint(eager=True)
    # (partition, group) weights: at most #partitions + #groups rows
    parts = local.groupBy("_pid", *group_cols).agg(
        *[F.coalesce(F.sum(F.col(w).cast("double")), F.lit(0.0)).alias(pn)
          for w, pn in zip(weight_cols, part_names)])
    w_grp = Window.partitionBy(*[F.col(c) for c in group_cols])
    w_before = w_grp.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = [F.coalesce(F.sum(pn).over(w_before), F.lit(0.0)).alias(f"_{w}_offset")
               for w, pn in zip(weight_cols, part_names)]
    totals = [F.sum(pn).over(w_grp).alias(f"_{w}_total") for w, pn in zip(weight_cols, part_names)]
    spans = parts.select("_pid", *group_cols, F.count(F.lit(1)).over(w_grp).alias("_nparts"), *offsets, *totals)
    if with_totals:
        # every (partition, group) pair: as many rows as groups, a plain join
        side = spans
    else:
        # only groups that cross a partition boundary: <= 2 x #partitions rows
        side = F.broadcast(spans.where(F.col("_nparts") > 1))
    l, r = local.alias("l"), side.alias("r")
    cond = F.col("l._pid") == F.col("r._pid")
    for g in group_cols:
        cond = cond & F.col(f"l.{g}").eqNullSafe(F.col(f"r.{g}"))
    joined = l.join(r, cond, "left")
    out = [F.col(f"l.{c}") for c in df.columns]
    out += [(F.coalesce(F.col(f"r._{w}_offset"), F.lit(0.0)) + F.col(f"l.{ln}")).alias(f"{w}_before")
            for w, ln in zip(weight_cols, local_names)]
    if with_totals:
        out += [F.col(f"r._{w}_total").alias(f"{w}_total") for w in weight_cols]
    return joined.select(*out)


def exact_median(df: DataFrame, group_cols: Sequence[str], value_col: str,
                 out_col: str = "median", num_partitions: int | None = None) -> DataFrame:
    """Exact median of ``value_col`` per group (A8), interpolating between the
    two middle values for an even count; NULL values and NULL groups dropped.

    One plan at every size: values are counted per (group, value) (map-side
    combine), then ranked with :func:`prefix_before` (range partitioning splits
    a hot group), so no task holds a whole group.
    """
    group_cols = list(group_cols)
    valid = F.col(value_col).isNotNull()
    for g in group_cols:
        valid = valid & F.col(g).isNotNull()
    rows = df.where(valid)
    counts = (rows.groupBy(*group_cols, value_col)
              .agg(F.count(F.lit(1)).cast("double").alias("_c")))
    # group sizes ride along the (partition, group) offsets: no join on the
    # bare group key, which would put a hot group into one task
    ranked = prefix_before(counts, group_cols, [value_col], ["_c"], num_partitions,
                           with_totals=True).withColumnRenamed("_c_total", "_n")
    k_lo = F.floor((F.col("_n") - 1) / 2)
    k_hi = F.floor(F.col("_n") / 2)
    start, end = F.col("_c_before"), F.col("_c_before") + F.col("_c")
    hit_lo = (start <= k_lo) & (k_lo < end)
    hit_hi = (start <= k_hi) & (k_hi < end)
    picked = ranked.where(hit_lo | hit_hi)  # at most two rows per group
    res = picked.groupBy(*group_cols).agg(
        F.max(F.when(hit_lo, F.col(value_col))).cast("double").alias("_lo"),
        F.max(F.when(hit_hi, F.col(value_col))).cast("double").alias("_hi"))
    return res.select(*group_cols, ((F.col("_lo") + F.col("_hi")) / 2).alias(out_col))


def top_k(df: DataFrame, k: int, order_col: str, tie_cols: Sequence[str] = (),
          descending: bool = True) -> DataFrame:
    """First ``k`` rows by ``order_col`` with a deterministic tie-break (O2).

    Planned as TakeOrderedAndProject: each partition keeps its own top k, so
    only k rows per partition move.
    """
    first = F.col(order_col).desc_nulls_last() if descending else F.col(order_col).asc_nulls_last()
    return df.orderBy(first, *[F.col(c).asc() for c in tie_cols]).limit(k)


def head(df: DataFrame, n: int, order_cols: Sequence[str] | None = None) -> DataFrame:
    """First-n rows (S2, S4, O3). With ``order_cols`` the result is
    reproducible; without, it is whatever rows the scan yields first."""
    if order_cols:
        return df.orderBy(*order_cols).limit(n)
    return df.limit(n)


def sort_desc(df: DataFrame, col: str, tie_cols: Sequence[str] = ()) -> DataFrame:
    """Sort descending with a tie key (O1); a distributed range sort."""
    return df.orderBy(F.col(col).desc_nulls_last(), *[F.col(c).asc() for c in tie_cols])
