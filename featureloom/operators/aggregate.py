"""Specification-driven group aggregates (survey A1-A17).

A *spec* is ``{column: [function, ...]}`` with functions from
:data:`AGG_FUNCS`. Output labels are flattened ``PREFIX + COL + '_' + FUNC``.

Everything a feature block needs is emitted by ONE ``groupBy(key).agg(...)``:

* numeric spec (A1-A7, A9);
* category shares straight from the string column, never materialising the
  one-hot matrix (A11);
* *subset views* (A10): the same spec over the rows matching a condition,
  as filtered aggregates ``fn(CASE WHEN cond THEN x END)``. The pandas
  original filtered, grouped and left-joined each view -- three scans and
  three shuffles; here it is one scan and one shuffle. The null contract
  is kept: a key without rows in a view gets NULL for every view feature
  (N2), a sum over only-missing values is 0 (N1).

All functions used are algebraic (partial aggregation map-side, so a hot
key costs one small partial row per task, not a hot reducer), except
``nunique`` which Spark plans as a (key, value) pre-aggregation followed by a
per-key count -- also skew-safe.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import agg_name, numeric_columns
from .encode import CategoryDictionary, indicator_name

Spec = Mapping[str, Sequence[str]]

AGG_FUNCS = ("min", "max", "mean", "sum", "var", "std", "size", "count", "nunique")


@dataclass
class View:
    """A subset view: rows where ``condition`` holds, aggregated with ``spec``
    under ``prefix`` (A10)."""
    prefix: str
    condition: Column
    spec: Spec = field(default_factory=dict)


def _agg(func: str, x: Column) -> Column:
    if func == "min":
        return F.min(x)
    if func == "max":
        return F.max(x)
    if func == "mean":
        return F.avg(x)
    if func == "sum":
        return F.sum(x)
    if func == "var":
        return F.var_samp(x)          # n-1 denominator, NULL for n < 2 (N3)
    if func == "std":
        return F.stddev_samp(x)
    if func == "count":
        return F.count(x)             # non-missing values
    if func == "nunique":
        return F.count_distinct(x)    # ignores missing (N4)
    raise ValueError(f"unknown aggregate function {func!r}")


def spec_exprs(spec: Spec, prefix: str = "", condition: Column | None = None) -> list[Column]:
    """Aggregate expressions for a spec, optionally restricted to a view."""
    out = []
    if condition is None:
        for col, funcs in spec.items():
            for f in funcs:
                name = agg_name(prefix, col, f)
                if f == "size":
                    out.append(F.count(F.lit(1)).alias(name))           # rows incl. missing (N4)
                elif f == "sum":
                    out.append(F.coalesce(F.sum(F.col(col)), F.lit(0)).alias(name))  # N1
                else:
                    out.append(_agg(f, F.col(col)).alias(name))
        return out
    rows_in_view = F.count_if(condition)
    present = rows_in_view > 0
    for col, funcs in spec.items():
        x = F.when(condition, F.col(col))
        for f in funcs:
            name = agg_name(prefix, col, f)
            if f == "size":
                out.append(F.when(present, rows_in_view).alias(name))
            elif f == "sum":
                out.append(F.when(present, F.coalesce(F.sum(x), F.lit(0))).alias(name))
            elif f in ("count", "nunique"):
                out.append(F.when(present, _agg(f, x)).alias(name))
            else:
                out.append(_agg(f, x).alias(name))
    return out


def share_exprs(categories: CategoryDictionary | Mapping[str, Sequence[str]],
                prefix: str = "", nan_indicator: bool = True, suffix: str = "_MEAN",
                columns: Sequence[str] | None = None,
                condition: Column | None = None) -> list[Column]:
    """Per-key share of every category (A11): the mean of its one-hot
    indicator, computed from the string column. ``<col>_nan`` is the share
    of missing values."""
    cats = categories.categories if isinstance(categories, CategoryDictionary) else categories
    columns = list(cats) if columns is None else list(columns)
    out = []
    for c in columns:
        tests = [(v, F.col(c).eqNullSafe(F.lit(v))) for v in cats[c]]
        if nan_indicator:
            tests.append((None, F.col(c).isNull()))
        for v, t in tests:
            ind = t.cast("double")
            if condition is not None:
                ind = F.when(condition, ind)
            out.append(F.avg(ind).alias(f"{prefix}{indicator_name(c, v)}{suffix}"))
    return out


def rate_exprs(column: str, values: Sequence[str], prefix: str) -> list[Column]:
    """Per-key rate of each value: count of the value / row count."""
    total = F.count(F.lit(1))
    return [F.try_divide(F.count_if(F.col(column) == F.lit(v)).cast("double"),
                         total.cast("double")).alias(f"{prefix}{v}") for v in values]


def agg_features(df: DataFrame, key: str | Sequence[str], spec: Spec | None = None,
                 prefix: str = "", categories: CategoryDictionary | Mapping | None = None,
                 nan_indicator: bool = True, views: Sequence[View] = (),
                 count_name: str | None = None, extra: Sequence[Column] = ()) -> DataFrame:
    """One ``groupBy(key).agg`` holding a numeric spec, category shares,
    subset views and an optional row count column (A1-A11, J6).

    Rows with a NULL key are dropped first (N6).
    """
    keys = [key] if isinstance(key, str) else list(key)
    exprs: list[Column] = []
    exprs += spec_exprs(spec or {}, prefix)
    if categories is not None:
        exprs += share_exprs(categories, prefix, nan_indicator)
    for v in views:
        exprs += spec_exprs(v.spec if v.spec else (spec or {}), v.prefix, v.condition)
    if count_name:
        exprs.append(F.count(F.lit(1)).alias(count_name))
    exprs += list(extra)
    if not exprs:
        raise ValueError("nothing to aggregate")
    valid = None
    for k in keys:
        valid = F.col(k).isNotNull() if valid is None else valid & F.col(k).isNotNull()
    return df.where(valid).groupBy(*keys).agg(*exprs)


def all_columns_spec(df: DataFrame, funcs: Sequence[str], exclude: Sequence[str]) -> dict:
    """The same function list over every remaining numeric column."""
    return {c: list(funcs) for c in numeric_columns(df, exclude)}


def two_level_aggregate(child: DataFrame, child_key: str, child_spec: Spec,
                        parent: DataFrame, parent_key: str, parent_spec: Spec,
                        prefix: str = "", child_categories=None,
                        child_nan_indicator: bool = True,
                        parent_categories=None, parent_views: Sequence[View] = (),
                        drop_child_key: bool = True) -> DataFrame:
    """Aggregate ``child`` per ``child_key``, left-join onto ``parent`` (which
    is unique per ``child_key``), then aggregate per ``parent_key`` (A12).

    The child-level aggregate is unique per child key, so the join is 1:1
    and never fans out; both aggregates use partial (map-side) aggregation.
    """
    child_agg = agg_features(child, child_key, child_spec, "", child_categories,
                             child_nan_indicator)
    joined = parent.join(child_agg, on=child_key, how="left")
    if drop_child_key:
        joined = joined.drop(child_key)
    return agg_features(joined, parent_key, parent_spec, prefix, parent_categories,
                        views=parent_views)


def category_rates(df: DataFrame, key: str, column: str, values: Sequence[str] | None,
                   prefix: str, total_name: str, base: DataFrame | None = None,
                   base_key: str | None = None) -> DataFrame:
    """Category rates per key with missing -> 0.

    With ``base`` (e.g. all applicants), reproduces "base LEFT JOIN rows,
    then count": a base key without rows counts one (NULL) row, so its total
    is 1 and every rate 0. The rows are aggregated *before* the join, so the
    join is 1:1 and a hot key never reaches a single join task. ``values``
    None: all values that the column holds.
    """
    if values is None:
        from .encode import CategoryDictionary
        values = CategoryDictionary.discover(df, [column])[column]
    rates = agg_features(df, key, None, extra=[F.count(F.lit(1)).alias(total_name),
                                               *rate_exprs(column, values, prefix)])
    if base is None:
        return rates.fillna(0, subset=[f"{prefix}{v}" for v in values])
    bk = base_key or key
    if bk != key:
        rates = rates.withColumnRenamed(key, bk)
    b = base.select(bk).where(F.col(bk).isNotNull())
    out = b.join(rates, on=bk, how="left")
    return out.select(bk, F.coalesce(F.col(total_name), F.lit(1)).cast("long").alias(total_name),
                      *[F.coalesce(F.col(f"{prefix}{v}"), F.lit(0.0)).alias(f"{prefix}{v}")
                        for v in values])


def distinct_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``drop_duplicates`` over a column subset."""
    return df.select(*columns).distinct()


def column_mean(df: DataFrame, column: str) -> Column:
    """Whole-column mean as a scalar-subquery column (A16); evaluated once."""
    return df.agg(F.avg(column)).scalar()


def mean_by(df: DataFrame, key: str, value: str, out: str | None = None) -> DataFrame:
    """Mean of ``value`` per ``key``."""
    return df.groupBy(key).agg(F.avg(value).alias(out or value))
