"""Row-wise (horizontal) statistics over a list of columns (survey R1-R5).

Spark has column aggregates but no row aggregates. The column list is known
when the plan is built, so each statistic is unrolled into plain arithmetic
over the columns (``coalesce``/``isNotNull`` to skip missing values): the
result is an ordinary Catalyst expression that whole-stage codegen compiles,
with repeated sub-expressions (the row mean) evaluated once. Missing-value
rules follow pandas ``axis=1`` reductions (N10, N11, N16).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: pandas treats a kurtosis denominator below this as zero
# (floating-point noise) and then reports kurtosis 0.
KURT_FPERR = 1e-14


def _cols(cols: Sequence[str | Column]) -> list[Column]:
    return [(F.col(c) if isinstance(c, str) else c).cast("double") for c in cols]


def _total(terms: list[Column]) -> Column:
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def row_count(cols: Sequence[str | Column]) -> Column:
    """Number of non-missing values."""
    cs = _cols(cols)
    if not cs:
        return F.lit(0)
    return _total([c.isNotNull().cast("int") for c in cs])


def row_sum(cols: Sequence[str | Column]) -> Column:
    """Sum skipping missing; all missing -> 0."""
    cs = _cols(cols)
    if not cs:
        return F.lit(0.0)
    return _total([F.coalesce(c, F.lit(0.0)) for c in cs])


def row_mean(cols: Sequence[str | Column]) -> Column:
    """Mean skipping missing; all missing -> NULL."""
    return F.try_divide(row_sum(cols), row_count(cols).cast("double"))


def _moment_sum(cols: Sequence[str | Column], mean: Column, power: int) -> Column:
    def pw(d: Column) -> Column:
        return d * d if power == 2 else (d * d) * (d * d)
    return _total([F.coalesce(pw(c - mean), F.lit(0.0)) for c in _cols(cols)])


def row_std(cols: Sequence[str | Column], ddof: int = 1) -> Column:
    """Sample standard deviation skipping missing; fewer than ddof+1 values
    -> NULL (R4, N11)."""
    n = row_count(cols).cast("double")
    mean = row_sum(cols) / n
    return F.when(n > ddof, F.sqrt(_moment_sum(cols, mean, 2) / (n - F.lit(float(ddof)))))


def row_kurtosis(cols: Sequence[str | Column]) -> Column:
    """Bias-corrected excess kurtosis skipping missing.

    n < 4 -> NULL; a (numerically) zero denominator -> 0; otherwise
    n(n+1)(n-1)*m4 / ((n-2)(n-3)*m2^2) - 3(n-1)^2/((n-2)(n-3))
    with m2, m4 the sums of squared / fourth-power deviations.
    """
    n = row_count(cols).cast("double")
    mean = row_sum(cols) / n
    m2 = _moment_sum(cols, mean, 2)
    m4 = _moment_sum(cols, mean, 4)
    num = n * (n + 1) * (n - 1) * m4
    den = (n - 2) * (n - 3) * m2 * m2
    adj = F.lit(3.0) * (n - 1) * (n - 1) / ((n - 2) * (n - 3))
    return (F.when(n < 4, F.lit(None).cast("double"))
            .when(F.abs(den) < KURT_FPERR, F.lit(0.0))
            .otherwise(num / den - adj))


def row_product(cols: Sequence[str | Column]) -> Column:
    """Product; any missing value -> NULL."""
    cs = _cols(cols)
    out = cs[0]
    for c in cs[1:]:
        out = out * c
    return out


ROW_STATS = ("count", "sum", "mean", "std", "kurt", "prod")


def with_row_stats(df, cols: Sequence[str], outputs: dict[str, str], ddof: int = 1):
    """Add several row statistics of ``cols`` to ``df`` in staged projections.

    ``outputs`` maps a statistic (``count sum mean std kurt prod``) to its
    output column. Same semantics as the single-expression functions above,
    but the count, sum, mean and the per-column deviations are computed once
    as intermediate columns: Catalyst does not re-inline a non-trivial
    expression that the next projection uses several times, so the
    generated code stays small (the one-expression kurtosis repeats the row
    mean dozens of times).
    """
    bad = set(outputs) - set(ROW_STATS)
    if bad:
        raise ValueError(f"unknown row statistics {sorted(bad)}")
    cs = _cols(cols)
    tmp_n, tmp_s, tmp_mu = "__rs_n", "__rs_s", "__rs_mu"
    devs = [f"__rs_d{i}" for i in range(len(cs))]
    out = df.withColumns({tmp_n: row_count(cols).cast("double"), tmp_s: row_sum(cols)})
    out = out.withColumn(tmp_mu, F.try_divide(F.col(tmp_s), F.col(tmp_n)))  # n = 0 -> NULL
    need_moments = "std" in outputs or "kurt" in outputs
    if need_moments:
        out = out.withColumns({d: c - F.col(tmp_mu) for d, c in zip(devs, cs)})
        sq = [F.coalesce(F.col(d) * F.col(d), F.lit(0.0)) for d in devs]
        fourth = [F.coalesce((F.col(d) * F.col(d)) * (F.col(d) * F.col(d)), F.lit(0.0)) for d in devs]
        out = out.withColumns({"__rs_m2": _total(sq), "__rs_m4": _total(fourth)})
    n, m2, m4 = F.col(tmp_n), F.col("__rs_m2"), F.col("__rs_m4")
    final = {}
    for stat, name in outputs.items():
        if stat == "count":
            final[name] = n.cast("int")
        elif stat == "sum":
            final[name] = F.col(tmp_s)
        elif stat == "mean":
            final[name] = F.try_divide(F.col(tmp_s), n)
        elif stat == "prod":
            final[name] = row_product(cols)
        elif stat == "std":
            final[name] = F.when(n > ddof, F.sqrt(m2 / (n - F.lit(float(ddof)))))
        elif stat == "kurt":
            den = (n - 2) * (n - 3) * m2 * m2
            final[name] = (F.when(n < 4, F.lit(None).cast("double"))
                           .when(F.abs(den) < KURT_FPERR, F.lit(0.0))
                           .otherwise(n * (n + 1) * (n - 1) * m4 / den
                                      - F.lit(3.0) * (n - 1) * (n - 1) / ((n - 2) * (n - 3))))
    out = out.withColumns(final)
    drop = [tmp_n, tmp_s, tmp_mu] + (devs + ["__rs_m2", "__rs_m4"] if need_moments else [])
    return out.drop(*drop)
