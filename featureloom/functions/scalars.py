"""Scalar column expressions (survey M1-M7, P5, P13, X1).

All of them are plain Catalyst expressions, so they stay inside whole-stage
codegen and can be pushed around freely by the optimizer.

Division follows rule D1: x/0 and 0/0 become NULL (``try_divide``) instead of
the +-inf / NaN the pandas original produced; ANSI mode stays on.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Fixed value: the "not a date" sentinel of the credit tables' DAYS_* columns.
DAYS_SENTINEL = 365243


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_ratio(a: ColumnOrName, b: ColumnOrName) -> Column:
    """``a / b`` as double; zero denominator gives NULL (M1)."""
    return F.try_divide(_col(a).cast("double"), _col(b).cast("double"))


def shifted_ratio(a: ColumnOrName, b: ColumnOrName, shift: float = 1.0) -> Column:
    """``a / (shift + b)`` (M2)."""
    return F.try_divide(_col(a).cast("double"), F.lit(shift) + _col(b).cast("double"))


def difference(a: ColumnOrName, b: ColumnOrName) -> Column:
    """``a - b`` (M3); NULL if either side is NULL."""
    return _col(a) - _col(b)


def clamp_zero(x: ColumnOrName) -> Column:
    """``x if x > 0 else 0`` with missing -> 0 (M4, rule N8).

    ``greatest`` skips NULL, so a NULL input yields 0 exactly like the
    original lambda (``NaN > 0`` is false there). Input must be NULL-coded,
    not NaN-coded: see :func:`nan_to_null`.
    """
    return F.greatest(_col(x), F.lit(0))


def product(*cols: ColumnOrName) -> Column:
    """Row product; a missing factor makes the product missing."""
    out = _col(cols[0])
    for c in cols[1:]:
        out = out * _col(c)
    return out


def sentinel_to_null(x: ColumnOrName, sentinel=DAYS_SENTINEL) -> Column:
    """Replace a sentinel value by NULL."""
    return F.nullif(_col(x), F.lit(sentinel))


def nan_to_null(x: ColumnOrName) -> Column:
    """Normalise NaN to NULL once at the source (hard part 7.4.4)."""
    c = _col(x)
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def null_safe_ne(x: ColumnOrName, value) -> Column:
    """``x != value`` that keeps NULL rows (P5, rule N7)."""
    return ~_col(x).eqNullSafe(F.lit(value))


def null_safe_eq(x: ColumnOrName, value) -> Column:
    """Indicator test of a one-hot column ``x_value == 1`` (P3): false on NULL."""
    return _col(x).eqNullSafe(F.lit(value))
