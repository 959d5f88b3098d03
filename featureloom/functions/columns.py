"""Column-metadata helpers (survey P1, P7-P11, M7).

These work on ``df.schema`` in the driver: they choose *which* columns a
plan uses; no data is touched.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                 T.FloatType, T.DoubleType, T.DecimalType)


def columns_matching(df: DataFrame, contains: Iterable[str] = (),
                     excludes: Iterable[str] = (), numeric_only: bool = False) -> list[str]:
    """Columns whose name contains every ``contains`` substring and none of
    ``excludes`` (P8). ``numeric_only`` keeps numeric types only (D7)."""
    contains, excludes = list(contains), list(excludes)
    out = []
    for f in df.schema.fields:
        if any(s not in f.name for s in contains):
            continue
        if any(s in f.name for s in excludes):
            continue
        if numeric_only and not isinstance(f.dataType, NUMERIC_TYPES):
            continue
        out.append(f.name)
    return out


def string_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Categorical columns = string columns."""
    ex = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in ex]


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    ex = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in ex]


def feature_columns(df: DataFrame, exclude: Iterable[str]) -> list[str]:
    """All columns minus an exclusion list, in frame order (P10)."""
    ex = set(exclude)
    return [c for c in df.columns if c not in ex]


def agg_name(prefix: str, column: str, func: str) -> str:
    """Flattened aggregate label ``PREFIX + COL + '_' + FUNC``."""
    return f"{prefix}{column}_{func.upper()}"


def quote(name: str) -> str:
    """Back-tick a column name for string-based APIs (names may hold dots)."""
    return "`" + name.replace("`", "``") + "`"
