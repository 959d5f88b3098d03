"""Missing-data profile, mean fill and shape reports (survey A16, A18, P14, P15, S7)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def missing_profile(df: DataFrame, columns: Sequence[str] | None = None,
                    column_name: str = "column", total_name: str = "Total",
                    percent_name: str = "Percent") -> DataFrame:
    """Null count and percent per column, sorted descending.

    One aggregate job over all columns (a single row of counts), then an
    unpivot of that one row: the result has one row per column.
    """
    columns = list(df.columns) if columns is None else list(columns)
    counts = df.agg(F.count(F.lit(1)).alias("__n"),
                    *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    long = counts.unpivot(["__n"], columns, column_name, total_name)
    return (long.select(F.col(column_name), F.col(total_name).cast("long").alias(total_name),
                        (F.try_divide(F.col(total_name).cast("double"), F.col("__n").cast("double"))
                         * 100).alias(percent_name))
            .orderBy(F.col(total_name).desc(), F.col(column_name).asc()))


def fill_constant(df: DataFrame, value=0, subset: Sequence[str] | None = None) -> DataFrame:
    """Missing -> constant."""
    return df.fillna(value, subset=list(subset) if subset is not None else None)


def fill_with_mean(df: DataFrame, columns: Sequence[str], source: DataFrame | None = None
                   ) -> DataFrame:
    """Missing -> the column's global mean.

    The means come from one scalar subquery (a single-row aggregate evaluated
    once), so there is no join and nothing is collected by hand.
    """
    src = df if source is None else source
    means = src.agg(F.struct(*[F.avg(c).alias(c) for c in columns])).scalar()
    return df.withColumns({c: F.coalesce(F.col(c), means.getField(c)) for c in columns})


def observe_shape(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Attach a row counter to ``df`` (S7); read ``obs.get['rows']`` after the
    first action -- no extra job. Column count is ``len(df.columns)``."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs
