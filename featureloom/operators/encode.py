"""Category dictionary, one-hot and first-appearance encoding (survey E1-E4).

A one-hot schema depends on the data, so a plan needs the categories before
it can be built. :class:`CategoryDictionary` discovers them in ONE job over
all columns (distinct (column, value) pairs, pre-aggregated map-side), with a
size guard, and freezes them: training and scoring use the same dictionary,
and unseen values at scoring time get all-zero indicators.

One-hot encoding is a pure projection (``CASE`` expressions) inside whole-stage
codegen; codes and lookups join a table of one row a value, which is broadcast
up to a checked number of rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import string_columns

DEFAULT_MAX_CATEGORIES = None  # no limit unless a caller asks for one
BROADCAST_ROWS = 100_000  # a mapping of at most so many entries is broadcast, a larger one joined by its key


class CategoryGuardError(ValueError):
    """A column has more distinct values than the dictionary allows."""


def _guard(pairs: DataFrame, max_categories: int | None) -> None:
    """Raise for the first column (by name) of ``pairs`` with more than ``max_categories`` values."""
    if max_categories is None:
        return
    wide = pairs.groupBy("name").count().where(F.col("count") > max_categories).orderBy("name").first()
    if wide is not None:
        raise CategoryGuardError(f"column {wide['name']!r} has {wide['count']} categories, more than {max_categories}")


class CategoryDictionary:
    """Frozen, sorted category lists per column."""

    def __init__(self, categories: dict[str, list[str]]):
        self.categories = {c: list(v) for c, v in categories.items()}

    # -- discovery ---------------------------------------------------------
    @classmethod
    def discover(cls, df: DataFrame, columns: Sequence[str] | None = None,
                 max_categories: int | None = DEFAULT_MAX_CATEGORIES) -> "CategoryDictionary":
        """Distinct non-missing values of every column, in one job.

        The values become feature columns, so they reach the driver; with
        ``max_categories`` a column of more raises :class:`CategoryGuardError`
        before any value does. For columns too wide to pivot there is
        :func:`category_shares_long`.
        """
        columns = list(columns) if columns is not None else string_columns(df)
        if not columns:
            return cls({})
        pairs = df.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value"))
            for c in columns])).alias("p")).select("p.name", "p.value")
        pairs = pairs.where(F.col("value").isNotNull()).distinct()
        _guard(pairs, max_categories)
        found: dict[str, list[str]] = {c: [] for c in columns}
        for r in pairs.collect():
            found[r["name"]].append(r["value"])
        return cls({c: sorted(v) for c, v in found.items()})

    # -- persistence: the dictionary is a small table reused for scoring ----
    def to_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(c, i, v) for c, vals in self.categories.items() for i, v in enumerate(vals)]
        schema = T.StructType([T.StructField("column", T.StringType(), False),
                               T.StructField("position", T.IntegerType(), False),
                               T.StructField("value", T.StringType(), False)])
        return spark.createDataFrame(rows, schema)

    def save(self, spark: SparkSession, path: str) -> None:
        self.to_frame(spark).coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "CategoryDictionary":
        rows = spark.read.parquet(path).orderBy("column", "position").collect()
        cats: dict[str, list[str]] = {}
        for r in rows:
            cats.setdefault(r["column"], []).append(r["value"])
        return cls(cats)

    def to_json(self) -> str:
        return json.dumps(self.categories, sort_keys=True)

    @classmethod
    def from_json(cls, s: str) -> "CategoryDictionary":
        return cls(json.loads(s))

    def __getitem__(self, column: str) -> list[str]:
        return self.categories[column]

    def __contains__(self, column: str) -> bool:
        return column in self.categories

    def columns(self) -> list[str]:
        return list(self.categories)


def indicator_name(column: str, value: str | None) -> str:
    """pandas ``get_dummies`` label: ``<col>_<value>``; missing -> ``<col>_nan``."""
    return f"{column}_nan" if value is None else f"{column}_{value}"


def _check_case_clash(names: Iterable[str], existing: Iterable[str] = ()) -> None:
    seen: dict[str, str] = {n.lower(): n for n in existing}
    for n in names:
        k = n.lower()
        if k in seen:
            raise ValueError(f"columns {seen[k]!r} and {n!r} have one name; Spark resolves names case-insensitively"
                             + (" (a category 'nan' beside the missing indicator?)" if k.endswith("_nan") else ""))
        seen[k] = n


def one_hot_columns(dictionary: CategoryDictionary, columns: Sequence[str] | None = None,
                    nan_indicator: bool = True, dtype: str = "int") -> list[Column]:
    """Indicator expressions for every (column, category) (+ missing flag)."""
    columns = dictionary.columns() if columns is None else list(columns)
    out = []
    for c in columns:
        for v in dictionary[c]:
            out.append(F.col(c).eqNullSafe(F.lit(v)).cast(dtype).alias(indicator_name(c, v)))
        if nan_indicator:
            out.append(F.col(c).isNull().cast(dtype).alias(indicator_name(c, None)))
    return out


def one_hot(df: DataFrame, dictionary: CategoryDictionary | None = None,
            columns: Sequence[str] | None = None, nan_indicator: bool = True,
            max_categories: int | None = DEFAULT_MAX_CATEGORIES) -> tuple[DataFrame, list[str]]:
    """One-hot encode string columns (E1); returns (frame, new column names).

    Like ``get_dummies``: the encoded source columns are replaced, the other
    columns come first, indicators follow in column then sorted-value order,
    and ``<col>_nan`` is added for every column when ``nan_indicator``.
    """
    columns = string_columns(df) if columns is None else list(columns)
    if dictionary is None:
        dictionary = CategoryDictionary.discover(df, columns, max_categories)
    keep = [c for c in df.columns if c not in set(columns)]
    ind = one_hot_columns(dictionary, columns, nan_indicator)
    new_names = []
    for c in columns:
        new_names += [indicator_name(c, v) for v in dictionary[c]]
        if nan_indicator:
            new_names.append(indicator_name(c, None))
    _check_case_clash(new_names, keep)
    return df.select(*[F.col(c) for c in keep], *ind), new_names


def first_appearance_dictionary(df: DataFrame, columns: Sequence[str], order_col: str,
                                order: str = "first",
                                max_categories: int | None = DEFAULT_MAX_CATEGORIES
                                ) -> dict[str, dict[str, int]]:
    """Codes per column value (E2 dictionary), computed in one small job.

    ``order='first'``: by the smallest ``order_col`` at which the value occurs
    (pandas ``factorize``); ``'frequency'``: most frequent first; ``'alphabet'``.
    Ties break on the value. One (column, value, first, count) row a category
    reaches the driver; ``max_categories`` as in :meth:`CategoryDictionary.discover`.
    """
    pairs = df.select(F.col(order_col).alias("_ord"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value"))
        for c in columns])).alias("p")).select("p.name", "p.value", "_ord")
    stats = (pairs.where(F.col("value").isNotNull())
             .groupBy("name", "value")
             .agg(F.min("_ord").alias("first"), F.count(F.lit(1)).alias("n")))
    _guard(stats, max_categories)
    per: dict[str, list] = {c: [] for c in columns}
    for r in stats.collect():
        per[r["name"]].append((r["value"], r["first"], r["n"]))
    out = {}
    for c, vals in per.items():
        if order == "first":
            vals.sort(key=lambda t: (t[1], t[0]))
        elif order == "frequency":
            vals.sort(key=lambda t: (-t[2], t[0]))
        elif order == "alphabet":
            vals.sort(key=lambda t: t[0])
        else:
            raise ValueError(f"unknown order {order!r}")
        out[c] = {v: i for i, (v, _, _) in enumerate(vals)}
    return out


def code_column(column: str, codes: dict[str, int], missing_code: int = -1) -> Column:
    """Integer code from a frozen dictionary; missing / unseen -> ``missing_code``."""
    if not codes:
        return F.lit(missing_code).cast("int")
    m = F.create_map(*[x for v, i in codes.items() for x in (F.lit(v), F.lit(i))])
    return F.coalesce(F.try_element_at(m, F.col(column).cast("string")),
                      F.lit(missing_code)).cast("int")


def factorize(df: DataFrame, columns: Sequence[str], order_col: str, order: str = "first",
              dictionary: dict[str, dict[str, int]] | None = None,
              max_categories: int | None = DEFAULT_MAX_CATEGORIES
              ) -> tuple[DataFrame, dict[str, dict[str, int]]]:
    """Replace each column by its integer code (E2); missing or unseen -> -1.

    Spark rows have no inherent order, so "first appearance" needs an explicit
    ``order_col``, e.g. the row number in file order
    (:func:`featureloom.sources.file_ordinal`). The codes are joined as a table of
    one row a category.
    """
    if dictionary is None:
        dictionary = first_appearance_dictionary(df, columns, order_col, order, max_categories)
    names = df.columns
    for c in columns:
        df = _joined_values(df, dictionary[c], F.col(f"`{c}`").cast("string"), "string", c, "int", F.lit(-1))
    return df.select(*(f"`{c}`" for c in names)), dictionary


def _joined_values(df: DataFrame, mapping: dict, key: Column, key_type: str, out_col: str, value_type: str,
                   missing: Column | None = None) -> DataFrame:
    """``out_col`` = the mapping's value at ``key`` by a join with a table of the mapping, NULL or ``missing`` elsewhere."""
    rows = [(k, v) for k, v in mapping.items() if k is not None]
    table = df.sparkSession.createDataFrame(rows, T.StructType.fromDDL(f"_key {key_type}, _value {value_type}"))
    if len(rows) <= BROADCAST_ROWS:
        table = F.broadcast(table)
    value = F.col("_value") if missing is None else F.coalesce("_value", missing.cast(value_type))
    return df.join(table, key == F.col("_key"), "left").withColumn(out_col, value).drop("_key", "_value")


def lookup(df: DataFrame, mapping: dict, key_col: str, out_col: str,
           value_type: str = "double") -> DataFrame:
    """Value lookup by a frozen mapping (E4, ``Series.map``), joined as a table; unknown -> NULL."""
    key_type = df.schema[key_col].dataType.simpleString()
    as_value = float if value_type in ("double", "float") else (lambda v: v)
    mapping = {k: None if v is None else as_value(v) for k, v in mapping.items()}
    return _joined_values(df, mapping, F.col(f"`{key_col}`"), key_type, out_col, value_type)


def category_shares_long(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Shares of every category of every column per key, as rows (key, column,
    value, share): no pivot, no dictionary and no driver traffic, for columns
    with any number of values. Missing values are the category NULL; NULL keys
    are dropped."""
    pairs = df.where(F.col(key).isNotNull()).select(key, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])).alias("p"))
    counts = pairs.groupBy(key, "p.column", "p.value").agg(F.count(F.lit(1)).alias("n"))
    totals = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("total"))
    return counts.join(totals, key).select(key, "column", "value", (F.col("n") / F.col("total")).alias("share"))
