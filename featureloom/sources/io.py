"""Scans, sinks and casts (survey S1-S6).

CSV reads take declared types by column name and find the types of the other
columns in one pass; Parquet scans get column pruning and filter pushdown from
Catalyst.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import nan_to_null
from .csv_dialect import DIALECT, BadRowsError, read_cells, write_bad_rows
from .ordinal import file_ordinal, first_rows

# The cell texts pandas ``read_csv`` reads as missing by default.
PANDAS_NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def null_tokens_to_null(df: DataFrame, tokens: Sequence[str] = PANDAS_NA_TOKENS) -> DataFrame:
    """Missing-value tokens in string columns -> NULL (S6, N15). Literal
    strings such as ``XNA`` are not tokens and stay."""
    toks = list(tokens)
    repl = {f.name: F.when(F.col(f.name).isin(toks), F.lit(None)).otherwise(F.col(f.name))
            for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.withColumns(repl) if repl else df


def _as_struct(spark: SparkSession, schema: T.StructType | str) -> T.StructType:
    if isinstance(schema, T.StructType):
        return schema
    return spark.createDataFrame([], schema).schema


_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


_FRACTIONAL = (T.FloatType, T.DoubleType)


class UnreadableCellsError(ValueError):
    """A column declared numeric holds cells that are no numbers."""


def _raise_if_bad(n: int) -> None:
    if n:
        raise BadRowsError(f"{n} rows have more cells than the header or are cut off inside a cell; "
                           "bad_rows='aside' sets them apart")


def _typed(raw: DataFrame, schema: T.StructType, counted: DataFrame | None = None, bad: Column | None = None) -> DataFrame:
    """Every header column of a string table, typed; schema columns come first.

    One aggregate pass counts, for each column that is not declared string,
    the cells that are no whole number of the declared width, no whole number
    at all, and no number. A declared type holds where all cells fit; whole
    numbers outside it widen to bigint and fractions to double (pandas does the
    same), and cells that are no numbers raise. Undeclared columns become
    bigint, double or string, an all-missing one double. A declared column that
    the file does not have is all NULL. ``counted`` is the table with the column
    that the condition ``bad`` needs; its bad rows are counted in the same pass.
    """
    declared = {f.name: f.dataType for f in schema.fields}
    cells = [f.name for f in raw.schema.fields if isinstance(f.dataType, T.StringType)]
    open_cols = [c for c in cells if not isinstance(declared.get(c), T.StringType)]
    counts = []
    for i, c in enumerate(open_cols):
        cell = F.trim(F.col(f"`{c}`"))
        number = cell.try_cast("double")
        whole = F.coalesce(number == F.floor(number), F.lit(False))
        kind = declared[c] if isinstance(declared.get(c), _INTEGRAL) else T.LongType()
        counts += [F.count(F.when(~whole | number.try_cast(kind).isNull(), cell)).alias(f"narrow{i}"),
                   F.count(F.when(~whole | number.try_cast("bigint").isNull(), cell)).alias(f"whole{i}"),
                   F.count(F.when(number.isNull(), cell)).alias(f"text{i}"), F.count(cell).alias(f"n{i}")]
    if bad is not None:
        seen = counted.agg(F.count_if(bad).alias("bad"), *counts).first()
        _raise_if_bad(seen["bad"])
    else:
        seen = raw.agg(*counts).first() if counts else {}
    out = {}
    for i, c in enumerate(open_cols):
        cell, want = F.trim(F.col(f"`{c}`")), declared.get(c)
        if seen[f"text{i}"]:
            if want is not None:
                raise UnreadableCellsError(f"column {c!r}: {seen[f'text{i}']} of {seen[f'n{i}']} cells are no "
                                           f"{want.simpleString()}")
            continue
        if isinstance(want, _FRACTIONAL) or (want is None and not seen[f"n{i}"]):
            out[c] = cell.try_cast(want or T.DoubleType())
        elif seen[f"whole{i}"]:
            out[c] = cell.try_cast("double")
        else:
            kind = want if want is not None and not seen[f"narrow{i}"] else T.LongType()
            # whole cells may be written as 1.0 (a column that held missing values)
            out[c] = F.coalesce(cell.try_cast(kind), cell.try_cast("double").try_cast(kind))
    cols = [out.get(f.name, F.col(f"`{f.name}`")).alias(f.name) if f.name in raw.columns
            else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    cols += [out.get(c, F.col(f"`{c}`")).alias(c) for c in raw.columns if c not in declared]
    return raw.select(*cols)


def nan_columns_to_null(df: DataFrame) -> DataFrame:
    """NaN in floating columns -> NULL: missing values look the same from every format."""
    floats = {f.name: nan_to_null(F.col(f"`{f.name}`")) for f in df.schema.fields
              if isinstance(f.dataType, _FRACTIONAL)}
    return df.withColumns(floats) if floats else df


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
               fmt: str = "parquet", null_tokens: Sequence[str] | None = PANDAS_NA_TOKENS,
               limit: int | None = None, order_by: Sequence[str] | None = None,
               options: Mapping[str, str] | None = None, multi_line: bool = True,
               bad_rows: str = "raise", bad_rows_path: str | None = None, ordinal: str | None = None) -> DataFrame:
    """Scan a table (S1); optional row cap for debug runs.

    CSV: the dialect of :mod:`.csv_dialect`; header row; ALL header columns are
    read, matched to the schema by NAME (Spark's own CSV schema is positional)
    and typed by :func:`_typed`; empty cells and the pandas NA tokens become
    NULL. Without a schema every cell stays a string. Rows with too many cells
    raise :class:`BadRowsError` with their number, counted in the pass that
    finds the types; with ``bad_rows='aside'`` they are written to
    ``bad_rows_path`` (file, record, cells) and the other rows are read.

    NaN becomes NULL in every format. ``limit`` takes the first rows in file
    order (:func:`.ordinal.first_rows`), with ``order_by`` the first in that order.
    ``ordinal`` names a column for the row number in file order.
    """
    def numbered(scan: DataFrame) -> DataFrame:
        if limit is not None and not order_by:
            scan = first_rows(scan, limit)
        return scan if ordinal is None else file_ordinal(scan, ordinal)

    reader = spark.read
    if fmt == "csv":
        cells, raw, bad = read_cells(spark, path, multi_line, options)
        if bad_rows == "aside":
            if not bad_rows_path:
                raise ValueError("bad_rows='aside' needs bad_rows_path")
            write_bad_rows(cells, raw, bad, bad_rows_path)
            cells = cells.where(~F.coalesce(bad, F.lit(False)))
        elif bad_rows != "raise":
            raise ValueError(f"unknown bad_rows {bad_rows!r}")
        elif schema is None:
            _raise_if_bad(cells.agg(F.count_if(bad)).first()[0])
        cells = numbered(cells)
        if null_tokens:
            cells = null_tokens_to_null(cells, null_tokens)
        df = cells.drop(raw)
        if schema is not None:
            df = _typed(df, _as_struct(spark, schema), *((cells, bad) if bad_rows == "raise" else ()))
    else:
        if schema is not None:
            reader = reader.schema(schema)
        for k, v in (options or {}).items():
            reader = reader.option(k, v)
        df = numbered(reader.format(fmt).load(path))
    df = nan_columns_to_null(df)
    if limit is not None and order_by:
        df = df.orderBy(*order_by).limit(limit)
    return df


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] | None = None, max_rows_per_file: int | None = None) -> None:
    """Sink without a row index (S3): CSV in the dialect that :func:`read_table` reads, with a header row, or Parquet."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if max_rows_per_file:
        w = w.option("maxRecordsPerFile", max_rows_per_file)
    if fmt == "csv":
        w = w.options(**DIALECT)
    w.format(fmt).save(path)


def cast_columns(df: DataFrame, types: Mapping[str, str], safe: bool = False) -> DataFrame:
    """Down-cast columns (S5). ANSI ``cast`` raises on overflow; ``safe``
    uses ``try_cast`` and yields NULL instead. ``float16`` maps to ``float``."""
    alias = {"int16": "smallint", "int32": "int", "int64": "bigint", "float16": "float",
             "float32": "float", "float64": "double"}
    out = {}
    for c, t in types.items():
        t = alias.get(t, t)
        out[c] = F.col(c).try_cast(t) if safe else F.col(c).cast(t)
    return df.withColumns(out)
