"""The CSV dialect of the reference's reader and writer, with a quarantine.

Cells may be quoted with ``"``; a quoted cell holds separators, line ends and,
doubled, quotes; backslashes and outer spaces are ordinary characters. Rows with
fewer cells than the header are filled with missing values. Rows with more
cells, and rows cut off inside a quoted cell, are bad: they are counted and
either raise or are written aside, never shifted or shortened.

``multi_line`` (the default) reads line ends inside cells, at the price of one
task a file; write tables in many files (``max_rows_per_file``). Without it
files are split among tasks, and a record that spans lines is bad.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The dialect, for reading and writing alike.
DIALECT = {"header": "true", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
#: A file whose header differs from the first one's raises; all cells of a row are parsed whatever columns are asked for.
READING = {"mode": "PERMISSIVE", "enforceSchema": "false", "columnPruning": "false", "inferSchema": "false"}


class BadRowsError(ValueError):
    """A file holds rows with more cells than its header, or rows cut off inside a cell."""


def cell_count(record: Column, sep: str = ",") -> Column:
    """Number of cells of a raw record: one more than the quoted, plain and empty cells that a separator follows."""
    s = "\\" + sep if sep in "|.^$*+?()[]{}\\" else sep
    return F.regexp_count(record, F.lit(f'(?:"(?:[^"]|"")*"[^{s}]*|[^"{s}][^{s}]*|){s}')) + 1


def read_cells(spark: SparkSession, path: str, multi_line: bool = True,
               options: Mapping[str, str] | None = None) -> tuple[DataFrame, str, Column]:
    """(all cells as strings plus a column with the raw text of irregular rows, that column's name, condition "row is bad")."""
    given = {**DIALECT, **READING, "multiLine": str(multi_line).lower(), **(options or {})}
    sep = given.get("sep", given.get("delimiter", ","))
    names = spark.read.options(**given).csv(path).columns
    raw = "_irregular"
    while raw in names:
        raw += "_"
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, raw]])
    cells = spark.read.options(**given, columnNameOfCorruptRecord=raw).schema(schema).csv(path)
    text = F.col(raw)
    cut_off = F.regexp_count(text, F.lit('"')) % 2 == 1
    # Spark refuses a scan that asks for the raw text alone, so the condition names another column too
    irregular = F.octet_length(F.concat(F.coalesce(F.col(f"`{names[0]}`"), F.lit("")), text)) > 0
    return cells, raw, irregular & ((cell_count(text, sep) > len(names)) | cut_off)


def write_bad_rows(cells: DataFrame, raw: str, bad: Column, path: str) -> None:
    """Write the bad rows (file, record, cells) aside as Parquet."""
    names = [c for c in cells.columns if c != raw]
    cells.where(bad).select(F.col("_metadata.file_path").alias("file"), F.col(raw).alias("record"),
                            F.array(*(F.col(f"`{c}`") for c in names)).alias("cells")).write.mode("overwrite").parquet(path)
