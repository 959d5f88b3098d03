"""Row numbers in file order, and the first rows of a file (survey P17, S2, E2).

A scan's rows have an order that no column shows: files by path, rows by their
place in the file. ``file_ordinal`` numbers them without a shuffle of the data:
Parquet scans know the row's place in its file (``_metadata.row_index``); for
other formats it is the place in the block a task read, blocks being known by
file and start. One row a file or block is counted, cumulated and joined back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_FILE, _BLOCK, _ROW = "_metadata.file_path", "_metadata.file_block_start", "_metadata.row_index"


def _placed(scan: DataFrame) -> DataFrame:
    """``scan`` with ``_at`` = struct(file, block) and ``_row``: ascending inside ``_at`` in file order, from ``_first``."""
    known = scan.select("_metadata").schema["_metadata"].dataType.names
    if "row_index" in known:
        at, row = F.struct(F.col(_FILE).alias("file"), F.lit(0).cast("long").alias("block")), F.col(_ROW)
    else:
        at, row = F.struct(F.col(_FILE).alias("file"), F.col(_BLOCK).alias("block")), F.monotonically_increasing_id()
    return scan.select("*", at.alias("_at"), row.alias("_row"))


def file_ordinal(scan: DataFrame, out: str = "ordinal") -> DataFrame:
    """``scan`` plus a column ``out``: 0, 1, 2, ... in file order, over all files by path.

    ``scan`` is a file scan with at most casts, or filters that take whole files,
    above it (of other formats than Parquet, any filter: its rows are not counted).
    The counts are one row a file (Parquet) or a block a task reads (other formats); blocks depend
    on the session's file settings, which must not change until the result is
    used. The data is not shuffled: the counts are joined to it, by a broadcast
    as long as Spark finds them small.
    """
    placed = _placed(scan)
    counts = placed.groupBy("_at").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    before = Window.orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)  # one row a file or block
    shift = (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift")
    return placed.join(counts.select("_at", shift), "_at").withColumn(out, F.col("_row") + F.col("_shift")) \
        .select(*scan.columns, out)


def first_rows(scan: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows of a file scan in file order.

    Whole files are counted, one, two, four, ... of them in path order, until
    they hold ``n`` rows; later files are not read.
    """
    files = sorted(scan.inputFiles())
    take = 1
    some = scan
    while True:
        if take >= len(files):
            some = scan
            break
        # the condition on the file's path prunes the files that are read
        last = files[take - 1]
        some = scan.where(F.url_decode(F.col(_FILE)) <= F.url_decode(F.lit(last)))
        if some.limit(n).count() >= n:
            break
        take *= 2
    return file_ordinal(some, "_ordinal").where(F.col("_ordinal") < n).drop("_ordinal")
