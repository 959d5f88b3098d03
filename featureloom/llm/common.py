"""Helpers shared by the training-data operators of this subpackage.

Nothing here looks at the size of the data to choose a plan. Intermediate
tables go to the folder named in ``spark.checkpoint.dir`` as zstd Parquet, so
they survive lost executors and cut the lineage; nothing is kept in a
machine-local folder.
"""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featureloom.session import checkpoint_path

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
#: Every ASCII byte that is neither a digit nor a letter becomes a space.
ALNUM = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in LOWER)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder."""
    return checkpoint_path(spark, f"llm-{name}-{uuid.uuid4().hex}")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]],
                schema: str) -> DataFrame:
    """``mapInArrow`` for a function that yields dicts of columns.

    ``schema`` is a DDL string; every yielded dict has its columns in order.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols in fn(batches):
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, type=f.type)
                 for c, f in zip((cols[f.name] for f in arrow), arrow)], schema=arrow)
            del cols
        release()

    return df.mapInArrow(run, schema)


def release() -> None:
    """Give freed memory back, so that a worker that waits for its next task holds little."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim:
        trim(0)


def texts(batch: pa.RecordBatch, column: str = "text", rows: int = 256) -> Iterator[tuple[int, list]]:
    """The texts of a batch in small runs, so that few of them are Python objects at once."""
    col = batch.column(column)
    for at in range(0, len(col), rows):
        yield at, col.slice(at, rows).to_pylist()


class WordHash(dict):
    """word bytes -> 64-bit xxh3, remembered; forgets everything past ``limit`` words."""

    def __init__(self, limit: int = 200_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def set_apart(df: DataFrame, names: Iterable[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``df`` with columns called like one of ``names`` under fresh names, and what gives its columns their names back."""
    taken, used, fresh = {n.lower() for n in names}, {c.lower() for c in df.columns}, []
    for c in df.columns:
        name = c
        while c.lower() in taken and (name.lower() in taken or name.lower() in used):
            name += "_"
        used.add(name.lower())
        fresh.append(name)
    original = df.columns
    return (df if fresh == original else df.toDF(*fresh)), lambda out: out if fresh == original else out.toDF(*original)


def crc_bucket(column: str, modulus: int):
    """crc32 of the id written as text, modulo ``modulus``."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def is_empty(df: DataFrame) -> bool:
    return not df.take(1)
