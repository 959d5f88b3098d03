"""Joins and set operations (survey J1-J8, U1-U3).

Every join of the reference is a LEFT equi-join on an entity key whose right
side is an aggregate (unique per key). Blocks built by
:func:`featureloom.operators.aggregate.agg_features` leave their output
hash-partitioned on the key, so a chain of left joins on that key adds no
exchange for the blocks (only the base is shuffled once); AQE turns a join
into a broadcast at run time when a materialised side is small, and splits
skewed partitions otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join(left: DataFrame, right: DataFrame, on: str | Sequence[str],
              suffixes: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    """Left equi-join (J1, J2) with pandas-style clash suffixes (J5, N17):
    a non-key column present on both sides becomes ``<c>_x`` / ``<c>_y``. Where
    such a name is taken already, the suffix is numbered: ``<c>_x2``, ``<c>_y2``, ..."""
    keys = [on] if isinstance(on, str) else list(on)
    clash = [c for c in left.columns if c in set(right.columns) - set(keys)]
    if clash:
        taken = (set(left.columns) | set(right.columns)) - set(clash)

        def fresh(name: str) -> str:
            n = next(n for k in range(1, len(taken) + 2) if (n := name if k == 1 else f"{name}{k}") not in taken)
            taken.add(n)
            return n

        left = left.withColumnsRenamed({c: fresh(c + suffixes[0]) for c in clash})
        right = right.withColumnsRenamed({c: fresh(c + suffixes[1]) for c in clash})
    return left.join(right, on=keys, how="left")


def left_star(base: DataFrame, key: str | Sequence[str], blocks: Sequence[DataFrame],
              suffixes: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    """Star assembly: base LEFT JOIN every block on the key.

    Row count of ``base`` is preserved when every block is unique per key.
    """
    return reduce(lambda acc, b: left_join(acc, b, key, suffixes), blocks, base)


def semi_join(df: DataFrame, keys: DataFrame, on: str | Sequence[str],
              max_broadcast_rows: int | None = None) -> DataFrame:
    """Membership filter ``df[df.k.isin(keys)]``.

    ``max_broadcast_rows`` is a *proven* bound on ``keys`` (e.g. the k of a
    top-k); only then is the key side hinted as broadcast.
    """
    right = F.broadcast(keys) if max_broadcast_rows is not None else keys
    return df.join(right, on=on, how="left_semi")


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Union all by column name; columns absent on one side become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
