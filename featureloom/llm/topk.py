"""Exact top-k search by inner product with no-random-access aggregation.

Components become integers. Every task cuts its vectors into chunks and sorts
each chunk once per dimension. For a query the lists are read in step, best
contributions first (from the end where the query's component is negative):

* the lower bound of a vector is what has been read of it plus the worst
  entry of every list it has not been met in;
* the threshold is the k-th best lower bound, or the k-th score already found
  in earlier chunks of the task (chunks are small, so that it is known early);
* reading stops when the sum of the lists' current entries, the upper bound of
  every vector not met yet, is below the threshold;
* vectors whose upper bound reaches the threshold get their final score.

Queries are taken in blocks of about ``block`` vectors; one block at a time is
on the driver and broadcast (block * dimensions integers) and met by all rows,
which are never shuffled; its result is written before the next block is read.
Each task returns k + 1 rows a query at most; two windows (the first salted) keep
the best. Ties go to the smaller id.

A query's own row is searched like all others and left out at the end: of the rows
with the query's id and vector one is dropped.

Rules: vectors that are null or hold a null or non-finite component take no
part; a vector meets queries of its own length only; null ids take no part;
only the query's own row is no candidate: other rows of its id are, and repeated rows
are each a candidate; a query row that is there m times gives its ranking m times;
fewer than k candidates: all are returned. Integers beyond a long take its nearest value, and so
do scores; sums that a double cannot hold exactly get bounds with room for the rounding and
final scores in whole numbers. Extra columns are not read; empty tables give no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_batches, materialize

CHUNK = 4096
SALT = 32
EXACT = 2.0**52


class Lists:
    """The sorted lists of one chunk of vectors of one length."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        self.ids, self.x = ids, x
        rising = np.argsort(x, axis=0, kind="stable").T
        # list 2 d reads dimension d from its smallest entry, list 2 d + 1 from its largest
        self.order = np.stack([rising, rising[:, ::-1]], 1).reshape(-1, len(ids))
        value = np.take_along_axis(x.T, rising, 1)
        self.value = np.stack([value, value[:, ::-1]], 1).reshape(-1, len(ids)).astype(np.float64)
        self.floats = x.astype(np.float64)
        self.most = np.abs(self.floats).max(0) if x.size else np.zeros(x.shape[1])
        self.first = max(64, len(ids) // 8)  # entries read before the first look at the bounds

    def search(self, q: np.ndarray, k: int, floor: float) -> tuple[np.ndarray, np.ndarray]:
        """Rows that may be among the best k (no score below ``floor``), with their scores."""
        n = len(self.ids)
        use = np.flatnonzero(q)
        largest = float(self.most @ np.abs(q.astype(np.float64)))
        exact = largest < EXACT  # all sums below are sums of whole numbers that doubles hold
        room_for_rounding = 0.0 if exact else largest * (8 * len(q) + 64) * 2.0**-52
        whole, q = q, q[use].astype(np.float64)
        lists = 2 * use + (q > 0)
        worst = self.value[lists, -1] * q
        read, depth, step, parts = np.zeros(n), 0, self.first, []
        while True:
            entry = slice(depth, depth + step)
            rows, got = self.order[lists, entry].ravel(), self.value[lists, entry] * q[:, None]
            parts.append((rows, got.shape[1]))
            read += np.bincount(rows, (got - worst[:, None]).ravel(), n)
            depth, step = min(n, depth + step), max(64, n // 16)
            lower = worst.sum() + read
            least = (max(floor, np.partition(lower, n - k)[n - k]) if k <= n else floor) - room_for_rounding
            last = got[:, -1]
            if depth == n or last.sum() < least:
                break
        self.first = max(64, int(0.9 * depth))
        # upper bound: the lower one, with the lists' current entries where a row has not been met
        room = last - worst
        upper = lower + room.sum()
        for rows, size in parts:
            upper -= np.bincount(rows, np.repeat(room, size), n)
        rows = np.flatnonzero(upper + room_for_rounding >= least)
        if exact:
            return rows, (self.floats[rows] @ whole).astype(np.int64)
        return rows, np.array([product(v, whole) for v in self.x[rows]], np.int64)


def product(v: np.ndarray, q: np.ndarray) -> int:
    """The inner product in whole numbers of any size, brought into a long's range."""
    return max(-(1 << 63), min((1 << 63) - 1, sum(a * b for a, b in zip(v.tolist(), q.tolist()))))


def _search(queries, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        best: dict[int, tuple[np.ndarray, np.ndarray]] = defaultdict(
            lambda: (np.empty(0, np.int64), np.empty(0, np.int64)))
        pending: dict[int, list] = defaultdict(list)

        def meet(dim: int) -> None:
            ids = np.concatenate([p[0] for p in pending[dim]])
            lists = Lists(ids, np.concatenate([p[1] for p in pending[dim]]))
            pending[dim] = []
            for at, (_, q) in enumerate(queries.value):
                if len(q) != dim:
                    continue
                old_ids, old = best[at]
                rows, score = lists.search(q, k, float(old.min()) if len(old) >= k else -np.inf)
                all_ids, all_scores = np.concatenate([old_ids, ids[rows]]), np.concatenate([old, score])
                top = np.lexsort((all_ids, -all_scores))[:k]
                best[at] = all_ids[top], all_scores[top]

        for batch in batches:
            ids, vectors = batch.column("id").to_numpy(zero_copy_only=False), batch.column("v")
            flat, ends = vectors.flatten().to_numpy(zero_copy_only=False), np.cumsum(vectors.value_lengths().to_numpy())
            for dim in np.unique(np.diff(ends, prepend=0)):
                mine = np.flatnonzero(np.diff(ends, prepend=0) == dim)
                x = flat[(ends[mine] - dim)[:, None] + np.arange(dim)]
                for at in range(0, len(mine), CHUNK):
                    pending[dim].append((ids[mine[at:at + CHUNK]], x[at:at + CHUNK]))
                    if sum(len(p[0]) for p in pending[dim]) >= CHUNK:
                        meet(dim)
        for dim in [d for d, p in pending.items() if p]:
            meet(dim)
        for at, (ids, scores) in best.items():
            qid, q = queries.value[at]
            yield {"q": np.full(len(ids), at), "query_id": np.full(len(ids), qid), "vec_id": ids, "score": scores,
                   "own": (ids == qid) & (scores == product(q, q))}
    return run


def top_k(vectors: DataFrame, is_query, k: int = 10, scale: int = 1024, id_col: str = "vec_id",
          vector_col: str = "embedding", block: int = 16_384) -> DataFrame:
    """query_id, rank, vec_id, score: the k best inner products of each query row against all rows.

    ``is_query`` is a condition on the id column; components become
    ``floor(scale * x)``.
    """
    v = F.transform(vector_col, lambda x: x.cast("double"))
    ok = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & ok)
    whole = F.transform(v, lambda x: F.floor(x * scale))
    rows, queries = rows.select(F.col(id_col).cast("long").alias("id"), whole.alias("v")), \
        rows.where(is_query).select(F.col(id_col).cast("long").alias("id"), whole.alias("v"))
    queries = materialize(queries.groupBy("id", "v").agg(F.count("*").alias("copies")), "queries")
    blocks = max(1, -(-queries.count() // block))
    parts = []
    for b in range(blocks):
        mine = queries.where(F.pmod(F.xxhash64("id", "v"), F.lit(blocks)) == b).collect()  # about ``block`` rows
        shared = vectors.sparkSession.sparkContext.broadcast([(r.id, np.array(r.v, np.int64)) for r in mine])
        copies = vectors.sparkSession.createDataFrame([(q, r.copies) for q, r in enumerate(mine) if r.copies > 1], "q long, copies long")
        best = map_batches(rows, _search(shared, k + 1), "q long, query_id long, vec_id long, score long, own boolean")
        parts.append(materialize(_best(best, k).join(F.broadcast(copies), "q", "left")  # at most a block
                                 .select("query_id", "rank", "vec_id", "score", F.expr("explode(sequence(1L, coalesce(copies, 1L)))"))
                                 .drop("col"), "found"))
        shared.unpersist()
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


def _best(found: DataFrame, k: int) -> DataFrame:
    """The best k rows of each query without its own row."""
    order = [F.desc("score"), "vec_id"]
    for keys in (["q", F.pmod(F.hash("vec_id"), F.lit(SALT))], ["q"]):
        found = found.withColumn("at", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(f"at <= {k + 1}")
    own = F.min(F.when(F.col("own"), F.col("at"))).over(Window.partitionBy("q"))
    found = found.withColumn("own_at", own).where("own_at is null or at <> own_at")
    return found.withColumn("rank", F.expr("cast(at - if(at > own_at, 1, 0) as int)")).where(f"rank <= {k}")
