"""Merkle manifest of a dataset by time-forward processing.

Leaves of one group ascend by the order column; every ``FANOUT`` consecutive
nodes (the last run fewer, even one) are hashed into their parent until one node
is left, the group's subroot. The subroots, ordered by group, likewise give the
root. A digest is lowercase hex SHA-256, children enter it as hex text.

Nodes are processed in the order of their labels (level, place): a node's digest
is a message to its parent, kept in a priority queue ordered by the parent's
label, so that a parent finds all its children's digests at the queue's head.
The queue is external: Spark's shuffle deals messages by the label of the block
of ``FANOUT ** LEVELS`` nodes they belong to, a block's task runs the queue over
``LEVELS`` levels in memory (at most 4,096 messages), and the digest that leaves
a block is a message of the next epoch. The reversed sweep goes from the root
down: a block is sent the proof suffix of its top node, labels are taken in
falling order, and every parent delivers its suffix, with the child's siblings
in front, to its children, until the leaves have whole proofs.

A group may hold any share of the rows: leaves are ordered by range
partitioning, places come from row numbers inside partitions plus offsets (one
row for each pair of partition and group), and no task holds more than a block.

Rules: null fields are hashed as ``-``; a null group comes first; null order
values come first in their group; rows of equal order value follow their leaf
digests, so equal rows are interchangeable. A lone leaf is its subroot and has
an empty proof. An empty table gives no rows and no root. Columns that are not
named are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

FANOUT, LEVELS = 8, 4
PROOF = "array<struct<before:string,after:string>>"
_PROOF = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))
_ROW_BITS = 33  # monotonically_increasing_id: partition above, row below


def leaf_digest(*fields: Column) -> Column:
    """Digest of a row: every field as ``<UTF-8 bytes>:<value>``, or ``-`` where it is null."""
    def coded(c: Column) -> Column:
        s = c.cast("string")
        return F.when(c.isNull(), "-").otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))
    return F.sha2(F.concat(*map(coded, fields)), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf digest and its proof lead to."""
    return F.aggregate(proof, leaf, lambda digest, p: F.sha2(F.concat(p.before, digest, p.after), 256))


def proof_text(proof: Column) -> Column:
    """All sibling digests of a proof, level by level, left to right."""
    return F.array_join(F.transform(proof, lambda p: F.concat(p.before, p.after)), "")


def _h(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def _height(nodes: int, fanout: int) -> int:
    levels = 0
    while nodes > 1:
        nodes, levels = -(-nodes // fanout), levels + 1
    return levels


def climb(digests: Sequence[str], levels: int, fanout: int = FANOUT) -> tuple[str, dict]:
    """The top digest of a block and, by label (level, place), what each node received."""
    if not levels:
        return digests[0], {}
    queue = [((1, k // fanout), k % fanout, d) for k, d in enumerate(digests)]
    heapq.heapify(queue)
    inbox: dict[tuple[int, int], list[str]] = {}
    while True:
        label, got = queue[0][0], []
        while queue and queue[0][0] == label:
            got.append(heapq.heappop(queue)[2])
        inbox[label], digest = got, _h("".join(got))
        if label[0] == levels:
            return digest, inbox
        heapq.heappush(queue, ((label[0] + 1, label[1] // fanout), label[1] % fanout, digest))


def descend(inbox: dict, levels: int, suffix: tuple | None, count: int, fanout: int = FANOUT) -> list[list[tuple[str, str]]]:
    """The proofs of a block's ``count`` leaves; ``suffix`` is that of its top as linked (step, rest) pairs."""
    mail = {(levels, 0): suffix}
    queue = [(-levels, 0)]
    while queue and levels:
        label = heapq.heappop(queue)
        level, place = -label[0], -label[1]
        rest, got = mail.pop((level, place)), inbox[level, place]
        run = "".join(got)
        for k in range(len(got)):
            child = level - 1, place * fanout + k
            mail[child] = ((run[:64 * k], run[64 * (k + 1):]), rest)
            if level > 1:
                heapq.heappush(queue, (-child[0], -child[1]))
    proofs = []
    for k in range(count):
        steps, at = [], mail[0, k]
        while at is not None:
            steps.append(at[0])
            at = at[1]
        proofs.append(steps)
    return proofs


def _proof_array(proofs: list[list[tuple[str, str]]]) -> pa.Array:
    ends, flat = [0], []
    for p in proofs:
        flat += p
        ends.append(len(flat))
    steps = pa.StructArray.from_arrays([pa.array([s[k] for s in flat], pa.string()) for k in (0, 1)], ["before", "after"])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), steps)


def _placed(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` (with a column ``tree``) plus ``place`` in its tree and ``size`` of the tree."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["tree", *order]
    ordered = rows.repartitionByRange(parts, *(F.col(c).asc_nulls_first() for c in keys)) \
        .sortWithinPartitions(*(F.col(c).asc_nulls_first() for c in keys)).withColumn("at", F.monotonically_increasing_id())
    ordered = materialize(ordered, "merkle-leaves").withColumn("part", F.shiftright("at", _ROW_BITS))
    # one row for each pair of partition and tree: at most partitions + trees
    runs = ordered.groupBy("part", "tree").agg(F.count("*").alias("rows"), F.min("at").alias("first"))
    tree = Window.partitionBy("tree")
    before = F.coalesce(F.sum("rows").over(tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = materialize(runs.select("part", "tree", (before - F.col("first")).alias("shift"), F.sum("rows").over(tree).alias("size")),
                       "merkle-runs")
    return ordered.join(runs, ["part", "tree"]).withColumn("place", F.col("at") + F.col("shift")).drop("part", "at", "shift")


def _epochs(nodes: DataFrame, span: int, fanout: int, levels: int) -> list[DataFrame]:
    """Tables of nodes (tree, place, size, digest, ...), each a message table of blocks; the last has one node a tree."""
    def up(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        size = table["size"][0].as_py()
        digest, _ = climb(table["digest"].to_pylist(), min(levels, _height(size, fanout)), fanout)
        return pa.table({"tree": [key[0].as_py()], "place": pa.array([key[1].as_py()], pa.int64()),
                         "size": pa.array([-(-size // span)], pa.int64()), "digest": [digest]})

    epochs = [nodes]
    while epochs[-1].where("size > 1").take(1):
        messages = epochs[-1].select("tree", "place", "size", "digest", (F.col("place") / span).cast("long").alias("block"))
        epochs.append(materialize(messages.groupBy("tree", "block").applyInArrow(up, "tree string, place long, size long, digest string"),
                                  "merkle-epoch"))
    return epochs


def _deliver(epochs: list[DataFrame], tops: DataFrame, span: int, fanout: int, levels: int, keep: Sequence[str]) -> DataFrame:
    """Send ``tops`` (tree, proof, subroot, root) down the epochs; the first one's rows with ``keep`` and their proofs."""
    def down(names: Sequence[str]) -> Callable:
        def run(members: pa.Table, sent: pa.Table) -> pa.Table:
            members = members.sort_by("place")
            count = members.num_rows
            height = min(levels, _height(members["size"][0].as_py(), fanout))
            suffix = None
            for step in reversed(sent["proof"][0].as_py()):
                suffix = ((step["before"], step["after"]), suffix)
            _, inbox = climb(members["digest"].to_pylist(), height, fanout)
            proofs = _proof_array(descend(inbox, height, suffix, count, fanout)).cast(_PROOF)
            same = {c: pa.array([sent[c][0].as_py()] * count, pa.string()) for c in ("subroot", "root")}
            return pa.table({**{c: members[c] for c in names}, "proof": proofs, **same})
        return run

    sent = tops.withColumn("place", F.lit(0).cast("long"))
    for k in range(len(epochs) - 2, -1, -1):
        names = ["tree", "place"] if k else ["tree", *keep]
        members = epochs[k].withColumn("block", (F.col("place") / span).cast("long"))
        schema = ", ".join(f"`{c}` {members.schema[c].dataType.simpleString()}" for c in names)
        sent = members.groupBy("tree", "block").cogroup(sent.withColumnRenamed("place", "block").groupBy("tree", "block")) \
            .applyInArrow(down(names), f"{schema}, proof {PROOF}, subroot string, root string")
        if k:
            sent = materialize(sent, "merkle-proofs")
    if len(epochs) == 1:  # every tree is one leaf
        return epochs[0].select("tree", *keep).join(sent.drop("place"), "tree")
    return sent


def manifest(docs: DataFrame, fields: Sequence[str], group: str, order: str, others: dict[str, Column] | None = None,
             fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """One row a document: the order column, leaf, subroot, root and proof (array of siblings before and after).

    ``fields`` are the columns a leaf covers, in order. ``others`` are further
    columns, computed from the row, to carry along. ``fold(leaf, proof)``
    equals ``root`` for an unchanged row.
    """
    others, span = others or {}, fanout ** levels
    tree = F.when(F.col(group).isNull(), "-").otherwise(F.concat(F.lit("="), F.col(group).cast("string")))  # "-" < "="
    rows = docs.select(tree.alias("tree"), F.col(order).alias("key"), leaf_digest(*map(F.col, fields)).alias("digest"),
                       *(c.alias(f"x{k}") for k, c in enumerate(others.values())))
    keep = ["key", "digest", *(f"x{k}" for k in range(len(others)))]
    nodes = _epochs(_placed(rows, ["key", "digest"]), span, fanout, levels)
    subroots = nodes[-1].select("tree", "digest")
    upper = _epochs(_placed(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest"), ["name"]),
                    span, fanout, levels)
    top = upper[-1].select("tree", F.expr(f"cast(array() as {PROOF})").alias("proof"), F.lit("").alias("subroot"),
                           F.col("digest").alias("root"))
    tops = _deliver(upper, top, span, fanout, levels, ["name", "digest"]) \
        .select(F.col("name").alias("tree"), "proof", F.col("digest").alias("subroot"), "root")
    found = _deliver(nodes, materialize(tops, "merkle-tops"), span, fanout, levels, keep)
    return found.select(F.col("key").alias(order), F.col("digest").alias("leaf"), "subroot", "root", "proof",
                        *(F.col(f"x{k}").alias(n) for k, n in enumerate(others)))
