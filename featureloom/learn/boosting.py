"""Second-order histogram boosting of all folds at once, on Spark (survey L2, L3, L7).

* Features are coded once into at most ``bins`` ordered bins a column (cut at
  approximate quantiles; code 0 = missing) and written as one byte string a row.
* Where the packed rows and a tree's histograms take at most ``WHOLE_BYTES``, each
  model is trained in one task that keeps its rows packed (:func:`train_whole`):
  all rounds in one job a model. Larger tables are trained in passes, to the same trees
  (sums are exact, see :mod:`.histograms`):
* A pass over the coded rows adds up gradient and hessian histograms for every
  (model, open node, feature) -- all k fold models in the same pass, each without
  its own fold. Tasks send one row for each (model, node, block of features);
  Spark sums them and finds each block's best split where the sums are, and the
  driver sees one split for each (model, node, block). Only where the rows of all
  tasks and all passes are at most ``DRIVER_BYTES`` together (known before the
  pass), the driver sums them itself, with the same code, and the pass needs no
  shuffle.
* Trees grow best-first: each pass opens all nodes that could still be among the
  ``num_leaves - 1`` best splits, so the tree equals one grown a leaf at a time.
  Missing values take the side with the larger gain; L1 and L2 terms, smallest
  child weight, smallest gain and a column sample for each tree as usual.
* Margins are carried from round to round in persisted rows (recomputed from the
  trees of the rounds since the last written table if an executor is lost) and written
  every ``segment`` rounds with each row's held-out margin after every round in
  between; one AUC job covers all these rounds and folds. A model
  stops when ``patience`` rounds brought no better AUC and keeps its first best
  rounds: no second fit.

Nothing that a task or the driver holds grows with the rows beyond ``WHOLE_BYTES``: a
task of a pass holds at most ``TASK_BYTES`` of rows at a time, and histograms that
take models x open nodes x features x bins x 16 bytes.
"""

from __future__ import annotations

import heapq
import math
import uuid
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from itertools import zip_longest

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_path
from .histograms import Packing, grid, on_grid
from .metrics import best_round, roc_auc

BLOCK = 32  # features a histogram row
CUT_FEATURES, CUT_JOBS = 48, 8  # features whose cuts one job finds; such jobs at a time
MIN_TASK_BYTES, TASK_BYTES = 1 << 20, 64 << 20
DRIVER_BYTES = 32 << 20
WHOLE_BYTES = 256 << 20  # a model whose packed rows and histograms take no more is trained in one task


@dataclass(frozen=True)
class BoostParams:
    """Parameters of the boosted trees, named and set as in the reference where it has them."""
    rounds: int = 100
    learning_rate: float = 0.1
    num_leaves: int = 32
    max_depth: int = 8
    min_child_weight: float = 40.0
    min_split_gain: float = 0.0222415
    reg_alpha: float = 0.04
    reg_lambda: float = 0.073
    colsample: float = 0.9497036
    bins: int = 64
    patience: int | None = 20
    segment: int = 20
    seed: int = 47


@dataclass
class Tree:
    """Arrays over nodes; ``feature`` -1 marks a leaf. A code up to ``cut`` goes left, code 0 by ``missing_left``."""
    feature: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    missing_left: list[bool] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    weight: list[float] = field(default_factory=list)

    def add(self, value: float, weight: float) -> int:
        for column, v in (("feature", -1), ("cut", 0), ("missing_left", False), ("left", 0), ("right", 0), ("value", value),
                          ("gain", 0.0), ("weight", weight)):
            getattr(self, column).append(v)
        return len(self.feature) - 1

    def nodes_of(self, codes: np.ndarray) -> np.ndarray:
        """The node each coded row ends in."""
        feature, cut, missing = np.array(self.feature), np.array(self.cut), np.array(self.missing_left)
        left, right = np.array(self.left), np.array(self.right)
        at, rows = np.zeros(len(codes), np.int64), np.arange(len(codes))
        while True:
            f = feature[at]
            inner = f >= 0
            if not inner.any():
                return at
            c = codes[rows, np.maximum(f, 0)]
            go_left = np.where(c == 0, missing[at], c <= cut[at])
            at = np.where(inner, np.where(go_left, left[at], right[at]), at)

    def margins(self, codes: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.nodes_of(codes)]


def codes_of(column: pa.Array, rows: int, features: int) -> np.ndarray:
    """A column of byte strings of equal length as a matrix, without copying."""
    if not rows:
        return np.zeros((0, features), np.uint8)
    start = np.frombuffer(column.buffers()[1], np.int32)[column.offset]
    return np.frombuffer(column.buffers()[2], np.uint8)[start:start + rows * features].reshape(rows, features)


def list_matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _lists(matrix: np.ndarray) -> pa.Array:
    ends = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ascontiguousarray(matrix).ravel()))


def find_cuts(frame: DataFrame, features: Sequence[str], bins: int) -> list[np.ndarray]:
    """Ascending cut values of each feature: a value up to the i-th cut has code i + 1, larger ones the last code."""
    shares = F.array(*(F.lit(k / (bins - 2)) for k in range(bins - 1)))  # once: a column of its own for each feature takes the driver long
    cell = lambda c: F.when(~F.isnan(c), c)

    def values(some: Sequence[str]) -> list:
        return list(frame.select(*(F.col(f"`{c}`").cast("double").alias(f"v{k}") for k, c in enumerate(some))).agg(
            *(F.array_sort(F.array_distinct(F.percentile_approx(cell(F.col(f"v{k}")), shares, 100 * bins))).alias(f"v{k}")
              for k in range(len(some)))).first())

    groups = [features[a:a + CUT_FEATURES] for a in range(0, len(features), CUT_FEATURES)]  # one task merges the sketches of a job
    with ThreadPoolExecutor(max(min(len(groups), CUT_JOBS), 1)) as pool:
        return [np.array(v[:-1] if v else [], np.float64) for some in pool.map(values, groups) for v in some]


def threshold(cuts: np.ndarray, cut: int) -> float:
    """The largest value with a code up to ``cut``; infinity where all values have one, and only missing ones go right."""
    return float(cuts[cut - 1]) if cut <= len(cuts) else math.inf


def code_rows(frame: DataFrame, key: str, label: str, fold: str, features: Sequence[str], cuts: list[np.ndarray], path: str) -> DataFrame:
    """Write (key, y, fold, codes) of every row; y is NULL for rows to score only."""
    src = frame.select(F.col(key).alias("key"), F.col(label).cast("double").alias("y"), F.col(fold).cast("int").alias("fold"),
                       *(F.col(f"`{c}`").cast("double").alias(f"v{k}") for k, c in enumerate(features)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes = np.zeros((b.num_rows, len(cuts)), np.uint8)
            for k, cut in enumerate(cuts):
                v = b.column(3 + k).to_numpy(zero_copy_only=False)  # NULL comes as NaN
                codes[:, k] = np.where(np.isnan(v), 0, np.searchsorted(cut, v) + 1)
            ends = np.arange(b.num_rows + 1, dtype=np.int32) * len(cuts)
            packed = pa.BinaryArray.from_buffers(pa.binary(), b.num_rows, [None, pa.py_buffer(ends), pa.py_buffer(codes.tobytes())])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), packed], ["key", "y", "fold", "codes"])

    kind = src.schema["key"].dataType.simpleString()
    coded = src.mapInArrow(run, f"key {kind}, y double, fold int, codes binary")
    coded.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.parquet(path)


SPLIT = pa.schema([("model", pa.int32()), ("node", pa.int32()), ("feature", pa.int32()), ("gain", pa.float64()), ("cut", pa.int32()),
                   ("missing_left", pa.bool_()), *((c, pa.float64()) for c in ("gl", "hl", "gr", "hr", "g", "h"))])


def soft(g, alpha: float):
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0.0)


def best_split(g: np.ndarray, h: np.ndarray, allowed: np.ndarray, p: BoostParams) -> tuple | None:
    """Best (gain, feature, cut, missing_left, G left, H left, G right, H right) of histograms (feature, code).

    Ties go to the smaller feature, then the smaller cut, then missing values to the right.
    """
    total_g, total_h = g[0].sum(), h[0].sum()
    score = lambda a, b: soft(a, p.reg_alpha) ** 2 / (b + p.reg_lambda)
    left_g, left_h = np.cumsum(g[:, 1:-1], axis=1), np.cumsum(h[:, 1:-1], axis=1)
    best = None
    for missing_left in (False, True):
        gl = left_g + g[:, :1] if missing_left else left_g
        hl = left_h + h[:, :1] if missing_left else left_h
        gr, hr = total_g - gl, total_h - hl
        gain = score(gl, hl) + score(gr, hr) - score(total_g, total_h)
        gain = np.where((hl >= p.min_child_weight) & (hr >= p.min_child_weight) & allowed[:, None], gain, -np.inf)
        gain = gain.astype(np.float32)  # equal splits must tie whatever the order of the sums
        k = int(np.argmax(gain))
        f, c = divmod(k, gain.shape[1])
        if gain[f, c] > p.min_split_gain:
            found = (float(gain[f, c]), f, c + 1, missing_left, float(gl[f, c]), float(hl[f, c]), float(gr[f, c]), float(hr[f, c]))
            if best is None or (-found[0], found[1], found[2], found[3]) < (-best[0], best[1], best[2], best[3]):
                best = found
    return best


def cells_in(widths: np.ndarray, bins: int) -> np.ndarray:
    """Where the cells of a histogram lie in a matrix (feature, code)."""
    return np.flatnonzero(np.arange(bins) < widths[:, None])


def split_of(cells: np.ndarray, place: np.ndarray, allowed: np.ndarray, p: BoostParams) -> tuple | None:
    """:func:`best_split` of a histogram as :class:`.histograms.Packing` makes it; ``place``: :func:`cells_in`."""
    whole = np.zeros((2, len(allowed) * p.bins))
    whole[0, place], whole[1, place] = cells.real, cells.imag
    return best_split(*whole.reshape(2, len(allowed), p.bins), allowed, p)


def columns_of_tree(p: BoostParams, model: int, round_: int, features: int) -> np.ndarray:
    """Which features a tree may use."""
    keep = max(1, round(p.colsample * features))
    return np.isin(np.arange(features), np.random.default_rng([p.seed, model, round_]).permutation(features)[:keep])


class Grower:
    """One model's tree of one round, opened in passes (see the module's text), or only by the children of one split where no pass is saved."""

    def __init__(self, p: BoostParams, one_split: bool = False):
        self.p, self.one_split, self.tree, self.depth = p, one_split, Tree(), [0]
        self.tree.add(0.0, 0.0)
        self.known: dict[int, tuple | None] = {}
        self.open = [0]

    def leaf_value(self, g: float, h: float) -> float:
        return float(-soft(np.float64(g), self.p.reg_alpha) / (h + self.p.reg_lambda) * self.p.learning_rate)

    def learn(self, splits: dict[int, tuple | None], sums: dict[int, tuple[float, float]]) -> None:
        """Take the best splits of the open nodes and open the nodes needed next."""
        if 0 in self.open and 0 in sums:
            self.tree.value[0], self.tree.weight[0] = self.leaf_value(*sums[0]), sums[0][1]
        for node in self.open:
            self.known[node] = splits.get(node)
        self.open = [n for n in self.picks() if n not in self.known]

    def picks(self) -> list[int]:
        """Pick nodes best-first with what is known; their children become nodes of the tree. Returns the unknown ones met."""
        t, p = self.tree, self.p
        queue, unknown, left_over = [], [], p.num_leaves - 1
        self.chosen: list[int] = []

        def meet(node: int) -> None:
            if self.depth[node] >= p.max_depth or (node and t.weight[node] < 2 * p.min_child_weight):
                return
            if node not in self.known:
                unknown.append(node)
            elif self.known[node] is not None:
                heapq.heappush(queue, (-self.known[node][0], node))

        meet(0)
        while queue and left_over and not (unknown and self.one_split):
            _, node = heapq.heappop(queue)
            left_over -= 1
            self.chosen.append(node)
            gain, f, cut, missing_left, gl, hl, gr, hr = self.known[node]
            if t.feature[node] < 0:
                t.feature[node], t.cut[node], t.missing_left[node], t.gain[node] = f, cut, missing_left, gain
                for side, g, h in (("left", gl, hl), ("right", gr, hr)):
                    getattr(t, side)[node] = t.add(self.leaf_value(g, h), h)
                    self.depth.append(self.depth[node] + 1)
            if left_over:  # a child may still displace nodes picked later
                meet(t.left[node])
                meet(t.right[node])
        return unknown

    def finished(self) -> Tree:
        """The tree with the picked nodes only."""
        self.picks()
        out, chosen = Tree(), set(self.chosen)

        def copy(node: int) -> int:
            at = out.add(self.tree.value[node], self.tree.weight[node])
            if node in chosen:
                out.feature[at], out.cut[at] = self.tree.feature[node], self.tree.cut[node]
                out.missing_left[at], out.gain[at] = self.tree.missing_left[node], self.tree.gain[node]
                out.left[at] = copy(self.tree.left[node])
                out.right[at] = copy(self.tree.right[node])
            return at

        copy(0)
        return out


def held_out_auc(score: np.ndarray, y: np.ndarray) -> float:
    """AUC as :func:`.metrics.roc_auc` has it; 0.5 where a class has no rows."""
    _, at = np.unique(score, return_inverse=True)
    pos, neg = (np.bincount(at, y == k) if len(y) else np.zeros(0) for k in (1, 0))
    pairs = pos.sum() * neg.sum()
    return float((pos * (np.cumsum(neg) - neg / 2.0)).sum() / pairs) if pairs else 0.5


def whole_bytes(rows: int, packing: Packing, p: BoostParams) -> int:
    """What :func:`train_whole` holds: packed rows with label, margin, gradients and place, and the leaves' histograms."""
    return rows * (2 * len(packing.packs) + 40) + 16 * packing.cells * p.num_leaves


def train_whole(p: BoostParams, model: int, packing: Packing, rows: np.ndarray, y: np.ndarray, held: np.ndarray, held_y: np.ndarray,
                start: float) -> tuple[list[Tree], list[float]]:
    """All trees of one model on packed rows, and the AUC of the held-out rows after every round.

    A split counts the rows of its smaller child; the other child's histogram is what is left of the parent's.
    """
    scale, features = grid(len(y) + len(held_y)), len(packing.widths)
    place = cells_in(np.array(packing.widths), p.bins)
    margins, held_margins = np.full(len(y), start), np.full(len(held_y), start)
    trees, aucs = [], []
    for r in range(p.rounds):
        gh, allowed = on_grid(margins, y, scale), columns_of_tree(p, model, r, features)
        grower = Grower(p, one_split=True)
        tree = grower.tree
        at, held_at, cells = {0: np.arange(len(y))}, {0: np.arange(len(held_y))}, {0: packing.histogram(rows, None, gh)}

        def divide(node: int) -> None:
            for where, packed in ((at, rows), (held_at, held)):
                mine = where.pop(node)
                c = packing.codes(packed, tree.feature[node], mine)
                left = np.where(c == 0, tree.missing_left[node], c <= tree.cut[node])
                where[tree.left[node]], where[tree.right[node]] = mine[left], mine[~left]

        total = cells[0][:packing.widths[0]].sum()
        grower.learn({0: split_of(cells[0], place, allowed, p)}, {0: (total.real, total.imag)})
        while grower.open:
            node = grower.chosen[-1]
            divide(node)
            small, large = sorted((tree.left[node], tree.right[node]), key=lambda n: len(at[n]))
            some = packing.histogram(rows, at[small], gh[at[small]])
            cells[small], cells[large] = some, cells.pop(node) - some
            grower.learn({n: split_of(cells[n], place, allowed, p) for n in grower.open}, {})
            for n in (small, large):
                if grower.known.get(n) is None:  # no further split
                    del cells[n]
        for node in grower.chosen:
            if node in at:
                divide(node)
        for where, sums in ((at, margins), (held_at, held_margins)):
            for leaf, some in where.items():
                sums[some] += tree.value[leaf]
        trees.append(grower.finished())
        if len(held_y):  # a fold without rows stops nothing
            aucs.append(held_out_auc(held_margins, held_y))
        if p.patience and aucs and len(aucs) - best_round([-a for a in aucs], p.patience) >= p.patience:
            break
    return trees, aucs


ROUND = pa.schema([("auc", pa.float64()), ("feature", pa.list_(pa.int32())), ("cut", pa.list_(pa.int32())), ("missing_left", pa.list_(pa.bool_())),
                   ("left", pa.list_(pa.int32())), ("right", pa.list_(pa.int32())), *((c, pa.list_(pa.float64())) for c in ("value", "gain", "weight"))])


def _whole_models(known: DataFrame, p: BoostParams, widths: np.ndarray, active: list[int], start: list[float],
                  rows_of: dict[int, int]) -> dict[int, list[dict]]:
    """The rounds of all models, one job of one task a model: it reads the coded rows and keeps them packed."""
    rows, features = sum(rows_of.values()), len(widths)

    def train(model: int) -> list[dict]:
        sizes, start_here = (rows - rows_of.get(model, 0), rows_of.get(model, 0)), start[model]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            packing = Packing(widths)
            tables, labels, filled = [np.empty((len(packing.packs), n), np.uint16) for n in sizes], [np.empty(n) for n in sizes], [0, 0]
            for b in batches:
                codes = codes_of(b.column(2), b.num_rows, features)
                y, fold = (b.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
                for k, mine in enumerate((fold != model, fold == model)):
                    a = filled[k]
                    filled[k] = z = a + int(mine.sum())
                    tables[k][:, a:z], labels[k][a:z] = packing.pack(codes[mine]), y[mine]
            trees, aucs = train_whole(p, model, packing, tables[0], labels[0], tables[1], labels[1], start_here)
            yield pa.RecordBatch.from_pylist([{"auc": auc, **t.__dict__} for t, auc in zip_longest(trees, aucs)], ROUND)

        kinds = "auc double, feature array<int>, cut array<int>, missing_left array<boolean>, left array<int>, right array<int>, " \
                "value array<double>, gain array<double>, weight array<double>"
        return [r.asDict() for r in known.select("y", "fold", "codes").coalesce(1).mapInArrow(run, kinds).collect()]

    with ThreadPoolExecutor(len(active)) as pool:
        return dict(zip(active, pool.map(train, active)))


def _together(batches: Iterator[pa.RecordBatch], features: int, models: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(codes, y, fold, margins) of at most ``TASK_BYTES`` of rows at a time: few rows count slowly."""
    kept, size = [], 0

    def whole() -> tuple[np.ndarray, ...]:
        return tuple(np.concatenate(some) for some in zip(*kept))

    for b in batches:
        if not b.num_rows:
            continue
        kept.append((codes_of(b.column(0), b.num_rows, features).copy(), *(b.column(k).to_numpy(zero_copy_only=False) for k in (1, 2)),
                     list_matrix(b.column(3), models).copy()))
        size += b.num_rows * (features + 8 * models)
        if size >= TASK_BYTES:
            yield whole()
            kept, size = [], 0
    if kept:
        yield whole()


def _histograms(state: DataFrame, p: BoostParams, widths: np.ndarray, models: int, rows: int,
                growing: dict[int, tuple[Tree, list[int]]], allowed: dict[int, np.ndarray], tasks: int) -> list[dict]:
    """The best split of each (model, open node, block of features), and the node's sums ``g`` and ``h``.

    Rows hold the ``widths`` codes that each feature has, so a flag takes three cells and not ``bins``.
    """
    features = len(widths)
    ends = np.cumsum(widths)
    shift, cells_of_all = ends - widths, int(ends[-1])
    blocks = [(a, min(a + BLOCK, features)) for a in range(0, features, BLOCK)]
    packing, scale = Packing(widths), grid(rows)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        sums: dict[tuple[int, int], np.ndarray] = {}
        for codes, y, fold, margins in _together(batches, features, models):
            packed = packing.pack(codes)
            for m, (tree, open_nodes) in growing.items():
                at = tree.nodes_of(codes)
                at[fold == m] = -1
                for node in open_nodes:
                    here = np.flatnonzero(at == node)
                    if not len(here):  # nothing to send of this node
                        continue
                    cells = packing.histogram(packed, here, on_grid(margins[here, m], y[here], scale))
                    total = sums.get((m, node))
                    sums[m, node] = cells if total is None else total + cells
        for (m, node), cells in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([m] * len(blocks), pa.int32()), pa.array([node] * len(blocks), pa.int32()), pa.array([a for a, _ in blocks], pa.int32()),
                 pa.array([part] * len(blocks), pa.int32()), pa.array([cells[shift[a]:ends[z - 1]].tobytes() for a, z in blocks], pa.binary())],
                ["model", "node", "block", "part", "sums"])

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows of one (model, node, block) follow each other, ordered by ``part``."""
        key, sums, out = None, [], []
        for b in batches:
            for *at, one in zip(*(b.column(c).to_pylist() for c in ("model", "node", "block", "sums"))):
                if at != key and sums:
                    out.append(settled(*key, sums))
                    sums = []
                key = at
                sums.append(one)
        if sums:
            out.append(settled(*key, sums))
        yield pa.RecordBatch.from_pylist(out, SPLIT)

    def settled(m: int, node: int, a: int, sums: list[bytes]) -> dict:
        wide = widths[a:a + BLOCK]
        cells = sum(np.frombuffer(s, np.complex128) for s in sums)
        found, total = split_of(cells, cells_in(wide, p.bins), allowed[m][a:a + BLOCK], p), cells[:wide[0]].sum()
        gain, f, cut, missing_left, gl, hl, gr, hr = found or (None, 0, 0, False, 0.0, 0.0, 0.0, 0.0)
        return {"model": m, "node": node, "feature": a + f, "gain": gain, "cut": cut, "missing_left": missing_left,
                "gl": gl, "hl": hl, "gr": gr, "hr": hr, "g": float(total.real), "h": float(total.imag)}

    partial = state.select("codes", "y", "fold", "margins") \
        .mapInArrow(add_up, "model int, node int, block int, part int, sums binary")
    groups = sum(len(nodes) for _, nodes in growing.values()) * len(blocks)
    if tasks * sum(len(nodes) for _, nodes in growing.values()) * cells_of_all * 16 * p.rounds * p.max_depth > DRIVER_BYTES:  # a tree takes at most max_depth passes
        key = ["model", "node", "block"]
        splits = partial.repartition(min(groups, tasks), *key) \
            .sortWithinPartitions(*key, "part").mapInArrow(
                settle, "model int, node int, feature int, gain double, cut int, missing_left boolean, gl double, hl double, gr double, "
                        "hr double, g double, h double")
        return [r.asDict() for r in splits.collect()]
    sums: dict[tuple[int, int, int], list[bytes]] = {}
    for r in partial.toArrow().sort_by("part").to_pylist():  # always in the same order
        sums.setdefault((r["model"], r["node"], r["block"]), []).append(r["sums"])
    return [settled(*key, some) for key, some in sums.items()]


def _advance(state: DataFrame, features: int, models: int, trees: dict[int, Tree]) -> DataFrame:
    """The state after one round: its trees added to the margins, each row's held-out margin appended to ``staged``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes = codes_of(b.column(0), b.num_rows, features)
            fold = b.column(2).to_numpy(zero_copy_only=False)
            margins = list_matrix(b.column(3), models).copy()
            for m, tree in trees.items():
                margins[:, m] += tree.margins(codes)
            before = b.column(4).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1 if b.num_rows else 0)
            staged = np.hstack([before, margins[np.arange(b.num_rows), fold][:, None]])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), _lists(margins), _lists(staged)],
                                             ["codes", "y", "fold", "margins", "staged"])

    return state.select("codes", "y", "fold", "margins", "staged").mapInArrow(
        run, "codes binary, y double, fold int, margins array<double>, staged array<double>")


@dataclass
class BoostedFolds:
    """The fold models: trees of the rounds each one keeps, and the held-out AUC after every round."""
    features: list[str]
    cuts: list[np.ndarray]
    start: list[float]
    trees: list[list[Tree]]
    aucs: list[list[float]]
    coded: DataFrame  # key, y, fold, codes

    def probability(self, rows: DataFrame, own_fold: bool) -> DataFrame:
        """Coded rows with ``score``: by the model of the row's own fold, or the mean over all models."""
        start, trees, features = self.start, self.trees, len(self.features)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                codes = codes_of(b.column(3), b.num_rows, features)
                fold = b.column(2).to_numpy(zero_copy_only=False)
                score = np.zeros(b.num_rows)
                for m, some in enumerate(trees):
                    mine = np.flatnonzero(fold == m) if own_fold else np.arange(b.num_rows)
                    margin = start[m] + sum((t.margins(codes[mine]) for t in some), np.zeros(len(mine)))
                    score[mine] += 1.0 / (1.0 + np.exp(-margin)) / (1 if own_fold else len(trees))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(score)], ["key", "y", "fold", "score"])

        kind = rows.schema["key"].dataType.simpleString()
        return rows.select("key", "y", "fold", "codes").mapInArrow(run, f"key {kind}, y double, fold int, score double")

    def nodes(self) -> DataFrame:
        """The node table: fold, round, node, feature (NULL for a leaf), threshold, missing_left, left, right, value, gain, weight."""
        rows = []
        for m, some in enumerate(self.trees):
            for r, t in enumerate(some):
                for n, f in enumerate(t.feature):
                    inner = f >= 0
                    rows.append((m + 1, r + 1, n, self.features[f] if inner else None,
                                 threshold(self.cuts[f], t.cut[n]) if inner else None, t.missing_left[n] if inner else None,
                                 t.left[n] if inner else None, t.right[n] if inner else None, t.value[n],
                                 t.gain[n] if inner else None, t.weight[n]))
        return self.coded.sparkSession.createDataFrame(rows, "fold int, round int, node int, feature string, threshold double, "
                                                             "missing_left boolean, left int, right int, value double, gain double, weight double")

    def importances(self) -> DataFrame:
        """(feature, importance, gain, fold): split counts, the reference's importance, and summed gains of every feature."""
        spark = self.coded.sparkSession
        every = spark.createDataFrame([(f, m + 1) for f in self.features for m in range(len(self.trees))], "feature string, fold int")
        counts = self.nodes().where("feature is not null").groupBy("feature", "fold") \
            .agg(F.count("*").cast("double").alias("importance"), F.sum("gain").alias("gain"))
        return every.join(F.broadcast(counts), ["feature", "fold"], "left").select(  # one row a feature and fold
            "feature", F.coalesce("importance", F.lit(0.0)).alias("importance"), F.coalesce("gain", F.lit(0.0)).alias("gain"), "fold")


def _best(trees: list[Tree], aucs: list[float], p: BoostParams) -> list[Tree]:
    """The trees of the first best rounds."""
    return trees[:best_round([-a for a in aucs], p.patience)] if p.patience and aucs else trees


def boost_folds(frame: DataFrame, key: str, label: str, fold: str, n_folds: int, features: Sequence[str],
                p: BoostParams = BoostParams()) -> BoostedFolds:
    """Boost one model a fold on the labelled rows of the other folds. ``fold`` is 0 to n_folds - 1 where a label is."""
    if not 3 <= p.bins <= 256:
        raise ValueError("bins must lie between 3 and 256")
    spark, features = frame.sparkSession, list(features)
    base = checkpoint_path(spark, f"boost-{uuid.uuid4().hex}")
    cuts = find_cuts(frame, features, p.bins)
    coded = code_rows(frame, key, label, fold, features, cuts, f"{base}/coded")
    known = coded.where("y is not null and fold is not null")
    sums = {r["fold"]: (r["n"], r["pos"]) for r in known.groupBy("fold").agg(F.count("*").alias("n"), F.sum("y").alias("pos")).collect()}
    rows, positives = sum(n for n, _ in sums.values()), sum(q for _, q in sums.values())
    start = []
    for m in range(n_folds):
        n, q = sums.get(m, (0, 0.0))
        share = min(max((positives - q) / max(rows - n, 1), 1e-6), 1 - 1e-6)
        start.append(math.log(share / (1 - share)))
    widths = np.array([len(c) + 2 for c in cuts], np.int64)  # missing, up to each cut, above
    trees: list[list[Tree]] = [[] for _ in range(n_folds)]
    aucs: list[list[float]] = [[] for _ in range(n_folds)]
    active = [m for m in range(n_folds) if rows > sums.get(m, (0, 0.0))[0]]
    size = rows * max(len(features), 1)
    if active and features and p.rounds and whole_bytes(rows, Packing(widths), p) <= WHOLE_BYTES:
        for m, some in _whole_models(known, p, widths, active, start, {m: n for m, (n, _) in sums.items()}).items():
            aucs[m] = [x for r in some if (x := r.pop("auc")) is not None]
            trees[m] = [Tree(**r) for r in some]
        return BoostedFolds(features, cuts, start, [_best(t, a, p) for t, a in zip(trees, aucs)], aucs, coded)
    tasks = max(-(-size // TASK_BYTES), min(spark.sparkContext.defaultParallelism, -(-size // MIN_TASK_BYTES)), 1)
    nothing = F.expr("cast(array() as array<double>)").alias("staged")
    known.select("codes", "y", "fold", F.array(*(F.lit(s) for s in start)).alias("margins"), nothing).repartition(tasks) \
        .write.option("compression", "zstd").parquet(f"{base}/state-0")
    state = spark.read.parquet(f"{base}/state-0")
    done = 0
    while active and features and done < p.rounds:
        count = min(p.segment, p.rounds - done)
        state = state.withColumn("staged", nothing).persist()
        kept = [state]
        for r in range(done, done + count):
            growers = {m: Grower(p) for m in active}
            allowed = {m: columns_of_tree(p, m, r, len(features)) for m in active}
            while any(g.open for g in growers.values()):
                growing = {m: (g.tree, g.open) for m, g in growers.items() if g.open}
                found = _histograms(state, p, widths, n_folds, rows, growing, allowed, tasks)
                for m in growing:
                    mine = [s for s in found if s["model"] == m]
                    splits: dict[int, tuple | None] = {}
                    for s in sorted((s for s in mine if s["gain"] is not None), key=lambda s: (-s["gain"], s["feature"])):
                        splits.setdefault(s["node"], (s["gain"], s["feature"], s["cut"], s["missing_left"], s["gl"], s["hl"], s["gr"], s["hr"]))
                    totals = {s["node"]: (s["g"], s["h"]) for s in sorted(mine, key=lambda s: -s["feature"])}
                    growers[m].learn(splits, totals)
            finished = {m: g.finished() for m, g in growers.items()}
            for m, tree in finished.items():
                trees[m].append(tree)
            state = _advance(state, len(features), n_folds, finished).persist()
            kept.append(state)
            if len(kept) > 2:
                kept.pop(0).unpersist()
        done += count
        state.write.option("compression", "zstd").parquet(f"{base}/state-{done}")
        for old in kept:
            old.unpersist()
        state = spark.read.parquet(f"{base}/state-{done}")
        scored = state.select("y", "fold", F.posexplode("staged").alias("round", "score"))
        for row in roc_auc(scored, "score", "y", group_cols=["fold", "round"]).orderBy("fold", "round").collect():
            if row["fold"] in active:
                aucs[row["fold"]].append(0.5 if row["auc"] is None else row["auc"])
        if p.patience:
            active = [m for m in active if len(aucs[m]) < done or done - best_round([-a for a in aucs[m]], p.patience) < p.patience]
    return BoostedFolds(features, cuts, start, [_best(t, a, p) for t, a in zip(trees, aucs)], aucs, coded)
