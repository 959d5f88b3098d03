"""MinHash near-duplicate components with min-max hashing.

Every permutation ``h(x) = a * x + b (mod 2**64)`` contributes both its minimum
and its maximum over a document's shingle set, so 64 multiplications per
shingle give a signature of 128 values, each an unbiased estimate of the
Jaccard similarity. 32 bands of 4 values send a pair at the threshold 0.8 to a
common bucket with probability 1 - (1 - 0.8**4)**32 > 1 - 1e-7.

1. One pass over the texts gives per row: set size, class (128-bit digest of
   the shingle set), band keys and the signature cut to 8 bits a value. Equal
   sets share a class from here on, so copies never meet as pairs.
2. Buckets of two or more classes are kept; inside a bucket (hot ones are cut
   into blocks of ``block`` members) the 8-bit signatures are compared in numpy.
   A pair counts only in the first bucket it shares, when its estimate is above
   ``threshold - slack`` and its classes lie in different components.
3. In the quota rounds each class proposes its most similar such partners; the
   pairs are confirmed on the full shingle sets, and confirmed links join
   components (min-label propagation with pointer jumping).
4. What is left after them is settled whole: every class that still has such a
   partner is sent with its set to the bucket's block, and there all remaining
   pairs are confirmed, those in one component by then excepted. Only links
   leave the task. No partner is capped and no pair of a group is written out.

``slack`` 0.15 is over four standard deviations of a 128-value estimate.

Rules: null or word-free texts have the empty set, size 0, and link with
nothing; repeated rows are rows of one class; a null id gives a row with a
null id and takes part through its text only (an all-null component has a
null ``component_id`` and its rows are kept); only the id and text columns are
read, so other columns cannot clash; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, WordHash, is_empty, map_batches, materialize, texts

PERMUTATIONS, BANDS, ROWS = 64, 32, 4
EMPTY = b"\0" * 16
MIX = np.uint64(0x9E3779B97F4A7C15)


def shingle_set(words: list[bytes], hashes: WordHash, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``width``-word shingles; fewer words: the whole sequence."""
    if not words:
        return np.empty(0, np.uint64)
    h = hashes.array(words)
    width = min(width, len(h))
    out = np.full(len(h) - width + 1, width, np.uint64)
    for j in range(width):
        out = (out ^ h[j:len(h) - width + 1 + j]) * MIX
        out ^= out >> np.uint64(32)
    return np.unique(out)


def permutations(seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    a, b = rng.integers(0, 2**63, (2, PERMUTATIONS), dtype=np.uint64)
    return (a << np.uint64(1)) | np.uint64(1), b


def minmax_signature(sets: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minimum and maximum under each permutation, as upper 32 bits, interleaved."""
    low, high = np.full(len(a), 2**64 - 1, np.uint64), np.zeros(len(a), np.uint64)
    for at in range(0, len(sets), 512):
        m = a[:, None] * sets[None, at:at + 512] + b[:, None]
        np.minimum(low, m.min(1), out=low)
        np.maximum(high, m.max(1), out=high)
    return (np.stack([low, high], 1).ravel() >> np.uint64(32)).astype(np.uint32)


def _signatures(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        hashes, (a, b) = WordHash(), permutations()
        for batch in batches:
            for at, some in texts(batch):
                out = {k: [] for k in ("n", "cls", "bands", "sig")}
                for text in some:
                    s = shingle_set((text or "").encode().translate(LOWER).split(), hashes, width)
                    out["n"].append(len(s))
                    if not len(s):
                        out["cls"].append(EMPTY), out["bands"].append(None), out["sig"].append(None)
                        continue
                    sig = minmax_signature(s, a, b)
                    key = np.arange(1, BANDS + 1, dtype=np.uint64) * MIX
                    for v in sig.reshape(BANDS, ROWS).T.astype(np.uint64):
                        key = (key ^ v) * MIX
                        key ^= key >> np.uint64(29)
                    out["cls"].append(class_of(s))
                    out["bands"].append(key.view(np.int64))
                    out["sig"].append((sig & np.uint32(255)).astype(np.uint8).tobytes())
                yield {"id": batch.column("id").slice(at, len(some)), "h": batch.column("h").slice(at, len(some)), **out}
    return run


def _short_bands(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Band keys cut to 32 bits, packed."""
    for batch in batches:
        keys = [np.array(k, np.int64).astype(np.uint32).tobytes() for k in batch.column("bands").to_pylist()]
        yield {**{f.name: batch.column(f.name) for f in batch.schema}, "bands": keys}


def class_of(sets: np.ndarray) -> bytes:
    return hashlib.blake2b(sets.tobytes(), digest_size=16).digest()


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        hashes = WordHash()
        for batch in batches:
            for _, some in texts(batch):
                sets = [shingle_set(t.encode().translate(LOWER).split(), hashes, width) for t in some]
                yield {"cls": [class_of(s) for s in sets], "blob": [s.tobytes() for s in sets]}
    return run


ROW = ("cls", "comp", "n", "sig", "bands", "band", "seeks")


def _groups(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[tuple[tuple, dict[str, list]]]:
    """Runs of rows with one (bucket, m, s), as columns."""
    last, rows = None, {}
    for batch in batches:
        d = batch.to_pydict()
        for key, *values in zip(zip(d["bucket"], d["m"], d["s"]), *(d[k] for k in names)):
            if key != last:
                if rows:
                    yield last, rows
                last, rows = key, {k: [] for k in names}
            for k, v in zip(names, values):
                rows[k].append(v)
    if rows:
        yield last, rows


def _partners(rows: dict[str, list], least: float, ratio: float) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(i, partners, estimates) of every seeking row that has partners in other components."""
    if len(set(rows["comp"])) < 2:
        return
    codes = np.unique(np.array([c.hex() for c in rows["comp"]]), return_inverse=True)[1]
    sig = np.frombuffer(b"".join(rows["sig"]), np.uint8).reshape(len(codes), -1)
    bands = np.frombuffer(b"".join(rows["bands"]), np.uint32).reshape(len(codes), -1)
    n, band = np.array(rows["n"], np.float64), rows["band"][0]
    for i in np.flatnonzero(rows["seeks"]):
        js = np.flatnonzero((codes != codes[i]) & (np.minimum(n, n[i]) >= ratio * np.maximum(n, n[i])))
        same = (sig[js] == sig[i]).mean(1)
        good = (same >= least) & ~(bands[js, :band] == bands[i, :band]).any(1)
        if good.any():
            yield i, js[good], same[good]


def _propose(quota: int, least: float, ratio: float):
    """The most similar partners of each class, as pairs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for _, rows in _groups(batches, ROW):
            found = set()
            for i, js, same in _partners(rows, least, ratio):
                if len(js) > quota:
                    js = js[np.argpartition(-same, quota - 1)[:quota]]
                found.update(tuple(sorted((rows["cls"][i], rows["cls"][j]))) for j in js)
            if found:
                yield {"x": [p[0] for p in found], "y": [p[1] for p in found]}
    return run


def _involved(least: float, ratio: float):
    """The rows of each group that still have a partner."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for (bucket, m, s), rows in _groups(batches, ROW):
            mine = set()
            for i, js, _ in _partners(rows, least, ratio):
                mine.add(i)
                mine.update(js.tolist())
            if mine:
                yield {"bucket": [bucket] * len(mine), "m": [m] * len(mine), "s": [s] * len(mine),
                       **{k: [rows[k][i] for i in mine] for k in ROW}}
    return run


def is_linked(s: np.ndarray, t: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(s, t, assume_unique=True))
    return 100 * both >= percent * (len(s) + len(t) - both)


def _settle(least: float, ratio: float, percent: int):
    """Links that join the components of a group, all its remaining pairs confirmed on their sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for _, rows in _groups(batches, (*ROW, "blob")):
            root = {c: c for c in rows["comp"]}

            def find(c: bytes) -> bytes:
                while root[c] != c:
                    root[c] = c = root[root[c]]
                return c

            sets, links = [np.frombuffer(b, np.uint64) for b in rows["blob"]], []
            for i, js, same in _partners(rows, least, ratio):
                for j in js[np.argsort(-same)].tolist():
                    a, b = find(rows["comp"][i]), find(rows["comp"][j])
                    if a != b and is_linked(sets[i], sets[j], percent):
                        root[a] = b
                        links.append((rows["cls"][i], rows["cls"][j]))
            if links:
                yield {"x": [p[0] for p in links], "y": [p[1] for p in links]}
    return run


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            xs, ys, linked = batch.column("x").to_pylist(), batch.column("y").to_pylist(), []
            for bx, by in zip(batch.column("bx"), batch.column("by")):
                linked.append(is_linked(np.frombuffer(bx.as_buffer(), np.uint64), np.frombuffer(by.as_buffer(), np.uint64), percent))
            yield {"x": xs, "y": ys, "linked": linked}
    return run


def connected_components(links: DataFrame) -> DataFrame:
    """(node, comp) for every end of ``links`` (x, y); comp is the smallest node reachable.

    Min-label propagation with pointer jumping; every step is joins and
    aggregations with map-side combine, its state a written table.
    """
    edges = materialize(links.select("x", "y").unionAll(links.select(F.col("y"), F.col("x"))).distinct(), "edges")
    label = materialize(edges.groupBy(F.col("x").alias("node")).agg(F.min("y").alias("m"))
                        .select("node", F.least("node", "m").alias("comp")), "label")
    while True:
        near = edges.join(label, edges.y == label.node).groupBy("x").agg(F.min("comp").alias("m"))
        step = label.join(near, label.node == near.x).select("node", F.least("comp", "m").alias("new"),
                                                              F.col("comp").alias("old"))
        step = materialize(step, "step")
        jump = step.select(F.col("node").alias("root"), F.col("new").alias("far"))
        both = step.join(jump, step.new == jump.root).select(
            "node", F.least("new", "far").alias("comp"), "old")
        both = materialize(both, "label")
        label = both.select("node", "comp")
        if is_empty(both.where("comp <> old")):
            return label


def _blocks(rows: DataFrame, block: int) -> DataFrame:
    """Rows of buckets that hold two or more components, dealt into groups of a bounded size.

    A bucket's largest component does not seek. Seekers are replicated to every
    block of members and members to every block of seekers, so each group holds
    about ``2 * block`` rows at most and every (seeker, member) meets once.
    """
    parts = rows.groupBy("bucket", "comp").agg(F.count("*").alias("c")).groupBy("bucket").agg(
        F.max_by("comp", F.struct("c", "comp")).alias("main"), F.sum("c").alias("members"),
        F.max("c").alias("largest"), F.count("*").alias("k")).where("k > 1")
    rows = rows.select("bucket", "cls", "comp", "band").join(parts, "bucket").withColumns({
        "seeker": F.col("comp") != F.col("main"),
        "nm": F.ceil(F.col("members") / block).cast("int"),
        "ns": F.ceil((F.col("members") - F.col("largest")) / block).cast("int"),
    }).withColumns({"mb": F.expr("pmod(hash(cls), nm)"), "sb": F.expr("pmod(hash(cls, 1), ns)")})
    copies = F.expr("""concat(
        if(seeker, transform(sequence(0, nm - 1), m -> struct(m as m, sb as s, true as seeks)), array()),
        if(seeker and nm = 1 and ns = 1, array(),
           transform(sequence(0, ns - 1), s -> struct(mb as m, s as s, false as seeks))))""")
    return rows.select("bucket", "cls", "comp", "band", F.inline(copies))


def _merge(src: DataFrame, member: DataFrame, active: DataFrame, width: int, percent: int,
           block: int, slack: float, quotas: tuple[int, ...]) -> DataFrame:
    """(node, comp) of the classes in ``active``."""
    pick = active.select("id", "h").hint("shuffle_hash")
    texts_ = src.join(pick, src.id.eqNullSafe(pick.id) & (src.h == pick.h), "left_semi")
    sets = materialize(map_batches(texts_.select("text"), _sets(width), "cls binary, blob binary")
                       .join(active.select("cls"), "cls", "left_semi").dropDuplicates(["cls"]), "sets")
    comp = active.select(F.col("cls").alias("node"), F.col("cls").alias("comp"))
    tried = None
    least, ratio = percent / 100 - slack, percent / 100
    row_ddl = "bucket long, m int, s int, cls binary, comp binary, n long, sig binary, bands binary, band int, seeks boolean"

    def grouped(rows: DataFrame) -> DataFrame:
        return rows.repartition("bucket", "m", "s").sortWithinPartitions("bucket", "m", "s")

    def joined(links: DataFrame) -> DataFrame:
        cx, cy = comp.toDF("x", "cx"), comp.toDF("y", "cy")
        ends = links.join(cx, "x").join(cy, "y").where("cx <> cy").select(F.col("cx").alias("x"), F.col("cy").alias("y"))
        roots = connected_components(ends).select(F.col("node").alias("comp"), F.col("comp").alias("root"))
        return materialize(comp.join(roots, "comp", "left").select("node", F.coalesce("root", "comp").alias("comp")), "comp")

    for quota in (*quotas, 0):
        rows = member.join(comp, F.col("cls") == comp.node).select("bucket", "cls", "comp", "band", "c")
        if tried is None:  # every class is a component of its own: blocks of a bucket apart
            rows = rows.withColumns({"m": F.expr(f"cast(pmod(hash(cls), ceil(c / {block})) as int)"), "s": F.lit(0), "seeks": F.lit(True)})
        else:
            rows = _blocks(rows, block)
        # the signatures come last, so that they are shuffled to the groups alone
        rows = grouped(rows.join(active.select("cls", "n", "sig", "bands"), "cls").select("bucket", "m", "s", *ROW))
        if not quota:
            left = map_batches(rows, _involved(least, ratio), row_ddl).join(sets, "cls").select("bucket", "m", "s", *ROW, "blob")
            return joined(materialize(map_batches(grouped(left), _settle(least, ratio, percent), "x binary, y binary"), "links"))
        pairs = map_batches(rows, _propose(quota, least, ratio), "x binary, y binary").distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["x", "y"], "left_anti")
        pairs = materialize(pairs, "pairs")
        x, y = sets.select(F.col("cls").alias("x"), F.col("blob").alias("bx")), \
            sets.select(F.col("cls").alias("y"), F.col("blob").alias("by"))
        checked = materialize(map_batches(pairs.join(x, "x").join(y, "y").select("x", "y", "bx", "by"),
                                          _confirm(percent), "x binary, y binary, linked boolean"), "checked")
        tried = checked.select("x", "y") if tried is None else tried.unionAll(checked.select("x", "y"))
        comp = joined(checked.where("linked"))


def _first_rows(sigs: DataFrame, comps: DataFrame, id_col: str, text_hash: str) -> DataFrame:
    key = F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("h"))
    rows = sigs.where("n > 0").join(comps, sigs.cls == comps.node, "left").select("id", "h", "n", F.coalesce("comp", "cls").alias("root"))
    least = materialize(rows.groupBy("root").agg(F.min(key).alias("least")), "least")
    full = rows.join(least, "root").select("id", "h", "n", F.col("least.id").alias("component_id"), key.eqNullSafe(F.col("least")).alias("kept"))
    none = sigs.where("n = 0").select("id", "h", "n", F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    return full.unionAll(none).toDF(id_col, text_hash, "n_shingles", "component_id", "kept")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text", block: int = 2048, slack: float = 0.15,
                    quotas: tuple[int, ...] = (2, 16), text_hash: str | None = None) -> DataFrame:
    """Per row: id, ``n_shingles``, ``component_id`` and ``kept`` (the component's smallest id).

    With ``text_hash``, a column of that name has xxhash64 of the text, and
    ``kept`` holds for the component's smallest (id, hash) alone, null ids last.

    Two rows are linked when 100 * |A and B| >= percent * |A or B| over their
    distinct ``width``-word shingles. ``quotas``: how many partners a class
    proposes in each quota round.
    """
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumn("h", F.xxhash64("text"))
    id_type = dict(src.dtypes)["id"]
    sigs = materialize(map_batches(src, _signatures(width), f"id {id_type}, h long, n long, cls binary, "
                                   "bands array<bigint>, sig binary"), "sigs")
    # one row a class: a (id, text hash) to find its text again, its bands and signature
    classes = sigs.where("n > 0").groupBy("cls").agg(
        F.min(F.struct("id", "h")).alias("at"), F.first("n").alias("n"), F.first("bands").alias("bands"),
        F.first("sig").alias("sig"))
    classes = materialize(classes.select("cls", "at.id", "at.h", "n", "bands", "sig"), "classes")
    keys = classes.select(F.posexplode("bands").alias("band", "bucket"), "cls")
    shared = keys.groupBy("bucket").agg(F.count("*").alias("c")).where("c > 1")
    member = materialize(keys.join(shared, "bucket"), "members")
    active = materialize(map_batches(classes.join(member.select("cls").distinct(), "cls", "left_semi"), _short_bands,
                                     f"cls binary, id {id_type}, h long, n long, bands binary, sig binary"), "active")
    comps = _merge(src, member, active, width, percent, block, slack, quotas)
    if text_hash:
        return _first_rows(sigs, comps, id_col, text_hash)
    rows = sigs.select("id", "n", "cls").join(comps, sigs.cls == comps.node, "left").select(
        "id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.coalesce("comp", "cls")).alias("root"))
    # written, so that the join below has two plain exchanges and a hot component can be split
    least = materialize(sigs.where("n > 0").join(comps, sigs.cls == comps.node, "left")
                        .groupBy(F.coalesce("comp", "cls").alias("root")).agg(F.min("id").alias("component_id")), "least")
    full = rows.where("n_shingles > 0").join(least, "root").select("id", "n_shingles", "component_id")
    none = rows.where("n_shingles = 0").select("id", "n_shingles", F.col("id").alias("component_id"))
    return full.unionAll(none).select(
        F.col("id").alias(id_col), "n_shingles", "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"))
