import random

import numpy as np
import pytest

from featureloom.llm import neardup
from featureloom.llm.common import LOWER, WordHash

from .conftest import edge_rows, frame, prose


def brute(rows, width, percent):
    """component (smallest id reachable), set size of every row, all pairs compared."""
    sets = []
    for _, t in rows:
        w = (t or "").encode().translate(LOWER).split()
        sets.append({tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    out = []
    for i, (d, _) in enumerate(rows):
        comp = least.get(find(i)) if sets[i] else d
        out.append((d, len(sets[i]), comp, comp is None or d == comp if d is not None or comp is None else False))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()), key=repr)


@pytest.mark.parametrize("width", [4])
def test_edge_cases_equal_brute_force(edge_docs, width):
    got, want = result(neardup.near_duplicates(edge_docs, width=width)), brute(edge_rows(), width, 80)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert all(k == (d == c if d is not None and c is not None else c is None) for d, _, c, k in got)


def test_empty_table(no_docs):
    assert neardup.near_duplicates(no_docs).collect() == []


def test_hot_group_in_small_blocks(spark):
    """A group of near copies around the threshold, cut into blocks of 16, chained and not all linked directly."""
    rng, rows = random.Random(3), []
    base = prose(9, 150).split()
    for d in range(120):
        w = list(base)
        for _ in range(rng.randrange(9)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        rows.append((d, " ".join(w)))
    rows += [(500 + d, prose(100 + d)) for d in range(40)]
    got = result(neardup.near_duplicates(frame(spark, rows), width=4, block=16, quotas=(1, 2)))
    assert [g[:3] for g in got] == [w[:3] for w in brute(rows, 4, 80)]


def test_minmax_signature_is_unbiased():
    a, b = neardup.permutations()
    rng = np.random.default_rng(0)
    x = rng.integers(0, 2**63, 1000, dtype=np.uint64)
    s, t = neardup.minmax_signature(x[:800], a, b), neardup.minmax_signature(x[200:], a, b)
    assert abs((s == t).mean() - 0.6) < 0.15


def test_short_texts_are_one_shingle():
    h = WordHash()
    assert len(neardup.shingle_set([b"a", b"b"], h, 4)) == 1
    assert len(neardup.shingle_set([], h, 4)) == 0
    assert neardup.shingle_set([b"a", b"b"], h, 4)[0] != neardup.shingle_set([b"b", b"a"], h, 4)[0]


def test_groups_are_dealt_without_signatures(spark):
    from featureloom.llm.neardup import _blocks
    data = [(b, bytes([b, k]), bytes([k % 3]), 0) for b in (1, 2) for k in range(9)] + [(3, b"x", b"\0", 0), (3, b"y", b"\0", 0)]
    light = spark.createDataFrame(data, "bucket long, cls binary, comp binary, band int")
    groups = {}
    for r in _blocks(light, 2).collect():
        groups.setdefault((r.bucket, r.m, r.s), []).append(r)
    met = [(bytes(x.cls), bytes(y.cls)) for g in groups.values() for x in g if x.seeks for y in g if x.comp != y.comp]
    pairs = {tuple(sorted(p)) for p in met}
    assert pairs == {tuple(sorted((a[1], b[1]))) for a in data for b in data if a[0] == b[0] and a[2] != b[2]}
    assert all(r.bucket != 3 for g in groups.values() for r in g) and set(next(iter(groups.values()))[0].asDict()) == {"bucket", "cls", "comp", "band", "m", "s", "seeks"}
