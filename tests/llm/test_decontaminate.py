import re

import numpy as np
import pytest

from featureloom.llm import decontaminate as dc

from .conftest import edge_rows, frame, prose

WORD = re.compile(r"[0-9a-z\x80-\U0010ffff]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items, width=10):
    w, hit, found = words(text), set(), set()
    for item, t in items:
        p = words(t)
        for i in range(max(1, len(p) - width + 1) if p else 0):
            q = p[i:i + width]
            for j in range(len(w) - len(q) + 1):
                if w[j:j + len(q)] == q:
                    hit.update(range(j, j + len(q)))
                    if item is not None:
                        found.add(str(item))
    return len(w), hit, sorted(found)


def items_of():
    base = prose(1).split()
    return [(1, " ".join(base[20:45])), (2, "one two"), (3, None), (4, ""), (5, " ".join(base[40:52]).upper()),
            (6, prose(77, 30)), (1, " ".join(base[20:45])), (None, " ".join(prose(2).split()[:12])), (10, "Two")]


@pytest.mark.parametrize("block_words,shard", [(2_000_000, 1_000_000), (20, 300)])
def test_equals_brute_force(spark, edge_docs, block_words, shard):
    items = spark.createDataFrame(items_of(), "item_id long, text string").selectExpr("*", "1 as item", "'x' as piece")
    rows = [r for r in edge_rows() if len(r[1] or "") < 50_000]
    docs = edge_docs.where("text is null or length(text) < 50000")
    got = dc.find_contamination(docs, items, block_words=block_words, shard_words=shard).collect()
    key = lambda r: repr((r[0], r[1]))
    want = sorted(((d, t, *brute(t, items_of())) for d, t in rows), key=key)
    for r, (d, t, n, hit, found) in zip(sorted(got, key=lambda r: key((r.doc_id, r.text))), want, strict=True):
        assert (r.doc_id, r["__n_words"], r["__items"]) == (d, n, found)
        assert {k for s in r["__spans"] for k in range(s.s, s.e)} == hit
        assert r.bucket == "bucket"


def test_long_text(edge_docs, spark):
    phrase = " ".join(edge_rows()[11][1].split()[29_000:29_010])
    items = spark.createDataFrame([("a", phrase)], "item_id string, text string")
    got = dc.find_contamination(edge_docs.where("doc_id = 9"), items).first()
    assert got["__items"] == ["a"] and any(s.s <= 29_000 and s.e >= 29_010 for s in got["__spans"])


def test_empty_tables(spark, edge_docs, no_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert dc.find_contamination(no_docs, none).collect() == []
    assert all(r["__spans"] == [] for r in dc.find_contamination(edge_docs, none).collect())


def test_removal_cuts_only_the_spans(spark):
    text = "Keep this. A b c d e f g h i j, stays é."
    docs = frame(spark, [(1, text), (2, "clean words only"), (3, None)])
    items = spark.createDataFrame([(1, "a B c d e f g h i j")], "item_id long, text string")
    out = {r.doc_id: r.text for r in dc.remove_contamination(docs, items).collect()}
    assert out == {1: "Keep this. , stays é.", 2: "clean words only", 3: None}


def test_fm_index_against_plain_search():
    rng = np.random.default_rng(1)
    symbols = rng.integers(0, 4, 3000)
    symbols[500:700] = symbols[100:300]  # long repeats
    symbols[-1] = 0
    order = dc.suffix_array(symbols)
    assert sorted(order.tolist()) == list(range(len(symbols)))
    index = dc.FMIndex(symbols, 4)
    for n in (1, 3, 6):
        phrases = np.unique(np.stack([rng.integers(1, 4, n) for _ in range(200)]), axis=0)
        found, low, high = index.search(phrases)
        hits = {int(k): set(index.locate(np.arange(a, b)).tolist()) for k, a, b in zip(found, low, high)}
        for k, p in enumerate(phrases):
            want = {i for i in range(len(symbols) - n + 1) if (symbols[i:i + n] == p).all()}
            assert hits.get(k, set()) == want
