import random
import re
import zlib
from collections import Counter

import pytest

from featureloom.llm import spelling
from featureloom.llm.queries import QUERIES

from ..conftest import SF
from .conftest import CLASHING


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows, least_length=5, least_count=3):
    n = Counter()
    for d, t in rows:
        t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        for w in re.findall("[a-zÀ-ÿ]+", t):
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if h % 97 == 0:
                k = h % len(w)
                w = w[:k] + w[k + 1:]
            n[w] += 1
    n = {w: c for w, c in n.items() if len(w) >= least_length and c >= least_count}
    by_length = {}
    for w in n:
        by_length.setdefault(len(w), []).append(w)
    friends = {w: [v for m in (len(w) - 1, len(w), len(w) + 1) for v in by_length.get(m, ()) if near(w, v)] for w in n}
    form = {}
    for w, some in friends.items():
        best = min(some, key=lambda v: (-n[v], v), default=None)
        if best is not None and n[best] >= 2 * n[w]:
            form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(friends[w]), n[form[w]] if w in form else None))
    return sorted(out)


def rows_of(df):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect())


def corpus(seed, n, letters="abé", longest=9):
    rng = random.Random(seed)
    words = ["".join(rng.choices(letters, k=rng.randrange(4, longest))) for _ in range(n)]
    return [(d, " ".join(rng.choices(words, weights=[1 / (1 + k) for k in range(n)], k=300))) for d in range(40)]


def frame(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for c in (*CLASHING, "wid", "gram", "p", "q", "len", "form", "root"):
        df = df.selectExpr("*", f"1 as `{c}`")
    return df.repartition(3)


@pytest.mark.parametrize("list_size", [1, 8, 10_000])
def test_dense_words_equal_brute_force(spark, list_size):
    rows = corpus(1, 600) + [(None, "Wörter WÖRTER wörter×"), (7, None), (7, ""), (8, "one"), (8, "one")]
    assert rows_of(spelling.spelling_variants(frame(spark, rows), list_size=list_size)) == brute(rows)


def test_shorter_words_and_long_ones(spark):
    long = "".join(random.Random(9).choices("abcdefgh", k=4000))
    rows = corpus(2, 300, "ab", 7) + [(d, f"{long} {long[:1999]}{long[2000:]} {long[:-1]}z {'a' * 5000} {'a' * 5001}") for d in range(900, 912)]
    got = rows_of(spelling.spelling_variants(frame(spark, rows), least_length=2, least_count=2))
    assert got == brute(rows, 2, 2)


def test_forms_chain_to_a_root(spark):
    rows = [(1, "colour " * 50 + "colours " * 20 + "coloursx " * 8 + "coloursxy " * 3 + "other " * 9 + "othar " * 9)]
    got = {r[0]: r for r in rows_of(spelling.spelling_variants(frame(spark, rows)))}
    assert got["coloursxy"][1:3] == ("coloursx", "colour") and got["colour"][1] is None
    assert got["other"][1] is None and got["other"][4] == 1  # as frequent as its near word


def test_an_empty_table_has_no_words(spark):
    assert spelling.spelling_variants(frame(spark, [])).collect() == []


def test_an_edit_never_changes_all_merged_grams():
    rng = random.Random(5)
    for _ in range(300):
        word = "".join(rng.choices("abc", k=rng.randrange(2, 14)))
        frequent = {p << 5 | q: rng.randrange(0, 3) for p in range(len(word)) for q in range(1, 8)}
        for cls in (len(word) - 1, len(word)):
            if cls >= 2:
                grams = spelling.decompose(word, frequent, cls)
                some = spelling.merged_lists(grams)
                assert spelling.affected(some) < len(some) and some == sorted(grams)[:len(some)]


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert rows_of(QUERIES["op11_spelling_variants"](spark, SF)) == brute(rows)
