import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from featureloom.llm.queries import QUERIES, byte_bpe
from featureloom.llm.token_counts import Counter, _every_second, count_tokens

from ..conftest import SF


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(byte_bpe())
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)


@pytest.fixture(scope="module")
def counter():
    return Counter(open(byte_bpe(), encoding="utf-8").read())


def test_hostile_texts_equal_the_library(counter, library):
    rng = random.Random(1)
    parts = ["a", "b", " ", "  ", "\n", "\t", "'s", "'LL", "1", "é", "ß", "中", "😀", "՘", "\U00010940", "<|endoftext|>", "<|endo",
             "the", "ing", "aaaa", "\x00", "　", "​", "é", " ", "½"]
    made = ["".join(rng.choices(parts, k=rng.randrange(1, 30))) for _ in range(3000)]
    assert counter.of(made) == [library(t) for t in made]


@pytest.mark.parametrize("text", [
    "".join(random.Random(2).choices("abcdefghijklmnopqrstuvwxyz", k=300_000)),
    "".join(random.Random(3).choices("abcXYZ019+/", k=300_000)),
    "a" * 200_003, "ab" * 100_000, " " * 100_000 + "x", "the" * 7001 + "a" * 5000 + "e" * 3333, "hello world " * 50_000])
def test_long_runs_without_a_space(counter, library, text):
    assert counter.of([text]) == [library(text)]


def test_sequences_of_both_kinds_agree(counter):
    rng = random.Random(4)
    for _ in range(200):
        word = "".join(rng.choices("abeinrst ", k=rng.randrange(1, 60))).encode()
        symbols = counter.bpe.of_byte[list(word)]
        assert counter.bpe.sweep(symbols.copy()) == counter.bpe.counts([word])[0]
    import numpy as np
    assert _every_second(np.array([1, 1, 1, 0, 1, 1, 0, 1], bool)).tolist() == [0, 2, 4, 7]


def test_the_cache_may_be_emptied(counter, library, monkeypatch):
    monkeypatch.setattr("featureloom.llm.token_counts.CACHED", 5)
    texts = ["one two three four five six seven", "eight nine", "one eight ten eleven twelve"]
    small = Counter(open(byte_bpe(), encoding="utf-8").read())
    assert small.of(texts) == [library(t) for t in texts]


def test_edge_rows(spark, edge_docs, no_docs, library):
    got = count_tokens(edge_docs, byte_bpe())
    assert got.columns == ["doc_id", "n_bytes", "n_tokens"]
    want = sorted((r.doc_id or -1, len((r.text or "").encode()), library(r.text or "")) for r in edge_docs.collect())
    assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in got.collect()) == want
    assert count_tokens(no_docs, byte_bpe()).collect() == []


def test_query_equals_the_library(spark, library):
    got = {r.doc_id: r for r in QUERIES["op13_token_counts"](spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        n = library(r.text or "")
        assert (got[r.doc_id].n_bytes, got[r.doc_id].n_tokens, got[r.doc_id].over_limit) == (len((r.text or "").encode()), n, n > 512)


def test_other_kinds_of_vocabulary_are_refused():
    with pytest.raises(ValueError):
        Counter(open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read())
