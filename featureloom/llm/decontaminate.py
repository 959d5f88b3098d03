"""Benchmark decontamination with one FM-index per training shard.

A shard is a run of whole documents of about ``shard_words`` words inside one
task. Its words are written as symbols: words that some benchmark phrase uses
get numbers, every other word is a separator, and neighbouring separators
merge, because no phrase can cross one; a run of symbols shorter than the
shortest phrase is a separator too. Each separator is a symbol of its own
when suffixes are ordered, so suffix sorting never looks past it.

* The suffix array comes from prefix doubling, which only re-sorts suffixes
  that still tie; its last column (BWT) is stored as a wavelet matrix.
* All phrases are searched backwards at once: every step maps their row
  intervals with two wavelet-tree ranks and drops the empty ones.
* Rows found are located by stepping backwards until a sampled suffix position
  (every ``SAMPLE``-th, and the start of each run of symbols).
* Spans of all phrases merge into removal spans of each document.

The benchmark is cut into blocks of a bounded number of words; one block at a
time is broadcast and searched in all documents, so neither its size nor the
corpus size bounds the other. The corpus is never shuffled.

Rules: words are runs of digits, a-z and non-ASCII characters after
lower-casing A-Z; a phrase is ``width`` consecutive item words, or the whole
of a shorter item; null or word-free texts and items have none. Repeated rows
and items are treated one by one; equal items are all reported; items with a
null id are searched and reported as no item. Extra columns pass through
untouched. Empty tables give empty or clean results.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ALNUM, LOWER, map_batches, materialize, set_apart, texts

SAMPLE = 32
PIECE = 4096  # words of an item kept in one row
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
N_WORDS, SPANS, ITEMS = "__n_words", "__spans", "__items"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(ALNUM).split()


class WaveletMatrix:
    """Rank queries over a sequence of small integers, for arrays of queries at once."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.ones, self.zeros = bits, [], []
        for level in range(bits - 1, -1, -1):
            bit = (symbols >> level & 1).astype(bool)
            ones = np.zeros(len(symbols) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(len(symbols) - int(ones[-1]))
            symbols = np.concatenate([symbols[~bit], symbols[bit]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each ``symbol`` occurs before its position ``at``."""
        start = np.zeros_like(at)
        for level, ones, zeros in zip(range(self.bits - 1, -1, -1), self.ones, self.zeros):
            bit = (symbol >> level & 1).astype(bool)
            at = np.where(bit, zeros + ones[at], at - ones[at])
            start = np.where(bit, zeros + ones[start], start - ones[start])
        return at - start


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Order of all suffixes; 0 is a separator that differs from every other one. Ends with 0."""
    n = len(symbols)
    gaps = symbols == 0
    count = np.bincount(symbols)
    before = np.concatenate([[0], np.cumsum(count)[:-1]])
    rank = before[symbols].astype(np.int64)
    rank[gaps] = np.arange(count[0])
    rest, step = np.flatnonzero(~gaps & (count[symbols] > 1)), 1
    while len(rest):
        old = rank[rest]
        key = old * n + rank[rest + step]
        order = np.argsort(key, kind="stable")
        rest, old, key = rest[order], old[order], key[order]
        place = np.arange(len(rest))
        new_key = np.concatenate([[True], key[1:] != key[:-1]])
        new_group = np.concatenate([[True], old[1:] != old[:-1]])
        first = np.maximum.accumulate(np.where(new_key, place, 0))
        group = np.maximum.accumulate(np.where(new_group, place, 0))
        rank[rest] = old + first - group
        alone = new_key & np.concatenate([new_key[1:], [True]])
        rest, step = rest[~alone], step * 2
    out = np.empty(n, np.int64)
    out[rank] = np.arange(n)
    return out


class FMIndex:
    """Backward search and location over a separator-split symbol sequence ending with 0."""

    def __init__(self, symbols: np.ndarray, alphabet: int):
        order = suffix_array(symbols)
        self.bwt = symbols[order - 1]  # before the first suffix stands the closing separator
        self.start = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=alphabet))])
        self.tree = WaveletMatrix(self.bwt, max(1, int(alphabet - 1).bit_length()))
        self.sampled = (order % SAMPLE == 0) | (self.bwt == 0)
        self.slot = np.cumsum(self.sampled) - 1
        self.position = order[self.sampled]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of a (phrases, length) matrix: rows found, and the interval of suffixes of each."""
        found = np.arange(len(phrases))
        last = phrases[:, -1]
        low, high = self.start[last], self.start[last + 1]
        for j in range(phrases.shape[1] - 2, -1, -1):
            keep = low < high
            found, low, high = found[keep], low[keep], high[keep]
            if not len(found):
                break
            c = phrases[found, j]
            low, high = (self.start[c] + self.tree.rank(c, x) for x in (low, high))
        keep = low < high
        return found[keep], low[keep], high[keep]

    def locate(self, rows: np.ndarray) -> np.ndarray:
        out, steps, left, rows = np.empty(len(rows), np.int64), 0, np.arange(len(rows)), rows.copy()
        while len(left):
            done = self.sampled[rows]
            out[left[done]] = self.position[self.slot[rows[done]]] + steps
            left, rows = left[~done], rows[~done]
            c = self.bwt[rows]
            rows = self.start[c] + self.tree.rank(c, rows)
            steps += 1
        return out


class Phrases:
    """The distinct phrases of some items, by length, as rows of word numbers from 1."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], width: int):
        self.number: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set] = defaultdict(set)
        for item, words in items:
            ids = [self.number.setdefault(w, len(self.number) + 1) for w in words]
            for at in range(max(1, len(ids) - width + 1) if ids else 0):
                owners[tuple(ids[at:at + width])].add(item)
        by_length = defaultdict(list)
        for phrase in owners:
            by_length[len(phrase)].append(phrase)
        self.rows = {n: np.array(p, np.int64) for n, p in by_length.items()}
        self.owners = {n: [sorted(x for x in owners[q] if x is not None) for q in p] for n, p in by_length.items()}


def search_shard(docs: list[list[bytes]], phrases: Phrases) -> list[tuple[list[tuple[int, int]], set[str]]]:
    """Merged (start, end) word spans and the items found, for each document of a shard."""
    out: list[tuple[list[tuple[int, int]], set[str]]] = [([], set()) for _ in docs]
    lengths = np.array([len(d) + 1 for d in docs])  # each document ends with a separator
    first = np.concatenate([[0], np.cumsum(lengths)])
    ids = np.zeros(first[-1], np.int64)
    for at, doc in zip(first, docs):
        ids[at:at + len(doc)] = np.fromiter(map(phrases.number.get, doc, repeat(0)), np.int64, len(doc))
    # runs too short for the shortest phrase become separators as well
    edges = np.flatnonzero(np.diff((ids != 0).astype(np.int8), prepend=0, append=0))
    short = edges[1::2] - edges[::2] < min(phrases.rows, default=1)
    change = np.zeros(len(ids) + 1, np.int8)
    change[edges[::2][short]], change[edges[1::2][short]] = 1, -1
    ids[np.cumsum(change[:-1], dtype=np.int8) > 0] = 0
    word = np.flatnonzero((ids != 0) | np.concatenate([[True], ids[:-1] != 0]))
    symbols = ids[word]
    if not symbols.any():
        return out
    index = FMIndex(symbols, len(phrases.number) + 1)
    cover = np.zeros(first[-1] + 1, np.int32)
    for length, rows in phrases.rows.items():
        found, low, high = index.search(rows)
        if not len(found):
            continue
        size = high - low
        which = np.repeat(found, size)
        suffix = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(low, size)
        at = word[index.locate(suffix)]
        np.add.at(cover, at, 1)
        np.add.at(cover, at + length, -1)
        doc = np.searchsorted(first, at, side="right") - 1
        owners = phrases.owners[length]
        for d, p in np.unique(np.stack([doc, which], 1), axis=0):
            out[d][1].update(owners[p])
    hit = np.concatenate([[False], np.cumsum(cover) > 0])
    starts, ends = np.flatnonzero(hit[1:] & ~hit[:-1]), np.flatnonzero(~hit[1:] & hit[:-1])
    for d, s, e in zip(np.searchsorted(first, starts, side="right") - 1, starts, ends):
        out[d][0].append((int(s - first[d]), int(e - first[d])))
    return out


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _search(phrases, text_col: str, shard_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            old = [batch.column(c).to_pylist() for c in (SPANS, ITEMS)]
            docs, n_words, begin = [], 0, 0

            def close(end: int) -> dict:
                cols = {f.name: batch.column(f.name).slice(begin, end - begin) for f in batch.schema}
                found = search_shard(docs, phrases.value)
                return {**cols, N_WORDS: [len(d) for d in docs],
                        SPANS: [[{"s": s, "e": e} for s, e in merge([*f[0], *((x["s"], x["e"]) for x in o)])]
                                for f, o in zip(found, old[0][begin:end])],
                        ITEMS: [sorted(f[1].union(o)) for f, o in zip(found, old[1][begin:end])]}

            for _, some in texts(batch, text_col):
                for text in some:
                    if n_words > shard_words:
                        yield close(begin + len(docs))
                        begin, docs, n_words = begin + len(docs), [], 0
                    docs.append(words_of(text))
                    n_words += len(docs[-1])
            if docs:
                yield close(begin + len(docs))
    return run


def _pieces(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            out = {"item": [], "n": [], "piece": []}
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist()):
                words = words_of(text)
                for at in range(0, max(len(words) - width + 1, 1) if words else 0, PIECE):
                    part = words[at:at + PIECE + width - 1]
                    out["item"].append(item), out["n"].append(len(part)), out["piece"].append(b" ".join(part).decode())
            yield out
    return run


def find_contamination(docs: DataFrame, items: DataFrame, width: int = 10, text_col: str = "text",
                       item_col: str = "item_id", item_text_col: str = "text",
                       shard_words: int = 1_000_000, block_words: int = 2_000_000) -> DataFrame:
    """``docs`` with ``__n_words``, ``__spans`` (merged [s, e) word spans) and ``__items``; columns of ``docs`` so named give way."""
    sc = docs.sparkSession.sparkContext
    pieces = materialize(map_batches(
        items.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).alias("text")),
        _pieces(width), "item string, n long, piece string"), "phrases")
    total = pieces.agg(F.sum("n")).first()[0] or 0
    blocks = 1 + total // block_words
    out = docs.withColumns({N_WORDS: F.lit(0).cast("long"), ITEMS: F.array().cast("array<string>"),
                            SPANS: F.array().cast("array<struct<s:long,e:long>>")})
    fields = {f.name: f.dataType.simpleString() for f in out.schema}
    schema = ", ".join(f"`{k}` {v}" for k, v in fields.items())
    for k in range(blocks):
        part = pieces.where(F.expr(f"pmod(xxhash64(item, piece), {blocks}) = {k}")).collect()
        phrases = sc.broadcast(Phrases([(r.item, r.piece.encode().split()) for r in part], width))
        out = map_batches(out, _search(phrases, text_col, shard_words), schema)
        if k + 1 < blocks:
            out = materialize(out, "searched")
    return out


def cut_spans(text: str, spans: list) -> str:
    """``text`` without the words of ``spans`` and what stands between them."""
    raw = text.encode()
    at = [m.span() for m in WORD.finditer(raw.translate(LOWER))]
    out, last = [], 0
    for s, e in spans:
        out.append(raw[last:at[s][0]])
        last = at[e - 1][1]
    return b"".join([*out, raw[last:]]).decode()


def remove_contamination(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``docs`` with the removal spans cut out of their texts; all rows and columns stay."""
    text_col = options.get("text_col", "text")
    docs, named = set_apart(docs, (N_WORDS, SPANS, ITEMS))
    found = find_contamination(docs, items, **options)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            cols = {f.name: batch.column(f.name) for f in docs_schema}
            for at, some in texts(batch, text_col):
                spans = batch.column(SPANS).slice(at, len(some)).to_pylist()
                cut = [cut_spans(t, [(x["s"], x["e"]) for x in s]) if s else t for t, s in zip(some, spans)]
                yield {k: cut if k == text_col else v.slice(at, len(some)) for k, v in cols.items()}

    docs_schema = docs.schema.fields
    return named(map_batches(found, run, schema))
