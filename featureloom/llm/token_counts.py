"""Token counts of whole texts by rank-synchronous array merging of byte-level BPE.

A text is split at the tokenizer's special strings (one token each) and by its
pre-token pattern. Pre-tokens not met before in a task are laid one after
another in one ragged numpy array of symbols, cut further where no vocabulary
entry holds the two bytes at the cut (no merge can ever cross it). In each round
every sequence applies its own lowest-rank pair at all its places at once;
sequences without a pair that merges leave the array with their symbol count.
Later merges only use earlier results (checked when the vocabulary is read), so
this gives the merges of one-at-a-time BPE. Sequences of more than ``LONG``
bytes are swept by rising rank instead, one linked array each, so that their
cost does not grow with rounds times length.

Rules: a null text is empty: 0 bytes, 0 tokens. Rows with a null id and repeated
rows each get their own result. Columns other than the id and the text are not
read. An empty table gives no rows.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, texts

# The pattern of byte-level pre-tokens, as the tokenizers library has it.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Code points outside these ranges may be letters in one Unicode version only; the library splits such texts itself.
EXOTIC = regex.compile(r"[^\u0000-\u0557\u2000-\u206f\u3040-\u30ff\u4e00-\u9fff\uac00-\ud7a3]")
LONG, CACHED, SLICE = 1024, 300_000, 65_536
NEVER = np.iinfo(np.int64).max


class ByteBpe:
    """The tables of a byte-level BPE vocabulary file of the tokenizers library."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer
        self.tokenizer, raw = Tokenizer.from_str(spec), json.loads(spec)
        model, pre = raw["model"], raw["pre_tokenizer"]
        added = raw.get("added_tokens") or []
        plain = model["type"] == "BPE" and not raw.get("normalizer") and pre["type"] == "ByteLevel" and pre["use_regex"] \
            and not pre["add_prefix_space"] and not model.get("ignore_merges") and not model.get("dropout")
        if not plain or any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError("not a plain byte-level BPE file")
        self.special = regex.compile("|".join(regex.escape(t["content"]) for t in sorted(added, key=lambda t: -len(t["content"])))) \
            if added else None
        # byte-level alphabet: printable Latin-1 bytes stand for themselves, the rest follow from 256
        own = [b for b in range(256) if chr(b).isprintable() and not chr(b).isspace()]
        alphabet = {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in own)}
        vocab = model["vocab"]
        self.of_byte = np.array([vocab[alphabet[b]] for b in range(256)], np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left, right = (np.array([vocab[m[k]] for m in merges], np.int64) for k in (0, 1))
        self.result = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.width = int(max(vocab.values())) + 1
        born = np.full(self.width, -1, np.int64)
        born[self.result] = np.arange(len(merges))
        if len(set(self.result.tolist())) != len(merges) or np.any(np.maximum(born[left], born[right]) >= np.arange(len(merges))):
            raise ValueError("a merge uses a symbol that a later merge makes")
        keys = left * self.width + right
        self.rank_of = np.argsort(keys)
        self.keys = keys[self.rank_of]
        #: byte pairs that lie side by side in some vocabulary entry
        self.joinable = np.zeros((256, 256), bool)
        byte_of = {c: b for b, c in alphabet.items()}
        for token in vocab:
            b = [byte_of[c] for c in token if c in byte_of]
            self.joinable[b[:-1], b[1:]] = True

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merge rank of each pair of symbols, NEVER where there is none."""
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank_of[at], NEVER)

    def counts(self, words: list[bytes]) -> np.ndarray:
        """Number of tokens of each non-empty word."""
        data = np.frombuffer(b"".join(words), np.uint8)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        cut = np.ones(len(data), bool)  # a sequence starts here
        cut[1:] = ~self.joinable[data[:-1], data[1:]]
        starts = np.cumsum(lengths) - lengths
        cut[starts] = True
        first = np.flatnonzero(cut)
        owner = np.searchsorted(starts, first, side="right") - 1
        size = np.diff(np.append(first, len(data)))
        total = np.zeros(len(words), np.int64)
        for k in np.flatnonzero(size > LONG):
            total[owner[k]] += self.sweep(self.of_byte[data[first[k]:first[k] + size[k]]])
        short = size <= LONG
        symbols = self.of_byte[data[np.repeat(short, size)]]
        owner, size = owner[short], size[short]
        while len(size):
            first = np.cumsum(size) - size
            rank = np.full(len(symbols), NEVER)
            rank[:-1] = self.ranks(symbols[:-1], symbols[1:])
            rank[first + size - 1] = NEVER
            low = np.minimum.reduceat(rank, first)
            done = low == NEVER
            np.add.at(total, owner[done], size[done])
            hit = _every_second((rank == np.repeat(low, size)) & (rank != NEVER))
            symbols[hit] = self.result[rank[hit]]
            keep = ~np.repeat(done, size)
            merged = np.zeros(len(symbols), np.int64)
            merged[hit] = 1
            keep[hit + 1] = False
            symbols, owner, size = symbols[keep], owner[~done], (size - np.add.reduceat(merged, first))[~done]
        return total

    def sweep(self, symbols: np.ndarray) -> int:
        """Symbols left of one long sequence: its pairs are applied rank by rank on a linked array."""
        n = len(symbols)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        rank = np.full(n, NEVER)
        rank[:-1] = self.ranks(symbols[:-1], symbols[1:])
        queue: list[int] = []
        places: dict[int, list[np.ndarray]] = {}

        def add(at: np.ndarray) -> None:
            at = at[rank[at] != NEVER]
            at = at[np.argsort(rank[at], kind="stable")]
            for some in np.split(at, np.flatnonzero(np.diff(rank[at])) + 1):
                if len(some):
                    r = int(rank[some[0]])
                    if r not in places:
                        places[r] = []
                        heapq.heappush(queue, r)
                    places[r].append(some)

        add(np.arange(n))
        alive = np.ones(n, bool)
        while queue:
            r = heapq.heappop(queue)
            at = np.unique(np.concatenate(places.pop(r)))
            at = at[alive[at] & (rank[at] == r)]
            if not len(at):
                continue
            touching = np.zeros(len(at), bool)  # its right symbol is the next place's left one
            touching[:-1] = after[at[:-1]] == at[1:]
            run = np.arange(len(at)) - np.maximum.accumulate(np.where(np.append(True, ~touching[:-1]), np.arange(len(at)), 0))
            at = at[run % 2 == 0]
            gone = after[at]
            symbols[at], alive[gone], rank[gone] = self.result[r], False, NEVER
            after[at] = after[gone]
            inner = after[at] < n
            before[after[at[inner]]] = at[inner]
            renew = np.unique(np.concatenate([at, before[at][before[at] >= 0]]))
            right = after[renew]
            rank[renew] = np.where(right < n, self.ranks(symbols[renew], symbols[np.minimum(right, n - 1)]), NEVER)
            add(renew)
        return int(alive.sum())


def _every_second(hit: np.ndarray) -> np.ndarray:
    """Places of ``hit``; of a run of places side by side (one symbol repeated) every second one."""
    at = np.flatnonzero(hit)
    if not len(at):
        return at
    k = np.arange(len(at))
    new = np.append(True, np.diff(at) != 1)
    return at[(k - np.maximum.accumulate(np.where(new, k, 0))) % 2 == 0]


class Counter:
    """Texts -> token counts, remembering the counts of pre-tokens; forgets all past ``CACHED`` of them."""

    def __init__(self, spec: str):
        self.bpe, self.known = ByteBpe(spec), {}
        self.find, self.iterate = regex.compile(PATTERN).findall, regex.compile(PATTERN).finditer

    def pieces(self, text: str) -> Iterator[list[str]]:
        """The pre-tokens of a text without special strings, a bounded number at a time."""
        if not text.isascii() and EXOTIC.search(text):
            spans = self.bpe.tokenizer.pre_tokenizer.pre_tokenize_str(text)
            yield [text[a:b] for _, (a, b) in spans]
        elif len(text) <= SLICE:
            yield self.find(text)
        else:
            found = (m.group() for m in self.iterate(text))
            while some := list(islice(found, SLICE)):
                yield some

    def learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > CACHED:
            self.known.clear()
            new = list(words)
        if new:
            self.known.update(zip(new, self.bpe.counts([w.encode() for w in new]).tolist()))

    def of(self, some: list[str | None]) -> list[int]:
        """Token counts of some texts; the pre-tokens of many short ones or a part of a long one are looked up together."""
        total = [0] * len(some)
        waiting: list[tuple[int, list[str]]] = []
        held = 0

        def settle() -> None:
            self.learn({w for _, words in waiting for w in words})
            for k, words in waiting:
                total[k] += sum(map(self.known.__getitem__, words))
            waiting.clear()

        for k, text in enumerate(some):
            parts = [text or ""]
            if self.bpe.special is not None:
                parts = self.bpe.special.split(parts[0])
                total[k] = len(parts) - 1
            for part in filter(None, parts):
                for words in self.pieces(part):
                    waiting.append((k, words))
                    held += len(words)
                    if held >= SLICE:
                        settle()
                        held = 0
        settle()
        return total


def count_tokens(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens) of every row: UTF-8 bytes and tokens of the whole text.

    Begin, end and added special tokens are not counted; special strings inside
    a text are one token each, as by the library's default. The vocabulary file
    (a bounded size) is broadcast; nothing is shuffled.
    """
    spec = docs.sparkSession.sparkContext.broadcast(open(tokenizer_path, encoding="utf-8").read())
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = src.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        counter = Counter(spec.value)
        for batch in batches:
            n_bytes = pc.fill_null(pc.cast(pc.binary_length(batch.column("text")), pa.int64()), 0)
            for at, some in texts(batch, rows=64):
                yield {"id": batch.column("id").slice(at, len(some)), "n_bytes": n_bytes.slice(at, len(some)),
                       "n_tokens": counter.of(some)}

    return map_batches(src, run, f"id {kind}, n_bytes long, n_tokens long").withColumnRenamed("id", id_col)
