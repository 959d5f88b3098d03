"""Token-id files: adaptive context-mixing range coder in independent blocks.

A file (``.tok``) is::

    "FLTOK1\\0\\0" | n_docs u32 | n_ids u64 | n_blocks u32 | table bytes u32 | table crc32 u32
    document table (zlib): ids i64, tokens u32
    n_blocks * (payload bytes u32, payload crc32 u32, crc32 of the block's ids u32)
    payloads

All numbers are little-endian. Blocks hold ``BLOCK`` ids (the last one fewer),
start from an empty model and can be decoded alone.

Model of one block: the order-2 and order-1 contexts (last two ids, last id;
hashed) each predict one id with a confidence; the order-0 model is the
frequency of the ids' upper and lower bytes, re-counted every ``RECOUNT`` ids.
The three are mixed with weights that adapt for every pair of confidences: the
weight of the order-2 id, that of the order-1 id, and the rest, which is spread
over the upper and lower bytes by order-0 frequency. One interval of
2**``TOTAL`` codes an id, through a range coder with carries. All blocks of a
file are coded in step, one numpy lane each; the last block is filled up with
zeros that are cut off again.

``write_tokens`` encodes whole texts with the tokenizers library, appends the
end id, deals documents to ranges of their ids and writes files in ascending
id order; ``read_tokens`` reads them through Spark's binary file source.

Rules: a null text is empty and gets the end id only; rows with a null id come
first; rows of one id stay together, ordered by their ids; ids are integers.
Extra columns are not read. An empty table writes no file and reads no row.
"""

from __future__ import annotations

import functools
import json
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import LOWER, map_batches, materialize, scratch

BLOCK, RECOUNT, FILE_IDS = 4096, 256, 12_000_000
SLOTS, CONTEXTS, TOTAL0, TOTAL = 2048, 32, 1024, 31
MAGIC = b"FLTOK1\0\0"
HEAD = struct.Struct("<8sIQIII")
CHUNK_BYTES = 8_000_000
#: How ``PATTERN`` cuts words: runs of letters (those of Latin-1 too), single digits,
#: runs of signs; words with other bytes stay whole.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SPACE, LETTER, DIGIT, SIGN, ODD = range(5)
KIND = np.array([SPACE if chr(b) in " \t\n\r\v\f" else ODD if not 32 < b < 127 or chr(b) == "'" else
                 LETTER if chr(b).isalpha() else DIGIT if chr(b).isdigit() else SIGN for b in range(256)], np.uint8)
LOWERED = np.frombuffer(LOWER, np.uint8)


class Coder:
    """Range coder with carries, 16-bit words, one lane a block. Low, range and code are whole numbers below 2**53 in floats."""

    def __init__(self, lanes: int, words: list[np.ndarray] | None = None):
        self.lanes, self.range = lanes, np.full(lanes, 2.0**48 - 1)
        self.at, self.low, self.code = np.arange(lanes), np.zeros(lanes), None
        # words lie step by step, lanes side by side: lanes are at similar steps
        if words is None:
            self.flat = np.empty((3 * BLOCK + 4) * lanes, np.uint32)  # an upper half is a carry to the word before
        else:
            by_lane = np.zeros((lanes, max(map(len, words)) + 4), np.uint16)
            for row, w in zip(by_lane, words):
                row[:len(w)] = w
            self.flat = np.ascontiguousarray(by_lane.T).ravel()
            self.code = 2.0**32 * self.flat[:lanes] + 2.0**16 * self.flat[lanes:2 * lanes] + self.flat[2 * lanes:3 * lanes]
            self.at += 3 * lanes

    def narrow(self, unit: np.ndarray, start: np.ndarray, size: np.ndarray) -> None:
        """Take [start, start + size) of 2**TOTAL and shift words, three at most."""
        start = unit * start.astype(np.float64)
        if self.code is None:
            self.low += start
        else:
            self.code -= start
        self.range = unit * size.astype(np.float64)
        short = self.range < 2.0**32
        one = short.astype(np.float64)
        factor = one * 65535 + 1
        if self.code is None:
            word = np.floor(self.low * 2.0**-32)
            self.flat[self.at] = word  # written again where it does not count
            word *= one
            self.low -= word * 2.0**32
            self.low *= factor
        else:
            self.code *= factor
            self.code += one * self.flat.take(self.at)
        self.range *= factor
        self.at += short.astype(np.int64) * self.lanes
        go = np.flatnonzero(self.range < 2.0**32)
        while len(go):
            at = self.at[go]
            if self.code is None:
                low = self.low[go]
                word = np.floor(low * 2.0**-32)
                self.flat[at] = word
                self.low[go] = (low - word * 2.0**32) * 65536
            else:
                self.code[go] = self.code[go] * 65536 + self.flat[at]
            size = self.range[go] * 65536
            self.range[go], self.at[go] = size, at + self.lanes
            go = go[size < 2.0**32]

    def finish(self) -> list[bytes]:
        for _ in range(3):
            word = np.floor(self.low * 2.0**-32)
            self.flat[self.at] = word
            self.low = (self.low - word * 2.0**32) * 65536
            self.at += self.lanes
        n = self.at // self.lanes
        rows = self.flat[:int(n.max()) * self.lanes].reshape(-1, self.lanes)
        for j in range(len(rows) - 1, 0, -1):
            rows[j - 1] += np.where(j < n, rows[j] >> 16, 0).astype(np.uint32)
        by_lane = np.ascontiguousarray(rows.astype("<u2").T)
        return [row[:k].tobytes() for row, k in zip(by_lane, n)]


def _code(coder: Coder, ids: np.ndarray, decode: bool) -> None:
    """Code the lanes of ``ids`` (steps, lanes) in step."""
    steps, lanes = ids.shape
    lane = np.arange(lanes, dtype=np.int32)
    both = np.arange(2, dtype=np.int32)[:, None]  # order-1, order-2
    base, own = (both * lanes + lane) * SLOTS, lane * CONTEXTS
    bytes_of, places_of = lane * 256, lane * TOTAL0
    table = np.empty(2 * lanes * SLOTS, np.int32)  # predicted id | confidence << 16: 0, 2, 4, 6 and 0, 8, 16, 24
    table.fill(0)  # unlike zeros, numpy asks for large pages here: a third less time a look-up
    more, most = np.array([[2], [8]], np.int32) << 16, np.array([[6], [24]], np.int32) << 16
    twice = 2 * more
    weight = np.full(lanes * CONTEXTS, 2**13 << 16 | 2**12, np.int32)  # of the order-2 id, of the order-1 id
    count = np.ones((2, lanes, 256), np.int32)  # upper and lower bytes
    total, cum = np.empty_like(count), np.zeros((2, lanes, 257), np.int32)
    x = before = np.zeros(lanes, np.int32)
    slot = np.empty((2, lanes), np.int32)
    for t0 in range(0, steps, RECOUNT):
        chunk = ids[t0:t0 + RECOUNT]
        np.cumsum(count, 2, out=total)
        whole = total[:, :, -1:].copy()
        total *= TOTAL0 - 256
        cum[:, :, 1:] = total / whole
        cum[:, :, 1:] += np.arange(1, 257, dtype=np.int32)
        width = np.diff(cum, axis=2)
        share = width << 16
        share |= cum[:, :, :-1]
        share = share.reshape(2, -1)
        if decode:
            find = np.repeat(np.tile(np.arange(256, dtype=np.uint8), 2 * lanes), width.ravel()).reshape(2, -1)
        else:
            up, down = share[0].take(bytes_of + (chunk >> 8)), share[1].take(bytes_of + (chunk & 255))
            wide = up >> 16
            here = chunk.astype(np.int32)
            starts, sizes = ((up & 0xFFFF) << 10) + wide * (down & 0xFFFF), wide * (down >> 16)
        escaped = np.empty(chunk.shape, bool)
        for t in range(len(chunk)):
            first = x * 40503
            slot[0], slot[1] = first >> 3, first + before * 30011 >> 4
            before = x
            place = ((slot & SLOTS - 1) + base).astype(np.intp)
            old = table.take(place)
            guess, k = old & 0xFFFF, old >> 16
            ctx = (own + k[0] + k[1] + (guess[0] == guess[1])).astype(np.intp)
            q = weight.take(ctx)
            q2, q1 = q >> 16, q & 0xFFFF
            s2 = q2 >> 4
            left = 2048 - s2
            s1 = left * q1 >> 15
            rest = left - s1
            end2 = s2 << 20
            size1 = s1 << 20
            end1 = end2 + size1
            unit = np.floor(coder.range * 2.0**-TOTAL)
            # masks: all bits or none
            if decode:
                v = (coder.code / unit).astype(np.int32)
                v1 = v - end1
                is2, other = v - end2 >> 31, ~(v1 >> 31)
                is1 = ~(is2 | other)
                j = ((v1 & other) / rest).astype(np.int32)
                high = find[0].take(places_of + (j >> 10))
                up = share[0].take(bytes_of + high)
                wide = up >> 16
                up &= 0xFFFF
                up <<= 10
                low = find[1].take(places_of + ((j - up) / wide).astype(np.int32))
                down = share[1].take(bytes_of + low)
                start, size = up + wide * (down & 0xFFFF), wide * (down >> 16)
                x = high.astype(np.int32) << 8 | low
                x &= other
                x |= guess[1] & is2 | guess[0] & is1
                chunk[t] = x
                hit = (guess ^ x) - 1 >> 31
            else:
                x = here[t]
                hit = (guess ^ x) - 1 >> 31
                is2, other = hit[1], ~(hit[0] | hit[1])
                is1 = hit[0] & ~is2
                start, size = starts[t], sizes[t]
            rest &= other
            coder.narrow(unit, rest * start + (end1 & other | end2 & is1), rest * size + (end2 & is2 | size1 & is1))
            escaped[t] = other
            # the right id gains confidence, another one loses it or is replaced
            stay = hit | 65535 - old >> 31
            new = x ^ (x ^ old) & stay
            new += twice & hit
            new -= more & stay
            table[place] = np.minimum(new, old | most)
            q += ((is2 & 28544) + 128 - q2 >> 4) << 16
            q += ((is1 & 28544) + 128 - q1 >> 4) & ~is2
            weight[ctx] = q
        sent, of = chunk[escaped], np.broadcast_to(bytes_of, chunk.shape)[escaped]
        for n, part in zip(count, (sent >> 8, sent & 255)):
            n += 8 * np.bincount(of + part, minlength=lanes * 256).astype(np.int32).reshape(lanes, 256)


def encode_blocks(ids: np.ndarray) -> list[bytes]:
    """Payloads of the blocks of one id sequence (ids below 65,536)."""
    lanes = -(-len(ids) // BLOCK)
    if not lanes:
        return []
    grid = np.zeros(lanes * BLOCK, np.uint16)
    grid[:len(ids)] = ids
    coder = Coder(lanes)
    _code(coder, np.ascontiguousarray(grid.reshape(lanes, BLOCK)[:, :len(ids)].T), False)
    return coder.finish()


def decode_blocks(payloads: list[bytes], n_ids: int) -> np.ndarray:
    lanes = len(payloads)
    if not lanes:
        return np.empty(0, np.uint16)
    grid = np.zeros((min(n_ids, BLOCK), lanes), np.uint16)
    _code(Coder(lanes, [np.frombuffer(p, "<u2") for p in payloads]), grid, True)
    return np.ascontiguousarray(grid.T).ravel()[:n_ids]


def pack_file(doc_ids: list[int | None], counts: np.ndarray, ids: np.ndarray) -> bytes:
    known = np.array([d is not None for d in doc_ids], np.uint8)
    table = zlib.compress(np.array([d or 0 for d in doc_ids], "<i8").tobytes() + np.asarray(counts, "<u4").tobytes()
                          + known.tobytes(), 1)
    payloads = encode_blocks(ids)
    heads = [struct.pack("<III", len(p), zlib.crc32(p), zlib.crc32(np.ascontiguousarray(ids[k * BLOCK:(k + 1) * BLOCK], "<u4")))
             for k, p in enumerate(payloads)]
    head = HEAD.pack(MAGIC, len(doc_ids), len(ids), len(payloads), len(table), zlib.crc32(table))
    return b"".join([head, table, *heads, *payloads])


def unpack_file(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """(document ids, their token counts, all ids); raises ValueError where a checksum fails."""
    magic, n_docs, n_ids, n_blocks, size, crc = HEAD.unpack_from(data)
    table = data[HEAD.size:HEAD.size + size]
    if magic != MAGIC or zlib.crc32(table) != crc:
        raise ValueError("not a token file, or its document table is damaged")
    table = zlib.decompress(table)
    doc_ids, counts = np.frombuffer(table, "<i8", n_docs), np.frombuffer(table, "<u4", n_docs, 8 * n_docs)
    known = np.frombuffer(table, np.uint8, n_docs, 12 * n_docs)
    heads = list(struct.iter_unpack("<III", data[HEAD.size + size:HEAD.size + size + 12 * n_blocks]))
    at, payloads = HEAD.size + size + 12 * n_blocks, []
    for length, crc, _ in heads:
        payloads.append(data[at:at + length])
        at += length
        if zlib.crc32(payloads[-1]) != crc:
            raise ValueError(f"block {len(payloads) - 1} is damaged")
    ids = decode_blocks(payloads, n_ids)
    for k, (_, _, crc) in enumerate(heads):
        if zlib.crc32(ids[k * BLOCK:(k + 1) * BLOCK].astype("<u4")) != crc:
            raise ValueError(f"block {k} decodes to other ids")
    return [int(d) if ok else None for d, ok in zip(doc_ids, known)], counts, ids


class WordIds(dict):
    """white-space separated word -> its ids as packed 16-bit numbers, through the tokenizers library.

    The tokenizer drops white space, so a text's ids are those of its words.
    Words of plain Latin-1 letters, digits and signs are lower-cased and split
    by the tokenizer's own pattern, and each part goes to its BPE model; other
    words go through the whole tokenizer.
    """

    def __init__(self, spec: str, limit: int = 1_000_000):
        super().__init__()
        from tokenizers import Tokenizer
        self.tokenizer, self.limit = Tokenizer.from_str(spec), limit
        pattern = json.loads(spec)["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.known = pattern == PATTERN
        self.split, self.plain = regex.compile(pattern).findall, regex.compile("[!-~¡-ÿ]+").fullmatch
        self.model, self.parts = self.tokenizer.model, {}
        # byte-level alphabet: printable Latin-1 bytes stand for themselves, the rest follow from 256
        own = [b for b in range(256) if chr(b).isprintable() and not chr(b).isspace()]
        self.byte = {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in own)}

    def part(self, part: str) -> bytes:
        got = self.parts.get(part)
        if got is None:
            if len(self.parts) >= self.limit:
                self.parts.clear()
            got = self.parts[part] = self.encode(part)
        return got

    def encode(self, part: str) -> bytes:
        text = part if part.isascii() else "".join(map(self.byte.__getitem__, part.encode()))
        return array("H", [t.id for t in self.model.tokenize(text)]).tobytes()

    def __missing__(self, raw: bytes) -> bytes:
        if len(self) >= self.limit:
            self.clear()
        word = raw.decode()
        if self.known and raw.isalpha():  # one part
            value = self.encode(word.lower())
        elif self.plain(word) and "<|" not in word:
            value = self.encode(word.lower()) if self.known and word.isalpha() else b"".join(map(self.part, self.split(word.lower())))
        else:
            value = array("H", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        self[raw] = value
        return value

    def words(self, raw: np.ndarray, edges: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """The words (or their parts) of the texts between ``edges``, and how many there are up to each text's end."""
        kind = KIND[raw]
        mark = np.flatnonzero(raw[:-1] == 60)
        kind[mark[raw[mark + 1] == 124]] = ODD  # "<|" may begin a special token
        low = LOWERED[raw]
        lead = np.flatnonzero(raw == 0xC3)  # the letters from U+00C0 to U+00FF
        after = raw[lead + 1]
        letter = after & 0xDF != 0x97
        kind[lead[letter]] = kind[lead[letter] + 1] = LETTER
        low[lead[letter & (after < 0x9F)] + 1] += 32
        solid = kind != SPACE
        first = solid.copy()
        first[1:] &= ~solid[:-1]
        heads = edges[:-1][edges[:-1] < len(raw)]
        first[heads] = solid[heads]
        cut = first
        if self.known:
            cut = kind == DIGIT
            cut[1:] |= kind[1:] != kind[:-1]
            cut &= solid
            cut |= first
        odd = kind == ODD
        if odd.any():  # such words stay whole and as they are
            word = np.cumsum(first)
            whole = np.zeros(len(raw) + 1, bool)
            whole[word[odd]] = True
            whole = whole[word]
            cut, low = np.where(whole, first, cut), np.where(whole, raw, low)
        body = low[solid]
        offsets = np.append(np.flatnonzero(cut[solid]), len(body)).astype(np.int32)
        return (pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(body)]),
                np.searchsorted(np.flatnonzero(cut), edges[1:]))

    def of(self, texts: pa.Array, end: bytes) -> pa.Array:
        """The packed ids of every text, and the end id."""
        texts = texts.fill_null("")
        edges = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, 4 * texts.offset).astype(np.int64)
        raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[edges[0]:edges[-1]]
        words, ends = self.words(raw, edges - edges[0])
        coded = words.dictionary_encode()
        values = [*map(self.__getitem__, coded.dictionary.to_numpy(zero_copy_only=False).tolist()), end]
        flat = np.frombuffer(b"".join(values), "<u2")
        size = np.fromiter(map(len, values), np.int64, len(values)) // 2
        place = np.cumsum(size) - size
        order = np.full(len(words) + len(ends), len(values) - 1, np.int64)
        spot = np.ones(len(order), bool)
        spot[ends + np.arange(len(ends))] = False  # the end ids
        order[spot] = coded.indices.to_numpy()
        taken = size[order]
        upto = np.cumsum(taken)
        ids = np.repeat(place[order] - upto + taken, taken)
        ids += np.arange(upto[-1])
        ids = flat.take(ids)
        offsets = np.append(0, 2 * upto[ends + np.arange(len(ends))]).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(offsets), pa.py_buffer(ids)])


@functools.lru_cache(1)
def word_ids(spec: str) -> WordIds:
    """One for all tasks of a worker process; ``_write`` drops it."""
    return WordIds(spec)


def _tokenize(spec, end_id: int):
    end = np.array([end_id], "<u2").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        words = word_ids(spec.value)
        for batch in batches:
            col = batch.column("text")
            edges = np.cumsum(pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
            at = 0
            while at < len(col):
                stop = max(at + 1, int(np.searchsorted(edges, (edges[at - 1] if at else 0) + CHUNK_BYTES, side="right")))
                some = batch.slice(at, stop - at)
                yield {"id": some.column("id"), "bucket": some.column("bucket"), "ids": words.of(some.column("text"), end)}
                at = stop
    return run


def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        from pyarrow import fs
        word_ids.cache_clear()
        store, root = fs.FileSystem.from_uri(folder)
        bucket, part, docs, size = None, 0, [], 0

        def close() -> dict:
            name = f"{bucket:08d}-{part:06d}.tok"
            ids = np.frombuffer(b"".join(d[1] for d in docs), "<u2")
            data = pack_file([d[0] for d in docs], np.array([len(d[1]) // 2 for d in docs]), ids)
            temp = f"{root}/_writing-{name}-{uuid.uuid4().hex}"  # a second attempt replaces the file whole
            with store.open_output_stream(temp) as out:
                out.write(data)
            store.move(temp, f"{root}/{name}")
            return {"name": [name], "n_docs": [len(docs)], "n_ids": [len(ids)], "bytes": [len(data)]}

        for batch in batches:
            for key, doc, ids in zip(*(batch.column(c).to_pylist() for c in ("bucket", "id", "ids"))):
                if docs and (key != bucket or size >= FILE_IDS):
                    yield close()
                    part, docs, size = part + 1 if key == bucket else 0, [], 0
                bucket = key
                docs.append((doc, ids))
                size += len(ids) // 2
        if docs:
            yield close()
    return run


def write_tokens(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id",
                 text_col: str = "text", file_chars: int = 24_000_000) -> DataFrame:
    """Encode and write; returns the manifest (name, n_docs, n_ids, bytes, first_id), files in id order.

    ``folder`` is a URI in a store that all executors share. Documents are
    dealt to ranges of ids of about ``file_chars`` characters.
    """
    from pyarrow import fs
    spark = docs.sparkSession
    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    chars = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = 1 + chars // file_chars
    edges = src.agg(F.percentile_approx("id", [k / ranges for k in range(1, ranges)] or [0.5], 10_000)).first()[0] or []
    edges = sorted(set(edges)) if ranges > 1 else []
    spec = spark.sparkContext.broadcast(open(tokenizer_path, encoding="utf-8").read())  # the vocabulary file
    if edges:
        places = spark.sparkContext.broadcast(np.array(edges, np.int64))
    else:
        places = None

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            ids = batch.column("id")
            got = np.zeros(len(ids), np.int64) if places is None else np.where(
                ids.is_valid().to_numpy(zero_copy_only=False),
                np.searchsorted(places.value, ids.fill_null(0).to_numpy(zero_copy_only=False), side="left"), 0)
            yield {"id": ids, "text": batch.column("text"), "bucket": got}

    tokenize = _tokenize(spec, end_id)

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        def dealt() -> Iterator[pa.RecordBatch]:
            for cols in deal(batches):
                yield pa.RecordBatch.from_arrays([cols["id"], cols["text"], pa.array(cols["bucket"])], ["id", "text", "bucket"])
        return tokenize(dealt())

    tokens = map_batches(src, both, "id long, bucket long, ids binary")
    files = map_batches(tokens.repartition("bucket").sortWithinPartitions("bucket", "id", "ids"), _write(folder),
                        "name string, n_docs long, n_ids long, bytes long")
    files = materialize(files, "manifest")
    before = Window.orderBy("name").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    return files.withColumn("first_id", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_tokens(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids (packed little-endian u32) of every document in the files."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.tok").load(folder) if manifest.take(1) else \
        spark.createDataFrame([], "path string, content binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                doc_ids, counts, ids = unpack_file(content.as_py())
                ends = np.cumsum(counts, dtype=np.int64)
                for at in range(0, len(doc_ids), 1024):
                    mine = slice(at, at + 1024)
                    yield {"name": [path.rsplit("/", 1)[1]] * len(doc_ids[mine]), "doc_id": doc_ids[mine],
                           "at": ends[mine] - counts[mine], "n_tokens": counts[mine].astype(np.int64),
                           "ids": [ids[e - n:e].astype("<u4").tobytes() for e, n in zip(ends[mine], counts[mine])]}

    docs = map_batches(files.select("path", "content"), run, "name string, doc_id long, at long, n_tokens long, ids binary")
    return docs.join(manifest.select("name", "first_id"), "name").select(
        "doc_id", (F.col("at") + F.col("first_id")).alias("start"), "n_tokens", "ids")


def token_digest(spark: SparkSession, docs: DataFrame, tokenizer_path: str, end_id: int = 1) -> DataFrame:
    """Write the token files of ``docs`` to the shared folder, read them back and give each document's digest."""
    folder = scratch(spark, "tokens")
    manifest = materialize(write_tokens(docs, folder, tokenizer_path, end_id), "files")
    return read_tokens(spark, folder, manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
