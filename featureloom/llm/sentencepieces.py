"""SentencePiece encoding and decoding as a relational lattice.

1. Texts are cut into words where no piece can cross: before a space that ends
   a word, and between two characters that never stand together in a piece.
   Tasks write chunks: the documents as word numbers, and the chunk's words,
   dealt by a hash into small compressed lists.
2. The lists meet by hash and give every distinct word once, with the (chunk,
   number) places that use it.
3. Lattice of the distinct words: all substrings up to the longest piece are
   exploded and equi-joined to the piece table (broadcast: its size is that of
   the vocabulary file); a character without a piece gets an edge of its own
   below every score. Edges are grouped by word and one higher-order aggregate
   folds them in order of their ends: best score of each position, its last
   piece; a second one walks back.
4. Ids go back to the chunks that use the word; the task of a chunk reads its
   documents from the written table and puts them together. Characters without
   a piece become byte pieces.

Words are encoded once for the whole corpus; texts are written once, as word
numbers, and never shuffled. A frequent word costs one row for each few
thousand chunks, never a row for each use.

``fold`` names the segmentation taken from the same lattice:

* ``viterbi`` - the pieces with the largest sum of scores; ties take the longest
  last piece. This is what the library does for a unigram model.
* ``merge`` - neighbours merge in order of the merged piece's score, leftmost
  first. This is what the library does for a BPE model.

Rules: a null or empty text has no ids; a text begins with a space mark if
``dummy_prefix``; spaces become U+2581, nothing else is normalised (a text that holds U+2581
itself decodes to spaces there, and ``round_trip`` says so). Repeated
rows and null document ids are kept row by row. Only the id and text columns are read. An empty table gives no
rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_batches, materialize, texts

MARK = "▁"
CHUNK_WORDS, CHUNK_DISTINCT = 3_500_000, 300_000
PLACES = 4096  # uses of a word in one row
WORDS = re.compile(" +[^ ]*|[^ ]+").findall
PENALTY = 10.0  # a character without a piece scores this much below the worst piece
PLACE = np.dtype([("chunk", "<i8"), ("code", "<u4")])


class Pieces:
    """The piece table of a model file: pieces, scores, byte pieces."""

    def __init__(self, model_path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        n = sp.get_piece_size()
        self.special = [i for i in range(n) if sp.is_unknown(i) or sp.is_control(i) or sp.is_unused(i)]
        self.byte_id = {int(sp.id_to_piece(i)[1:-1], 16): i for i in range(n) if sp.is_byte(i)}
        skip = {*self.special, *self.byte_id.values()}
        self.rows = [(sp.id_to_piece(i), i, float(sp.get_score(i))) for i in range(n) if i not in skip]
        self.unknown = min(r[2] for r in self.rows) - PENALTY
        self.longest = max(len(r[0]) for r in self.rows)
        self.unk_id = sp.unk_id()
        text = {i: p.replace(MARK, " ").encode() for p, i, _ in self.rows} | {i: bytes([b]) for b, i in self.byte_id.items()}
        self.bytes = [text.get(i, b"") for i in range(n)]
        self.joined = {p[k:k + 2] for p, _, _ in self.rows for k in range(len(p) - 1)}

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, "piece string, id long, score double")

    def of_character(self, edge: int) -> list[int]:
        """Byte pieces of an edge without a piece."""
        raw = -1 - edge
        return [self.byte_id.get(b, self.unk_id) for b in raw.to_bytes(max(1, (raw.bit_length() + 7) // 8), "big")]


def lattice(words: DataFrame, pieces: DataFrame, longest: int, unknown: float) -> DataFrame:
    """(word, edges) with edges (e, s, id, score): piece ``id`` covers characters s to e of the word.

    A character without a piece has the edge id ``-1 - its UTF-8 bytes as one number``.
    """
    spans = words.select("word", F.expr("explode(sequence(1, length(word)))").alias("at")).select(
        "word", "at", F.expr(f"explode(sequence(1, least({longest}, length(word) - at + 1)))").alias("size")) \
        .select("word", "at", "size", F.expr("substring(word, at, size)").alias("piece"))
    edges = spans.join(F.broadcast(pieces), "piece", "left").where("id is not null or size = 1")
    return edges.groupBy("word").agg(F.sort_array(F.collect_list(F.struct(
        (F.col("at") + F.col("size") - 1).alias("e"), (F.col("at") - 1).alias("s"),
        F.expr("coalesce(id, -1 - cast(conv(hex(piece), 16, 10) as bigint))").alias("id"), F.coalesce("score", F.lit(unknown)).alias("score")))).alias("edges"))


#: acc.done: (score, s, id) of the best path to each finished position; acc.best: to the position in work.
VITERBI = """
aggregate(edges,
  named_struct('done', array(named_struct('score', 0D, 's', 0, 'id', 0L)),
               'best', named_struct('score', double('-Infinity'), 's', 0, 'id', 0L)),
  (acc, x) -> if(x.e = size(acc.done),
    named_struct('done', acc.done,
      'best', if(acc.done[x.s].score + x.score > acc.best.score,
                 named_struct('score', acc.done[x.s].score + x.score, 's', x.s, 'id', x.id), acc.best)),
    named_struct('done', concat(acc.done, array(acc.best)),
      'best', named_struct('score', if(x.s < size(acc.done), acc.done[x.s].score, acc.best.score) + x.score,
                           's', x.s, 'id', x.id))),
  acc -> aggregate(sequence(1, size(acc.done)),
    named_struct('p', acc.best.s, 'ids', array(acc.best.id)),
    (b, i) -> if(b.p = 0, b, named_struct('p', acc.done[b.p].s, 'ids', concat(array(acc.done[b.p].id), b.ids))),
    b -> b.ids))
"""
#: acc: the edges chosen so far, in order; each step merges the neighbours whose joint edge scores best, leftmost first.
MERGE = """
transform(aggregate(sequence(2, greatest(2, length(word))),
  filter(edges, x -> x.e = x.s + 1),
  (acc, i) -> aggregate(
    array(array_max(transform(sequence(1, greatest(1, size(acc) - 1)), k -> if(k < size(acc),
      array_max(transform(filter(edges, x -> x.s = acc[k - 1].s and x.e = acc[k].e and x.id >= 0),
        x -> named_struct('score', x.score, 'k', -k, 'x', x))), null)))),
    acc, (a, m) -> if(m is null, a,
      concat(slice(a, 1, -m.k - 1), array(m.x), slice(a, -m.k + 2, greatest(0, size(a) + m.k - 1)))))),
  x -> x.id)
"""
FOLDS = {"viterbi": VITERBI, "merge": MERGE}


def encode_words(words: DataFrame, table: Pieces, fold: str = "viterbi") -> DataFrame:
    """(word, ids) of distinct non-empty words; a character without a piece is its edge's id."""
    edges = lattice(words, table.frame(words.sparkSession), table.longest, table.unknown)
    return edges.select("word", F.expr(FOLDS[fold]).alias("ids"))


def cut_word(raw: str, joined: set[str]) -> list[str]:
    """A word with its leading spaces as marks, cut between characters that no piece joins."""
    word, out, at = raw.replace(" ", MARK), [], 0
    for k in range(1, len(word)):
        if word[k - 1:k + 1] not in joined:
            out.append(word[at:k])
            at = k
    return [*out, word[at:]]


def steps_of(rising: np.ndarray) -> bytes:
    """Rising numbers as their differences, which compress well."""
    return np.diff(rising, prepend=rising.dtype.type(0)).astype("<u4").tobytes()


def from_steps(raw: bytes, count: int, at: int = 0) -> np.ndarray:
    return np.cumsum(np.frombuffer(raw, "<u4", count, at), dtype=np.uint32)


def planes(values: np.ndarray) -> bytes:
    """32-bit numbers as all lower and then all upper halves."""
    return (values & 0xFFFF).astype("<u2").tobytes() + (values >> 16).astype("<u2").tobytes()


def from_planes(raw: bytes) -> np.ndarray:
    halves = np.frombuffer(raw, "<u2")
    return halves[:len(halves) // 2].astype(np.uint32) | halves[len(halves) // 2:].astype(np.uint32) << 16


class Chunk:
    """Documents of one task as word numbers, and the words."""

    def __init__(self, joined: set[str]):
        self.joined = joined
        self.clear()

    def clear(self) -> None:
        self.code: dict[str, int] = {}
        self.raw: dict[str, bytes] = {}
        self.seqs: list[bytes] = []
        self.size = 0

    def __getitem__(self, raw: str) -> bytes:
        got = self.raw.get(raw)
        if got is None:
            got = self.raw[raw] = np.array([self.code.setdefault(s, len(self.code)) for s in cut_word(raw, self.joined)],
                                           "<u4").tobytes()
        return got

    def add(self, text: str | None, dummy: bool) -> None:
        text = (" " + text if dummy else text) if text else ""
        self.seqs.append(b"".join(map(self.__getitem__, WORDS(text))))
        self.size += len(self.seqs[-1]) // 4

    def full(self) -> bool:
        return self.size >= CHUNK_WORDS or len(self.code) >= CHUNK_DISTINCT or len(self.raw) >= 2 * CHUNK_DISTINCT

    def row(self, number: int, ids: list, checks: list[int], buckets: int) -> dict:
        pack = zstandard.ZstdCompressor(level=3).compress
        # words hold no space (it became the mark), so a space separates them
        lists: list[list[str]] = [[] for _ in range(buckets)]
        codes: list[list[int]] = [[] for _ in range(buckets)]
        for word, code in self.code.items():
            b = zlib.crc32(word.encode()) % buckets
            lists[b].append(word)
            codes[b].append(code)
        seq = np.frombuffer(b"".join(self.seqs), "<u4")
        return {"chunk": [number],
                "words": [[pack(steps_of(np.array(c, "<u4")) + " ".join(w).encode()) if c else b"" for w, c in zip(lists, codes)]],
                "sizes": [[len(c) for c in codes]], "ids": [ids], "lens": [[len(s) // 4 for s in self.seqs]],
                "checks": [checks], "seq": [pack(planes(seq))]}


def _chunks(joined, dummy: bool, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        from pyspark import TaskContext
        chunk, ids, checks = Chunk(joined.value), [], []
        number = TaskContext.get().partitionId() << 24  # of the task and its chunk; the table is written once
        for batch in batches:
            keys = batch.column("id").to_pylist()
            for at, some in texts(batch):
                for key, text in zip(keys[at:], some):
                    chunk.add(text, dummy)
                    ids.append(key)
                    checks.append(zlib.crc32((text or "").encode()))
                    if chunk.full():
                        yield chunk.row(number, ids, checks, buckets)
                        chunk.clear()
                        number, ids, checks = number + 1, [], []
        if ids:
            yield chunk.row(number, ids, checks, buckets)
    return run


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Distinct words of a bucket with the packed places that use them."""
    unpack = zstandard.ZstdDecompressor().decompress
    current, uses = None, {}

    def close() -> Iterator[dict]:
        words = list(uses)
        for at in range(0, len(words), 20_000):
            part = [(w, bytes(u[k:k + 12 * PLACES])) for w in words[at:at + 20_000] for u in (uses[w],)
                    for k in range(0, len(u), 12 * PLACES)]
            yield {"word": [p[0] for p in part], "places": [p[1] for p in part]}
        uses.clear()

    for batch in batches:
        for bucket, chunk, size, blob in zip(*(batch.column(c).to_pylist() for c in ("bucket", "chunk", "size", "blob"))):
            if bucket != current:
                yield from close()
                current = bucket
            raw = unpack(blob)
            place = np.empty(size, PLACE)
            place["chunk"], place["code"] = chunk, from_steps(raw, size)
            flat = place.tobytes()
            for k, word in enumerate(raw[4 * size:].decode().split(" ")):
                if word in uses:
                    uses[word] += flat[12 * k:12 * k + 12]
                else:
                    uses[word] = bytearray(flat[12 * k:12 * k + 12])
    yield from close()


def spread(values: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Concatenated ``values[start:start + len]``."""
    ends = np.cumsum(lens)
    return values[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lens, lens)]


def _back_to_chunks(table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        pieces = table.value
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            if not batch.num_rows:
                continue
            lists, places = batch.column("ids"), batch.column("places").to_pylist()
            values, lens = lists.flatten().to_numpy(zero_copy_only=False), lists.value_lengths().to_numpy()
            if (values < 0).any():  # byte pieces
                new = [[j for i in row for j in ([i] if i >= 0 else pieces.of_character(i))] for row in lists.to_pylist()]
                values, lens = np.array([i for row in new for i in row], np.int64), np.array([len(r) for r in new])
            starts = np.cumsum(lens) - lens
            place = np.frombuffer(b"".join(places), PLACE)
            row = np.repeat(np.arange(len(places)), [len(p) // 12 for p in places])
            order = np.lexsort((place["code"], place["chunk"]))
            place, row = place[order], row[order]
            cuts = np.flatnonzero(np.concatenate([[True], np.diff(place["chunk"]) != 0, [True]]))
            out = {"chunk": place["chunk"][cuts[:-1]], "part": []}
            for a, b in zip(cuts, cuts[1:]):
                r = row[a:b]
                flat = spread(values, starts[r], lens[r])
                out["part"].append(pack(np.uint32(b - a).tobytes() + steps_of(place["code"][a:b])
                                        + lens[r].astype("<u4").tobytes() + planes(flat)))
            yield out
    return run


def decode_ids(ids: np.ndarray, pieces: Pieces) -> bytes:
    """The UTF-8 text of ids, with its leading space mark as a space."""
    return b"".join([pieces.bytes[i] for i in ids])


def _assemble(table, dummy: bool, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        import pyarrow.parquet as pq
        from pyarrow import fs
        pieces = table.value
        unpack = zstandard.ZstdDecompressor().decompress
        size = np.array([len(b) for b in pieces.bytes])
        letters, first = np.frombuffer(b"".join(pieces.bytes), np.uint8), np.cumsum(size) - size
        parts: list[bytes] = []
        for batch in batches:
            for number, part, file in zip(*(batch.column(c).to_pylist() for c in ("chunk", "part", "file"))):
                if file is None:
                    parts.append(part)
                    continue
                codes, lens, flat = [], [], []
                for raw in map(unpack, parts):
                    n = int(np.frombuffer(raw, "<u4", 1)[0])
                    codes.append(from_steps(raw, n, 4))
                    lens.append(np.frombuffer(raw, "<u4", n, 4 + 4 * n))
                    flat.append(from_planes(raw[4 + 8 * n:]))
                parts = []
                code = np.concatenate(codes) if codes else np.empty(0, np.int64)
                n_ids, start = np.zeros(len(code), np.int64), np.zeros(len(code), np.int64)
                if len(code):
                    many, values = np.concatenate(lens).astype(np.int64), np.concatenate(flat)
                    n_ids[code], start[code] = many, np.cumsum(many) - many
                store, path = fs.FileSystem.from_uri(file)
                row = pq.read_table(path, filesystem=store, columns=["ids", "lens", "checks", "seq"],
                                    filters=[("chunk", "==", number)]).combine_chunks()
                seq = from_planes(unpack(row["seq"][0].as_py()))
                ids, checks, words = row["ids"][0].values, row["checks"][0].values.to_pylist(), row["lens"][0].values.to_pylist()
                at = 0
                for k in range(0, len(words), 256):
                    out = {"doc": ids.slice(k, 256), "n_ids": [], "n_bytes": [], "crc": [], "same": [], "ids": []}
                    for n, check in zip(words[k:k + 256], checks[k:k + 256]):
                        w = seq[at:at + n]
                        at += n
                        doc = spread(values, start[w], n_ids[w]).astype("<u4") if n else np.empty(0, "<u4")
                        text = spread(letters, first[doc], size[doc]).tobytes()
                        out["n_ids"].append(len(doc))
                        out["n_bytes"].append(len(text))
                        out["crc"].append(zlib.crc32(doc))
                        out["same"].append(zlib.crc32(text[1:] if dummy and text else text) == check)
                        out["ids"].append(doc.astype(np.int32) if keep_ids else None)
                    yield out
    return run


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", fold: str = "viterbi",
           dummy_prefix: bool = True, keep_ids: bool = True) -> DataFrame:
    """Per row: id, ``n_ids``, ``ids_crc32`` (of the ids as little-endian u32), ``round_trip`` and ``ids``.

    ``round_trip``: decoding the ids gave the text's bytes back. ``ids`` is null without ``keep_ids``.
    """
    spark = docs.sparkSession
    table = Pieces(model_path)
    buckets = max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = dict(src.dtypes)["id"]
    joined, shared = spark.sparkContext.broadcast(table.joined), spark.sparkContext.broadcast(table)  # of the vocabulary's size
    chunks = materialize(map_batches(src, _chunks(joined, dummy_prefix, buckets),
                                     f"chunk long, words array<binary>, sizes array<int>, ids array<{kind}>, lens array<int>, "
                                     "checks array<bigint>, seq binary"), "chunks")
    lists = chunks.select("chunk", F.posexplode(F.arrays_zip("words", "sizes")).alias("bucket", "w")) \
        .select("chunk", "bucket", F.col("w.words").alias("blob"), F.col("w.sizes").alias("size")).where("size > 0")
    # small partitions by word: the edges of a word are some twenty times its rows
    places = map_batches(lists.repartition("bucket").sortWithinPartitions("bucket"), _places, "word string, places binary") \
        .repartition(4 * buckets, "word")
    # the aggregate needs both columns, so that the words and their places come from one exchange
    words = places.groupBy("word").agg(F.max(F.octet_length("places")).alias("bytes")).where("bytes > 0").select("word")
    coded = encode_words(words, table, fold)
    parts = map_batches(places.join(coded, "word").select("ids", "places"), _back_to_chunks(shared), "chunk long, part binary")
    where = chunks.select("chunk", F.lit(None).cast("binary").alias("part"), F.col("_metadata.file_path").alias("file"))
    both = parts.select("chunk", "part", F.lit(None).cast("string").alias("file")).unionAll(where)
    both = both.repartition("chunk").sortWithinPartitions("chunk", F.col("file").isNotNull())
    out = map_batches(both, _assemble(shared, dummy_prefix, keep_ids),
                      f"doc {kind}, n_ids long, n_bytes long, crc long, same boolean, ids array<int>")
    return out.select(F.col("doc").alias(id_col), "n_ids", "n_bytes", F.col("crc").alias("ids_crc32"),
                      F.col("same").alias("round_trip"), "ids")


def decode(encoded: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids",
           dummy_prefix: bool = True) -> DataFrame:
    """Per row: id and ``text`` decoded from its ids (null ids: null; ids outside the vocabulary: nothing)."""
    shared = encoded.sparkSession.sparkContext.broadcast(Pieces(model_path))
    kind = dict(encoded.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        pieces = shared.value
        for batch in batches:
            out = []
            for ids in batch.column("ids").to_pylist():
                raw = None if ids is None else decode_ids([i for i in ids if i is not None and 0 <= i < len(pieces.bytes)], pieces)
                out.append(None if raw is None else (raw[1:] if dummy_prefix and raw[:1] == b" " else raw).decode(errors="replace"))
            yield {"id": batch.column("id"), "text": out}

    return map_batches(encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids")), run,
                       f"id {kind}, text string").select(F.col("id").alias(id_col), "text")
