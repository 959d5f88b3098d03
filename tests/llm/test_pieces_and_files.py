import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from featureloom.llm import sentencepieces as sp
from featureloom.llm import token_files as tf
from featureloom.llm.common import scratch
from featureloom.llm.queries import piece_model, word_bpe

from .conftest import edge_rows, frame

ODD = ["  two  spaces ", "日本語 ▁ text\n\ttabs\r\n", "naïve \U0001f600 zero\0byte", "don't <|endoftext|> 'tis", "ﬁ ½ ³ İ ΑΣ", "a" * 300]


@pytest.fixture(scope="module")
def rows():
    return [r for r in edge_rows()] + [(100 + i, t) for i, t in enumerate(ODD)]


def best_score(table, word):
    """Plain Viterbi: the largest sum of scores."""
    score = {p: s for p, _, s in table.rows}
    best = [0.0] + [-np.inf] * len(word)
    for e in range(1, len(word) + 1):
        for s in range(max(0, e - table.longest), e):
            v = score.get(word[s:e], table.unknown if e == s + 1 else None)
            if v is not None:
                best[e] = max(best[e], best[s] + v)
    return best[-1]


def test_viterbi_is_optimal_and_round_trips(spark, rows):
    table = sp.Pieces(piece_model())
    score = {i: s for _, i, s in table.rows}
    got = sp.encode(frame(spark, rows), piece_model()).collect()
    assert len(got) == len(rows) and [r.doc_id for r in got if not r.round_trip] == [101]  # its text holds the space mark
    text = {d: t for d, t in rows if d is not None and d != 7}
    for r in got:
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and r.n_ids == len(r.ids)
        t = text.get(r.doc_id)
        if r.doc_id in text and len(t or "") < 5000:
            assert sp.decode_ids(np.array(r.ids), table).decode() == (" " + t if t else "").replace(sp.MARK, " ")
            if t and not any(i in table.byte_id.values() for i in r.ids):
                want = sum(best_score(table, w) for raw in sp.WORDS(" " + t) for w in sp.cut_word(raw, table.joined))
                assert sum(score[i] for i in r.ids) == pytest.approx(want)


def test_merge_fold_equals_the_library(spark, rows):
    import sentencepiece
    lib = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    some = [(i, t) for i, (_, t) in enumerate(rows) if len(t or "") < 5000 and (t or "") != "a" * 300]
    got = {r.doc_id: r.ids for r in sp.encode(frame(spark, some), piece_model(), fold="merge").collect()}
    assert got == {i: lib.encode(t or "") for i, t in some}


def test_decode_and_empty_table(spark, rows, no_docs):
    some = [(i, t) for i, (_, t) in enumerate(rows)]
    coded = sp.encode(frame(spark, some), piece_model())
    back = {r.doc_id: r.text for r in sp.decode(coded, piece_model()).collect()}
    assert back == {i: (t or "").replace(sp.MARK, " ") for i, t in some}
    assert sp.encode(no_docs, piece_model()).collect() == []


def test_cut_is_where_no_piece_crosses():
    table = sp.Pieces(piece_model())
    for word in ("  thanedble,", " a\nb", " 日本"):
        parts = sp.cut_word(word, table.joined)
        assert "".join(parts) == word.replace(" ", sp.MARK)
        for a, b in zip(parts, parts[1:]):
            assert not any(a[-1] + b[0] in p for p, _, _ in table.rows)


def test_token_digest_equals_library(spark, rows, no_docs):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(word_bpe())
    got = tf.token_digest(spark, frame(spark, rows).repartition(3), word_bpe()).orderBy("start").collect()
    # ids ascend, null first; rows of one id by their ids
    coded = [(d is not None, d or 0, np.array(tok.encode(t or "", add_special_tokens=False).ids + [1], "<u2").tobytes()) for d, t in rows]
    at = 0
    for r, (known, d, raw) in zip(got, sorted(coded), strict=True):
        ids = np.frombuffer(raw, "<u2").astype("<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (d if known else None, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert tf.token_digest(spark, no_docs, word_bpe()).collect() == []


def test_several_files_and_ranges(spark):
    rows = [(i, f"word{i % 7} and {i}") for i in range(300)]
    folder = scratch(spark, "test-tokens")
    manifest = tf.write_tokens(frame(spark, rows), folder, word_bpe(), 1, file_chars=500)
    assert manifest.count() > 3
    got = tf.read_tokens(spark, folder, manifest).orderBy("doc_id").collect()
    assert [r.doc_id for r in got] == list(range(300))
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    assert manifest.agg(F.sum("n_ids")).first()[0] == sum(r.n_tokens for r in got)


@pytest.mark.parametrize("ids", [[], [5], [0] * 9000, list(range(4097)), np.random.default_rng(0).integers(0, 65536, 9000).tolist(),
                                 (np.random.default_rng(1).zipf(1.3, 20_000) % 500).tolist()])
def test_coder_round_trip(ids):
    ids = np.array(ids, np.int64)
    assert (tf.decode_blocks(tf.encode_blocks(ids), len(ids)) == ids).all()


def test_one_interval_an_id(monkeypatch):
    calls = []
    narrow = tf.Coder.narrow
    monkeypatch.setattr(tf.Coder, "narrow", lambda *a: calls.append(1) or narrow(*a))
    ids = np.random.default_rng(3).integers(0, 65536, 700)  # hardly one is foreseen
    data = tf.encode_blocks(ids)
    assert len(calls) == 700 and sum(map(len, data)) < 700 * 2.4
    assert (tf.decode_blocks(data, 700) == ids).all() and len(calls) == 1400


def test_words_are_looked_up_once_a_batch_and_equal_the_library():
    from tokenizers import Tokenizer
    spec = open(word_bpe(), encoding="utf-8").read()
    library, rng = Tokenizer.from_str(spec), np.random.default_rng(4)
    bits = ["a", "B", "É", "e", "\u0301", "T\u0308", "'", "'s", "'RE", "''s", "'ll", "3", "½", "12", " ", "  ", "\n", "\x1c", "\0", "\x85",
            "\u3000", "日本", ".", "..", "_", "<|", "<|endoftext|>", "<|ENDoftext|>", "<", "|", "À", "ÿ", "×", "÷", "ß", "Ößa", "ª", "ñ\u0303", "x"]
    texts = [None, "", " ", *("".join(rng.choice(bits, rng.integers(0, 14))) for _ in range(3000))]
    got = tf.WordIds(spec).of(pa.array(["junk", *texts]).slice(1), b"\1\0").to_pylist()
    assert got == [np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u2").tobytes() for t in texts]

    class Counted(tf.WordIds):
        looked = 0

        def __getitem__(self, word):
            self.looked += 1
            return super().__getitem__(word)

    words = Counted(spec)
    words.of(pa.array(["One, two. ONE two, Één één!"] * 500), b"\1\0")
    assert words.looked == 6  # one two één , . !


def test_damage_is_found():
    data = bytearray(tf.pack_file([1, None], np.array([3, 2]), np.array([7, 8, 9, 7, 8])))
    assert tf.unpack_file(bytes(data))[0] == [1, None]
    for at in (10, len(data) // 2, len(data) - 1):
        bad = bytearray(data)
        bad[at] ^= 1
        with pytest.raises(Exception):  # noqa: B017
            tf.unpack_file(bytes(bad))
    with pytest.raises(ValueError):
        bad = bytearray(data)
        bad[-1] ^= 1
        tf.unpack_file(bytes(bad))


def test_contexts_are_used():
    rng = np.random.default_rng(2)
    once = rng.integers(0, 40_000, 500)
    repeats, noise = np.tile(once, 8), rng.integers(0, 40_000, 4000)
    size = lambda ids: sum(map(len, tf.encode_blocks(ids)))
    assert size(repeats) < 0.45 * size(noise)
