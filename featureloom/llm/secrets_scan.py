"""Secret scan: fixed patterns plus a randomness test battery.

Patterns find assignments, access keys and long hex runs (``base`` spans). The
battery looks at every run of ``min_len`` or more characters of
``[A-Za-z0-9+/_-]`` (with ``=`` padding): its encoding is inferred from the
characters used, and under that alphabet it takes

* a chi-squared test of uniform characters (exact multinomial variance),
* a runs test on the upper and lower half of the alphabet,
* a serial-correlation test of neighbouring characters,

joined by Fisher's method into ``p_random`` (small: not a random string). False
discoveries are controlled against ordinary text: ``p_text`` is the chance that
text of the run's length stays in the alphabet, times the tail of the
likelihood ratio of uniform against the corpus' own character frequencies
(letters of one case stand for both unless the alphabet has both; numbers
alone never count as secret), and a Benjamini-Hochberg threshold at level
``fdr`` is taken in each (encoding, length class) over all runs of the corpus.
A run is a secret when its ``p_text`` passes and ``p_random`` >= ``alpha``.
p-values are rounded up to 1/20 of a decade, so the counts behind the
thresholds have a fixed size (encodings x length classes x 400).

Rules: a null text is scanned as empty; empty texts have no spans; repeated
rows are scanned one by one; ids and other columns may be null and pass
through (their names may be anything but the double-underscore names below);
texts are scanned whole, in code points. An empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, materialize, set_apart, texts

ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
KINDS = ("assign", "access", "hex", "random")
BASE, SPANS, RUNS, HIST = "__base", "__spans", "__runs", "__hist"
RUN_CHARS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
IS_HEX = bytes(b"h"[0] if b in b"0123456789abcdef" else 32 for b in range(256))
IS_RUN = bytes(b"t"[0] if b in RUN_CHARS else 32 for b in range(256))
LOWER_CASE, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
#: Encodings, tried in this order; the first whose alphabet holds every character is taken.
ENCODINGS = {
    "decimal": DIGITS, "hex": DIGITS + "abcdef", "HEX": DIGITS + "ABCDEF", "lower": LOWER_CASE,
    "base32": UPPER + "234567", "base36": LOWER_CASE + DIGITS, "base62": UPPER + LOWER_CASE + DIGITS,
    "base64": UPPER + LOWER_CASE + DIGITS + "+/", "base64url": UPPER + LOWER_CASE + DIGITS + "-_",
    "mixed": RUN_CHARS.decode(),
}
LENGTHS = (24, 32, 48, 64, 128)  # upper bounds of the length classes
BINS, PER_DECADE = 400, 20


def base_spans(text: str, raw: bytes | None = None) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the fixed patterns, by start and then kind as listed in KINDS."""
    raw = text.encode() if raw is None else raw
    out = []
    low = raw.lower()  # bytes: ASCII letters only
    if any(k in low for k in KEYWORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if b"AKIA" in raw:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    if b"h" * 24 in raw.translate(IS_HEX):
        out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return [(s, KINDS[k], e) for s, k, e in sorted(out)]


def _tail(z: np.ndarray) -> np.ndarray:
    return np.array([0.5 * math.erfc(x / math.sqrt(2)) for x in z.tolist()])


def infer_encoding(token: str) -> int:
    chars = set(token)
    return next(i for i, a in enumerate(_ALPHABETS) if chars <= a)


_ALPHABETS = [set(a) for a in ENCODINGS.values()]


def battery(tokens: list[str], text_counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(encoding, p_random, p_text) of each run; ``text_counts``: the corpus' 256 byte counts."""
    tokens = [t.rstrip("=") for t in tokens]
    kind = np.array([infer_encoding(t) for t in tokens], np.int64)
    p_random, p_text = np.ones(len(tokens)), np.ones(len(tokens))
    letters = np.array([c for c in range(256) if chr(c).isascii() and chr(c).isalpha()])
    folded = text_counts.astype(float).copy()  # either case counts for both
    folded[letters] = text_counts[letters] + text_counts[letters ^ 32]
    all_text = text_counts[letters].sum() + text_counts[48:58].sum() + 36.0
    for e, alphabet in enumerate(ENCODINGS.values()):
        mine, k = np.flatnonzero(kind == e), len(alphabet)
        codes = np.frombuffer(alphabet.encode(), np.uint8)
        table = np.zeros(256, np.int64)
        table[codes] = np.arange(k)
        seen = folded if alphabet.lower() == alphabet or alphabet.upper() == alphabet else text_counts
        freq = seen[codes] + 1.0
        inside = min(1.0, freq.sum() / all_text)  # a character of text lies in the alphabet
        freq /= freq.sum()
        gain = -np.log(k * freq)  # log of uniform over text
        mean, var = (freq * gain).sum(), (freq * gain**2).sum() - (freq * gain).sum() ** 2
        for part in np.array_split(mine, max(1, -(-len(mine) // 4096))):
            if not len(part):
                continue
            n = np.array([len(tokens[i]) for i in part])
            sym = table[np.frombuffer("".join(tokens[i] for i in part).encode(), np.uint8)]
            row = np.repeat(np.arange(len(part)), n)
            total = lambda v: np.bincount(row, weights=v, minlength=len(part))  # noqa: E731, B023
            counts = np.bincount(row * k + sym, minlength=len(part) * k).reshape(-1, k)
            chi = (counts**2).sum(1) * k / n - n
            p1 = _tail((chi - (k - 1)) / np.sqrt(2 * (k - 1) * np.maximum(n - 1, 1) / n))
            high, inner = sym >= k // 2, np.concatenate([row[1:] == row[:-1], [False]])
            a = total(high)
            b = n - a
            runs = 1 + total(inner & (high != np.roll(high, -1)))
            expect = 1 + 2 * a * b / n
            spread = np.sqrt(np.maximum((expect - 1) * (expect - 2) / np.maximum(n - 1, 1), 1e-9))
            p2 = np.where(a * b == 0, 2.0 ** (1 - n), 2 * _tail(np.abs(runs - expect) / spread))
            u = sym - (k - 1) / 2
            r = total(np.where(inner, u * np.roll(u, -1), 0)) / ((k * k - 1) / 12)
            p3 = 2 * _tail(np.abs(r) / np.sqrt(np.maximum(n - 1, 1)))
            x = -np.log(np.maximum(np.stack([p1, np.minimum(p2, 1), np.minimum(p3, 1)]), 1e-300)).sum(0)
            p_random[part] = np.exp(-x) * (1 + x + x * x / 2)  # Fisher: chi-squared with 6 degrees
            if e and var > 1e-9:  # a long number is no secret by itself
                p_text[part] = inside**n * _tail((counts @ gain - n * mean) / np.sqrt(n * var))
    return kind, p_random, p_text


def p_bin(p: np.ndarray) -> np.ndarray:
    """p rounded up to a bin: bin b stands for 10 ** (-b / PER_DECADE)."""
    return np.minimum(np.floor(-np.log10(np.maximum(p, 1e-300)) * PER_DECADE + 1e-9), BINS - 1).astype(np.int64)


def thresholds(rows: list, fdr: float) -> dict[tuple[int, int], int]:
    """Benjamini-Hochberg on binned p-values: the smallest passing bin of each (encoding, length class)."""
    strata: dict[tuple[int, int], np.ndarray] = {}
    for enc, length, b, c in rows:
        strata.setdefault((enc, length), np.zeros(BINS))[b] += c
    out = {}
    for key, counts in strata.items():
        at_most = np.cumsum(counts[::-1])[::-1]  # runs with a p-value as small as the bin's
        good = np.flatnonzero((10.0 ** (-np.arange(BINS) / PER_DECADE) <= fdr * at_most / counts.sum()) & (at_most > 0))
        if len(good):
            out[key] = int(good[0])
    return out


def _scan(text_col: str, keep: list[str], min_len: int):
    run_re = re.compile(rf"[A-Za-z0-9+/_-]{{{min_len},}}={{0,2}}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for at, some in texts(batch, text_col):
                base, runs, hist = [], [], np.zeros(256, np.int64)
                for text in some:
                    text = text or ""
                    raw = text.encode()
                    hist += np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
                    base.append([{"k": k, "s": s, "e": e} for s, k, e in base_spans(text, raw)])
                    found = run_re.finditer(text) if b"t" * min_len in raw.translate(IS_RUN) else ()
                    runs.append([{"s": m.start(), "token": m[0]} for m in found])
                yield {**{c: batch.column(c).slice(at, len(some)) for c in keep}, BASE: base, RUNS: runs,
                       HIST: [hist] + [None] * (len(some) - 1)}
    return run


def _tests(text_counts):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            cols = {f.name: batch.column(f.name) for f in batch.schema if f.name not in (RUNS, HIST)}
            lists = batch.column(RUNS).to_pylist()
            flat = [x for xs in lists for x in xs]
            kind, p_random, p_text = battery([x["token"] for x in flat], text_counts.value)
            length = np.searchsorted(LENGTHS, [len(x["token"]) for x in flat], side="right")
            tested = [{"s": x["s"], "e": x["s"] + len(x["token"]), "enc": int(k), "len": int(n), "bin": int(b), "p": float(p)}
                      for x, k, n, b, p in zip(flat, kind, length, p_bin(p_text), p_random)]
            it = iter(tested)
            yield {**cols, RUNS: [[next(it) for _ in xs] for xs in lists]}
    return run


def find_secrets(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None,
                 min_len: int = 20, fdr: float = 0.001, alpha: float = 0.001) -> DataFrame:
    """The ``keep`` columns (default: all) with ``__base`` and ``__spans``: arrays of (k, s, e).

    ``__spans`` holds the base spans and the battery's ``random`` spans that no
    base span covers, by start and kind. Columns of ``docs`` with these names give way.
    """
    inner = {n.lower() for n in (BASE, SPANS, RUNS, HIST)}
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in inner]
    schema = {f.name: f.dataType.simpleString() for f in docs.schema}
    ddl = "".join(f"`{c}` {schema[c]}, " for c in keep) + f"{BASE} array<struct<k:string,s:long,e:long>>, "
    src = docs.select(*{text_col: 0, **dict.fromkeys(keep)})
    found = materialize(map_batches(src, _scan(text_col, keep, min_len),
                                    ddl + f"{RUNS} array<struct<s:long,token:string>>, {HIST} array<bigint>"), "runs")
    counts = np.zeros(256, np.int64)
    for r in found.where(f"{HIST} is not null").select(F.posexplode(HIST)).groupBy("pos").agg(F.sum("col").alias("n")).collect():
        counts[r.pos] = r.n
    shared = docs.sparkSession.sparkContext.broadcast(counts)  # 256 numbers
    tested = materialize(map_batches(found.drop(HIST), _tests(shared),
                                     ddl + f"{RUNS} array<struct<s:long,e:long,enc:int,len:int,bin:int,p:double>>"), "tested")
    table = tested.select(F.inline(RUNS)).groupBy("enc", "len", "bin").count().collect()  # bounded by the classes
    passed = thresholds([(r["enc"], r["len"], r["bin"], r["count"]) for r in table], fdr)
    limit = F.lit(None).cast("int") if not passed else F.create_map(*[F.lit(x) for (e, n), b in sorted(passed.items())
                                                                     for x in (e * 100 + n, b)])
    least = (lambda x: limit) if not passed else (lambda x: F.try_element_at(limit, x.enc * 100 + x.len))
    random = F.filter(RUNS, lambda x: (x.bin >= least(x)) & (x.p >= alpha)
                      & ~F.exists(BASE, lambda b: (b.s <= x.s) & (b.e >= x.e)))
    spans = F.concat(BASE, F.transform(random, lambda x: F.struct(F.lit("random").alias("k"), x.s.alias("s"), x.e.alias("e"))))
    order = F.array_sort(F.transform(spans, lambda x: F.struct(
        x.s.alias("s"), F.array_position(F.array(*map(F.lit, KINDS)), x.k).alias("o"), x.k.alias("k"), x.e.alias("e"))))
    return tested.withColumn(SPANS, F.transform(order, lambda x: F.struct(x.k.alias("k"), x.s.alias("s"), x.e.alias("e")))) \
        .drop(RUNS)


def span_text(spans):
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x.k, x.s.cast("string"), x.e.cast("string"))), ",")


def redact(text: str, spans: list[tuple[int, int]], mark: str = "[REDACTED]") -> str:
    out, last = [], 0
    for s, e in sorted(spans):
        if s >= last:
            out += [text[last:s], mark]
        last = max(last, e)
    return "".join([*out, text[last:]])


def redact_secrets(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """``docs`` with every found span replaced by ``[REDACTED]``; all rows and columns stay."""
    docs, named = set_apart(docs, (BASE, SPANS, RUNS, HIST))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    columns = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for at, some in texts(batch, text_col):
                spans = batch.column(SPANS).slice(at, len(some)).to_pylist()
                out = [redact(t, [(x["s"], x["e"]) for x in s]) if s else t for t, s in zip(some, spans)]
                yield {c: out if c == text_col else batch.column(c).slice(at, len(some)) for c in columns}

    return named(map_batches(find_secrets(docs, text_col, **options), run, schema))
