"""Quality classifier: random-indexing word vectors and a small calibrated network.

1. Random indexing over the whole corpus: every token bucket has a fixed sparse
   random vector; the context vector of a bucket is the sum of the random
   vectors of its neighbours up to two tokens away. Tokens are lower-case words
   plus marks for punctuation, all-capital words and repeated words, hashed to
   ``BUCKETS`` buckets, so the table has a fixed size (4 MB) at any corpus size.
   Tasks add up their own table and two shuffles of table slices (salted, each
   slice summed as a stream) join them.
2. A document is the frequency-weighted mean of its tokens' unit vectors, with
   the mean of their squares.
3. A two-layer network is trained in numpy on a bounded labelled sample; a
   temperature fitted on rows it has not seen calibrates its probabilities.

Rules: a null text counts as empty; an empty text has the zero vector and is
scored by the network like any other; without labels of both classes every
score is the share of label 1 (0 without labels). Repeated rows are scored one by one; null ids are no
obstacle; extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, materialize, texts
from .labelled import labelled_sample

BUCKETS, DIM, SPARSE, WINDOW = 16_384, 64, 2, 2
SLICES, SALT = 64, 16
CAPS, REPEAT = 1, 2  # buckets of the marks; 0 is no token
EDGE = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


class Tokens(dict):
    """raw word -> word bucket + BUCKETS * punctuation bucket + BUCKETS**2 * capitals; bounded."""

    def __init__(self, limit: int = 400_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, raw: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        word = raw.decode()
        core = word.strip(EDGE)
        marks = word.replace(core, " ", 1) if core else word
        bucket = lambda s: 3 + zlib.crc32(s.encode()) % (BUCKETS - 3)
        caps = len(core) > 2 and core.isupper()
        value = self[raw] = (bucket(core.lower()) if core else 0) + BUCKETS * (
            bucket("mark:" + marks) if marks.strip() else 0) + BUCKETS**2 * caps
        return value

    def of(self, text: str | None) -> np.ndarray:
        """The token buckets of a text, in order."""
        words = (text or "").encode().split()
        code = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        seq = np.zeros((len(code), 4), np.int32)
        seq[:, 0], seq[:, 1] = code % BUCKETS, code // BUCKETS % BUCKETS
        seq[:, 2] = np.where(code >= BUCKETS**2, CAPS, 0)
        seq[1:, 3] = np.where(code[1:] == code[:-1], REPEAT, 0)
        seq = seq.ravel()
        return seq[seq > 0]


def index_vectors(seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the SPARSE non-zero entries of every bucket's random vector."""
    rng = np.random.default_rng(seed)
    return rng.integers(0, DIM, (BUCKETS, SPARSE)), rng.choice([-1.0, 1.0], (BUCKETS, SPARSE))


def add_contexts(seq: np.ndarray, table: np.ndarray, place: np.ndarray, sign: np.ndarray) -> None:
    """Add the context vectors and, in the last column, the counts of one token sequence."""
    for step in range(1, WINDOW + 1):
        a, b = seq[:-step], seq[step:]
        for of, by in ((a, b), (b, a)):
            for j in range(SPARSE):
                cell = of.astype(np.int64) * (DIM + 1) + place[by, j]
                table += np.bincount(cell, sign[by, j], BUCKETS * (DIM + 1))
    table[DIM::DIM + 1] += np.bincount(seq, minlength=BUCKETS)


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    tokens, (place, sign) = Tokens(), index_vectors()
    table, pending, size = np.zeros(BUCKETS * (DIM + 1)), [], 0
    gap = np.zeros(WINDOW, np.int32)  # bucket 0 between documents; its row is cleared at the end

    def flush() -> None:
        if pending:
            add_contexts(np.concatenate(pending), table, place * 1, sign)

    sign[0] = 0.0
    for batch in batches:
        for _, some in texts(batch):
            for text in some:
                seq = tokens.of(text)
                pending += [seq, gap]
                size += len(seq)
                if size > 2_000_000:
                    flush()
                    pending, size = [], 0
    flush()
    table[:DIM + 1] = 0
    parts = table.astype(np.float32).reshape(SLICES, -1)
    yield {"slice": list(range(SLICES)), "part": [p.tobytes() for p in parts]}


def _sum_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, part in zip(batch.column("slice").to_pylist(), batch.column("part")):
            v = np.frombuffer(part.as_buffer(), np.float32 if len(part.as_buffer()) == BUCKETS * (DIM + 1) * 4 // SLICES
                              else np.float64).astype(np.float64)
            total[k] = total[k] + v if k in total else v
    yield {"slice": list(total), "part": [v.tobytes() for v in total.values()]}


def word_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """(BUCKETS, DIM) unit vectors scaled by a + frequency weight, from all texts."""
    parts = map_batches(docs.select(F.col(text_col).alias("text")), _contexts, "slice int, part binary")
    some = map_batches(parts.repartition("slice", F.pmod(F.hash("part"), F.lit(SALT))), _sum_slices, "slice int, part binary")
    one = materialize(map_batches(some.repartition("slice"), _sum_slices, "slice int, part binary"), "vectors")
    table = np.zeros((SLICES, BUCKETS * (DIM + 1) // SLICES))
    for r in one.collect():  # SLICES rows, 8 MB
        table[r["slice"]] += np.frombuffer(r["part"])
    table = table.reshape(BUCKETS, DIM + 1)
    count = table[:, DIM]
    vec = np.sign(table[:, :DIM]) * np.sqrt(np.abs(table[:, :DIM]))
    norm = np.sqrt((vec**2).sum(1, keepdims=True))
    frequency = count / max(1.0, count.sum())
    return (vec / np.maximum(norm, 1e-9) * (1e-2 / (1e-2 + frequency))[:, None]).astype(np.float32)


def pool(docs: list[str | None], tokens: Tokens, vectors: np.ndarray) -> np.ndarray:
    out = np.zeros((len(docs), 2 * DIM), np.float32)
    for i, text in enumerate(docs):
        seq = tokens.of(text)
        for at in range(0, len(seq), 65_536):
            v = vectors[seq[at:at + 65_536]]
            out[i, :DIM] += v.sum(0)
            out[i, DIM:] += np.einsum("ij,ij->j", v, v)
        out[i] /= max(1, len(seq))
    return out


class Network:
    """Two layers, tanh between them; Adam on the weighted logistic loss."""

    def __init__(self, hidden: int = 32, epochs: int = 40, batch: int = 128, rate: float = 3e-3, decay: float = 1e-4, seed: int = 3):
        self.hidden, self.epochs, self.batch, self.rate, self.decay, self.seed = hidden, epochs, batch, rate, decay, seed
        self.temperature = 1.0

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Network:
        rng = np.random.default_rng(self.seed)
        self.mean, self.std = x.mean(0), x.std(0) + 1e-6
        x = (x - self.mean) / self.std
        self.p = [rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], self.hidden)), np.zeros(self.hidden),
                  rng.normal(0, self.hidden**-0.5, self.hidden), np.zeros(1)]
        m, v, t = [np.zeros_like(q) for q in self.p], [np.zeros_like(q) for q in self.p], 0
        for _ in range(self.epochs):
            order = rng.permutation(len(x))
            for at in range(0, len(x), self.batch):
                i = order[at:at + self.batch]
                h = np.tanh(x[i] @ self.p[0] + self.p[1])
                d = weight[i] * (1 / (1 + np.exp(-(h @ self.p[2] + self.p[3]))) - y[i]) / weight[i].sum()
                back = np.outer(d, self.p[2]) * (1 - h * h)
                t += 1
                for k, g in enumerate((x[i].T @ back, back.sum(0), h.T @ d, d.sum(keepdims=True))):
                    g = g + self.decay * self.p[k]
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.p[k] -= self.rate * m[k] / (1 - 0.9**t) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
        return self

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.std @ self.p[0] + self.p[1]) @ self.p[2] + self.p[3]

    def calibrate(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Network:
        """The temperature with the least weighted log loss."""
        z = self.logit(x)
        loss = lambda t: (weight * np.logaddexp(0, np.where(y > 0, -z, z) / t)).sum()
        self.temperature = min(np.geomspace(0.25, 16, 200), key=loss)
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -50, 50)))


class QualityModel:
    def __init__(self, vectors: np.ndarray, prior: float):
        self.vectors, self.prior, self.net = vectors, prior, None

    def score(self, docs: list[str | None], tokens: Tokens) -> np.ndarray:
        if self.net is None:
            return np.full(len(docs), self.prior)
        return self.net.predict(pool(docs, tokens, self.vectors))


def train(docs: DataFrame, labels: DataFrame, usable, per_class: int = 10_000) -> QualityModel:
    """Word vectors from all of ``docs``; the network from at most ``per_class`` usable labelled rows of each class."""
    vectors = word_vectors(docs)
    sample, weights = labelled_sample(docs, labels, "quality", usable, per_class)
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        tokens = Tokens()
        for batch in batches:
            for at, some in texts(batch):
                yield {"y": batch.column("y").slice(at, len(some)), "fold": batch.column("fold").slice(at, len(some)),
                       "x": list(pool(some, tokens, shared.value))}

    rows = map_batches(sample, run, "y int, fold long, x array<float>").toPandas()  # at most 2 * per_class rows
    y, fold = rows.y.to_numpy(float), rows.fold.to_numpy()
    w = np.where(y > 0, weights.get(1, 1.0), weights.get(0, 1.0))
    model = QualityModel(vectors, float(np.average(y, weights=w)) if len(y) else 0.0)
    if all(len(set(y[m])) == 2 for m in (fold < 8, fold >= 8)):
        x = np.array(rows.x.tolist(), np.float64)
        model.net = Network().fit(x[fold < 8], y[fold < 8], w[fold < 8]).calibrate(x[fold >= 8], y[fold >= 8], w[fold >= 8])
    return model


def score(docs: DataFrame, model: QualityModel, keep: list[str], text_col: str = "text", name: str = "score") -> DataFrame:
    """The ``keep`` columns and the probability of label 1 for each whole text."""
    types = {f.name: f.dataType.simpleString() for f in docs.schema}
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 4 MB of vectors and a small network

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        tokens = Tokens()
        for batch in batches:
            for at, some in texts(batch, text_col):
                yield {**{c: batch.column(c).slice(at, len(some)) for c in keep}, name: shared.value.score(some, tokens)}

    return map_batches(docs.select(*dict.fromkeys([text_col, *keep])), run,
                       "".join(f"`{c}` {types[c]}, " for c in keep) + f"`{name}` double")
