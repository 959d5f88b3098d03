"""Toxicity: gradient-boosted trees over dense text features, isotonic calibration.

1. A lexicon is learned from labelled texts: whole words and word beginnings of
   4 to 8 letters whose document rate in toxic texts is significantly above
   that in others (log odds over their standard error) and at least 2 %.
2. Every text becomes ``FEATURES``: lexicon densities, closeness of lexicon
   words to a second-person word, capitals, punctuation, obfuscation (letters
   written as digits or symbols, stretched letters) and length.
3. Depth-limited trees on histogram bins are boosted on the logistic loss.
4. Pool-adjacent-violators regression on rows that the trees have not seen
   maps their output to a probability.

Lexicon, trees and calibration use separate folds of one bounded sample
(``per_class`` rows of each class). Scoring is one pass over whole texts
without a shuffle.

Rules: a null text counts as empty; an empty text is scored from its features
like any other; without labels of both classes every score is the share of
toxic labels (0 without any label). Repeated rows are scored one by one, a
null id is no obstacle; extra columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, texts
from .labelled import labelled_sample

#: A document is toxic from this probability on, in ``op10_toxicity`` and in the pipeline.
THRESHOLD = 0.3
#: Second-person words of English, German, French and Spanish.
SECOND_PERSON = frozenset(("you your yours yourself u ur du dich dir dein deine euch euer ihr tu toi te ton ta tes "
                           "vous votre vos ti tus usted ustedes vosotros").split())
#: Characters written for letters.
LEET = str.maketrans("01345$@!7*", "oleassaiti")
FEATURES = ("lexicon_density", "lexicon_weight", "lexicon_hits", "lexicon_distinct", "near_you", "you_rate",
            "capitals", "exclaim", "punctuation", "obfuscated", "stretched", "digits", "log_words", "strongest")
EDGE = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "“”„«»¿¡…"
STRETCH = re.compile(r"(.)\1\1")


def normal(raw: bytes) -> str:
    return raw.decode().strip(EDGE).lower()


def keys_of(word: str) -> list[str]:
    """The lexicon keys a word may match: itself and its beginnings, marked with ``*``."""
    return [word, *(word[:n] + "*" for n in range(4, min(len(word), 8) + 1))]


class WordCodes(dict):
    """raw word -> row of (weight, second person, obfuscated, stretched, word number); bounded."""

    def __init__(self, lexicon: dict[str, float], limit: int = 300_000):
        super().__init__()
        self.lexicon, self.limit = lexicon, limit
        self.rows: dict[tuple, int] = {}

    def __missing__(self, raw: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        word, look = normal(raw), self.lexicon.get
        weight, plain = max((look(k, 0.0), k) for k in keys_of(word)), word.translate(LEET)
        hidden = False
        if plain != word and any(c.isalpha() for c in word):
            hidden = True
            weight = max(weight, max((look(k, 0.0), k) for k in keys_of(plain)))
        code = (round(weight[0], 3), word in SECOND_PERSON, hidden, bool(STRETCH.search(word)),
                weight[1] if weight[0] else "")
        value = self[raw] = self.rows.setdefault(code, len(self.rows))
        return value


def features(docs: list[str | None], codes: WordCodes) -> np.ndarray:
    out = np.zeros((len(docs), len(FEATURES)), np.float64)
    seen = [(d or "").encode() for d in docs]
    ids = [np.fromiter(map(codes.__getitem__, w), np.int64, len(w)) for w in map(bytes.split, seen)]
    names: dict[str, int] = {}
    rows = np.array([(w, y, o, s, names.setdefault(k, len(names))) for w, y, o, s, k in codes.rows] or [(0,) * 5], np.float64)
    for i, (raw, code) in enumerate(zip(seen, ids)):
        n, size = max(1, len(code)), max(1, len(raw))
        byte = np.bincount(np.frombuffer(raw, np.uint8), minlength=128)
        letters = max(1, byte[65:91].sum() + byte[97:123].sum())
        w = rows[code]
        hit, you = w[:, 0] > 0, w[:, 1] > 0
        at = np.flatnonzero(hit)
        near = 0
        if len(at) and you.any():
            yous = np.concatenate([[-100], np.flatnonzero(you), [len(code) + 100]])
            k = np.searchsorted(yous, at)
            near = (np.minimum(at - yous[k - 1], yous[k] - at) <= 5).sum()
        out[i] = (len(at) / n, w[:, 0].sum() / n, np.log1p(len(at)), len(np.unique(w[at, 4])), np.log1p(near),
                  you.sum() / n, byte[65:91].sum() / letters, byte[33] / n,
                  (byte[33:48].sum() + byte[58:65].sum() + byte[91:97].sum() + byte[123:127].sum()) / size,
                  w[:, 2].sum() / n, w[:, 3].sum() / n, byte[48:58].sum() / size, np.log1p(len(code)),
                  w[at, 0].max() if len(at) else 0)
    return out


class BoostedTrees:
    """Logistic gradient boosting on quantile bins; complete trees of a fixed depth."""

    def __init__(self, trees: int = 80, depth: int = 3, rate: float = 0.15, bins: int = 32, least: float = 10.0):
        self.trees, self.depth, self.rate, self.bins, self.least = trees, depth, rate, bins, least

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> BoostedTrees:
        self.cuts = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        b = self.bin(x)
        p = np.average(y, weights=weight)
        self.base, self.nodes = float(np.log(p / (1 - p))), []
        margin = np.full(len(y), self.base)
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-margin))
            g, h = weight * (y - p), weight * p * (1 - p)
            node, tree = np.zeros(len(y), np.int64), []
            for level in range(self.depth):
                splits = [self.split(b, g, h, node == k) for k in range(2 ** level)]
                tree.append(splits)
                f, c = (np.array(v)[node] for v in zip(*splits))
                node = 2 * node + (b[np.arange(len(b)), f] > c)
            leaves = 2 ** self.depth
            gain, mass = np.bincount(node, g, leaves), np.bincount(node, h, leaves)
            value = self.rate * gain / (mass + 1.0)
            margin += value[node]
            self.nodes.append((tree, value))
        return self

    def split(self, b, g, h, mask) -> tuple[int, int]:
        best = (0.0, 0, self.bins)
        g, h, b = g[mask], h[mask], b[mask]
        total, mass = g.sum(), h.sum()
        for f in range(b.shape[1]):
            left = np.cumsum(np.bincount(b[:, f], g, self.bins + 1))[:-1]
            below = np.cumsum(np.bincount(b[:, f], h, self.bins + 1))[:-1]
            ok = (below >= self.least / 10) & (mass - below >= self.least / 10)
            gain = np.where(ok, left**2 / (below + 1) + (total - left) ** 2 / (mass - below + 1) - total**2 / (mass + 1), 0)
            k = int(gain.argmax())
            best = max(best, (float(gain[k]), f, k))
        return best[1:]

    def bin(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, v, side="left") for c, v in zip(self.cuts, x.T)], 1)

    def margin(self, x: np.ndarray) -> np.ndarray:
        b, out = self.bin(x), np.full(len(x), self.base)
        for tree, value in self.nodes:
            node = np.zeros(len(x), np.int64)
            for splits in tree:
                f, c = (np.array(v)[node] for v in zip(*splits))
                node = 2 * node + (b[np.arange(len(b)), f] > c)
            out += value[node]
        return out


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: centre and mean of each block, both rising."""
    order = np.argsort(x, kind="stable")
    blocks: list[list[float]] = []  # weight, sum of y, sum of x
    for a, b, w in zip(x[order], y[order], weight[order]):
        blocks.append([w, w * b, w * a])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last)]
    return np.array([b[2] / b[0] for b in blocks]), np.array([b[1] / b[0] for b in blocks])


class ToxicityModel:
    def __init__(self, prior: float):
        self.prior, self.lexicon, self.trees, self.steps = prior, {}, None, None

    def score(self, docs: list[str | None], codes: WordCodes) -> np.ndarray:
        if self.trees is None:
            return np.full(len(docs), self.prior)
        return np.clip(np.interp(self.trees.margin(features(docs, codes)), *self.steps), 0.0, 1.0)


def _count_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        labels = batch.column("y").to_pylist()
        for at, some in texts(batch):
            for y, text in zip(labels[at:], some):
                words = {normal(w) for w in set((text or "").encode().split())} - {""}
                counts[y].update({k for w in words for k in keys_of(w)})
        keys = list(counts[0].keys() | counts[1].keys())
        yield {"key": keys, "pos": [counts[1][k] for k in keys], "neg": [counts[0][k] for k in keys]}


def learn_lexicon(sample: DataFrame, weights: dict[int, float], size: int, least_z: float = 3.2,
                  least_share: float = 0.02) -> dict[str, float]:
    sizes = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
    n1, n0 = sizes.get(1, 0) + 1.0, sizes.get(0, 0) + 1.0
    counts = map_batches(sample.select("y", "text"), _count_keys, "key string, pos long, neg long") \
        .groupBy("key").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).where(F.col("pos") >= max(3.0, least_share * n1))
    # one pseudo document, dealt to the classes by their sizes
    a, b = F.col("pos") + n1 / (n1 + n0), F.col("neg") + n0 / (n1 + n0)
    odds = F.log(a / n1) - F.log(b / n0)
    top = counts.select("key", odds.alias("w"), (odds / F.sqrt(1 / a + 1 / b)).alias("z")).where(F.col("z") >= least_z) \
        .orderBy(F.desc("z"), "key").limit(size)
    return {r["key"]: min(6.0, r["w"]) for r in top.collect()}


def train(docs: DataFrame, labels: DataFrame, usable, per_class: int = 10_000, lexicon_size: int = 1000) -> ToxicityModel:
    """Fit on at most ``per_class`` labelled rows of each class among those where ``usable`` holds."""
    sample, weights = labelled_sample(docs, labels, "toxic", usable, per_class)
    sample = sample.persist()
    n = {r["y"]: r["count"] * weights[r["y"]] for r in sample.groupBy("y").count().collect()}
    model = ToxicityModel(n.get(1, 0) / max(1, sum(n.values())))
    if len(n) == 2:
        model.lexicon = learn_lexicon(sample.where("fold < 5"), weights, lexicon_size)
        lexicon = sample.sparkSession.sparkContext.broadcast(model.lexicon)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
            codes = WordCodes(lexicon.value)
            for batch in batches:
                for at, some in texts(batch):
                    yield {"y": batch.column("y").slice(at, len(some)), "fold": batch.column("fold").slice(at, len(some)),
                           "x": list(features(some, codes))}

        rows = map_batches(sample.where("fold >= 5"), run, "y int, fold long, x array<double>").toPandas()
        x, y, fold = np.array(rows.x.tolist()).reshape(len(rows), -1), rows.y.to_numpy(float), rows.fold.to_numpy()
        w = np.where(y > 0, weights.get(1, 1.0), weights.get(0, 1.0))
        fit, rest = fold < 8, fold >= 8
        if all(len(set(y[m])) == 2 for m in (fit, rest)):
            model.trees = BoostedTrees().fit(x[fit], y[fit], w[fit])
            model.steps = isotonic(model.trees.margin(x[rest]), y[rest], w[rest])
    sample.unpersist()
    return model


def score(docs: DataFrame, model: ToxicityModel, keep: list[str], text_col: str = "text", name: str = "score") -> DataFrame:
    """The ``keep`` columns and the toxicity probability of each whole text."""
    types = {f.name: f.dataType.simpleString() for f in docs.schema}
    shared = docs.sparkSession.sparkContext.broadcast(model)  # lexicon and trees: bounded by their parameters

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        model = shared.value
        codes = WordCodes(model.lexicon)
        for batch in batches:
            for at, some in texts(batch, text_col):
                yield {**{c: batch.column(c).slice(at, len(some)) for c in keep}, name: model.score(some, codes)}

    return map_batches(docs.select(*dict.fromkeys([text_col, *keep])), run,
                       "".join(f"`{c}` {types[c]}, " for c in keep) + f"`{name}` double")


def drop_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose score reaches ``threshold``; columns stay.

    Only the text goes to the Python worker and only the score comes back; the
    other columns wait in the executor.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # lexicon and trees: bounded by their parameters

    @F.arrow_udf("double")
    def chance(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        codes = WordCodes(model.lexicon)
        for part in parts:
            scores = [np.asarray(model.score(part.slice(at, 256).to_pylist(), codes), np.float64) for at in range(0, len(part), 256)]
            yield pa.array(np.concatenate(scores) if scores else np.zeros(0))

    return docs.where(chance(F.col(text_col)) < threshold)
