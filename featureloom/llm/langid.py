"""Language identification of web pages by Bayesian evidence fusion.

1. Text: naive Bayes over hashed byte trigrams of the visible text, learned
   from a bounded sample of labelled documents of each language; log
   likelihoods are tempered (trigrams overlap).
2. Markup: the language the page declares (``lang`` or ``xml:lang`` of the html tag, or a content-language header tag).
3. Address: the last label of the host name.
4. Host prior: shares of languages by host, smoothed towards the registered domain's
   shares, which are smoothed towards the corpus' shares. A page's own text
   does not count towards its own prior.

How well markup and suffix tell the language, and all priors, are expected
counts of the text posteriors, summed by grouped aggregation (partial sums
first, so a hot host is one small row a task) and joined back to the pages.

Rules: a null or empty page has no text evidence and the rest decides; a null
or unreadable address has the empty host, domain and suffix; a page declaring nothing has
the declared value ''. Repeated pages each count. Ties go to the
alphabetically first language. Without any labelled document there is no
language and no row. Extra columns are not read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, materialize, texts

BUCKETS = 1 << 14
HIDDEN = re.compile(r"<(script|style|noscript|template)\b.*?</\1\s*>|<!--.*?-->", re.S | re.I)
TAG = re.compile(r"<[^>]*>")
DECLARED = (re.compile(r"<html\b[^>]*?\b(?:xml:)?lang\s*=\s*[\"']?([A-Za-z]{2,3})\b", re.I),
            re.compile(r"<meta\b[^>]*?content-language[^>]*?content\s*=\s*[\"']?([A-Za-z]{2,3})\b", re.I))
HOST = re.compile(r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)")


def visible(page: str | None) -> str:
    return html.unescape(TAG.sub(" ", HIDDEN.sub(" ", page or "")))


def declared(page: str | None) -> str:
    return next((m[1].lower() for m in (p.search(page or "") for p in DECLARED) if m), "")


def host_of(url: str | None) -> str:
    m = HOST.match(url or "")
    return m[1].lower().rstrip(".") if m else ""


def trigrams(text: str) -> np.ndarray:
    """Counts of the hashed byte trigrams of the lower-cased words."""
    b = np.frombuffer((" " + " ".join(text.lower().split()) + " ").encode(), np.uint8).astype(np.int64)
    return np.bincount((b[:-2] * 961 + b[1:-1] * 31 + b[2:]) * 40503 % 65521 % BUCKETS, minlength=BUCKETS)


class TextModel:
    """Log probabilities (trigram bucket, language)."""

    def __init__(self, counts: dict[str, np.ndarray], temper: float):
        self.langs, self.temper = sorted(counts), temper
        table = np.array([counts[x] for x in self.langs], np.float64) + 0.5
        self.log = np.log(table / table.sum(1, keepdims=True)).T

    def posterior(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Tempered log likelihoods (largest 0) and the posterior under equal priors."""
        n = trigrams(text) if text.strip() else np.zeros(BUCKETS)
        ll = (n @ self.log) * self.temper
        ll -= ll.max()
        p = np.exp(ll)
        return ll, p / p.sum()


def train_text(docs: DataFrame, per_lang: int = 2000, lang_col: str = "lang", id_col: str = "doc_id",
               text_col: str = "text", temper: float = 0.02) -> TextModel | None:
    """From at most ``per_lang`` documents of each language, taken in the order of a hash of the id."""
    known = docs.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(id_col).alias("id"))
    rate = known.groupBy("lang").agg(F.count("*").alias("n")).select("lang", F.least(F.lit(1.0), per_lang / F.col("n")).alias("rate"))
    rates = {r.lang: r.rate for r in rate.collect()}  # one row a language
    if not rates:
        return None
    limit = F.create_map(*[F.lit(x) for kv in sorted(rates.items()) for x in kv])
    sample = docs.where(F.pmod(F.xxhash64(id_col), F.lit(1_000_000)) < limit[F.col(lang_col)] * 1_000_000) \
        .select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for at, some in texts(batch):
                for lang, text in zip(langs[at:], some):
                    if text and text.strip():
                        n = trigrams(text)
                        total[lang] = total[lang] + n if lang in total else n
        yield {"lang": list(total), "counts": [v.tobytes() for v in total.values()]}

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, raw in zip(batch.column("lang").to_pylist(), batch.column("counts").to_pylist()):
                n = np.frombuffer(raw, np.int64)
                total[lang] = total[lang] + n if lang in total else n
        yield {"lang": list(total), "counts": [v.tobytes() for v in total.values()]}

    counts = {lang: np.zeros(BUCKETS, np.int64) for lang in rates}
    parts = map_batches(sample, run, "lang string, counts binary").repartition("lang")
    for r in map_batches(parts, add, "lang string, counts binary").collect():  # one row a language
        counts[r["lang"]] = counts[r["lang"]] + np.frombuffer(r["counts"], np.int64)
    return TextModel(counts, temper)


def identify(pages: DataFrame, model: TextModel, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
             smooth_host: float = 4.0, smooth_domain: float = 8.0, smooth_value: float = 10.0) -> DataFrame:
    """Per page: id, lang, confidence, text_lang, declared, suffix, host."""
    langs = model.langs
    shared = pages.sparkSession.sparkContext.broadcast(model)  # trigram buckets x languages
    k = len(langs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            urls = batch.column("url").to_pylist()
            for at, some in texts(batch, "html", 64):
                got = [shared.value.posterior(visible(p)) for p in some]
                hosts = [host_of(u) for u in urls[at:at + len(some)]]
                yield {"id": batch.column("id").slice(at, len(some)), "host": hosts,
                       "domain": [".".join(h.split(".")[-2:]) for h in hosts], "suffix": [h.rsplit(".", 1)[-1] for h in hosts],
                       "declared": [declared(p) for p in some], "ll": [g[0] for g in got], "p": [g[1] for g in got]}

    src = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    kind = dict(src.dtypes)["id"]
    seen = materialize(map_batches(src, run, f"id {kind}, host string, domain string, suffix string, declared string, "
                                   "ll array<double>, p array<double>"), "evidence")
    sums = [F.sum(F.col("p")[i]).alias(f"s{i}") for i in range(k)]
    pack = F.array(*[f"s{i}" for i in range(k)])

    def by(col: str, name: str) -> DataFrame:
        return seen.groupBy(col).agg(*sums).select(col, pack.alias(name))

    overall = seen.agg(*sums).first()
    total = [float(overall[i] or 0.0) + 1.0 for i in range(k)]
    share = F.array(*[F.lit(t / sum(total)) for t in total])
    out = seen
    for col, name in (("host", "h"), ("domain", "d"), ("suffix", "x"), ("declared", "m")):
        out = out.join(by(col, name), col)
    # leave-one-out, hierarchically smoothed host prior
    less = lambda a: F.zip_with(a, "p", lambda n, p: F.greatest(n - p, F.lit(0.0)))
    add = lambda a: F.aggregate(a, F.lit(0.0), lambda t, n: t + n)
    out = out.withColumns({"h": less("h"), "d": less("d"), "x": less("x"), "m": less("m"), "share": share})
    out = out.withColumn("domain_prior", F.zip_with("d", "share", lambda n, q: n + smooth_domain * q))
    out = out.withColumn("domain_prior", F.transform("domain_prior", lambda v: v / (add("d") + smooth_domain)))
    out = out.withColumn("prior", F.zip_with("h", "domain_prior", lambda n, q: n + smooth_host * q))
    out = out.withColumn("prior", F.transform("prior", lambda v: v / (add("h") + smooth_host)))
    # P(value | language): the value's expected count among the language's, smoothed by the value's overall share
    n_all = float(sum(total))
    totals = F.array(*map(F.lit, total))
    for col in ("x", "m"):
        rate = smooth_value * F.col(f"{col}_rate") + 1e-9
        out = out.withColumn(f"{col}_rate", add(col) / n_all)
        out = out.withColumn(f"{col}_like", F.zip_with(col, totals, lambda n, t: (n + rate) / (t + smooth_value)))  # noqa: B023
    score = F.zip_with(F.zip_with("ll", F.transform("prior", F.ln), lambda a, b: a + b),
                       F.zip_with(F.transform("x_like", F.ln), F.transform("m_like", F.ln), lambda a, b: a + b),
                       lambda a, b: a + b)
    names = F.array(*map(F.lit, langs))
    out = out.withColumn("score", score).withColumn("top", F.array_max("score"))
    best = F.array_position("score", F.col("top")).cast("int")
    text_best = F.array_position("ll", F.array_max("ll")).cast("int")
    weight = F.aggregate("score", F.lit(0.0), lambda t, v: t + F.exp(v - F.col("top")))
    return out.select(F.col("id").alias(id_col), F.element_at(names, best).alias("lang"), (1 / weight).alias("confidence"),
                      F.element_at(names, text_best).alias("text_lang"), "declared", "suffix", "host")
