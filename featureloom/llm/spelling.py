"""Spelling variants of the words of a corpus, found with a variable-length gram index.

Words near each other (one code point inserted, deleted or replaced) are found
by list merging over grams of variable length:

1. **Gram dictionary, pruned by frequency.** ``$`` ends every word. Grams of
   ``SHORTEST`` letters up are counted over all words; a gram is extended by a
   letter only while it occurs more than ``list_size`` times, so the dictionary
   holds short rare grams and long ones where short ones are frequent.
2. **Decomposition.** From every place of a word, the shortest dictionary gram
   that is not extended any further. Whether a gram is taken depends on its own
   letters alone, so an edit affects exactly the grams that cover its place.
3. **Affected-gram bound.** The most grams of a set that one edit can affect: the
   largest number of them that cover one place. A near word has all but so many.
4. **List merging.** A word's grams are ordered by occurrences, the same way for
   all words. Its first grams of which no one place is covered by all, so that the
   bound lies below their number, always hold the rarest gram that an edit leaves;
   the same holds for the near word. So only these few rarest lists are merged, and
   two words meet in one of them, at the same place or, in a word of one letter
   more, the next. Lists are kept by class, the length of the shorter word of a
   pair: a word of L letters stands in the classes L and L - 1, and its grams of
   class c have at most half of c letters, so there always are two grams without a
   common place.
5. **Verification** of each pair met, by its edit distance.

Word ids ascend in code-point order; counts, candidates, near words and roots are
DataFrame operations on ids.

Rules: a null text has no runs, a null document id is written as nothing in front
of the colon. Repeated rows count again. An empty table gives no rows. Other
columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, is_empty, map_batches, materialize, texts

SHORTEST, LONGEST, STEP, LIST_SIZE = 3, 16, 3, 64
TYPO_EVERY, HELD = 97, 200_000
END = "$"


def runs_of(text: str, least: int = 1) -> list[str]:
    """Maximal runs of letters (A-Z, a-z, U+00C0 to U+00FF) of at least ``least``, A-Z lower-cased."""
    return re.findall("[a-zÀ-ÿ]{%d,}" % least, text.encode().translate(LOWER).decode())


def dropped_letter(run: str, doc_crc: int, every: int = TYPO_EVERY) -> str:
    """The run, without one code point where ``every`` divides crc32 of ``<doc_id>:<run>`` (``doc_crc`` covers up to the colon)."""
    h = zlib.crc32(run.encode(), doc_crc)
    if h % every:
        return run
    k = h % len(run)
    return run[:k] + run[k + 1:]


def count_words(docs: DataFrame, least_length: int = 5, least_count: int = 3, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """(wid, word, len, n) of the words of all texts, written; wid ascends in code-point order."""
    src = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held: Counter[str] = Counter()
        for batch in batches:
            for at, some in texts(batch):
                for doc, text in zip(batch.column("id").slice(at, len(some)).to_pylist(), some):
                    if text:
                        crc = zlib.crc32(f"{doc or ''}:".encode())
                        for word, n in Counter(runs_of(text, least_length)).items():
                            held[dropped_letter(word, crc)] += n
                if len(held) >= HELD:
                    yield {"word": list(held), "n": list(held.values())}
                    held.clear()
        yield {"word": list(held), "n": list(held.values())}

    words = map_batches(src, run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")) \
        .where((F.col("n") >= least_count) & (F.char_length("word") >= least_length))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialize(words.repartitionByRange(parts, "word").sortWithinPartitions("word")
                       .select(F.monotonically_increasing_id().alias("wid"), "word", F.char_length("word").alias("len"), "n"), "words")


def _most(cls: int, longest: int) -> int:
    return min((cls + 1) // 2, longest)


def _grams(lo: int, longest: int):
    """Grams of ``lo`` to ``lo + STEP - 1`` letters from the open places of each word (all at first)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        out: dict[str, list] = {c: [] for c in ("wid", "p", "q", "gram")}
        for batch in batches:
            open_places = batch.column("places").to_pylist() if "places" in batch.schema.names else None
            for row, (wid, word) in enumerate(zip(batch.column("wid").to_pylist(), batch.column("word").to_pylist())):
                ended, length = word + END, len(word)
                most = min(_most(length, longest), lo + STEP - 1)
                for p in range(length) if open_places is None else open_places[row]:
                    room = length + 1 - p
                    for q in range(min(lo, room, most) if lo == SHORTEST else lo, min(most, room) + 1):
                        out["p"].append(p)
                        out["q"].append(q)
                        out["gram"].append(ended[p:p + q])
                out["wid"] += [wid] * (len(out["p"]) - len(out["wid"]))
                if len(out["wid"]) >= 65_536:
                    yield out
                    out = {c: [] for c in out}
        yield out
    return run


def frequent_grams(words: DataFrame, list_size: int = LIST_SIZE, longest: int = LONGEST) -> DataFrame:
    """(wid, p, q, f): the places of all dictionary grams that occur ``f`` > ``list_size`` times."""
    lo, todo, found = SHORTEST, words.select("wid", "word"), []
    while True:
        grams = map_batches(todo, _grams(lo, longest), "wid long, p int, q int, gram string")
        grams = materialize(grams, "grams")
        often = materialize(grams.groupBy("gram").agg(F.count("*").alias("f")).where(F.col("f") > list_size), "often")
        hits = materialize(grams.join(often, "gram").select("wid", "p", "q", "f"), "frequent")
        found.append(hits)
        lo += STEP
        still = hits.where(F.col("q") == lo - 1)
        if lo > longest or not still.take(1):
            break
        todo = words.join(still.groupBy("wid").agg(F.collect_list("p").alias("places")), "wid").select("wid", "word", "places")
    out = found[0]
    for more in found[1:]:
        out = out.unionAll(more)
    return out


def decompose(word: str, frequent: dict[int, int], cls: int, longest: int = LONGEST) -> list[tuple[int, str, int]]:
    """(occurrences or 0, gram, place) from every place of a word, extended while frequent; at most half of ``cls`` letters."""
    ended, most = word + END, _most(cls, longest)
    out = []
    for p in range(len(word)):
        room = len(ended) - p
        q = min(SHORTEST, room, most)
        while (f := frequent.get(p << 5 | q, 0)) and q < room and q < most:
            q += 1
        out.append((f, ended[p:p + q], p))
    return out


def affected(grams: list[tuple[int, str, int]]) -> int:
    """The most of some grams that one edit can change."""
    return max(sum(p <= at < p + len(g) for _, g, p in grams) for _, _, at in grams)


def merged_lists(grams: list[tuple[int, str, int]]) -> list[tuple[int, str, int]]:
    """The rarest grams, as many as it takes until no edit can change them all (``affected`` lies below their number)."""
    last_start, first_end = -1, len(grams) + 2
    ordered = sorted(grams)
    for k, (_, gram, p) in enumerate(ordered):
        last_start, first_end = max(last_start, p), min(first_end, p + len(gram))
        if last_start >= first_end:
            return ordered[:k + 1]
    raise ValueError("words need two letters")


def _lists(least_length: int, longest: int):
    """The lists that a word takes part in, of its two classes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("cls", "gram", "p", "wid", "len", "n", "word")}
            columns = [batch.column(c).to_pylist() for c in ("wid", "word", "len", "n", "hits")]
            for wid, word, length, n, hits in zip(*columns):
                frequent = {x & 0xFFFFFFFF: x >> 32 for x in hits or ()}
                for cls in range(max(length - 1, least_length), length + 1):
                    some = merged_lists(decompose(word, frequent, cls, longest))
                    out["gram"] += [g for _, g, _ in some]
                    out["p"] += [p for _, _, p in some]
                    out["cls"] += [cls] * len(some)
                for name, value in (("wid", wid), ("len", length), ("n", n), ("word", word)):
                    out[name] += [value] * (len(out["p"]) - len(out[name]))
                if len(out["wid"]) >= 65_536:
                    yield out
                    out = {c: [] for c in out}
            yield out
    return run


def near_pairs(words: DataFrame, least_length: int = 5, list_size: int = LIST_SIZE, longest: int = LONGEST) -> DataFrame:
    """(a, a_n, b, b_n): the ids of all pairs of near words, once each, written. ``words`` as of :func:`count_words`."""
    place = F.col("f") * F.lit(1 << 32) + F.col("p") * 32 + F.col("q")
    hits = frequent_grams(words, list_size, longest).groupBy("wid").agg(F.collect_list(place).alias("hits"))
    known = words.join(hits, "wid", "left").select("wid", "word", "len", "n", "hits")
    lists = materialize(map_batches(known, _lists(least_length, longest),
                                    "cls int, gram string, p int, wid long, len int, n long, word string"), "lists")
    shift = F.explode(F.array(F.lit(0), F.lit(1)))
    a = lists.where(F.col("len") == F.col("cls")).withColumn("shift", shift).withColumn("p", F.col("p") + F.col("shift")).alias("a")
    b = lists.alias("b")
    same = (F.col("a.shift") == 0) & (F.col("b.len") == F.col("a.len")) & (F.col("a.wid") < F.col("b.wid"))
    longer = F.col("b.len") > F.col("a.len")
    met = a.join(b, (F.col("a.cls") == F.col("b.cls")) & (F.col("a.gram") == F.col("b.gram")) & (F.col("a.p") == F.col("b.p"))
                 & (same | longer) & (F.levenshtein(F.col("a.word"), F.col("b.word"), 1) == 1))
    return materialize(met.select(F.col("a.wid").alias("a"), F.col("a.n").alias("a_n"), F.col("b.wid").alias("b"),
                                  F.col("b.n").alias("b_n")).distinct(), "near")


def variant_forms(words: DataFrame, pairs: DataFrame, times: int = 2) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word.

    The form is the near word of largest n (ties: smallest), if that is at least
    ``times`` the word's own n; the root follows forms to the last one.
    """
    both = pairs.select(F.col("a").alias("wid"), F.col("a_n").alias("n"), F.col("b").alias("to"), F.col("b_n").alias("to_n")) \
        .unionAll(pairs.select(F.col("b").alias("wid"), F.col("b_n").alias("n"), F.col("a").alias("to"), F.col("a_n").alias("to_n")))
    best = F.max(F.when(F.col("to_n") >= times * F.col("n"), F.struct(F.col("to_n"), -F.col("to"))))
    near = materialize(both.groupBy("wid").agg(F.count("*").alias("n_near"), best.alias("best"))
                       .select("wid", "n_near", F.col("best.to_n").alias("form_n"), (-F.col("best.col2")).alias("form")), "forms")
    step = near.where(F.col("form").isNotNull()).select("wid", F.col("form").alias("root"))
    roots = step
    while True:  # pointer jumping: a path halves each time
        a, b = roots.alias("a"), roots.alias("b")
        jumped = materialize(a.join(b, F.col("a.root") == F.col("b.wid"), "left").select(
            "a.wid", F.coalesce("b.root", "a.root").alias("root"), F.col("b.root").isNotNull().alias("moved")), "roots")
        roots = jumped.select("wid", "root")
        if is_empty(jumped.where("moved")):
            break
    name = words.select("wid", "word")
    named = near.join(roots, "wid", "left") \
        .join(name.select(F.col("wid").alias("form"), F.col("word").alias("form_word")), "form", "left") \
        .join(name.select(F.col("wid").alias("root"), F.col("word").alias("root_word")), "root", "left") \
        .select("wid", "n_near", "form_n", "form_word", "root_word")
    return words.join(named, "wid", "left").select(
        "word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")


def spelling_variants(docs: DataFrame, least_length: int = 5, least_count: int = 3, times: int = 2,
                      list_size: int = LIST_SIZE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Words of ``docs`` with their forms and roots (see :func:`variant_forms`)."""
    words = count_words(docs, least_length, least_count, id_col, text_col)
    return variant_forms(words, near_pairs(words, least_length, list_size), times)
