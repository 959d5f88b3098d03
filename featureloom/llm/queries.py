"""The registered queries of this subpackage: name -> (spark, sf_dir) -> DataFrame.

Each applies its operator with production parameters to its whole table and
derives the digest columns of its contract. ``ORACLE_SQL`` has DuckDB SQL
where SQL can express a query.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (decontaminate, langid, licenses, merkle, quality, secrets_scan, sentencepieces, spelling, token_counts, token_files,
               topk, toxicity)
from .common import crc_bucket, table
from .neardup import near_duplicates


def piece_model() -> str:
    """The SentencePiece model file of the installed public tokenizers."""
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def word_bpe() -> str:
    """The tokenizers file of the installed public tokenizers."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def byte_bpe() -> str:
    """The byte-level tokenizers file of the installed public tokenizers."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepieces.encode(table(spark, sf_dir, "documents"), piece_model(), keep_ids=False).drop("ids")


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=80)


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets_scan.find_secrets(table(spark, sf_dir, "documents"), keep=["doc_id"])
    base = F.col(secrets_scan.BASE)
    count = lambda kind: F.size(F.filter(base, lambda x: x.k == kind)).cast("long")
    return found.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
                        count("hex").alias("n_hex"), F.sha2(secrets_scan.span_text(base), 256).alias("base_sha256"),
                        secrets_scan.span_text(F.col(secrets_scan.SPANS)).alias("spans"))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                             table(spark, sf_dir, "benchmark"))
    hit = F.aggregate(decontaminate.SPANS, F.lit(0).cast("long"), lambda a, x: a + x.e - x.s)
    items = F.col(decontaminate.ITEMS)
    return found.select("doc_id", F.col(decontaminate.N_WORDS).alias("n_words"), hit.alias("n_hit"),
                        F.size(items).cast("long").alias("n_items"),
                        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = langid.train_text(table(spark, sf_dir, "documents"))
    pages = table(spark, sf_dir, "pages")
    if model is None:
        return pages.limit(0).selectExpr("page_id", "'' as lang", "0d as confidence", "'' as text_lang", "'' as declared",
                                         "'' as suffix", "'' as host")
    return langid.identify(pages, model)


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), crc_bucket("doc_id", 3) == 1
    model = quality.train(docs, table(spark, sf_dir, "labels"), ~held_out)
    return quality.score(docs, model, ["doc_id"]).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_digest(spark, table(spark, sf_dir, "documents"), word_bpe(), end_id=1)


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_digest(licenses.find_licenses(table(spark, sf_dir, "documents"), ["doc_id"]))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), crc_bucket("doc_id", 4) == 2
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), ~held_out)
    return toxicity.score(docs, model, ["doc_id"]).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.when(crc_bucket("doc_id", 3) == 0, merkle.leaf_digest(*map(F.col, fields[:-1]), lowered))
    found = merkle.manifest(table(spark, sf_dir, "documents"), fields, "lang", "doc_id", others={"tampered": tampered})
    folded = merkle.fold(F.coalesce("tampered", "leaf"), F.col("proof"))
    return found.select("doc_id", "leaf", "subroot", "root", F.sha2(merkle.proof_text(F.col("proof")), 256).alias("proof_sha256"),
                        folded.alias("folded_root"), (folded == F.col("root")).alias("verified"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.count_tokens(table(spark, sf_dir, "documents"), byte_bpe())
    return counts.withColumn("over_limit", F.col("n_tokens") > 512)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_minhash_near_dedup": op2_minhash_near_dedup,
    "op3_secret_scan": op3_secret_scan,
    "op4_benchmark_decontamination": op4_benchmark_decontamination,
    "op5_language_id": op5_language_id,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_exact_top_k": op7_exact_top_k,
    "op8_token_files": op8_token_files,
    "op9_license_scan": op9_license_scan,
    "op10_toxicity": op10_toxicity,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_token_counts": op13_token_counts,
}

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["op4_benchmark_decontamination"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
p AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS phrase
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
o AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS phrase
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM p) WHERE len(w) >= n)),
m AS (SELECT o.doc_id, o.i, o.n, p.item_id FROM o JOIN p USING (n, phrase)),
hits AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM m) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS s
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items.s, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""

ORACLE_SQL["op7_exact_top_k"] = """
WITH v AS (
  SELECT row_number() OVER () AS own, vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.own, q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v AS q JOIN v AS c ON q.vec_id % 100 = 0 AND q.own <> c.own),
r AS (SELECT *, row_number() OVER (PARTITION BY own ORDER BY score DESC, vec_id) AS k FROM s)
SELECT query_id, CAST(k AS INTEGER) AS rank, vec_id, score FROM r WHERE k <= 10
"""


def _crc32_sql(text: str) -> str:
    """crc32 of a text's UTF-8 bytes, bit by bit; DuckDB has no such function."""
    code = f"hex({text})"
    steps = (f"flatten(list_transform(range(1, length({code}) + 1, 2), "
             f"lambda i: [CAST('0x' || substr({code}, i, 2) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))")
    return (f"xor(list_reduce({steps}, lambda c, x: xor(xor(c, x) >> 1, (xor(c, x) & 1) * 3988292384), 4294967295), 4294967295)")


ORACLE_SQL["op11_spelling_variants"] = f"""
WITH RECURSIVE r AS (
  SELECT doc_id, w, count(*) AS c FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS w
    FROM documents) GROUP BY doc_id, w),
h AS (SELECT w, c, {_crc32_sql("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w")} AS h FROM r),
words AS (
  SELECT word, CAST(sum(c) AS BIGINT) AS n FROM (
    SELECT c, CASE WHEN h % 97 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word FROM h)
  GROUP BY word HAVING sum(c) >= 3 AND length(word) >= 5),
gone AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS v FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
near AS (
  SELECT a.word, a.n, b.word AS o, b.n AS o_n FROM gone AS a JOIN gone AS b ON a.i = b.i AND a.v = b.v AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM gone AS a JOIN words AS b ON a.v = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM gone AS a JOIN words AS b ON a.v = b.word),
best AS (
  SELECT word, n, count(*) AS n_near, first(o ORDER BY o_n DESC, o) AS o, max(o_n) AS o_n FROM near GROUP BY word, n),
forms AS (SELECT word, o AS form, o_n AS form_n FROM best WHERE o_n >= 2 * n),
path AS (
  SELECT word, form AS dest FROM forms
  UNION ALL SELECT path.word, forms.form FROM path JOIN forms ON path.dest = forms.word)
SELECT words.word, form, coalesce(dest, words.word) AS root, words.n, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near, form_n
FROM words LEFT JOIN best USING (word) LEFT JOIN forms ON forms.word = words.word
LEFT JOIN (SELECT word, dest FROM path WHERE dest NOT IN (SELECT word FROM forms)) AS ends ON ends.word = words.word
"""


def _field_sql(column: str) -> str:
    return f"coalesce(strlen(CAST({column} AS VARCHAR)) || ':' || CAST({column} AS VARCHAR), '-')"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(map(_field_sql, ("doc_id", "source", "lang", "n_chars", text))) + ")"


def _tree_sql(name: str, leaves: str) -> str:
    return f"""{name} AS (
  {leaves}
  UNION ALL SELECT tree, level + 1, place // 8, (size + 7) // 8, sha256(string_agg(digest, '' ORDER BY place))
  FROM {name} WHERE size > 1 GROUP BY tree, level, size, place // 8)"""


def _steps_sql(name: str) -> str:
    run = "(PARTITION BY tree, level, place // 8 ORDER BY place ROWS BETWEEN"
    return f"""SELECT tree, level, place,
    coalesce(string_agg(digest, '') OVER {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS b,
    coalesce(string_agg(digest, '') OVER {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS a
  FROM {name} WHERE size > 1"""


ORACLE_SQL["op12_merkle_manifest"] = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce('=' || lang, '-') AS tree, {_leaf_sql('text')} AS leaf,
    CASE WHEN {_crc32_sql('CAST(doc_id AS VARCHAR)')} % 3 = 0
      THEN {_leaf_sql("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS tampered FROM documents),
p AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY tree) AS size FROM d),
{_tree_sql('low', 'SELECT tree, 0 AS level, place, size, leaf AS digest FROM p')},
sub AS (SELECT tree, level AS height, digest, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS size FROM low WHERE size = 1),
{_tree_sql('high', "SELECT '' AS tree, 0 AS level, place, size, digest FROM sub")},
top AS (SELECT digest AS root FROM high WHERE size = 1),
steps AS (
  SELECT p.tree, p.place, s.level AS k, b, a FROM p JOIN ({_steps_sql('low')}) AS s
    ON p.tree = s.tree AND p.place // CAST(pow(8, s.level) AS BIGINT) = s.place
  UNION ALL SELECT p.tree, p.place, sub.height + s.level, b, a FROM p JOIN sub ON p.tree = sub.tree
    JOIN ({_steps_sql('high')}) AS s ON sub.place // CAST(pow(8, s.level) AS BIGINT) = s.place),
fold AS (
  SELECT tree, place, 0 AS k, coalesce(tampered, leaf) AS digest FROM p
  UNION ALL SELECT fold.tree, fold.place, fold.k + 1, sha256(b || digest || a) FROM fold JOIN steps USING (tree, place, k)),
proofs AS (SELECT tree, place, string_agg(b || a, '' ORDER BY k) AS proof, count(*) AS height FROM steps GROUP BY tree, place)
SELECT p.doc_id, p.leaf, sub.digest AS subroot, top.root, sha256(coalesce(proof, '')) AS proof_sha256,
       fold.digest AS folded_root, fold.digest = top.root AS verified
FROM p JOIN sub ON p.tree = sub.tree CROSS JOIN top LEFT JOIN proofs ON p.tree = proofs.tree AND p.place = proofs.place
JOIN fold ON fold.tree = p.tree AND fold.place = p.place AND fold.k = coalesce(proofs.height, 0)
"""
