"""Training-corpus pipeline over ``documents``: five stages, each on all its predecessor kept.

1. toxicity: documents that ``op10_toxicity`` would call toxic go,
2. near_duplicates: one document of each group of near copies stays,
3. decontamination: spans of benchmark phrases are cut out of the texts,
4. secrets: found secrets are replaced by a mark,
5. sentencepiece: the texts become ids.

Every stage but the last returns the columns of ``documents``. The models are
trained on the documents a stage is given and ``labels``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featureloom.llm import decontaminate, secrets_scan, sentencepieces, toxicity
from featureloom.llm.common import is_empty, materialize, set_apart
from featureloom.llm.neardup import near_duplicates
from featureloom.llm.queries import piece_model


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.drop_toxic(docs, toxicity.train(docs, labels, F.lit(True)), toxicity.THRESHOLD)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, similarity 0.8; of each group the row of the smallest id and text hash stays, null ids last.

    Of word-free rows, which are in no group, one of equal rows that repeat an id stays.
    """
    docs, named = set_apart(docs, ("__id", "__hash", "c", "n", "row"))
    found = materialize(near_duplicates(docs, width=5, percent=80, text_hash="__hash").withColumnRenamed("doc_id", "__id"), "groups")
    gone = found.where("not kept").select("__id", "__hash").distinct()
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__hash"))
    kept = docs.join(gone, same, "left_anti")
    repeated = materialize(found.where("kept and (n_shingles > 0 or __id is not null)").groupBy("__id", "__hash")
                           .agg(F.count("*").alias("c"), F.max("n_shingles").alias("n")).where("c > 1"), "repeated")
    if is_empty(repeated):
        return named(kept)
    once = kept.join(repeated, same).groupBy("__id", "__hash", F.when(F.col("n") == 0, F.xxhash64(*docs.columns))) \
        .agg(F.min(F.struct(*docs.columns)).alias("row")).select("row.*")
    return named(kept.join(repeated, same, "left_anti").unionByName(once))


def cut_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets_scan.redact_secrets(docs)


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sentencepieces.encode(docs, piece_model())


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", cut_benchmarks),
    ("secrets", redact_secrets),
    ("sentencepiece", to_pieces),
]

#: SQL cannot express the trained, hashed and learned stages; tests hold ``run`` against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each one's rows written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialize(docs, name)
    return docs
