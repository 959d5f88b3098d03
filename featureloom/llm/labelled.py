"""A bounded labelled sample for the classifiers of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, usable, per_class: int,
                    id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, dict[int, float]]:
    """(id, text, y, fold 0-9) of at most ``per_class`` labelled rows of each class, and class weights.

    Rows are taken in the order of a hash of the id, among ids where the
    column condition ``usable`` holds. A null id or label is no label; of
    repeated labels the largest counts; repeated documents are all taken. The
    weights undo the unequal rates. Only the chosen ids (2 * per_class rows)
    are broadcast; the texts are not shuffled.
    """
    known = labels.where(usable & F.col(id_col).isNotNull() & F.col(label).isin(0, 1)) \
        .groupBy(F.col(id_col).alias("id")).agg(F.max(label).cast("int").alias("y"))
    totals = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    chosen = None
    for y in sorted(totals):
        part = known.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(per_class)
        chosen = part if chosen is None else chosen.unionAll(part)
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    if chosen is None:
        return src.limit(0).select("id", "text", F.lit(0).alias("y"), F.lit(0).cast("bigint").alias("fold")), {}
    sample = src.join(F.broadcast(chosen), "id").select(
        "id", "text", "y", F.pmod(F.xxhash64(F.col("id"), F.lit("fold")), F.lit(10)).alias("fold"))
    return sample, {y: max(1.0, n / per_class) for y, n in totals.items()}
