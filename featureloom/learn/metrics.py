"""ROC AUC as a distributed DataFrame computation (survey L5).

AUC = P(score of a random positive > score of a random negative), ties
counted half:  sum_s pos(s) * (neg_below(s) + neg(s)/2) / (P * N).
Scores are first aggregated to (score, pos, neg); ``neg_below`` is a prefix
sum over the score order computed by range partitioning + partition offsets
(no single-partition window), optionally per group (e.g. per fold).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.aggregate import mean_by
from ..operators.assemble import semi_join
from ..operators.ranking import prefix_before, top_k


def roc_auc(df: DataFrame, score_col: str, label_col: str,
            group_cols: Sequence[str] = (), num_partitions: int | None = None) -> DataFrame:
    """One row per group: ``auc``, ``n_pos``, ``n_neg``. Labels 1 = positive,
    0 = negative; rows with a NULL score or label are ignored."""
    group_cols = list(group_cols)
    lab = F.col(label_col)
    s = (df.where(F.col(score_col).isNotNull() & lab.isNotNull())
         .groupBy(*group_cols, score_col)
         .agg(F.sum((lab == 1).cast("double")).alias("pos"),
              F.sum((lab == 0).cast("double")).alias("neg")))
    r = prefix_before(s, group_cols, [score_col], ["neg"], num_partitions)
    agg = [F.try_divide(F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / 2.0)),
                         F.sum("pos") * F.sum("neg")).alias("auc"),
           F.sum("pos").cast("long").alias("n_pos"),
           F.sum("neg").cast("long").alias("n_neg")]
    return r.groupBy(*group_cols).agg(*agg) if group_cols else r.agg(*agg)


def fold_mean(scores: Sequence[Column]) -> Column:
    """Mean of the fold models' scores of a row (L6): row-wise, no shuffle."""
    total = scores[0]
    for c in scores[1:]:
        total = total + c
    return total / float(len(scores))


def top_importance_rows(importances: DataFrame, k: int) -> DataFrame:
    """All fold rows (feature, importance, fold) of the ``k`` features with the
    largest mean importance, ties by name (L8)."""
    top = top_k(mean_by(importances, "feature", "importance"), k, "importance", tie_cols=["feature"]).select("feature")
    return semi_join(importances, top, "feature", max_broadcast_rows=k)


def best_round(losses: Sequence[float], patience: int) -> int:
    """Boosting rounds to keep (L3): the first round with the smallest loss before
    ``patience`` rounds in a row brought no better one."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1
