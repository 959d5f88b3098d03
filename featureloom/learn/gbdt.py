"""k-fold gradient-boosted classifier on a feature table (survey L2-L10, F8).

:func:`kfold_boost` trains all folds together by second-order histogram boosting
(:mod:`.boosting`): leaf-wise trees, a learned side for missing values, early
stopping on the held-out fold's AUC, split-count importances.

:func:`kfold_gbt` is the same loop with Spark ML's ``GBTClassifier``:

* split labelled / unlabelled rows on ``label IS NULL`` (P6);
* fold column from the key hash (L1);
* per fold, ONE ``GBTClassifier`` fit on all labelled rows with a
  validation indicator = "row is in this fold": trees are grown on the other
  folds and boosting stops early on the held-out fold (L2, L3);
* out-of-fold probabilities (L4), fold and overall AUC (L5), mean test
  score over folds (L6), importance table (L7) and the top-k features with
  all their fold rows (L8), submission table (L9).

Missing values: Spark trees need no NaN, so features are coded with a
sentinel below any real value (the trees can isolate it in one split).
The feature frame is checkpointed once (lineage cut, reliable storage):
the k fits re-read it instead of recomputing the feature joins.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import NUMERIC_TYPES, feature_columns
from ..operators.assemble import union_by_name
from ..session import checkpoint_path, ensure_checkpoint_dir
from .boosting import BoostedFolds, BoostParams, boost_folds
from .folds import kfold_column, stratified_kfold_column
from .metrics import best_round, fold_mean, roc_auc, top_importance_rows

# Identifier columns never used as features.
ID_COLUMNS = ("TARGET", "SK_ID_CURR", "SK_ID_BUREAU", "SK_ID_PREV", "index")


@dataclass
class KFoldResult:
    submission: DataFrame    # key, TARGET = mean test probability over folds
    oof: DataFrame           # key, label, fold, score (out-of-fold probability)
    fold_auc: DataFrame      # fold, auc, n_pos, n_neg
    full_auc: DataFrame      # auc, n_pos, n_neg over all out-of-fold rows
    importances: DataFrame   # feature, importance, fold
    top_importances: DataFrame  # rows of ``importances`` for the top-k features
    models: BoostedFolds | None = None  # trees, cuts and held-out AUCs of ``kfold_boost``
    report: list[tuple[str, int, int]] | None = None  # (stage, rows, columns) of an end-to-end run


def kfold_boost(frame: DataFrame, key: str, label: str = "TARGET", n_folds: int = 5, seed: int = 47,
                stratified: bool = False, features: list[str] | None = None, top_k_features: int = 40,
                **params) -> KFoldResult:
    """The k-fold loop by histogram boosting; ``params`` are those of :class:`.boosting.BoostParams`.

    The feature table is written once; every later pass reads its coded rows.
    Importances are split counts (``importance``) with summed gains beside them.
    """
    spark = frame.sparkSession
    if features is None:
        features = [c for c in feature_columns(frame, [*ID_COLUMNS, key, label])
                    if isinstance(frame.schema[c].dataType, NUMERIC_TYPES)]
    fold = "_fold"
    while fold in frame.columns:
        fold += "_"
    data = frame.select(key, label, *(f"`{c}`" for c in features))
    if stratified:  # unlabelled rows are a stratum of their own
        data = stratified_kfold_column(data, key, label, n_folds, seed, out_col=fold)
    else:
        data = data.withColumn(fold, kfold_column(key, n_folds, seed))
    path = checkpoint_path(spark, f"features-{uuid.uuid4().hex}")
    data.withColumn(fold, F.when(F.col(label).isNotNull(), F.col(fold))).write.option("compression", "zstd").parquet(path)
    models = boost_folds(spark.read.parquet(path), key, label, fold, n_folds, features, BoostParams(seed=seed, **params))
    named = lambda df, *more: df.select(F.col("key").alias(key), *more)
    oof = named(models.probability(models.coded.where("y is not null"), True), F.col("y").alias(label),
                (F.col("fold") + 1).alias("fold"), "score")
    submission = named(models.probability(models.coded.where("y is null"), False), F.col("score").alias(label))
    importances = models.importances()
    return KFoldResult(submission=submission, oof=oof, fold_auc=roc_auc(oof, "score", label, group_cols=["fold"]),
                       full_auc=roc_auc(oof, "score", label), importances=importances,
                       top_importances=top_importance_rows(importances, top_k_features), models=models)


def kfold_gbt(frame: DataFrame, key: str, label: str = "TARGET", n_folds: int = 5,
              seed: int = 47, stratified: bool = False, features: list[str] | None = None,
              max_iter: int = 100, max_depth: int = 8, step_size: float = 0.1,
              subsampling_rate: float = 0.85, feature_subset: str = "0.95",
              min_instances_per_node: int = 40, validation_tol: float = 0.01,
              sentinel: float = -1e9, top_k_features: int = 40,
              checkpoint: bool = True, parallelism: int = 1,
              patience: int | None = None) -> KFoldResult:
    """``parallelism`` > 1 fits that many folds concurrently (as
    ``CrossValidator(parallelism=...)`` does): boosting runs many small jobs,
    so overlapping folds keeps the executors busy.

    Early stopping: without ``patience``, Spark ends boosting at the first
    round that gains less than ``validation_tol`` on the held-out fold; with
    it, the other folds are boosted for ``max_iter`` rounds, the held-out loss
    of each round is read, and the model is fitted again up to the round after
    which ``patience`` rounds brought nothing better."""
    spark = frame.sparkSession
    if features is None:
        exclude = set(ID_COLUMNS) | {key, label}
        features = [f.name for f in frame.schema.fields
                    if f.name not in exclude and isinstance(f.dataType, NUMERIC_TYPES)]
    data = frame.select(
        F.col(key), F.col(label).cast("double").alias(label),
        *[F.coalesce(F.col(c).cast("double"), F.lit(sentinel)).alias(c) for c in features])
    # one projection over the frame, so the feature table is planned once
    if stratified:  # unlabelled rows are a stratum of their own
        data = stratified_kfold_column(data, key, label, n_folds, seed, out_col="_fold")
    else:
        data = data.withColumn("_fold", kfold_column(key, n_folds, seed))
    data = data.withColumn("_fold", F.when(F.col(label).isNotNull(), F.col("_fold")))
    if checkpoint:
        # features and folds computed once; the k fits re-read this
        ensure_checkpoint_dir(spark)
        data = data.checkpoint(eager=True)
    train = data.where(F.col(label).isNotNull())
    test = data.where(F.col(label).isNull()).drop("_fold")

    assembler = VectorAssembler(inputCols=features, outputCol="_features", handleInvalid="keep")

    def fit_fold(f: int):
        gbt = GBTClassifier(labelCol=label, featuresCol="_features", maxIter=max_iter,
                            maxDepth=max_depth, stepSize=step_size,
                            subsamplingRate=subsampling_rate,
                            featureSubsetStrategy=feature_subset,
                            minInstancesPerNode=min_instances_per_node, seed=seed,
                            validationIndicatorCol="_is_valid", validationTol=validation_tol)
        if patience is None:
            return Pipeline(stages=[assembler, gbt]).fit(train.withColumn("_is_valid", F.col("_fold") == f))
        gbt = gbt.copy()
        gbt.clear(gbt.validationIndicatorCol)
        others, held_out = train.where(F.col("_fold") != f), train.where(F.col("_fold") == f)
        full = Pipeline(stages=[assembler, gbt]).fit(others)
        losses = full.stages[-1].evaluateEachIteration(assembler.transform(held_out))
        rounds = best_round(losses, patience)
        return full if rounds == max_iter else \
            Pipeline(stages=[assembler, gbt.copy({gbt.maxIter: rounds})]).fit(others)

    if parallelism > 1:
        from concurrent.futures import ThreadPoolExecutor
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            models = list(pool.map(fit_fold, range(n_folds)))
    else:
        models = [fit_fold(f) for f in range(n_folds)]

    oofs, imp_rows = [], []
    prob = vector_to_array(F.col("probability"))[1]
    for f, model in enumerate(models):
        oofs.append(model.transform(train.where(F.col("_fold") == f))
                    .select(key, label, F.lit(f + 1).alias("fold"), prob.alias("score")))
        imp = model.stages[-1].featureImportances.toArray()
        imp_rows += [(name, float(v), f + 1) for name, v in zip(features, imp)]
    oof = union_by_name(*oofs)   # folds are disjoint: a narrow union, no shuffle

    # Test score = mean over the k fold models (L6). The k models score the
    # test frame in ONE pass, each writing its own columns, and the mean is a
    # row-wise expression: no union of k scored copies and no shuffle by key.
    scored = assembler.transform(test)
    fold_scores = []
    for f, model in enumerate(models):
        gm = model.stages[-1].copy()
        gm.setProbabilityCol(f"_p{f}").setRawPredictionCol(f"_r{f}").setPredictionCol(f"_y{f}")
        scored = gm.transform(scored)
        fold_scores.append(vector_to_array(F.col(f"_p{f}"))[1])
    submission = scored.select(key, fold_mean(fold_scores).alias(label))
    imp_schema = T.StructType([T.StructField("feature", T.StringType(), False),
                               T.StructField("importance", T.DoubleType(), False),
                               T.StructField("fold", T.IntegerType(), False)])
    importances = spark.createDataFrame(imp_rows, imp_schema)
    return KFoldResult(
        submission=submission, oof=oof,
        fold_auc=roc_auc(oof, "score", label, group_cols=["fold"]),
        full_auc=roc_auc(oof, "score", label),
        importances=importances,
        top_importances=top_importance_rows(importances, top_k_features))
