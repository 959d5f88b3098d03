"""Spark ML k-fold learning job: folds, AUC, gradient-boosted trees."""

from .folds import kfold_column, stratified_kfold_column
from .metrics import roc_auc

__all__ = ["kfold_column", "stratified_kfold_column", "roc_auc"]
