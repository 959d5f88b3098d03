"""featureloom: wide per-entity feature tables and a k-fold classifier on Spark.

Subpackages: ``sources`` (scans, sinks, casts), ``functions`` (column
expressions), ``operators`` (encoders, aggregates, joins, profiles,
ranking), ``plans`` (credit feature blocks, driver-table queries), ``learn``
(folds, AUC, gradient-boosted trees), ``streaming`` (none needed).
"""

__version__ = "0.1.0"
