"""Column expressions: scalars, row statistics and column selection."""

from .columns import (agg_name, columns_matching, feature_columns, numeric_columns,
                      quote, string_columns)
from .rowstats import (ROW_STATS, row_count, row_kurtosis, row_mean, row_product, row_std,
                       row_sum, with_row_stats)
from .scalars import (DAYS_SENTINEL, clamp_zero, difference, nan_to_null, null_safe_eq,
                      null_safe_ne, product, safe_ratio, sentinel_to_null, shifted_ratio)

__all__ = [
    "agg_name", "columns_matching", "feature_columns", "numeric_columns", "quote",
    "string_columns", "row_count", "row_kurtosis", "row_mean", "row_product", "row_std",
    "row_sum", "ROW_STATS", "with_row_stats", "DAYS_SENTINEL", "clamp_zero", "difference", "nan_to_null", "null_safe_eq",
    "null_safe_ne", "product", "safe_ratio", "sentinel_to_null", "shifted_ratio",
]
