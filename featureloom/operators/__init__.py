"""DataFrame operators: encoders, aggregates, joins, profiles, ranking."""

from .aggregate import (AGG_FUNCS, View, agg_features, all_columns_spec, category_rates,
                        column_mean, distinct_rows, mean_by, rate_exprs, share_exprs,
                        spec_exprs, two_level_aggregate)
from .assemble import left_join, left_star, semi_join, union_by_name
from .encode import (CategoryDictionary, CategoryGuardError, code_column, factorize,
                     first_appearance_dictionary, indicator_name, lookup, one_hot,
                     one_hot_columns)
from .profile import fill_constant, fill_with_mean, missing_profile, observe_shape
from .ranking import exact_median, head, prefix_before, sort_desc, top_k

__all__ = [
    "AGG_FUNCS", "View", "agg_features", "all_columns_spec", "category_rates", "column_mean",
    "distinct_rows", "mean_by", "rate_exprs", "share_exprs", "spec_exprs",
    "two_level_aggregate", "left_join", "left_star", "semi_join", "union_by_name",
    "CategoryDictionary", "CategoryGuardError", "code_column", "factorize",
    "first_appearance_dictionary", "indicator_name", "lookup", "one_hot", "one_hot_columns",
    "fill_constant", "fill_with_mean", "missing_profile", "observe_shape", "exact_median",
    "head", "prefix_before", "sort_desc", "top_k",
]
