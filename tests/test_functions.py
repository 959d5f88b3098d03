"""Scalar and row-wise expressions against pandas semantics."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from featureloom.functions import (clamp_zero, columns_matching, null_safe_ne, row_kurtosis,
                                   row_mean, row_product, row_std, row_sum, safe_ratio,
                                   sentinel_to_null, shifted_ratio, string_columns)


def _same(a, b, tol=1e-9):
    if a is None or (isinstance(a, float) and math.isnan(a)):
        return b is None or (isinstance(b, float) and math.isnan(b))
    return b is not None and abs(a - b) <= tol * max(1.0, abs(b))


def test_safe_ratio_zero_denominator_is_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0), (6.0, 3.0), (None, 2.0)], "a double, b double")
    got = [r[0] for r in df.select(safe_ratio("a", "b")).collect()]
    assert got == [None, None, 2.0, None]


def test_shifted_ratio_and_sentinel(spark):
    df = spark.createDataFrame([(10.0, 1), (10.0, -1), (9.0, 2)], "a double, b int")
    assert [r[0] for r in df.select(shifted_ratio("a", "b")).collect()] == [5.0, None, 3.0]
    d2 = spark.createDataFrame([(365243,), (-100,), (None,)], "d int")
    assert [r[0] for r in d2.select(sentinel_to_null("d")).collect()] == [None, -100, None]


def test_clamp_zero_maps_missing_to_zero(spark):
    # Pandas lambda x: x if x > 0 else 0 sends NaN to 0
    df = spark.createDataFrame([(5.0,), (-3.0,), (None,), (0.0,)], "x double")
    assert [r[0] for r in df.select(clamp_zero("x")).collect()] == [5.0, 0.0, 0.0, 0.0]


def test_null_safe_ne_keeps_null(spark):
    # Pandas != keeps missing rows
    df = spark.createDataFrame([("M",), ("XNA",), (None,), ("F",)], "g string")
    assert sorted(str(r[0]) for r in df.where(null_safe_ne("g", "XNA")).collect()) == ["F", "M", "None"]


ROWS = [
    (None, None, None, None, None),        # all missing
    (1.0, None, None, None, None),         # one value
    (1.0, 3.0, None, None, None),          # two values
    (1.0, 2.0, 4.0, None, None),           # three values
    (1.0, 1.0, 1.0, 1.0, 1.0),             # constant row
    (0.0, 1.0, 0.0, 1.0, 1.0),             # five mixed
    (2.5, -1.0, 7.0, 3.0, None),           # four values
    (7.0, 7.0, 7.000000000000001, 7.000000000000001, None),  # numerically constant
]


@pytest.fixture
def rows_df(spark):
    return spark.createDataFrame(ROWS, "a double, b double, c double, d double, e double")


def test_row_stats_match_pandas(rows_df):
    cols = ["a", "b", "c", "d", "e"]
    got = rows_df.select(row_sum(cols).alias("s"), row_mean(cols).alias("m"),
                         row_std(cols).alias("sd"), row_kurtosis(cols).alias("k"),
                         row_product(cols[:3]).alias("p")).toPandas()
    pdf = pd.DataFrame(ROWS, columns=cols, dtype="float64")
    exp_sum = pdf.sum(axis=1)
    exp_mean = pdf.mean(axis=1)
    exp_std = pdf.std(axis=1)
    exp_kurt = pdf.kurtosis(axis=1)
    exp_prod = pdf["a"] * pdf["b"] * pdf["c"]
    for i in range(len(ROWS)):
        assert _same(got.s[i], exp_sum[i]), (i, got.s[i], exp_sum[i])
        assert _same(got.m[i], exp_mean[i]), (i, got.m[i], exp_mean[i])
        assert _same(got.sd[i], exp_std[i]), (i, got.sd[i], exp_std[i])
        assert _same(got.k[i], exp_kurt[i], 1e-7), (i, got.k[i], exp_kurt[i])
        assert _same(got.p[i], exp_prod[i]), (i, got.p[i], exp_prod[i])


def test_row_stats_random_against_pandas(spark):
    rng = np.random.default_rng(3)
    arr = rng.normal(size=(200, 6))
    arr[rng.random(arr.shape) < 0.3] = np.nan
    pdf = pd.DataFrame(arr, columns=[f"c{i}" for i in range(6)])
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in r) for r in arr],
                               ", ".join(f"c{i} double" for i in range(6)))
    cols = list(pdf.columns)
    got = df.select(row_kurtosis(cols).alias("k"), row_std(cols).alias("s")).toPandas()
    ek, es = pdf.kurtosis(axis=1), pdf.std(axis=1)
    for i in range(len(pdf)):
        assert _same(got.k[i], ek[i], 1e-7)
        assert _same(got.s[i], es[i], 1e-9)


def test_column_selection_by_pattern_and_type(spark):
    df = spark.createDataFrame(
        [(1, 0, 1, 1, 0, "Y", "a")],
        "FLAG_DOC_A int, FLAG_DOC_B int, FLAG_PHONE_X int, FLAG_MAIL_X int, REG_FLAG_X int, "
        "FLAG_OWN_CAR string, NAME string")
    assert columns_matching(df, ["FLAG_DOC"]) == ["FLAG_DOC_A", "FLAG_DOC_B"]
    # The string FLAG_OWN_CAR is not summed
    assert columns_matching(df, ["FLAG_"], ["FLAG_DOC", "_FLAG_"], numeric_only=True) == \
        ["FLAG_PHONE_X", "FLAG_MAIL_X"]
    assert string_columns(df) == ["FLAG_OWN_CAR", "NAME"]
    assert df.select(row_sum(["FLAG_PHONE_X", "FLAG_MAIL_X"])).first()[0] == 2.0
    assert df.select(F.lit(1)).count() == 1


def test_staged_row_stats_equal_single_expressions(rows_df):
    from featureloom.functions import with_row_stats
    cols = ["a", "b", "c", "d", "e"]
    staged = with_row_stats(rows_df, cols, {"sum": "s", "mean": "m", "std": "sd", "kurt": "k",
                                            "count": "n", "prod": "p"}).toPandas()
    single = rows_df.select(row_sum(cols).alias("s"), row_mean(cols).alias("m"),
                            row_std(cols).alias("sd"), row_kurtosis(cols).alias("k"),
                            row_product(cols).alias("p")).toPandas()
    for c in ("s", "m", "sd", "k", "p"):
        for x, y in zip(staged[c], single[c]):
            assert _same(x, y, 1e-12), (c, x, y)
    assert staged["n"].tolist() == [0, 1, 2, 3, 5, 5, 4, 4]
