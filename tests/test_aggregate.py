"""Spec aggregates, fused views, shares, rates, profiles."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from featureloom.operators import (View, agg_features, category_rates, fill_with_mean,
                                   left_join, left_star, missing_profile, two_level_aggregate,
                                   union_by_name)

LOANS = [
    # key, status, amount, days
    (1, "Active", 100.0, -10),
    (1, "Closed", None, -20),
    (1, "Active", 50.0, None),
    (2, "Closed", None, -5),      # only-missing amounts; no Active rows
    (3, "Active", 7.0, -1),       # exactly one row -> var NULL
    (None, "Active", 99.0, -3),   # NULL key: dropped (N6)
    (4, None, 1.0, -2),
    (4, "Other", 1.0, -2),
]
SCHEMA = "k long, status string, amt double, days int"
SPEC = {"amt": ["min", "max", "mean", "sum", "var", "size"], "days": ["mean", "nunique"]}


@pytest.fixture
def loans(spark):
    return spark.createDataFrame(LOANS, SCHEMA)


def _pandas_spec(pdf, spec, prefix):
    g = pdf.dropna(subset=["k"]).groupby("k").agg({c: [("size" if f == "size" else
                                                        "nunique" if f == "nunique" else f)
                                                       for f in fs] for c, fs in spec.items()})
    g.columns = [f"{prefix}{a}_{b.upper()}" for a, b in g.columns]
    return g


def _eq(a, b):
    if a is None or (isinstance(a, float) and math.isnan(a)):
        return b is None or (isinstance(b, float) and math.isnan(b))
    return abs(float(a) - float(b)) < 1e-9


def test_spec_matches_pandas_groupby(loans):
    got = {r["k"]: r for r in agg_features(loans, "k", SPEC, prefix="B_").collect()}
    exp = _pandas_spec(pd.DataFrame(LOANS, columns=["k", "status", "amt", "days"]), SPEC, "B_")
    assert set(got) == {1, 2, 3, 4}      # NULL key dropped
    for k, row in exp.iterrows():
        for c in exp.columns:
            assert _eq(got[int(k)][c], row[c]), (k, c, got[int(k)][c], row[c])
    assert got[2]["B_amt_SUM"] == 0      # N1
    assert got[3]["B_amt_VAR"] is None   # N3
    assert got[1]["B_amt_SIZE"] == 3     # N4: size counts missing
    assert got[1]["B_days_NUNIQUE"] == 2  # N4: nunique skips missing


def test_fused_views_equal_joined_views(loans):
    views = [View("ACT_", F.col("status").eqNullSafe("Active"), SPEC),
             View("CLS_", F.col("status").eqNullSafe("Closed"), SPEC)]
    fused = agg_features(loans, "k", SPEC, prefix="B_", views=views)
    joined = left_star(agg_features(loans, "k", SPEC, prefix="B_"), "k",
                       [agg_features(loans.where(v.condition), "k", SPEC, prefix=v.prefix)
                        for v in views])
    assert sorted(fused.columns) == sorted(joined.columns)
    cols = sorted(fused.columns)
    assert fused.select(cols).exceptAll(joined.select(cols)).count() == 0
    assert joined.select(cols).exceptAll(fused.select(cols)).count() == 0
    r2 = {r["k"]: r for r in fused.collect()}[2]
    # No Active rows for key 2 -> every ACT_ feature NULL, sum and size included
    assert all(r2[c] is None for c in fused.columns if c.startswith("ACT_"))
    assert r2["CLS_amt_SUM"] == 0 and r2["CLS_amt_SIZE"] == 1


def test_category_shares_sum_to_one(loans):
    from featureloom.operators import CategoryDictionary
    cats = CategoryDictionary.discover(loans, ["status"])
    out = agg_features(loans, "k", categories=cats, prefix="S_")
    share_cols = [c for c in out.columns if c.startswith("S_status_")]
    assert "S_status_nan_MEAN" in share_cols
    for r in out.collect():
        assert abs(sum(r[c] for c in share_cols) - 1.0) < 1e-12
    r4 = {r["k"]: r for r in out.collect()}[4]
    assert r4["S_status_nan_MEAN"] == 0.5 and r4["S_status_Other_MEAN"] == 0.5


def test_category_rates_with_base(spark, loans):
    base = spark.createDataFrame([(1,), (2,), (3,), (4,), (5,)], "k long")
    out = {r["k"]: r for r in category_rates(loans, "k", "status", ["Active", "Closed"],
                                             "rate_", "total", base=base).collect()}
    # applicant 5 has no loan: the fan-out join gives one NULL row -> total 1, rates 0
    assert out[5]["total"] == 1 and out[5]["rate_Active"] == 0.0
    assert out[1]["total"] == 3 and abs(out[1]["rate_Active"] - 2 / 3) < 1e-12
    # brute force: left join then count, as the original does
    pdf = pd.DataFrame(LOANS, columns=["k", "status", "amt", "days"])
    fan = pd.DataFrame({"k": [1, 2, 3, 4, 5]}).merge(pdf, on="k", how="left")
    for k, grp in fan.groupby("k"):
        assert out[k]["total"] == len(grp)
        assert abs(out[k]["rate_Closed"] - (grp.status == "Closed").sum() / len(grp)) < 1e-12


def test_two_level_aggregate(spark):
    months = spark.createDataFrame(
        [(10, -1, "0"), (10, -2, "1"), (10, -3, "0"), (11, -1, "C"), (12, -5, None)],
        "loan long, m int, st string")
    loans = spark.createDataFrame([(1, 10), (1, 11), (2, 12), (3, 13)], "k long, loan long")
    from featureloom.operators import CategoryDictionary
    cats = CategoryDictionary.discover(months, ["st"])
    out = two_level_aggregate(
        months, "loan", {"m": ["min", "max", "size"]}, loans, "k",
        {"m_MIN": ["min"], "m_MAX": ["max"], "m_SIZE": ["mean", "sum"], "st_0_MEAN": ["mean"]},
        prefix="B_", child_categories=cats)
    got = {r["k"]: r for r in out.collect()}
    assert got[1]["B_m_MIN_MIN"] == -3 and got[1]["B_m_MAX_MAX"] == -1
    assert got[1]["B_m_SIZE_SUM"] == 4 and got[1]["B_m_SIZE_MEAN"] == 2.0
    assert abs(got[1]["B_st_0_MEAN_MEAN"] - (2 / 3 + 0) / 2) < 1e-12
    # loan 13 has no monthly rows (A12): size sum 0, min NULL
    assert got[3]["B_m_SIZE_SUM"] == 0 and got[3]["B_m_MIN_MIN"] is None


def test_left_join_suffixes(spark):
    a = spark.createDataFrame([(1, 1.0)], "k long, AMT_ANNUITY double")
    b = spark.createDataFrame([(1, 2.0), (1, 3.0)], "k long, AMT_ANNUITY double")
    out = left_join(a, b, "k")
    assert sorted(out.columns) == ["AMT_ANNUITY_x", "AMT_ANNUITY_y", "k"]
    assert out.count() == 2  # J2 fan-out


def test_missing_profile(spark, loans):
    prof = missing_profile(loans).collect()
    pdf = pd.DataFrame(LOANS, columns=["k", "status", "amt", "days"])
    exp_total = pdf.isnull().sum()
    for r in prof:
        assert r["Total"] == exp_total[r["column"]]
        assert abs(r["Percent"] - exp_total[r["column"]] / len(pdf) * 100) < 1e-9
    totals = [r["Total"] for r in prof]
    assert totals == sorted(totals, reverse=True)


def test_fill_with_mean_and_union(spark):
    a = spark.createDataFrame([(1, 1.0), (2, None), (3, 5.0)], "k long, x double")
    filled = {r["k"]: r["x"] for r in fill_with_mean(a, ["x"]).collect()}
    assert filled[2] == 3.0
    b = spark.createDataFrame([(4,)], "k long")
    u = union_by_name(a.withColumn("TARGET", F.lit(1)), b)
    rows = {r["k"]: r for r in u.collect()}
    assert rows[4]["TARGET"] is None and rows[4]["x"] is None


def test_hot_key_aggregate_is_exact(spark):
    # one key holds a third of the rows: partial aggregation keeps it exact
    rng = np.random.default_rng(0)
    keys = np.where(rng.random(3000) < 1 / 3, 0, rng.integers(1, 200, 3000))
    vals = rng.normal(size=3000)
    df = spark.createDataFrame([(int(k), float(v)) for k, v in zip(keys, vals)], "k long, v double")
    got = {r["k"]: r for r in agg_features(df, "k", {"v": ["mean", "sum", "var"]}).collect()}
    pdf = pd.DataFrame({"k": keys, "v": vals}).groupby("k")["v"]
    assert abs(got[0]["v_MEAN"] - pdf.mean()[0]) < 1e-12
    assert abs(got[0]["v_VAR"] - pdf.var()[0]) < 1e-9
