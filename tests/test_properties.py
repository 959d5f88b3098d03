"""Property tests on random small tables, few examples each
(every example is a Spark job)."""

import math

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from featureloom.learn import roc_auc
from featureloom.operators import View, agg_features, exact_median

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

rows_strategy = st.lists(
    st.tuples(st.one_of(st.none(), st.integers(0, 4)),               # key (NULL allowed)
              st.one_of(st.none(), st.sampled_from(["A", "C", "X"])),  # status
              st.one_of(st.none(), st.integers(-50, 50).map(float))),  # value
    min_size=1, max_size=40)


def _na(x):
    return x is None or (isinstance(x, float) and math.isnan(x))


@SETTINGS
@given(rows=rows_strategy)
def test_fused_views_equal_filter_group_join(spark, rows):
    df = spark.createDataFrame(rows, "k int, s string, v double")
    spec = {"v": ["sum", "mean", "max", "size", "var"]}
    views = [View("A_", F.col("s").eqNullSafe("A"), spec), View("C_", F.col("s").eqNullSafe("C"), spec)]
    got = {r["k"]: r for r in agg_features(df, "k", spec, prefix="B_", views=views).collect()}
    pdf = pd.DataFrame(rows, columns=["k", "s", "v"]).dropna(subset=["k"])

    def block(frame, prefix):
        g = frame.groupby("k").agg({"v": ["sum", "mean", "max", "size", "var"]})
        g.columns = [f"{prefix}v_{f.upper()}" for _, f in g.columns]
        return g
    exp = block(pdf, "B_").join(block(pdf[pdf.s == "A"], "A_")).join(block(pdf[pdf.s == "C"], "C_"))
    assert set(got) == set(int(k) for k in exp.index)
    for k, row in exp.iterrows():
        for c in exp.columns:
            e, g = row[c], got[int(k)][c]
            assert _na(e) == _na(g), (k, c, g, e)
            if not _na(e):
                assert abs(float(e) - float(g)) < 1e-9 * max(1, abs(float(e)))
        # a view never holds more rows than the whole group
        for p in ("A_", "C_"):
            if got[int(k)][f"{p}v_SIZE"] is not None:
                assert got[int(k)][f"{p}v_SIZE"] <= got[int(k)]["B_v_SIZE"]


@SETTINGS
@given(rows=rows_strategy, parts=st.integers(1, 6))
def test_exact_median_equals_pandas(spark, rows, parts):
    df = spark.createDataFrame(rows, "k int, s string, v double")
    got = {r["k"]: r["median"] for r in
           exact_median(df, ["k"], "v", num_partitions=parts).collect()}
    exp = pd.DataFrame(rows, columns=["k", "s", "v"]).dropna(subset=["k"]).groupby("k")["v"] \
        .median().dropna()
    assert set(got) == set(int(k) for k in exp.index)
    for k, val in exp.items():
        assert got[int(k)] == val


@SETTINGS
@given(pairs=st.lists(st.tuples(st.integers(0, 1), st.integers(0, 6).map(float)),
                      min_size=2, max_size=60),
       parts=st.integers(1, 5))
def test_auc_equals_pairwise_count(spark, pairs, parts):
    y = np.array([p[0] for p in pairs])
    s = np.array([p[1] for p in pairs])
    if y.min() == y.max():
        return
    df = spark.createDataFrame([(int(a), float(b)) for a, b in pairs], "y int, s double")
    auc = roc_auc(df, "s", "y", num_partitions=parts).first()["auc"]
    pos, neg = s[y == 1], s[y == 0]
    brute = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) \
        / (len(pos) * len(neg))
    assert abs(auc - brute) < 1e-12
