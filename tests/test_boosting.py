"""Histogram boosting on Spark against a plain version that grows one leaf at a time."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from featureloom.learn import boosting
from featureloom.learn.boosting import BoostParams, best_split, boost_folds, columns_of_tree
from featureloom.learn.gbdt import kfold_boost
from featureloom.operators import left_star, one_hot

SMALL = BoostParams(rounds=4, num_leaves=6, max_depth=4, min_child_weight=2.0, colsample=0.6, bins=16, patience=None, segment=3)


def rows(n=400, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        a, b, c = rng.gauss(0, 1), rng.choice([0.0, 1.0, 2.0]), rng.random()
        y = int(a + 0.7 * b + (1.5 if c < 0.2 else 0) + rng.gauss(0, 0.6) > 1)
        out.append((i, None if rng.random() < 0.1 else y, i % 3, None if c < 0.2 else a, b, rng.random(), float(i % 51 == 0)))
    return out


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(rows(), "id long, y int, fold int, a double, b double, noise double, rare double").repartition(3)


FEATURES = ["a", "b", "noise", "rare"]


def plain_tree(codes, g, h, allowed, p):
    """[(node path, feature, cut, missing_left)] and a function row -> value, leaf by leaf."""
    leaves = {"": np.arange(len(codes))}
    splits, values = {}, {}

    def candidate(path):
        if len(path) >= p.max_depth:
            return None
        r = leaves[path]
        hist = np.zeros((2, codes.shape[1], p.bins))
        for f in range(codes.shape[1]):
            np.add.at(hist[0, f], codes[r, f], g[r])
            np.add.at(hist[1, f], codes[r, f], h[r])
        return best_split(hist[0], hist[1], allowed, p)

    found = {"": candidate("")}
    while len(leaves) < p.num_leaves and any(found[x] for x in leaves):
        path = max((x for x in leaves if found[x]), key=lambda x: found[x][0])
        _, f, cut, missing_left, *_ = found[path]
        splits[path] = (f, cut, missing_left)
        r = leaves.pop(path)
        left = np.where(codes[r, f] == 0, missing_left, codes[r, f] <= cut)
        for side, some in (("L", r[left]), ("R", r[~left])):
            leaves[path + side] = some
            found[path + side] = candidate(path + side)
    out = np.zeros(len(codes))
    for path, r in leaves.items():
        value = -np.sign(g[r].sum()) * max(abs(g[r].sum()) - p.reg_alpha, 0) / (h[r].sum() + p.reg_lambda) * p.learning_rate
        values[path] = value
        out[r] = value
    return splits, out


def splits_of(tree):
    out = {}

    def walk(node, path):
        if tree.feature[node] >= 0:
            out[path] = (tree.feature[node], tree.cut[node], tree.missing_left[node])
            walk(tree.left[node], path + "L")
            walk(tree.right[node], path + "R")
    walk(0, "")
    return out


@pytest.mark.parametrize("driver_bytes, p", [(0, SMALL), (1 << 30, SMALL), (1 << 30, BoostParams(rounds=2, num_leaves=32, max_depth=8, min_child_weight=1.0, bins=32, patience=None, segment=1))])
def test_trees_equal_the_plain_version(spark, frame, monkeypatch, driver_bytes, p):
    monkeypatch.setattr(boosting, "DRIVER_BYTES", driver_bytes)
    monkeypatch.setattr(boosting, "MIN_TASK_BYTES", 256)
    got = boost_folds(frame, "id", "y", "fold", 3, FEATURES, p)
    coded = [r for r in got.coded.orderBy("key").collect() if r.y is not None]
    for m in range(3):
        mine = [r for r in coded if r.fold != m]
        codes = np.array([list(r.codes) for r in mine])
        y = np.array([r.y for r in mine])
        margin = np.full(len(y), math.log(y.mean() / (1 - y.mean())))
        assert abs(got.start[m] - margin[0]) < 1e-12 and len(got.trees[m]) == p.rounds
        for k, tree in enumerate(got.trees[m]):
            chance = 1 / (1 + np.exp(-margin))
            splits, values = plain_tree(codes, chance - y, chance * (1 - chance), columns_of_tree(p, m, k, len(FEATURES)), p)
            assert splits_of(tree) == splits
            np.testing.assert_allclose(tree.margins(codes), values, atol=1e-9)
            margin += values
        held_out = [r for r in coded if r.fold == m]
        score = np.full(len(held_out), got.start[m])
        for t in got.trees[m]:
            score += t.margins(np.array([list(r.codes) for r in held_out]))
        pairs = [(a > b) + 0.5 * (a == b) for a, ya in zip(score, held_out) if ya.y == 1 for b, yb in zip(score, held_out) if yb.y == 0]
        assert abs(got.aucs[m][-1] - np.mean(pairs)) < 1e-9
        own = {r.key: r.score for r in got.probability(got.coded.where("y is not null"), True).where(F.col("fold") == m).collect()}
        np.testing.assert_allclose([own[r.key] for r in held_out], 1 / (1 + np.exp(-score)), atol=1e-12)


def test_codes_keep_order_missing_and_rare_values(spark, frame):
    got = boost_folds(frame, "id", "y", "fold", 3, FEATURES, BoostParams(rounds=0))
    by_id = {r[0]: r for r in rows()}
    for r in got.coded.collect():
        for f, v in enumerate(by_id[r.key][3:]):
            want = 0 if v is None else 1 + int(np.searchsorted(got.cuts[f], v))
            assert r.codes[f] == want
    assert got.cuts[3].tolist() == [0.0]          # the rare 1.0 keeps a bin of its own
    assert all(len(c) <= 62 for c in got.cuts)


def test_a_plateau_stops_early_and_the_best_rounds_stay(spark, frame):
    p = BoostParams(rounds=60, learning_rate=0.5, num_leaves=8, min_child_weight=1.0, patience=4, segment=4)
    got = boost_folds(frame, "id", "y", "fold", 3, FEATURES, p)
    for trees, aucs in zip(got.trees, got.aucs):
        assert len(aucs) < 60 and aucs[len(trees) - 1] == max(aucs[:len(trees) + 4])
    whole = boost_folds(frame, "id", "y", "fold", 3, FEATURES, BoostParams(**{**p.__dict__, "segment": 20}))
    assert [len(t) for t in whole.trees] == [len(t) for t in got.trees]      # segments change nothing
    np.testing.assert_allclose(whole.aucs[0][:8], got.aucs[0][:8], atol=1e-9)


def test_importances_equal_a_walk_over_the_trees(spark, frame):
    res = kfold_boost(frame.withColumn("s", F.lit("text")), "id", "y", n_folds=2, features=None, rounds=3, min_child_weight=2.0, top_k_features=1)
    assert res.models.features == ["fold", *FEATURES]
    got = {(r.feature, r.fold): (r.importance, r.gain) for r in res.importances.collect()}
    for m, trees in enumerate(res.models.trees):
        for f, name in enumerate(res.models.features):
            mine = [(t, n) for t in trees for n, x in enumerate(t.feature) if x == f]
            assert got[name, m + 1][0] == len(mine)
            assert abs(got[name, m + 1][1] - sum(t.gain[n] for t, n in mine)) < 1e-9
    nodes = res.models.nodes()
    assert nodes.where("feature is null and left is null").count() == nodes.where("feature is not null").count() + sum(map(len, res.models.trees))
    assert res.submission.count() == sum(r[1] is None for r in rows()) and res.oof.count() == sum(r[1] is not None for r in rows())
    assert res.full_auc.first().auc > 0.75 and res.top_importances.count() == 2


def test_a_split_of_missing_from_present_values_has_a_threshold(spark):
    data = [(k, k % 3 % 2, None if k % 3 == 1 else 1.0 + k % 2 * (k % 5)) for k in range(120)] + [(k, None, 1.0) for k in range(120, 130)]
    res = kfold_boost(spark.createDataFrame(data, "k long, y int, a double"), "k", "y", n_folds=2, rounds=2, min_child_weight=0.1)
    nodes = res.models.nodes().where("feature is not null and node = 0").collect()
    assert nodes and all(r.threshold == math.inf and r.missing_left is False for r in nodes)
    assert res.submission.count() == 10 and res.importances.count() == 2


def test_histograms_of_all_passes_decide_who_sums_them(spark, frame, monkeypatch):
    monkeypatch.setattr(boosting, "DRIVER_BYTES", 1 << 16)  # one pass fits, all of them do not
    monkeypatch.setattr(boosting, "MIN_TASK_BYTES", 256)
    taken = []
    whole = type(frame).toArrow
    monkeypatch.setattr(type(frame), "toArrow", lambda self: taken.append(1) or whole(self))
    got = boost_folds(frame, "id", "y", "fold", 3, FEATURES, SMALL)
    assert not taken and [len(t) for t in got.trees] == [SMALL.rounds] * 3


def test_no_rows_no_labels_one_class(spark):
    schema = "k long, y int, a double"
    for data in ([], [(1, None, 1.0), (2, None, None)], [(k, 1, float(k)) for k in range(20)], [(k, k % 2, None) for k in range(20)]):
        res = kfold_boost(spark.createDataFrame(data, schema), "k", "y", n_folds=2, rounds=2, min_child_weight=0.1)
        assert res.submission.count() == sum(r[1] is None for r in data)
        assert all(0 < r.score < 1 for r in res.oof.collect())


def test_names_stay_distinct(spark):
    base = spark.createDataFrame([(1, 1)], "k int, c int")
    four = left_star(base, "k", [base] * 4)
    assert len(set(four.columns)) == len(four.columns) == 6 and four.columns[:3] == ["k", "c_x", "c_y"] and four.count() == 1
    with pytest.raises(ValueError, match="c_nan"):
        one_hot(spark.createDataFrame([("nan",), (None,)], "c string"))
