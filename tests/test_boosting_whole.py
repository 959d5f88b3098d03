"""Models trained whole in one task each against models trained in passes over all rows, and their histograms."""

import random

import numpy as np
import pytest

from featureloom.learn import boosting, histograms
from featureloom.learn.boosting import BoostParams, boost_folds, held_out_auc

FEATURES = ["a", "b", "noise", "twin", "rare", "same", "none"]
SCHEMA = "id long, y int, fold int, a double, b double, noise double, twin double, rare double, same double, none double"


def rows(n=600, seed=3):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        a, b, c = rng.gauss(0, 1), rng.choice([0.0, 1.0, 2.0]), rng.random()
        y = int(a + 0.7 * b + (1.5 if c < 0.2 else 0) + rng.gauss(0, 0.6) > 1)
        noise = rng.random()
        fold = i % 3 if rng.random() < 0.95 else 0
        out.append((i, None if rng.random() < 0.1 else y, fold, None if c < 0.2 else a, b, noise, noise * 2, float(i % 51 == 0), 4.0, None))
    return out


def in_passes(monkeypatch):
    monkeypatch.setattr(boosting, "WHOLE_BYTES", 0)


PARAMS = [BoostParams(rounds=5, num_leaves=6, max_depth=4, min_child_weight=2.0, colsample=0.6, bins=16, patience=None, segment=3),
          BoostParams(rounds=3, num_leaves=32, max_depth=8, min_child_weight=1.0, bins=32, patience=None, segment=2),
          BoostParams(rounds=30, learning_rate=0.5, num_leaves=8, min_child_weight=1.0, patience=3, segment=4)]


@pytest.mark.parametrize("p", PARAMS)
@pytest.mark.parametrize("twice", [False, True])
def test_both_ways_grow_the_same_trees(spark, monkeypatch, p, twice):
    data = rows() * (2 if twice else 1)  # keys may repeat
    frame = spark.createDataFrame(data, SCHEMA).repartition(3)
    whole = boost_folds(frame, "id", "y", "fold", 3, FEATURES, p)
    in_passes(monkeypatch)
    monkeypatch.setattr(boosting, "MIN_TASK_BYTES", 512)
    monkeypatch.setattr(boosting, "DRIVER_BYTES", 0)
    passes = boost_folds(frame, "id", "y", "fold", 3, FEATURES, p)
    assert whole.trees == passes.trees and any(f >= 0 for t in whole.trees[0] for f in t.feature)
    for few, many in zip(whole.aucs, passes.aucs):
        np.testing.assert_allclose(few, many[:len(few)], atol=1e-12)
    if p.patience:
        assert max(map(len, whole.aucs)) < p.rounds


def test_a_small_table_needs_no_pass_a_level(spark, monkeypatch):
    monkeypatch.setattr(boosting, "_histograms", lambda *a: pytest.fail("a pass over all rows"))
    jobs = spark.sparkContext._jsc.sc().dagScheduler().nextJobId
    before = jobs()
    frame = spark.createDataFrame(rows(), SCHEMA)
    got = boost_folds(frame, "id", "y", "fold", 3, FEATURES, BoostParams(rounds=40, min_child_weight=2.0, patience=None))
    assert [len(t) for t in got.trees] == [40] * 3 and jobs() - before < 30  # jobs do not grow with the rounds


def test_one_class_and_folds_without_rows(spark, monkeypatch):
    for data in ([(k, 1, k % 2, float(k)) for k in range(30)], [(k, k % 2, 0, float(k)) for k in range(30)], [(k, k % 2, k % 2, None) for k in range(30)]):
        frame = spark.createDataFrame(data, "id long, y int, fold int, a double")
        p = BoostParams(rounds=3, min_child_weight=0.1)
        with monkeypatch.context() as m:
            whole = boost_folds(frame, "id", "y", "fold", 2, ["a"], p)
            in_passes(m)
            passes = boost_folds(frame, "id", "y", "fold", 2, ["a"], p)
        assert whole.trees == passes.trees and whole.aucs == passes.aucs


@pytest.mark.parametrize("n", [1, 300, 20_000])
def test_histograms_equal_plain_counts(n):
    rng = np.random.default_rng(n)
    widths = np.array([64, 3, 2, 17, 64, 40, 3, 256])
    columns = np.stack([rng.integers(0, w, n) for w in widths]).astype(np.uint8)
    margins, y = rng.normal(size=n), rng.integers(0, 2, n).astype(float)
    gh, packing = histograms.on_grid(margins, y, histograms.grid(n)), histograms.Packing(widths)
    packed = packing.pack(columns.T)
    for at in (None, np.flatnonzero(rng.random(n) < 0.7)):
        some, g = (columns, gh) if at is None else (columns[:, at], gh[at])
        got = packing.histogram(packed, at, g)
        want = np.concatenate([np.bincount(c, g.real, w) + 1j * np.bincount(c, g.imag, w) for c, w in zip(some, widths)])
        assert (got == want).all()  # exact in any order
        parts = [packing.histogram(packed, p, gh[p]) for p in np.array_split(np.arange(n) if at is None else at, 3)]
        assert (sum(parts) == got).all()
        for f in range(len(widths)):
            assert (packing.codes(packed, f, np.arange(n) if at is None else at) == some[f]).all()
    chance = 1 / (1 + np.exp(-margins))
    np.testing.assert_allclose(gh, chance - y + 1j * chance * (1 - chance), atol=2.0 / histograms.grid(n))


def test_packs_hold_every_feature_once():
    widths = np.array([64] * 5 + [3] * 20 + [256, 2, 40])
    got = histograms.Packing(widths).packs
    assert sorted(f for p in got for f in p) == list(range(len(widths)))
    assert all(np.prod(widths[p]) <= histograms.TABLE for p in got) and len(got) < len(widths) / 2


def test_held_out_auc_counts_ties_half():
    score, y = np.array([0.1, 0.4, 0.4, 0.8, 0.1]), np.array([0.0, 1.0, 0.0, 1.0, 2.0])
    pairs = [(a > b) + 0.5 * (a == b) for a, p in zip(score, y) if p == 1 for b, q in zip(score, y) if q == 0]
    assert held_out_auc(score, y) == pytest.approx(np.mean(pairs))
    assert held_out_auc(score, np.ones(5)) == 0.5 and held_out_auc(np.zeros(0), np.zeros(0)) == 0.5
