import random

import numpy as np
from pyspark.sql import functions as F

from featureloom.llm import quality, toxicity
from featureloom.llm.common import crc_bucket

from .conftest import edge_rows, frame, prose


def auc(y, s):
    order = np.argsort(np.argsort(s, kind="stable")) + 1
    y = np.array(y)
    return (order[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (len(y) - y.sum()))


def corpus():
    rng, rows, labels = random.Random(2), [], []
    for d in range(500):
        words, toxic, low = prose(d, 60).split(), d % 5 == 0, d % 3 == 0
        if toxic:
            for _ in range(4):
                words[rng.randrange(len(words))] = rng.choice(["dolt", "cretin!", "nitwit,", "D0lt"])
        if low:
            words = [w + rng.choice(["%%%", "$$$"]) for w in words]
        rows.append((d, " ".join(words)))
        labels.append((d, int(not low), int(toxic)))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = corpus()
    docs, lab = frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    for module, col, held in ((toxicity, 2, crc_bucket("doc_id", 4) == 2), (quality, 1, crc_bucket("doc_id", 3) == 1)):
        model = module.train(docs, lab, ~held)
        got = module.score(docs, model, ["doc_id"]).where(held).collect()
        truth = {x[0]: x[col] for x in labels}
        assert all(0 <= r.score <= 1 for r in got)
        assert auc([truth[r.doc_id] for r in got], [r.score for r in got]) > 0.97


def test_edge_cases_and_no_labels(spark, edge_docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    odd = spark.createDataFrame([(None, 1, 1), (4, None, None), (5, 1, 1), (5, 1, 1), (6, 7, 9)], "doc_id long, quality int, toxic int")
    for module in (toxicity, quality):
        for labels, score in ((none, 0.0), (odd, 1.0)):
            model = module.train(edge_docs, labels, F.lit(True))
            got = module.score(edge_docs, model, ["doc_id"]).collect()
            assert len(got) == len(edge_rows()) and {r.score for r in got} == {score}
        assert module.score(no_docs, module.train(no_docs, none, F.lit(True)), ["doc_id"]).collect() == []
    rows, labels = corpus()
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.train(frame(spark, rows), lab, F.lit(True))
    got = toxicity.score(edge_docs, model, ["doc_id"]).collect()
    assert len(got) == len(edge_rows()) and all(0 <= r.score <= 1 for r in got)
    kept = toxicity.drop_toxic(frame(spark, rows), model)
    assert kept.columns == frame(spark, rows).columns and 350 < kept.count() < 450


def test_isotonic_rises_and_keeps_the_mean():
    rng = np.random.default_rng(0)
    x = rng.normal(size=500)
    y = (rng.uniform(size=500) < 1 / (1 + np.exp(-2 * x))).astype(float)
    at, value = toxicity.isotonic(x, y, np.ones(500))
    assert (np.diff(value) > 0).all() and (np.diff(at) > 0).all()


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 3))
    y = ((x[:, 0] > 0) & (x[:, 1] > 0)).astype(float)
    trees = toxicity.BoostedTrees().fit(x, y, np.ones(2000))
    assert ((trees.margin(x) > 0) == (y > 0)).mean() > 0.98


def test_context_vectors_equal_plain_sums():
    rng = np.random.default_rng(0)
    seq = rng.integers(1, 50, 300).astype(np.int32)
    place, sign = quality.index_vectors()
    table = np.zeros(quality.BUCKETS * (quality.DIM + 1))
    quality.add_contexts(seq, table, place, sign)
    want = np.zeros((quality.BUCKETS, quality.DIM + 1))
    for i, w in enumerate(seq):
        want[w, quality.DIM] += 1
        for j in range(max(0, i - quality.WINDOW), min(len(seq), i + quality.WINDOW + 1)):
            if j != i:
                for p, s in zip(place[seq[j]], sign[seq[j]]):
                    want[w, p] += s
    assert np.allclose(table.reshape(quality.BUCKETS, -1), want)


def test_temperature_lowers_the_loss():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 4))
    y = (rng.uniform(size=600) < 1 / (1 + np.exp(-x[:, 0]))).astype(float)
    net = quality.Network(epochs=60).fit(x[:300], y[:300], np.ones(300))
    loss = lambda: -np.log(np.where(y[300:] > 0, net.predict(x[300:]), 1 - net.predict(x[300:])) + 1e-12).mean()
    before = loss()
    net.calibrate(x[300:], y[300:], np.ones(300))
    assert loss() <= before + 1e-9
