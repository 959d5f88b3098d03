import numpy as np
from pyspark.sql import functions as F

from featureloom.llm import topk


def brute(rows, best):
    ok = [(i, [int(c) for c in np.clip(np.floor(1024 * np.array(v, np.float64)), -2.0**63, 2.0**63 - 1024)]) for i, v in rows
          if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for at, (qid, q) in enumerate(ok):
        if qid % 100 == 0:  # every query row against every other row
            cand = sorted((-sum(a * b for a, b in zip(q, v)), i) for k, (i, v) in enumerate(ok) if k != at and len(v) == len(q))
            out += [(qid, r + 1, i, max(-2**63, min(2**63 - 1, -s))) for r, (s, i) in enumerate(cand[:best])]
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in df.collect())


def test_equals_brute_force_with_edge_cases(spark):
    rng = np.random.default_rng(0)
    f32 = lambda v: [float(np.float32(x)) for x in v]
    rows = [(i, f32(rng.normal(0, 0.2, 16))) for i in range(700)]
    rows += [(1000 + i, rows[3][1]) for i in range(40)]  # ties
    rows += [(2000, None), (2100, [float("nan")] * 16), (2200, [0.1, None]), (2300, [float("inf")] + [0.0] * 15), (None, rows[1][1]),
             (2400, [0.5, -0.25]), (2401, [0.5, 0.5]), (2500, []), (2600, [0.0] * 16), (77, rows[77][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as id", "2 as v", "3 as rank")
    for chunk, block in ((topk.CHUNK, 16_384), (64, 3)):
        topk.CHUNK = chunk
        got = result(topk.top_k(df.repartition(3), F.col("vec_id") % 100 == 0, block=block))
        want = brute(rows, 10)
        assert got == want
    topk.CHUNK = 4096


def test_tasks_of_few_vectors_with_a_query(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.integers(-8, 9, 4) / 4]) for i in range(97, 160)]
    rows += [(200, [1.0, 1.0]), (201, [0.5, 0.5]), (202, [2.0, -1.0])]  # a rare length
    schema = "vec_id long, embedding array<float>"
    for size in (2, 5, 10):
        parts = [spark.createDataFrame(rows[at:at + size], schema).coalesce(1) for at in range(0, len(rows), size)]
        df = parts[0]
        for part in parts[1:]:
            df = df.unionAll(part)
        assert result(topk.top_k(df, F.col("vec_id") % 100 == 0)) == brute(rows, 10)


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(df, F.col("vec_id") % 100 == 0).collect() == []


def test_small_chunks_carry_the_threshold():
    rng = np.random.default_rng(1)
    x = rng.integers(-300, 300, (3000, 8))
    lists = topk.Lists(np.arange(3000), x)
    rows, score = lists.search(x[5], 10, 250_000.0)
    exact = x @ x[5]
    assert set(np.flatnonzero(exact >= 250_000)) <= set(rows.tolist()) and (exact[rows] == score).all()


def test_rows_that_share_a_querys_id(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.integers(-8, 9, 3) / 4]) for i in range(150)]
    rows += [(100, [1.0, 0.5, -1.0]), (100, [2.0, 0.25, 1.0]), (100, rows[100][1]), (100, rows[100][1]), (0, rows[0][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for block in (16_384, 2):
        assert result(topk.top_k(df.repartition(4), F.col("vec_id") % 100 == 0, block=block)) == brute(rows, 10)


def test_components_beyond_exact_doubles(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(0, 10.0 ** rng.integers(0, 5), 4)]) for i in range(400)]
    rows += [(1000 + i, [float(x) for x in rng.normal(0, 2e5, 4)]) for i in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert result(topk.top_k(df.repartition(3), F.col("vec_id") % 100 == 0)) == brute(rows, 10)
    huge = [(200, [1e25, 1.0]), (2, [-1e25, 1.0]), (3, [1.0, 1.0])]
    got = result(topk.top_k(spark.createDataFrame(huge, "vec_id long, embedding array<double>"), F.col("vec_id") % 100 == 0))
    assert [r[:3] for r in got] == [(200, 1, 3), (200, 2, 2)] and got[1][3] == -2**63
