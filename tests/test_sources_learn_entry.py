"""Sources / sinks (S1-S7), the k-fold learner (L1-L10) and the driver contract."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from featureloom.learn.gbdt import kfold_gbt
from featureloom.operators import observe_shape
from featureloom.sources import CREDIT_SCHEMAS, cast_columns, read_table, write_table

from .conftest import SF


def test_csv_scan_with_na_tokens(spark, tmp_path):
    p = tmp_path / "bb.csv"
    p.write_text("SK_ID_BUREAU,MONTHS_BALANCE,STATUS\n1,0,C\n1,NA,XNA\n2,-1,NA\n2,,\n3,-2,N/A\n")
    df = read_table(spark, str(p), CREDIT_SCHEMAS["bureau_balance"], fmt="csv")
    rows = [tuple(r) for r in df.orderBy("SK_ID_BUREAU", F.col("MONTHS_BALANCE").desc_nulls_last()).collect()]
    assert rows[1] == (1, None, "XNA")          # NA -> missing, XNA is a value (N15)
    assert rows[2][2] is None and rows[3] == (2, None, None) and rows[4][2] is None
    capped = read_table(spark, str(p), CREDIT_SCHEMAS["bureau_balance"], fmt="csv", limit=2,
                        order_by=["SK_ID_BUREAU"])
    assert capped.count() == 2                   # S2


def test_sink_roundtrip_and_casts(spark, tmp_path):
    df = spark.createDataFrame([(1, 40000, 1.5), (2, -3, 2.25)], "k long, m int, x double")
    c = cast_columns(df, {"m": "int16", "x": "float16"})
    assert dict(c.dtypes) == {"k": "bigint", "m": "smallint", "x": "float"}
    safe = cast_columns(df, {"m": "int16"}, safe=True)   # 40000 overflows smallint -> NULL
    assert [r["m"] for r in safe.orderBy("k").collect()] == [None, -3]
    out = str(tmp_path / "out_csv")
    write_table(df, out, fmt="csv")
    back = spark.read.option("header", True).csv(out)
    assert sorted(back.columns) == ["k", "m", "x"] and back.count() == 2   # S3: no index column
    obs_df, obs = observe_shape(df, "shape")
    obs_df.write.format("noop").mode("overwrite").save()
    assert obs.get["rows"] == 2                                            # S7


def test_kfold_gbt_planted_signal(spark):
    rng = np.random.default_rng(7)
    n = 600
    x1 = rng.normal(size=n)
    y = (x1 + 0.3 * rng.normal(size=n) > 0).astype(int)
    rows = [(i, float(a), float(b), (None if i % 5 == 0 else int(t)))
            for i, (a, b, t) in enumerate(zip(x1, rng.normal(size=n), y))]
    rows = [(i, None if i % 17 == 0 else a, b, t) for i, a, b, t in rows]   # missing features
    frame = spark.createDataFrame(rows, "SK_ID_CURR long, x1 double, noise double, TARGET int")
    res = kfold_gbt(frame, key="SK_ID_CURR", n_folds=3, max_iter=8, max_depth=3,
                    min_instances_per_node=5, top_k_features=1)
    auc = res.full_auc.first()["auc"]
    assert auc > 0.8
    assert res.fold_auc.count() == 3
    sub = res.submission.collect()
    assert len(sub) == n // 5 and all(0 <= r["TARGET"] <= 1 for r in sub)
    assert res.oof.count() == n - n // 5
    imp = {r["feature"]: r["importance"] for r in res.importances.where("fold = 1").collect()}
    assert imp["x1"] > imp["noise"]
    assert {r["feature"] for r in res.top_importances.collect()} == {"x1"}


def test_patience_goes_past_flat_rounds():
    from featureloom.learn.metrics import best_round
    assert best_round([0.9, 0.8, 0.8, 0.7, 0.75, 0.76], 3) == 4     # a flat round does not end it
    assert best_round([0.9, 0.8, 0.8, 0.8, 0.1], 2) == 2            # two rounds without gain do
    assert best_round([0.5], 5) == 1


def test_trained_queries_run_the_whole_learner(spark, monkeypatch):
    from featureloom.learn import gbdt
    from featureloom.learn.boosting import BoostParams
    from featureloom.plans import catalog
    calls = []

    class Stop(Exception):
        pass

    def record(*args):
        calls.append(args[-1])
        raise Stop
    monkeypatch.setattr(gbdt, "boost_folds", record)
    for name in ("gbdt_kfold", "credit_model"):
        with pytest.raises(Stop):
            catalog.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert calls == [BoostParams()] * 2  # the library's rounds, leaves, depth and patience
    assert BoostParams().rounds >= 100 and BoostParams().patience < BoostParams().rounds


def test_patience_path_keeps_the_best_round(spark):
    rng = np.random.default_rng(5)
    rows = [(i, float(x), None if i % 5 == 0 else int(x + rng.normal() > 0)) for i, x in enumerate(rng.normal(size=300))]
    frame = spark.createDataFrame(rows, "SK_ID_CURR long, x1 double, TARGET int")
    res = kfold_gbt(frame, key="SK_ID_CURR", n_folds=2, max_iter=6, max_depth=2, min_instances_per_node=5, patience=20, parallelism=2)
    got = res.submission.collect()
    assert len(got) == 60 and all(0 <= r["TARGET"] <= 1 for r in got) and res.full_auc.first()["auc"] > 0.7


def test_entry_contract(spark):
    import __spark_entry__ as E
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs)
    from featureloom.plans.catalog import ORACLE_SQL, QUERIES
    assert set(QUERIES) <= set(qs) and set(ORACLE_SQL) <= set(sqls)
    assert set(QUERIES) - set(ORACLE_SQL) == {"gbdt_kfold", "credit_model"}
    df = E.entry(spark)
    assert df.count() > 0 and "SK_ID_CURR" in df.columns
    assert df.select("SK_ID_CURR").distinct().count() == df.count()   # one row per applicant


@pytest.mark.parametrize("name", ["subset_views", "category_rate", "roc_auc", "roc_auc_by_fold", "kfold_assign", "csv_roundtrip",
                                  "bureau_rates_full", "bureau_rates_fanout", "category_share_long", "group_median_lookup"])
def test_queries_against_duckdb_small(spark, name):
    """The registered queries against their DuckDB oracle on sf0.001."""
    import duckdb

    import __spark_entry__ as E
    con = duckdb.connect()
    for t in ("customer", "orders", "lineitem", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t + '.parquet')}')")
    got = E.queries()[name](spark, SF).toPandas()
    exp = con.execute(E.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(exp.columns)
    cols = sorted(got.columns)

    def norm(v):
        if v is None or (isinstance(v, float) and v != v):
            return None
        return float(v) if isinstance(v, (int, float, np.number)) and not isinstance(v, bool) else v

    def key(df):
        vals = df[cols].astype(object).where(df[cols].notna(), None).values.tolist()
        return sorted(repr(tuple(norm(v) for v in row)) for row in vals)
    assert key(got) == key(exp)


def test_csv_reads_every_column_by_name(spark, tmp_path):
    p = tmp_path / "prev.csv"
    # file order differs from the schema, has extra columns and lacks declared ones
    p.write_text("EXTRA,AMT_CREDIT,SK_ID_CURR,HOUR_APPR_PROCESS_START,FLAG_X,RATIO,EMPTY\n"
                 "z,10.5,7,3.0,1,0.5,NA\nq,NA,8,,0,2,\n")
    schema = CREDIT_SCHEMAS["previous_application"]
    df = read_table(spark, str(p), schema, fmt="csv")
    assert df.columns == schema.fieldNames() + ["EXTRA", "FLAG_X", "RATIO", "EMPTY"]
    kinds = dict(df.dtypes)
    assert [kinds[c] for c in ("EXTRA", "FLAG_X", "RATIO", "EMPTY")] == ["string", "bigint", "double", "double"]
    rows = {r["SK_ID_CURR"]: r for r in df.collect()}
    assert rows[7]["AMT_CREDIT"] == 10.5 and rows[7]["HOUR_APPR_PROCESS_START"] == 3
    assert rows[8]["AMT_CREDIT"] is None and rows[7]["DAYS_DECISION"] is None
    assert (rows[7]["EXTRA"], rows[7]["FLAG_X"], rows[8]["RATIO"]) == ("z", 1, 2.0)


def test_csv_cells_are_never_changed_silently(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text("a,b,c\n-10.7,3000000000,x\n2,1,y\n")
    df = read_table(spark, str(p), "a int, b int, c string", fmt="csv")
    assert dict(df.dtypes) == {"a": "double", "b": "bigint", "c": "string"}      # widened, nothing cut
    assert df.where("a = -10.7 and b = 3000000000").count() == 1
    p.write_text("a\n1\noops\n")
    with pytest.raises(ValueError, match="'a': 1 of 2"):
        read_table(spark, str(p), "a int", fmt="csv")


def test_nan_reads_as_missing(spark, tmp_path):
    spark.sql("select double('NaN') as v union all select 1d").write.parquet(str(tmp_path / "t"))
    assert read_table(spark, str(tmp_path / "t")).where("v is null").count() == 1


def test_checkpoint_folder_must_be_shared_on_a_cluster():
    from types import SimpleNamespace

    from featureloom.session import ensure_checkpoint_dir
    none = SimpleNamespace(get=lambda *a: None)
    for master, raises in (("spark://h:7077", True), ("local-cluster[2,1,1024]", True)):
        sc = SimpleNamespace(master=master, getCheckpointDir=lambda: None, getConf=lambda: none)
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc, conf=none))



def test_kfold_gbt_stratified_folds(spark):
    rng = np.random.default_rng(5)
    n = 300
    x = rng.normal(size=n)
    y = (x > 0.8).astype(int)            # imbalanced labels
    rows = [(i, float(a), int(t)) for i, (a, t) in enumerate(zip(x, y))]
    frame = spark.createDataFrame(rows, "SK_ID_CURR long, x double, TARGET int")
    res = kfold_gbt(frame, key="SK_ID_CURR", n_folds=3, stratified=True, max_iter=3,
                    max_depth=2, min_instances_per_node=2, parallelism=3)
    per_fold = {r["fold"]: (r["n_pos"], r["n_neg"]) for r in res.fold_auc.collect()}
    pos = [p for p, _ in per_fold.values()]
    neg = [q for _, q in per_fold.values()]
    assert max(pos) - min(pos) <= 1 and max(neg) - min(neg) <= 1   # exactly balanced per label
    assert res.submission.count() == 0                               # no unlabelled rows
