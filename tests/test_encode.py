"""Category dictionary, one-hot and first-appearance codes."""

import pandas as pd
import pytest

from featureloom.operators import (CategoryDictionary, CategoryGuardError, factorize, lookup,
                                   one_hot)


@pytest.fixture
def cat_df(spark):
    # first appearance (by id): b, a, c ; alphabetical: a, b, c ; frequency: c, a, b
    rows = [(1, "b", "x"), (2, "a", "x"), (3, None, "x"), (4, "c", "x"), (5, "c", "x"),
            (6, "a", "x"), (7, "c", "x")]
    return spark.createDataFrame(rows, "id long, s string, t string")


def test_one_hot_matches_get_dummies(spark, cat_df):
    out, new = one_hot(cat_df, columns=["s", "t"])
    pdf = cat_df.toPandas()
    exp = pd.get_dummies(pdf, columns=["s", "t"], dummy_na=True, dtype=int)
    assert new == [c for c in exp.columns if c != "id"]
    got = out.orderBy("id").toPandas()
    assert list(got.columns) == list(exp.columns)  # non-encoded first, then dummies
    for c in new:
        assert got[c].tolist() == exp[c].tolist(), c
    # A column without missing values still gets <col>_nan
    assert "t_nan" in new and got["t_nan"].sum() == 0


def test_frozen_dictionary_unseen_value_is_all_zero(spark, cat_df):
    d = CategoryDictionary.discover(cat_df, ["s"])
    assert d["s"] == ["a", "b", "c"]
    scoring = spark.createDataFrame([(9, "zzz"), (10, "a")], "id long, s string")
    out, _ = one_hot(scoring, d, ["s"])
    rows = {r["id"]: r for r in out.collect()}
    assert [rows[9][c] for c in ("s_a", "s_b", "s_c", "s_nan")] == [0, 0, 0, 0]
    assert rows[10]["s_a"] == 1


def test_dictionary_roundtrip(spark, cat_df, tmp_path):
    d = CategoryDictionary.discover(cat_df, ["s", "t"])
    p = str(tmp_path / "dict")
    d.save(spark, p)
    assert CategoryDictionary.load(spark, p).categories == d.categories
    assert CategoryDictionary.from_json(d.to_json()).categories == d.categories


def test_category_guard(spark):
    df = spark.range(50).selectExpr("cast(id as string) as s")
    df = df.selectExpr("'x' as a", "s as b")
    with pytest.raises(CategoryGuardError, match="'b'"):
        CategoryDictionary.discover(df, ["a", "b"], max_categories=10)
    assert len(CategoryDictionary.discover(spark.range(3000).selectExpr("cast(id as string) as s"), ["s"])["s"]) == 3000


def test_case_clash_detected(spark):
    df = spark.createDataFrame([("a",), ("A",)], "s string")
    with pytest.raises(ValueError):
        one_hot(df, columns=["s"])


def test_factorize_first_appearance(spark, cat_df):
    out, dic = factorize(cat_df, ["s"], order_col="id")
    got = [r["s"] for r in out.orderBy("id").collect()]
    exp, _ = pd.factorize(cat_df.orderBy("id").toPandas()["s"])
    assert got == exp.tolist()           # b->0, a->1, NULL->-1, c->2
    assert dic["s"] == {"b": 0, "a": 1, "c": 2}
    _, by_freq = factorize(cat_df, ["s"], order_col="id", order="frequency")
    assert by_freq["s"] == {"c": 0, "a": 1, "b": 2}
    _, by_alpha = factorize(cat_df, ["s"], order_col="id", order="alphabet")
    assert by_alpha["s"] == {"a": 0, "b": 1, "c": 2}


def test_lookup_map(spark, cat_df):
    out = lookup(cat_df, {"a": 1.5, "b": 2.5}, "s", "v")
    got = {r["id"]: r["v"] for r in out.collect()}
    assert got[1] == 2.5 and got[2] == 1.5 and got[3] is None and got[4] is None
