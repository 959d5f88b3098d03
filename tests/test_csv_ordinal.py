"""The CSV dialect and its quarantine against pandas; row numbers in file order."""

import glob
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from featureloom.operators import factorize, lookup
from featureloom.sources import BadRowsError, file_ordinal, read_table, write_table

PARTS = ['"', '""', ",", "\n", "\\", '\\"', " ", "a", "b c", "é", "'", "\t", "\r\n", "|", "NA"]
SCHEMA = "k long, s string, t string, x double"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    return [(k, "".join(rng.choices(PARTS, k=rng.randrange(7))), "".join(rng.choices(PARTS, k=rng.randrange(5))),
             rng.choice([None, 1.5, -2.0])) for k in range(2000)]


def cells(df):
    return sorted((r.k, r.s or "", r.t or "", r.x) for r in df.collect())


def test_both_sides_speak_the_dialect_of_pandas(spark, tmp_path, rows):
    write_table(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "ours"), fmt="csv", max_rows_per_file=300)
    assert cells(read_table(spark, str(tmp_path / "ours"), SCHEMA, fmt="csv", null_tokens=("",))) == rows
    files = sorted(glob.glob(f"{tmp_path}/ours/*.csv"))
    assert len(files) >= 4
    theirs = pd.concat([pd.read_csv(f, keep_default_na=False, dtype=str) for f in files])
    assert sorted(zip(theirs.k.astype(int), theirs.s, theirs.t)) == [r[:3] for r in rows]
    pd.DataFrame(rows, columns=list("kstx")).to_csv(tmp_path / "theirs.csv", index=False)
    assert cells(read_table(spark, str(tmp_path / "theirs.csv"), SCHEMA, fmt="csv", null_tokens=("",))) == rows


BROKEN = 'k,s,n\n1,"say ""hi"", you",5\n2,"two\nlines",6\n4,long,7,8,9\n5,short\n6,"a,b",7,\n7, pad ,\n\n8,x\\,9\n'


def test_surplus_cells_raise_or_are_set_aside(spark, tmp_path):
    path, aside = str(tmp_path / "t.csv"), str(tmp_path / "aside")
    (tmp_path / "t.csv").write_text(BROKEN)
    for schema in (None, "k long, s string, n long"):
        with pytest.raises(BadRowsError, match="2 rows"):
            read_table(spark, path, schema, fmt="csv")
    got = read_table(spark, path, "k long, s string, n long", fmt="csv", bad_rows="aside", bad_rows_path=aside)
    assert sorted(map(tuple, got.collect())) == [(1, 'say "hi", you', 5), (2, "two\nlines", 6), (5, "short", None), (7, " pad ", None), (8, "x\\", 9)]
    assert sorted(r.record for r in spark.read.parquet(aside).collect()) == ["4,long,7,8,9", '6,"a,b",7,']
    # columns that are not asked for do not hide a bad row, and the count is right without them
    assert got.select("k").count() == 5
    # split files: a record over two lines is bad, not two rows
    got = read_table(spark, path, "k long, s string, n long", fmt="csv", bad_rows="aside", bad_rows_path=aside, multi_line=False)
    assert sorted(r.k for r in got.collect()) == [1, 5, 7, 8] and spark.read.parquet(aside).count() == 4


@pytest.mark.parametrize("text, sep, n", [
    ("", ",", 1), (",", ",", 2), ("a,b", ",", 2), ('"a,b",c', ",", 2), ('"a""b",', ",", 2), ('"a\nb,",c,d', ",", 3), ("a|b", "|", 2), ("a|b", ",", 1)])
def test_cells_of_a_record(spark, text, sep, n):
    from featureloom.sources.csv_dialect import cell_count
    assert spark.createDataFrame([(text,)], "r string").select(cell_count(F.col("r"), sep)).first()[0] == n


def test_other_headers_in_a_folder_raise(spark, tmp_path):
    for name, text in (("a", "k,s\n1,x\n"), ("b", "s,k\ny,2\n")):
        (tmp_path / f"{name}.csv").write_text(text)
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_table(spark, str(tmp_path), "k long, s string", fmt="csv").collect()


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_ordinals_follow_the_files(spark, tmp_path, fmt):
    order = random.Random(1).sample(range(1000), 1000)
    df = spark.createDataFrame([(i, k, random.Random(k % 7).choice("abc") * (k % 3) or None) for i, k in enumerate(order)], "at long, k long, s string")
    write_table(df.orderBy("at").repartitionByRange(5, "at").sortWithinPartitions("at"), str(tmp_path / "t"), fmt=fmt, max_rows_per_file=90)
    got = read_table(spark, str(tmp_path / "t"), "at long, k long, s string", fmt=fmt, ordinal="n")
    rows = sorted((r.n, r["at"], r.k, r.s) for r in got.collect())
    assert [r[:2] for r in rows] == [(i, i) for i in range(1000)]
    coded, _ = factorize(got, ["s"], order_col="n")
    want, _ = pd.factorize(pd.Series([r[3] for r in rows]))
    assert [r.s for r in coded.orderBy("n").collect()] == want.tolist()
    first = read_table(spark, str(tmp_path / "t"), "at long, k long, s string", fmt=fmt, limit=137)
    assert sorted(r["at"] for r in first.collect()) == list(range(137))


def test_first_rows_of_many_files(spark, tmp_path):
    write_table(spark.range(1000).repartitionByRange(20, "id").sortWithinPartitions("id"), str(tmp_path / "t"))
    first = read_table(spark, str(tmp_path / "t"), limit=60)
    assert sorted(r.id for r in first.collect()) == list(range(60))
    assert read_table(spark, str(tmp_path / "t"), limit=5000).count() == 1000
    assert read_table(spark, str(tmp_path / "t"), limit=0).count() == 0


def test_one_split_file_keeps_its_order(spark, tmp_path):
    (tmp_path / "big.csv").write_text("k,s\n" + "".join(f"{k},{'x' * 50}\n" for k in range(20_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        raw = spark.read.option("header", True).csv(str(tmp_path / "big.csv"))
        assert raw.rdd.getNumPartitions() > 3
        assert file_ordinal(raw, "n").where("n <> cast(k as long)").count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_large_mappings_are_joined_by_key(spark, monkeypatch):
    monkeypatch.setattr("featureloom.operators.encode.BROADCAST_ROWS", 2)
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("z", 4)], "s string, n int")
    got = lookup(df, {"a": 1, "b": 2.5, "c": 3}, "s", "v")
    assert sorted(((r.n, r.v) for r in got.collect())) == [(1, 1.0), (2, 2.5), (3, None), (4, None)]
    assert lookup(df, {}, "s", "v").where("v is null").count() == 4
