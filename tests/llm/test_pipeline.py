import corpus_pipeline
from featureloom.llm import decontaminate, secrets_scan, toxicity
from featureloom.llm.queries import ORACLE_SQL, QUERIES

from .conftest import prose
from .test_decontaminate import brute as brute_hits
from .test_neardup import brute as brute_groups


def tables(spark, tmp):
    base = prose(1, 120).split()
    rows = [(i, prose(i, 80)) for i in range(1, 200)]
    rows += [(300, " ".join(base)), (301, " ".join(base)), (302, " ".join(base[:60] + ["other"] + base[60:])),
             (303, prose(700, 30) + " " + " ".join(prose(900, 12).split()) + " " + prose(701, 30)),
             (304, prose(702, 40) + ' password = "hunter2hunter2"'), (305, None), (306, "")]
    for d in range(400, 460):
        words = prose(d, 60).split()
        for k in range(0, 60, 12):
            words[k] = "nitwit" if d % 2 else "cretin"
        rows.append((d, " ".join(words)))
    docs = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(f"{tmp}/documents.parquet")
    spark.createDataFrame([(d, 1, int(400 <= d < 460)) for d, _ in rows if d < 300 or d >= 400], "doc_id long, quality int, toxic int") \
        .write.parquet(f"{tmp}/labels.parquet")
    spark.createDataFrame([(1, prose(900, 12))], "item_id long, text string").write.parquet(f"{tmp}/benchmark.parquet")
    return rows


def test_stages_equal_brute_force(spark, tmp_path):
    rows = tables(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = docs.columns
    kept = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, str(tmp_path))
        if k < 4:
            assert docs.columns == columns
            path = f"{tmp_path}/{name}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
        kept[name] = docs.collect()
    left = {n: {r.doc_id for r in v} for n, v in kept.items()}
    assert left["toxicity"] == {d for d, _ in rows if not 400 <= d < 460}
    groups = brute_groups([(r.doc_id, r.text) for r in kept["toxicity"]], 5, 80)
    assert left["near_duplicates"] == {d for d, _, c, _ in groups if d == c}
    assert 300 in left["near_duplicates"] and not {301, 302} & left["near_duplicates"]
    before = {r.doc_id: r.text for r in kept["near_duplicates"]}
    for r in kept["decontamination"]:
        hit = brute_hits(before[r.doc_id], [(1, prose(900, 12))])[1]
        words = decontaminate.words_of(before[r.doc_id])
        assert decontaminate.words_of(r.text) == [w for k, w in enumerate(words) if k not in hit]
        assert hit or r.text == before[r.doc_id]
    before = {r.doc_id: r.text for r in kept["decontamination"]}
    for r in kept["secrets"]:
        spans = secrets_scan.base_spans(before[r.doc_id] or "")
        assert (r.text == before[r.doc_id]) == (not spans) and "hunter2" not in (r.text or "")
    assert left["sentencepiece"] == left["secrets"] == left["near_duplicates"]
    assert all(r.round_trip for r in kept["sentencepiece"])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(left["sentencepiece"])


def test_near_duplicates_of_repeated_and_null_ids(spark):
    a, b, c, e = (prose(s, 80) for s in (801, 802, 803, 804))
    rows = [(1, a), (5, a + " more"), (5, b), (5, b), (7, c), (7, c + " more"), (None, e), (None, e), (None, e + " more"),
            (None, a), (8, ""), (8, ""), (None, ""), (None, "")]
    docs = spark.createDataFrame([(*r, k % 2) for k, r in enumerate(rows)], "doc_id long, text string, other long").repartition(3)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    got = [(r.doc_id, r.text.removesuffix(" more")) for r in kept.collect()]
    want = [(1, a), (5, b), (7, c), (None, e), (8, ""), (8, ""), (None, ""), (None, "")]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_toxicity_stage_drops_what_op10_calls_toxic(spark, tmp_path, monkeypatch):
    tables(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for score, toxic in ((0.29, 0), (0.3, 1), (0.4, 1)):  # a model without trees gives every text its prior
        monkeypatch.setattr(toxicity, "train", lambda *_: toxicity.ToxicityModel(score))
        assert {r.predicted for r in QUERIES["op10_toxicity"](spark, str(tmp_path)).collect()} == {toxic}
        assert corpus_pipeline.drop_toxic(spark, docs, str(tmp_path)).count() == (0 if toxic else docs.count())


def test_all_queries_are_registered():
    import __spark_entry__ as entry
    names = entry.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names
    assert set(QUERIES) <= set(names) and set(ORACLE_SQL) <= set(entry.oracle_sql())


def test_columns_named_like_inner_ones(spark, tmp_path):
    names = ["__items", "__spans", "__n_words", "__base", "__runs", "__hist", "__id", "__hash", "__toxicity", "c", "n", "n_", "row", "id", "y",
             "fold", "score", "chunk", "word"]
    tables(spark, f"{tmp_path}/plain")
    plain = spark.read.parquet(f"{tmp_path}/plain/documents.parquet")
    more = plain.selectExpr("*", *(f"concat('{c}', doc_id) as `{c}`" for c in names)).unionAll(
        plain.where("doc_id = 300").selectExpr("*", *(f"concat('{c}', doc_id) as `{c}`" for c in names)))  # a repeated row
    docs = more
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:4]):
        out = stage(spark, docs, f"{tmp_path}/plain")
        assert out.columns == docs.columns
        plain = stage(spark, plain, f"{tmp_path}/plain")
        for path, df in ((f"{tmp_path}/{name}", out), (f"{tmp_path}/{name}-plain", plain)):
            df.write.parquet(path)
        docs, plain = spark.read.parquet(f"{tmp_path}/{name}"), spark.read.parquet(f"{tmp_path}/{name}-plain")
        rows = docs.collect()
        assert all(r[c] == f"{c}{r.doc_id}" for r in rows for c in names)
        if name != "toxicity":  # the repeated row is gone
            assert sorted((r.doc_id, r.text or "") for r in rows) == sorted((r.doc_id, r.text or "") for r in plain.collect())
    last = corpus_pipeline.STAGES[4][1](spark, docs, f"{tmp_path}/plain")
    assert last.count() == len(rows)
