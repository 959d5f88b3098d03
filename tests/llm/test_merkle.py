import random
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from featureloom.llm import merkle

from .conftest import CLASHING

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(text):
    return sha256(text.encode()).hexdigest()


def levels(digests, fanout):
    out = [digests]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i:i + fanout])) for i in range(0, len(out[-1]), fanout)])
    return out


def brute(rows, fanout=8):
    """(doc_id, leaf, subroot, root, proof) of every row, by plain lists."""
    groups = {}
    for r in rows:
        leaf = h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r))
        groups.setdefault(r[2], []).append((r[0], leaf))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[g] = levels([x[1] for x in groups[g]], fanout)
    upper = levels([trees[g][-1][0] for g in names], fanout)
    out = []
    for gi, g in enumerate(names):
        for i, (doc, leaf) in enumerate(groups[g]):
            proof = []
            for tree, k in ((trees[g], i), (upper, gi)):
                for nodes in tree[:-1]:
                    a = k // fanout * fanout
                    proof.append(("".join(nodes[a:k]), "".join(nodes[k + 1:a + fanout])))
                    k //= fanout
            out.append((doc, leaf, trees[g][-1][0], upper[-1][0], proof))
    return sorted(out, key=repr)


def made(n, seed=2):
    rng = random.Random(seed)
    return [(rng.choice([None, *range(n)]), rng.choice(["a", None, "é"]), rng.choice(["en", "de", None, "zz", "", "é"]),
             rng.choice([None, 5]), rng.choice(["Text é", None, "", str(i)])) for i in range(n)]


def frame(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    for c in (*CLASHING, "tree", "place", "size", "digest", "block", "proof", "root", "key", "x0", "at", "part"):
        df = df.withColumn(c, F.lit("other"))
    return df.repartition(3)


def rows_of(df):
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, [tuple(p) for p in r.proof]) for r in df.collect()), key=repr)


@pytest.mark.parametrize("n, fanout, height", [(1, 8, 4), (9, 8, 4), (500, 8, 4), (300, 8, 1), (200, 2, 3)])
def test_proofs_equal_brute_force(spark, n, fanout, height):
    rows = made(n)
    rows += rows[:n // 10]  # repeated rows
    got = merkle.manifest(frame(spark, rows), FIELDS, "lang", "doc_id", fanout=fanout, levels=height)
    assert rows_of(got) == brute(rows, fanout)


def test_an_empty_table_has_no_rows(spark):
    assert merkle.manifest(frame(spark, []), FIELDS, "lang", "doc_id").collect() == []


def test_folding_finds_changed_rows(spark):
    rows = made(200, 5) + [(1000, "s", "en", 3, "long " * 100_000)]
    changed = F.when(F.col("doc_id") % 2 == 0, merkle.leaf_digest(*map(F.col, FIELDS[:-1]), F.concat("text", F.lit("!"))))
    got = merkle.manifest(frame(spark, rows), FIELDS, "lang", "doc_id", others={"changed": changed})
    got = got.withColumn("same", merkle.fold(F.col("leaf"), F.col("proof")) == F.col("root")) \
        .withColumn("found", merkle.fold(F.coalesce("changed", "leaf"), F.col("proof")) != F.col("root")).collect()
    assert len(got) == len(rows) and all(r.same for r in got)
    assert all(r.found == (r.changed is not None and r.changed != r.leaf) for r in got) and any(r.found for r in got)


def test_query_counts(spark, tmp_path):
    from featureloom.llm.queries import QUERIES
    rows = [(i, "s", "en" if i % 3 else None, 4, "Text" if i % 2 else "text") for i in range(100)]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in QUERIES["op12_merkle_manifest"](spark, str(tmp_path)).collect()}
    import zlib
    want = {r[0]: (r[1], r[2], r[3], h("".join(a + b for a, b in r[4]))) for r in brute(rows)}
    for doc, r in got.items():
        assert (r.leaf, r.subroot, r.root, r.proof_sha256) == want[doc]
        assert r.verified == (r.folded_root == r.root) == (zlib.crc32(str(doc).encode()) % 3 != 0 or doc % 2 == 0)
