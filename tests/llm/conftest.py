import random

import pytest

#: Names that operators use inside; a table may hold them as columns.
CLASHING = ("id", "h", "n", "cls", "sig", "bucket", "word", "ids", "score", "node", "comp", "places", "name", "matches", "y", "fold")


def prose(seed, words=200, vocabulary=4000):
    rng = random.Random(seed)
    syllables = ["the", "an", "er", "in", "ou", "tion", "le", "ré", "sch", "ó", "be", "st"]
    return " ".join("".join(rng.choices(syllables, k=1 + rng.randrange(vocabulary) % 3)) for _ in range(words))


def edge_rows():
    long = prose(5, 30_000)
    base = prose(1)
    words = base.split()
    near = " ".join(words[:100] + ["changed"] + words[101:])
    return [(None, None), (None, base), (1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, "one two"), (6, base), (7, base),
            (7, base), (8, near), (9, long), (10, prose(2)), (11, prose(3)), (7, prose(4)), (12, base.upper())]


def frame(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for c in CLASHING:
        df = df.selectExpr("*", f"'{c}' as `{c}`")
    return df


@pytest.fixture(scope="session")
def edge_docs(spark):
    return frame(spark, edge_rows()).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return frame(spark, [])
