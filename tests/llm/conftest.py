from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(rng, n, letters="abcdefghijklmnop"):
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(2, 9))) for _ in range(n)]


def sentences(rng, n):
    out = []
    while n > 0:
        k = min(n, rng.randrange(6, 14))
        out.append(" ".join(words(rng, k)).capitalize() + ".")
        n -= k
    return " ".join(out)


def odd_texts():
    """Texts with every odd case: NULL, empty, blank, short, long, ties, copies, odd white space and letters."""
    rng = random.Random(3)
    base = [sentences(rng, rng.randrange(20, 200)) for _ in range(40)]
    near = [t.replace(t.split()[30 % len(t.split())], "changed", 1) for t in base[:10]]
    long = sentences(rng, 4000)
    return [None, "", "  \n\t ", "a", "one two", "the the the the the the the", *base, *base[:5], *near, long, long + " end",
            "é漢字🙂 \x1c x\x85y  z\n\n w", "I" * 5000]


def document_rows():
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(odd_texts())]
    return rows + [rows[10], rows[10], (None, rows[12][1], None, None, None), (None, None, None, None, None),
                   (7, rows[20][1], "en", "s", 1)]


@pytest.fixture(scope="module")
def odd(spark):
    """The odd documents, with columns that clash with names the operators use themselves."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(document_rows(), SCHEMA)
    for name in ("rank", "spans", "leaks", "log_weight", "row", "h", "_key", "part", "size", "score"):
        df = df.withColumn(name, F.lit("x"))
    return df


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small():
    """The smallest folder of shared tables."""
    return "/root/testdata/sf0.001"
