import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

KIND = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text) or (doc_id, text, source), over a few partitions."""

    def build(rows, partitions=3):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None) for r in rows]
        return spark.createDataFrame(full, KIND).repartition(partitions)

    return build


# NULL, empty and blank texts, repeated rows, a NULL key, letters beyond ASCII, one long text.
ODD = [
    (1, None), (2, ""), (3, " \t\n "), (4, "a"), (4, "a"), (None, "no key here"), (5, "Ünï çödé 中文 \U0001f600"),
    (6, "word " * 30_000), (7, "same words over again"), (8, "same words over again"), (9, "x" * 5_000),
]


@pytest.fixture(scope="session")
def odd(make, spark):
    """The cases above with columns whose names operators use inside."""
    docs = make(ODD)
    for name in ("row", "print", "size", "norm", "order", "sender", "start", "length", "times", "a.b"):
        docs = docs.withColumn(name, docs["lang"])
    return docs


@pytest.fixture(scope="session")
def empty(make):
    return make([])


@pytest.fixture(scope="session")
def sample(spark):
    """The smallest documents table as a frame and as plain pairs."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return docs, [(r["doc_id"], r["text"] or "", r["source"]) for r in docs.collect()]


@pytest.fixture(scope="session")
def small(spark):
    """The smallest documents with short texts, for brute force."""
    from pyspark.sql import functions as F

    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumn("text", F.substring("text", 1, 1500))
