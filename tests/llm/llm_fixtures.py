import random

import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators use inside
        T.StructField("rank", T.StringType()),
        T.StructField("token", T.StringType()),
        T.StructField("size", T.StringType()),
    ]
)


@pytest.fixture
def documents(spark):
    def make(rows, lang=None):
        """rows: (doc_id, text) pairs."""
        filled = [
            (i, t, lang[n] if lang else None, f"src{n % 3}", None if t is None else len(t), "x", None, "z")
            for n, (i, t) in enumerate(rows)
        ]
        return spark.createDataFrame(filled, DOCUMENTS)

    return make


@pytest.fixture
def prose():
    def make(seed, n, vocabulary=4000):
        rng = random.Random(seed)
        return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]

    return make
