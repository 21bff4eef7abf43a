import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that the operators use themselves
    T.StructField("score", T.StringType()), T.StructField("held_out", T.IntegerType()), T.StructField("size", T.StringType()),
    T.StructField("row", T.StringType()), T.StructField("ranges", T.IntegerType()), T.StructField("shard", T.StringType()),
    T.StructField("fp", T.StringType()), T.StructField("copies", T.StringType()), T.StructField("c0", T.StringType()),
])


def prose(seed: int, n: int, words: str = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu") -> str:
    r = random.Random(seed)
    return " ".join(r.choice(words.split()) + str(r.randrange(1000)) for _ in range(n))


def row(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, len(text) if text is not None else None,
            "x", 1, "s", "r", 5, "sh", "f", "c", "c0")


LONG = prose(99, 40_000)
COPY = prose(7, 120)
EDGE = [
    row(1, None), row(2, ""), row(3, "  \n\t "), row(4, "one"), row(5, LONG), row(6, COPY), row(7, COPY), row(8, COPY),
    row(9, prose(9, 80), None, None), row(9, prose(9, 80), None, None),            # a repeated row
    row(10, prose(10, 30) + " " + COPY), row(None, prose(11, 60)), row(None, None, None, None),
    row(12, "!!! ### 123"), row(13, "Licensed under CC BY-NC 4.0. All rights reserved. " + prose(13, 60), "de", "b"),
    *[row(20 + i, prose(100 + i, 60), "en" if i % 2 else "fr", "b" if i % 3 else "c") for i in range(20)],
]


@pytest.fixture(scope="session")
def edge_docs(spark):
    return spark.createDataFrame(EDGE, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
