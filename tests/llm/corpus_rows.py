"""Rows for the tests of the corpus operators."""

import random

from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"

# columns beyond id and text carry names that the operators use inside
ODD = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("kept", T.StringType()),
    T.StructField("node", T.StringType()), T.StructField("_hash", T.StringType()), T.StructField("content", T.StringType()),
    T.StructField("n_words", T.StringType()), T.StructField("_gone", T.StringType()), T.StructField("ids", T.StringType()),
    T.StructField("_gone_id", T.StringType()), T.StructField("_gone_content", T.StringType()), T.StructField("id", T.StringType()),
    T.StructField("raw", T.StringType()), T.StructField("_text", T.StringType()),
])


def prose(seed: int, n: int, vocabulary: int = 5000) -> str:
    rnd = random.Random(seed)
    return " ".join(f"w{rnd.randrange(vocabulary)}" for _ in range(n))
