import random

import pytest
from corpus_rows import ODD, prose


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows):
        full = [(i, t, "en", s, None if t is None else len(t), "k", "n", "h", "c", "w", "g", "i", "a", "b", "d", "r", "t")
                for i, t, s in rows]
        return spark.createDataFrame(full, ODD)
    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empties, ties, repeated rows, a long text, shared passages, near copies; (doc_id, text, source)."""
    rnd = random.Random(5)
    passage = prose(1, 60)
    base = prose(2, 300).split()
    rows = [(0, None, "s0"), (1, "", "s1"), (2, "  \n\t ", None), (3, "One", "s1"), (4, "one", "s2"), (5, "one two three", None),
            (6, prose(3, 90) + " " + passage + " " + prose(4, 50), "s3"), (7, passage, "s4"), (7, passage, "s4"),
            (8, passage.replace(" ", " \n "), "s5"), (9, prose(6, 4000, 40), "s6"), (10, "a " * 400, "s7"),
            (11, "x" * 5000, "s8"), (12, "Ünïcode  naïve 日本語 😀 <|endoftext|> a\x1cb", "s9"),
            (13, "token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\" and AKIA" + "Q7" * 9 + " pwd", "s1"),
            (14, "API_KEY: 'abc.def-12' secret=short token=xy password = hunter22", "s2"),
            (None, "no id here", "s1"), (None, None, None), (None, "one two three", "s3")]
    for k in range(45):
        near = list(base)
        for _ in range(rnd.randrange(0, 9)):
            near[rnd.randrange(len(near))] = f"e{rnd.randrange(10**6)}"
        rows.append((100 + k, " ".join(near), f"s{k % 12}"))
    rows += [(200 + k, f"Common line of all sites.\n{prose(300 + k, 12)}\n\n common line two \n", f"s{k}") for k in range(13)]
    rows += [(300, "Common line of all sites.", None), (301, rows[-1][1], "s0")]
    return rows


@pytest.fixture(scope="session")
def odd(make_docs, odd_rows):
    return make_docs(odd_rows)


@pytest.fixture(scope="session")
def none(make_docs):
    return make_docs([])
