import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from brute import words

DOCS = "doc_id long, text string, lang string, source string, n_chars long, n int, sig string, kind string, score double"


def row(i, text, source="s"):
    """A document with columns whose names clash with those that the operators use within."""
    return (i, text, "en", source, len(text or ""), 1, "x", "y", 0.5)


@pytest.fixture(scope="session")
def make(spark):
    return lambda texts, source="s": spark.createDataFrame([row(i, t, source if isinstance(source, str) else source[i]) for i, t in texts], DOCS)


@pytest.fixture(scope="session")
def corpus():
    """Copies exact and near, a shared passage, nulls, empty and long texts, repeated lines."""
    rnd = random.Random(11)
    t = {}
    for i in range(40):
        t[i] = " ".join(words(rnd, rnd.choice([1, 2, 5, 30, 80, 200])))
    for i in range(40, 60):
        t[i] = t[rnd.randrange(40)]
    base = words(rnd, 240)
    for i in range(60, 90):
        w = list(base)
        for _ in range(rnd.randrange(6)):
            w[rnd.randrange(240)] = "edit%d" % rnd.randrange(9)
        t[i] = " ".join(w)
    passage = words(rnd, 55)
    for i in range(90, 100):
        t[i] = " ".join(words(rnd, rnd.randrange(60)) + passage + words(rnd, rnd.randrange(60)))
    t |= {100: None, 101: "", 102: " \n\t ", 103: "One", 104: "one", 105: "a b", 106: "A  B", 107: "a b c d e\n" * 40, 108: " ".join(words(rnd, 20_000)), 109: "é 世 🌍 ###", 110: "a b c d e\n" * 40}
    return t
