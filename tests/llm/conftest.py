import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, key string, rank int, row string"


def make_docs(spark, rows):
    """Documents with columns whose names the operators also use."""
    full = [(i, t, "en", s, len(t or ""), 7, "k", 1, "r") for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture(scope="session")
def make(spark):
    return lambda rows: make_docs(spark, rows)


@pytest.fixture(scope="session")
def docs(spark):
    """Null, empty, blank, very long, repeated and tied rows, near and exact copies."""
    rnd = random.Random(3)
    words = ["w%d" % i for i in range(400)] + ["Élan", "naïve", "日本", "don't", "x_y", "42", "a.b", "No."]
    rows = [(1, None, "a"), (2, "", "a"), (3, " \t\n", None), (4, "ABC def", "b"), (5, "abc DEF", "b")]
    rows += [(6, "É abc", "b"), (7, "é abc", "c"), (8, "one", "c"), (8, "one", "c"), (None, "one", None)]
    base = [rnd.choice(words) for _ in range(300)]
    for i in range(10, 90):
        text = list(base) if i < 40 else [rnd.choice(words) for _ in range(rnd.randint(1, 200))]
        for _ in range(i % 4 if i < 40 else 0):
            text[rnd.randrange(len(text))] = rnd.choice(words)
        rows.append((i, " ".join(text), "abcd"[i % 4]))
    rows.append((90, " ".join(rnd.choice(words) for _ in range(60_000)), "a"))
    return make_docs(spark, rows).repartition(5)
