import random

import pytest


def words_of(rng, n, vocabulary=5000):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


@pytest.fixture(scope="session")
def corpus():
    """Rows (doc_id, text) with copies, shared passages, runs of one word, odd spaces, nulls and ties."""
    rng = random.Random(3)
    passages = [words_of(rng, n) for n in (49, 50, 51, 60, 75, 120)]
    rows = []
    for i in range(150):
        w = words_of(rng, rng.choice([0, 1, 3, 20, 49, 50, 80, 200]))
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(w) + 1)
            p = rng.choice(passages)
            w[at:at] = p[rng.randrange(8) : len(p) - rng.randrange(8)] if rng.random() < 0.3 else p
        rows.append((i, rng.choice([" ", "  ", "\n", "\t "]).join(w)))
    base = words_of(rng, 150)
    for i in range(150, 190):
        w = list(base)
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = "edit"
        rows.append((i, " ".join(w)))
    rows += [(190 + i, "again " * (55 + i)) for i in range(4)]
    rows += [(200 + i, " ".join(["a", "b"] * (30 + i))) for i in range(4)]
    rows += [(210, None), (211, ""), (212, "  \n"), (213, "Ünï cödé 漢字 " * 30), (214, "Ünï cödé 漢字 " * 31)]
    rows += [(220, rows[3][1]), (221, rows[150][1]), (222, rows[150][1]), (150, rows[150][1]), (-5, rows[160][1])]
    return rows


@pytest.fixture(scope="session")
def corpus_frame(spark, corpus):
    return spark.createDataFrame(corpus, "doc_id long, text string").repartition(5)
