"""The similarity join against all pairs."""

import random
import re

import numpy as np
import pytest

from wardbook.llm import ngram_join
from wardbook.llm.components import components


def shingles(text, n):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def roots(nodes, edges):
    root = {x: x for x in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {x: find(x) for x in nodes}


def expected(rows, n, percent):
    sets = [(i, shingles(t, n)) for i, t in rows]
    edges = []
    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if a and b and 0.8 * len(a) <= len(b) <= 1.25 * len(a) or a == b and a:
                if 100 * len(a & b) >= percent * len(a | b):
                    edges.append((i, j))
    root = roots({i for i, _ in rows}, edges)
    return sorted((i, len(s), root[i] if s else i) for i, s in sets)


def near_copies(rng, n_docs, first_id, length, edits):
    base = [f"w{rng.randrange(3000)}" for _ in range(length)]
    for k in range(n_docs):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        yield first_id + k, " ".join(w)


@pytest.fixture(scope="module")
def rows(corpus):
    rng = random.Random(5)
    out = [r for r in corpus if r[0] != 150] + [(300 + i, t) for i, t in [(0, "One Two"), (1, "one two"), (2, "one  TWO\n"), (3, "one")]]
    return out + list(near_copies(rng, 60, 400, 120, 7)) + list(near_copies(rng, 40, 500, 40, 3))


@pytest.mark.parametrize("n, percent, block", [(4, 85, 256), (5, 80, 16)])
def test_join(spark, rows, monkeypatch, n, percent, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(tuple(r) for r in ngram_join.joined(docs, n, percent).collect())
    assert got == expected(rows, n, percent)
    assert len({r[2] for r in got}) < len(got) - 50


def test_rows_without_use(spark):
    schema = "doc_id long, text string, n_shingles string"
    assert ngram_join.joined(spark.createDataFrame([], schema)).count() == 0
    docs = spark.createDataFrame([(None, "a b c", "x"), (1, "a b c", "x"), (2, "A B C", None), (3, None, None), (3, None, None)], schema)
    got = sorted((tuple(r) for r in ngram_join.joined(docs).collect()), key=str)
    assert got == sorted([(None, 1, None), (1, 1, 1), (2, 1, 1), (3, 0, 3), (3, 0, 3)], key=str)
    kept = ngram_join.one_per_group(docs)
    assert kept.columns == docs.columns and sorted(map(str, (r.doc_id for r in kept.collect()))) == ["1", "3", "3", "None"]


def test_divide_skip():
    rng = random.Random(2)
    base = rng.sample(range(10**6), 80)
    sets = [sorted(set(base[: rng.randrange(60, 80)]) | set(rng.sample(range(10**6), rng.randrange(15)))) for _ in range(40)]
    sets += [sorted(rng.sample(range(10**6), 30)) for _ in range(10)]
    sets.sort(key=len)
    for percent in (60, 85):
        index = ngram_join.DivideSkip([np.array(s) for s in sets], percent)
        got = {(r, m, o) for r in range(len(sets)) for m, o in index.search(r, lambda m: True)}
        want = set()
        for r, a in enumerate(sets):
            for m in range(r + 1, len(sets)):
                o = len(set(a) & set(sets[m]))
                if 100 * o >= percent * (len(a) + len(sets[m]) - o):
                    want.add((r, m, o))
        assert got == want and want


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(100, 140)] + [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(120)] + [(7, x) for x in range(2000, 2050)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = roots({x for e in edges for x in e}, edges)
    assert {k: v for k, v in want.items() if k in got} == got and all(want[k] == k for k in set(want) - set(got))
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
