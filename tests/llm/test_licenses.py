"""Licence marks against a plain search, and expressions against a recursive evaluation."""

import random
import re

import pytest

from wardbook.llm import licenses, queries
from wardbook.llm.licenses import BASE, NOTICES, PERMISSIVE, RESERVED, RESTRICTION, STRONG, UNKNOWN, WEAK

PHRASES = [*BASE, *NOTICES]
SCHEMA = "doc_id long, text string"


def split(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def plain(text):
    w = split(text)
    return len(w), sorted((p.label, i, n, p.base) for p in PHRASES for n in [len(p.words.split())] for i in range(len(w)) if " ".join(w[i : i + n]) == p.words)


def base(text):
    n, found = plain(text)
    found = [m for m in found if m[3]]
    at = [m[1] for m in found]
    return n, len(found), min(at, default=None), max(at, default=None), ",".join(sorted({m[0] for m in found}))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    parts = [p.words for p in PHRASES] + ["cc by cc by", "CC-BY 4.0", "All Rights, Reserved.", "all rights", "reserved", "General\nPublic\tLicense", "gnu lesser"]
    out = [(None, "cc by"), (None, None), (1, None), (2, ""), (3, " \n.,"), (4, "all rights reserved"), (4, "all rights reserved"), (5, "É CC BY é"), (6, "écc by")]
    out += [(7, "general public"), (8, "license cc"), (9, "by all rights"), (-3, "reserved"), (10, "word " * 60_000 + "CC BY"), (11, "cc\x7fby\x80x 漢字")]
    for i in range(20, 320):
        out.append((i, rng.choice([" ", "-", "\n", ". "]).join(rng.choice([*parts, "x1", "Wörter", "by", "cc"]) for _ in range(rng.randrange(12)))))
    return out


def test_query_against_a_plain_search(spark, rows, tmp_path):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    docs.selectExpr("*", "'x' AS marks", "1 AS score").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op12_license_scan(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    got = got.collect()
    assert sorted(str(tuple(r[:6])) for r in got) == sorted(str((i, *base(t))) for i, t in rows)
    for r in got:
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1
    assert (sum(r.score for r in got if not r.labels)) == 0


def test_marks(spark, rows):
    got = licenses.scanned(spark.createDataFrame(rows, SCHEMA).coalesce(1)).collect()
    assert sorted(str((r.doc_id, r.n_words, sorted(map(tuple, r.marks)))) for r in got) == sorted(str((i, *plain(t))) for i, t in rows)


def test_empty_table(spark):
    assert licenses.digest(licenses.scanned(spark.createDataFrame([], SCHEMA))).count() == 0


@pytest.mark.parametrize(
    ("text", "labels", "score"),
    [
        ("Released under the MIT License.", "mit", PERMISSIVE),
        ("Licensed under the Apache License, Version 2.0.", "apache,apache-2.0", PERMISSIVE),
        ("This work is licensed under the GNU General Public License, version 3.", "gpl,gpl-3.0", STRONG),
        ("the GNU Lesser General Public License", "gpl,lgpl", WEAK),
        ("# SPDX-License-Identifier: MIT OR GPL-3.0-only", "gpl-3.0-only,mit", PERMISSIVE),
        ("SPDX-License-Identifier: MIT AND GPL-3.0-only", "gpl-3.0-only,mit", STRONG),
        ("SPDX-License-Identifier: GPL-2.0-or-later WITH Classpath-exception-2.0", "gpl-2.0-or-later", STRONG * 0.75),
        ("/* SPDX-License-Identifier: (mit or isc) and MPL-2.0 */", "isc,mit,mpl-2.0", WEAK),
        ("SPDX-License-Identifier: LicenseRef-own", "licenseref-own", UNKNOWN),
        ('"license": "MIT",', "mit", PERMISSIVE),
        ("License: see the file", "", 0.0),
        ("License: MIT or later versions", "mit", PERMISSIVE),
        ("License MIT", "", 0.0),
        ("License: \nMIT", "", 0.0),
        ("License: MIT. All rights reserved", "mit,reserved", RESERVED),
        ("SPDX-License-Identifier: (MIT OR", "", 0.0),
        ("SPDX-License-Identifier: MIT) OR ISC", "mit", PERMISSIVE),
    ],
)
def test_notices_and_tags(text, labels, score):
    import pyarrow as pa

    t = next(licenses.S.texts([pa.RecordBatch.from_pydict({"text": [text]})]))
    _, marks, found = licenses._scan(t, tuple(PHRASES))
    assert ",".join(sorted({m[0] for m in marks[0]} | {x for e in found[0] for x in e.labels})) == labels
    assert licenses.score(marks[0], found[0]) == pytest.approx(score)


def random_expression(rng, depth):
    if depth == 0 or rng.random() < 0.25:
        name = rng.choice([*RESTRICTION, "own-1.0"])
        value = RESTRICTION.get(name, UNKNOWN)
        return (f"{name} with {rng.choice(['e1', 'e2'])}", value * 0.75, {name}, 3) if rng.random() < 0.3 else (name, value, {name}, 4)
    op = rng.choice(["and", "or"])
    a, b = (random_expression(rng, depth - 1) for _ in range(2))
    own = 2 if op == "and" else 1
    texts = [f"({x[0]})" if x[3] < own or rng.random() < 0.2 and x[3] != 4 else x[0] for x in (a, b)]
    return f"{texts[0]} {op} {texts[1]}", (max if op == "and" else min)(a[1], b[1]), a[2] | b[2], own


def test_random_expressions():
    rng = random.Random(2)
    for _ in range(400):
        text, value, labels, _ = random_expression(rng, rng.randrange(6))
        raw = "".join(rng.choice([c, c.upper()]) for c in text).replace(" ", rng.choice([" ", "  ", "\t"])).encode()
        infix = licenses.complete(licenses.tokens(raw, 0, len(raw)), known_only=False)
        found = licenses.evaluated(infix)
        assert (found.text, found.labels) == (text, tuple(sorted(labels))) and found.restriction == pytest.approx(value)


def test_deep_and_long_expressions():
    for raw in (b"(" * 50_000 + b"mit" + b")" * 50_000, b" or ".join([b"gpl-3.0"] * 50_000 + [b"mit"])):
        infix = licenses.complete(licenses.tokens(raw, 0, len(raw)), known_only=True)
        assert licenses.evaluated(infix).restriction == PERMISSIVE
    raw = b"(" * 50_000 + b"mit"
    assert licenses.complete(licenses.tokens(raw, 0, len(raw)), known_only=True) == []
