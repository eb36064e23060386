"""Licence marks: notice phrases and identifier tags found by Aho-Corasick, expressions by shunting-yard.

A text's words (digits, a-z after lower-casing A-Z, and whatever is beyond ASCII) are joined by single blanks,
for all documents of a step at once, and one Aho-Corasick automaton of all phrases reads the result, so the
time does not depend on the number of phrases. A match that runs from one document into the next is none.

An identifier tag ("SPDX-License-Identifier:", "License:") is followed in the text itself by an expression of
identifiers, parentheses and the operators ``with``, ``and``, ``or`` (binding in this order, in any case). Its
longest beginning that is complete is put into postfix order by two stacks and evaluated: every licence has a
restriction from 0 (none) to 1 (no use at all), ``or`` takes the lesser of two, ``and`` the greater, and an
exception after ``with`` takes a quarter off. A document's score is its greatest restriction.
"""

import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardbook.llm import spans as S


class Phrase(NamedTuple):
    """``words`` as they are compared, joined by blanks. A base phrase is reported apart from the others."""

    words: str
    label: str
    restriction: float
    base: bool = False


FREE, PERMISSIVE, ATTRIBUTION, WEAK, STRONG, NO_TRADE, RESERVED, UNKNOWN = 0.0, 0.1, 0.2, 0.4, 0.7, 0.8, 1.0, 0.5

# The phrases of known notices.
BASE = [
    Phrase("cc by", "cc-by", ATTRIBUTION, True),
    Phrase("general public license", "gpl", STRONG, True),
    Phrase("all rights reserved", "reserved", RESERVED, True),
]
NOTICES = [
    Phrase("apache license", "apache", PERMISSIVE),
    Phrase("apache license version 2 0", "apache-2.0", PERMISSIVE),
    Phrase("mit license", "mit", PERMISSIVE),
    Phrase("permission is hereby granted free of charge to any person obtaining a copy", "mit", PERMISSIVE),
    Phrase("bsd license", "bsd", PERMISSIVE),
    Phrase("redistribution and use in source and binary forms", "bsd", PERMISSIVE),
    Phrase("isc license", "isc", PERMISSIVE),
    Phrase("permission to use copy modify and or distribute this software for any purpose", "isc", PERMISSIVE),
    Phrase("boost software license", "bsl-1.0", PERMISSIVE),
    Phrase("zlib license", "zlib", PERMISSIVE),
    Phrase("gnu general public license", "gpl", STRONG),
    Phrase("gnu general public license version 2", "gpl-2.0", STRONG),
    Phrase("gnu general public license version 3", "gpl-3.0", STRONG),
    Phrase("gnu affero general public license", "agpl", STRONG),
    Phrase("gnu lesser general public license", "lgpl", WEAK),
    Phrase("gnu library general public license", "lgpl", WEAK),
    Phrase("gnu free documentation license", "gfdl", STRONG),
    Phrase("mozilla public license", "mpl", WEAK),
    Phrase("eclipse public license", "epl", WEAK),
    Phrase("creative commons attribution", "cc-by", ATTRIBUTION),
    Phrase("cc by sa", "cc-by-sa", WEAK),
    Phrase("cc by nd", "cc-by-nd", NO_TRADE),
    Phrase("cc by nc", "cc-by-nc", NO_TRADE),
    Phrase("cc by nc sa", "cc-by-nc-sa", NO_TRADE),
    Phrase("cc by nc nd", "cc-by-nc-nd", NO_TRADE),
    Phrase("cc0 1 0 universal", "cc0-1.0", FREE),
    Phrase("free and unencumbered software released into the public domain", "unlicense", FREE),
    Phrase("dedicated to the public domain", "public-domain", FREE),
    Phrase("proprietary and confidential", "proprietary", RESERVED),
]
# Known identifiers, by restriction.
IDENTIFIERS = {
    FREE: "0bsd cc0-1.0 unlicense wtfpl pddl-1.0",
    PERMISSIVE: "mit mit-0 apache-1.1 apache-2.0 bsd-2-clause bsd-3-clause bsd-3-clause-clear bsd-4-clause isc zlib bsl-1.0 python-2.0 psf-2.0 "
    "ncsa postgresql x11 unicode-3.0 ms-pl artistic-2.0 afl-3.0 blueoak-1.0.0 openssl php-3.01 w3c",
    ATTRIBUTION: "cc-by-2.0 cc-by-2.5 cc-by-3.0 cc-by-4.0 odc-by-1.0 ofl-1.1",
    WEAK: "lgpl-2.0-only lgpl-2.0-or-later lgpl-2.1 lgpl-2.1-only lgpl-2.1-or-later lgpl-3.0 lgpl-3.0-only lgpl-3.0-or-later mpl-1.1 mpl-2.0 "
    "epl-1.0 epl-2.0 cddl-1.0 cddl-1.1 eupl-1.1 eupl-1.2 ms-rl cc-by-sa-2.0 cc-by-sa-2.5 cc-by-sa-3.0 cc-by-sa-4.0 odbl-1.0 osl-3.0",
    STRONG: "gpl-1.0-only gpl-1.0-or-later gpl-2.0 gpl-2.0-only gpl-2.0-or-later gpl-3.0 gpl-3.0-only gpl-3.0-or-later agpl-3.0 agpl-3.0-only "
    "agpl-3.0-or-later gfdl-1.2-only gfdl-1.3-only gfdl-1.3-or-later sspl-1.0",
    NO_TRADE: "cc-by-nc-3.0 cc-by-nc-4.0 cc-by-nc-sa-3.0 cc-by-nc-sa-4.0 cc-by-nc-nd-3.0 cc-by-nc-nd-4.0 cc-by-nd-3.0 cc-by-nd-4.0 busl-1.1",
}
RESTRICTION = {name: value for value, names in IDENTIFIERS.items() for name in names.split()}
# After the first tag any identifier counts, after the others only known ones.
TAGS = ["spdx license identifier", "license", "licence", "license expression"]
_PRECEDENCE = {"with": 3, "and": 2, "or": 1}
_EXCEPTION_FACTOR = 0.75

_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True
_AFTER_TAG = re.compile(rb"[ \t\"'*]*[:=][ \t\"'*]*")
_TOKEN = re.compile(rb"[ \t]*(?:([()])|([A-Za-z0-9][A-Za-z0-9.+-]*))")


class Expression(NamedTuple):
    text: str
    labels: tuple[str, ...]
    restriction: float


def tokens(raw: bytes, at: int, end: int) -> Iterator[str]:
    """Parentheses and lower-case words from a place on, up to the first other character. A word that ends in a
    full stop or a dash is the last one."""
    while m := _TOKEN.match(raw, at, end):
        own = (m[1] or m[2]).decode()
        whole = own.rstrip(".-")
        yield whole.lower()
        if whole != own:
            return
        at = m.end()


def complete(found: Iterator[str], known_only: bool) -> list[str]:
    """The longest beginning that is a complete expression."""
    taken, end, depth, operand, plain = [], 0, 0, True, False
    for token in found:
        if operand:
            if token == "(" and not plain:
                depth += 1
            elif token in "()" or token in _PRECEDENCE or known_only and not plain and token not in RESTRICTION:
                break
            else:
                operand = False
        elif token in _PRECEDENCE:
            # What follows ``with`` is the name of an exception, and what it follows a licence's.
            operand, plain = True, token == "with"
            if plain and (taken[-1] == ")" or taken[-2:-1] == ["with"]):
                break
        elif token == ")" and depth:
            depth -= 1
        else:
            break
        taken.append(token)
        if token not in _PRECEDENCE:
            plain = False
        if not operand and not depth:
            end = len(taken)
    return taken[:end]


def postfix(infix: list[str]) -> list[str]:
    """Shunting-yard: operands as they come, operators after their operands."""
    out, held = [], []
    for token in infix:
        if token == "(":
            held.append(token)
        elif token == ")":
            while held[-1] != "(":
                out.append(held.pop())
            held.pop()
        elif token in _PRECEDENCE:
            while held and held[-1] != "(" and _PRECEDENCE[held[-1]] >= _PRECEDENCE[token]:
                out.append(held.pop())
            held.append(token)
        else:
            out.append(token)
    return out + held[::-1]


def evaluated(infix: list[str]) -> Expression:
    stack: list[tuple[frozenset[str], float]] = []
    for token in postfix(infix):
        if token not in _PRECEDENCE:
            stack.append((frozenset([token]), RESTRICTION.get(token.removesuffix("+"), UNKNOWN)))
            continue
        (b, second), (a, first) = stack.pop(), stack.pop()
        if token == "with":
            stack.append((a, first * _EXCEPTION_FACTOR))
        else:
            stack.append((a | b, min(first, second) if token == "or" else max(first, second)))
    labels, restriction = stack.pop()
    return Expression(" ".join(infix).replace("( ", "(").replace(" )", ")"), tuple(sorted(labels)), restriction)


@lru_cache(2)
def _automaton(phrases: tuple[Phrase, ...]) -> tuple[ahocorasick.Automaton, list[tuple[str, list[Phrase]]]]:
    """Finds each distinct run of words; what it may stand for is in the list."""
    by_words: dict[str, list[Phrase]] = {}
    for p in phrases:
        by_words.setdefault(p.words, []).append(p)
    for tag in TAGS:
        by_words.setdefault(tag, [])
    known, automaton = list(by_words.items()), ahocorasick.Automaton()
    for i, (words, _) in enumerate(known):
        automaton.add_word(f" {words} ", i)
    automaton.make_automaton()
    return automaton, known


def words_of(t: S.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the words, each document's first one, and the lower-cased bytes."""
    data = S.lower_ascii(t.data)
    start, end = S.edges(_WORD[data], t.offsets)
    return start, end, np.searchsorted(start, t.offsets), data


def matches(data: np.ndarray, start: np.ndarray, end: np.ndarray, automaton) -> Iterator[tuple[int, int]]:
    """Each match as its last word and the number of its run of words."""
    n = end - start + 1
    joined = np.append(data, np.uint8(32))[S.ranges(start, n)]
    after = np.cumsum(n)  # the blank after each word, with one blank in front of all
    joined[after - 1] = 32
    found = list(automaton.iter(" " + joined.tobytes().decode("latin-1")))
    places = np.searchsorted(after, np.array([e for e, _ in found], np.int64))
    return zip(places.tolist(), (i for _, i in found))


def _scan(t: S.Texts, phrases: tuple[Phrase, ...]):
    """Per document: number of words, marks (label, first word, words, base) and expressions."""
    automaton, known = _automaton(phrases)
    start, end, first, data = words_of(t)
    marks: list[list[tuple[str, int, int, bool, float]]] = [[] for _ in range(len(t))]
    expressions: list[list[Expression]] = [[] for _ in range(len(t))]
    raw = t.data.tobytes()
    for last, i in matches(data, start, end, automaton):
        words, own = known[i]
        n = words.count(" ") + 1
        doc = int(np.searchsorted(first, last, "right")) - 1
        at = last - n + 1 - int(first[doc])
        if at < 0:
            continue  # it began in the document before
        marks[doc] += [(p.label, at, n, p.base, p.restriction) for p in own]
        if words in TAGS and (m := _AFTER_TAG.match(raw, int(end[last]), int(t.offsets[doc + 1]))):
            infix = complete(tokens(raw, m.end(), int(t.offsets[doc + 1])), known_only=words != TAGS[0])
            if infix:
                expressions[doc].append(evaluated(infix))
    return np.diff(first), marks, expressions


def score(marks: list[tuple[str, int, int, bool, float]], expressions: list[Expression]) -> float:
    """The greatest restriction; a phrase within a longer one says nothing of its own."""
    most, reach = max([0.0, *(x.restriction for x in expressions)]), 0
    for _, at, n, _, restriction in sorted(marks, key=lambda m: (m[1], -m[2])):
        if at + n > reach:
            most, reach = max(most, restriction), at + n
    return most


_MARK = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("base", pa.bool_())])
_EXPRESSION = pa.struct([("text", pa.string()), ("labels", pa.list_(pa.string())), ("restriction", pa.float64())])
_SCHEMA = (
    "doc_id long, n_words long, marks array<struct<label: string, first_word: long, n_words: long, base: boolean>>, "
    "expressions array<struct<text: string, labels: array<string>, restriction: double>>, score double"
)


def scanned(docs: DataFrame, phrases: list[Phrase] = [*BASE, *NOTICES]) -> DataFrame:  # noqa: B006
    """Per row of ``docs`` (``doc_id`` and ``text`` are used): ``doc_id``, ``n_words``, ``marks`` (every place of
    a phrase: label, first word from 0, number of words, whether it is a base phrase), ``expressions`` (text,
    labels and restriction of every tag's) and ``score``, 0 without any.

    A null or empty text has no words and no marks; equal rows are each returned; an empty table gives no rows. A
    tag without a complete expression on its line stands for nothing. Documents are scanned whole; nothing is
    shuffled.
    """
    table = tuple(phrases)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in S.texts(batches):
            n, marks, expressions = _scan(t, table)
            scores = [score(m, x) for m, x in zip(marks, expressions)]
            yield S.with_column(
                t.rows, n_words=n.astype(np.int64), marks=pa.array([[dict(zip(_MARK.names, m)) for m in own] for own in marks], pa.list_(_MARK)),
                expressions=pa.array([[x._asdict() for x in own] for own in expressions], pa.list_(_EXPRESSION)), score=pa.array(scores, pa.float64()),
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _SCHEMA)


def _listed(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")


def digest(found: DataFrame) -> DataFrame:
    """Of ``scanned``: ``doc_id``, ``n_words``, ``n_base`` (places of base phrases), ``first_word`` and
    ``last_word`` (where the first and the last of them start, or null), ``base_labels``, ``labels`` (all labels;
    both distinct, sorted and joined by commas, empty without any) and ``score``."""
    rows = found.withColumn("base", F.filter("marks", lambda m: m["base"]))
    return rows.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min("base.first_word").alias("first_word"),
        F.array_max("base.first_word").alias("last_word"), _listed(F.col("base.label")).alias("base_labels"),
        _listed(F.concat(F.col("marks.label"), F.flatten("expressions.labels"))).alias("labels"), "score",
    )
