"""Quality rules by distribution divergence.

A language's reference is the histogram of character classes and of its common words over all its documents.
A document is compared with its language's reference, which is joined to it, by the Jensen-Shannon distance (square
root of the divergence in bits) of both histograms. Short documents and small languages, whose histograms say
little, are guarded by minimum lengths. Plain counts (words, symbols, repeated
lines and words) stand beside the verdict.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardbook.llm import spans as S
from wardbook.llm.scratch import stored

# The classes of a text's characters, by their first byte.
CLASSES = ["lower", "upper", "digit", "space", "stop", "sign", "symbol", "beyond_ascii", "control"]
_SYMBOLS = b"#*$%&|<>"
_CLASS = np.full(256, 8, np.int64)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 0, 1, 2
_CLASS[list(b" \t\n\r\x0b\x0c")] = 3
_CLASS[list(b".,;:?")] = 4
_CLASS[list(b"!\"'()-/@+=[\\]^_`{}~")] = 5
_CLASS[list(_SYMBOLS)] = 6
_CLASS[192:] = 7
_SKIPPED = 9  # the later bytes of a character
_CLASS[128:192] = _SKIPPED

REPEAT_WINDOW = 8
COMMON_WORDS = 64
# The documents of a language with fewer characters or words in all are not judged by that histogram.
REFERENCE_CHARS, REFERENCE_WORDS = 4000, 1000
# A task reports its counts when it holds so many distinct words, and at its end.
HELD_WORDS = 1 << 20


@dataclass(frozen=True)
class Limits:
    """Distances over these fail; a histogram of fewer characters or words is not judged."""

    class_distance: float = 0.28
    word_distance: float = 0.40
    min_chars: int = 400
    min_words: int = 100


@dataclass
class Reference:
    classes: np.ndarray  # shares
    words: np.ndarray  # sorted hashes of common words
    word_shares: np.ndarray  # of these, and of the rest
    judges_classes: bool  # whether the language has characters enough
    judges_words: bool


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Between rows of shares."""
    m = (p + q) / 2

    def bits(a):
        return np.sum(np.where(a > 0, a * np.log2(np.where(a > 0, a, 1) / np.where(m > 0, m, 1)), 0), axis=-1)

    return np.sqrt(np.maximum(0, (bits(p) + bits(q)) / 2))


def _shares(counts: np.ndarray) -> np.ndarray:
    return counts / np.maximum(1, counts.sum(axis=-1, keepdims=True))


def _lower(t: S.Texts) -> S.Words:
    return S.words(t, S.lower_ascii(t.data))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts of a task: rows (lang, kind, key, n) of documents, characters by class and words."""
    classes, docs, words = {}, {}, {}

    def rows(name: str, kind: str, key: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(key), 1 << 16):
            k, c = key[at : at + (1 << 16)], n[at : at + (1 << 16)]
            cols = [pa.array([name] * len(k)), pa.array([kind] * len(k)), pa.array(k, pa.int64()), pa.array(c, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, names=["lang", "kind", "key", "n"])

    def reported() -> Iterator[pa.RecordBatch]:
        for name in words:
            hashes, n = _summed(words[name])
            yield from rows(name, "word", hashes.view(np.int64), n)
            yield from rows(name, "words", np.zeros(1, np.int64), n.sum(keepdims=True))
        words.clear()

    for t in S.texts(batches):
        lang = t.rows.column(t.rows.schema.get_field_index("lang")).to_numpy(zero_copy_only=False)
        names, which = np.unique(lang.astype(str), return_inverse=True)
        by_class = S.histogram(t, _CLASS[t.data], len(CLASSES) + 1)
        w = _lower(t)
        word_lang = np.repeat(which, w.counts)
        for i, name in enumerate(names):
            classes[name] = classes.get(name, 0) + by_class[which == i].sum(axis=0)
            docs[name] = docs.get(name, 0) + int((which == i).sum())
            words.setdefault(name, []).append(np.unique(w.hash[word_lang == i], return_counts=True))
            if len(words[name]) >= 16:
                words[name] = [_summed(words[name])]
        if sum(len(h) for parts in words.values() for h, _ in parts) > HELD_WORDS:
            yield from reported()
    yield from reported()
    for name in docs:
        yield from rows(name, "class", np.arange(len(CLASSES)), classes[name][: len(CLASSES)])
        yield from rows(name, "docs", np.zeros(1, np.int64), np.array([docs[name]]))


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    hashes, at = np.unique(np.concatenate([h for h, _ in parts]), return_inverse=True)
    return hashes, np.bincount(at, np.concatenate([n for _, n in parts]), len(hashes)).astype(np.int64)


def _lang(docs: DataFrame) -> Column:
    """Null is a language of its own."""
    return (F.coalesce(F.col("lang").cast("string"), F.lit("")) if "lang" in docs.columns else F.lit("")).alias("lang")


def references(docs: DataFrame) -> DataFrame:
    """From all of ``docs`` (``text``, and ``lang`` if there is one): ``lang`` and ``reference`` (whole counts of classes
    and common words, and of all characters and words), a row of about a kilobyte for each language that is judged."""
    own = docs.select(_lang(docs), "text").filter("text is not null")
    counts = own.mapInArrow(_counts, "lang string, kind string, key long, n long")
    counts = counts.groupBy("lang", "kind", "key").agg(F.sum("n").alias("n"))
    place = F.row_number().over(W.partitionBy("lang", "kind").orderBy(F.desc("n"), "key"))
    best = counts.withColumn("place", place).filter(F.col("place") <= COMMON_WORDS)
    of = lambda kind, what: F.when(F.col("kind") == kind, what)
    pairs = [F.collect_list(of(kind, F.struct("key", "n"))).alias(name) for kind, name in (("class", "classes"), ("word", "words"))]
    sums = [F.coalesce(F.sum(of(kind, F.col("n"))), F.lit(0)).alias(name) for kind, name in (("class", "n_chars"), ("words", "n_words"))]
    found = best.groupBy("lang").agg(*pairs, *sums).filter((F.col("n_chars") >= REFERENCE_CHARS) | (F.col("n_words") >= REFERENCE_WORDS))
    return stored(found.select("lang", F.struct("classes", "words", "n_chars", "n_words").alias("reference")), "references")


def _reference(row: dict) -> Reference:
    classes = np.zeros(len(CLASSES))
    for c in row["classes"]:
        classes[c["key"]] = c["n"]
    words = np.array([x["key"] for x in row["words"]], np.int64).view(np.uint64)
    n, order = np.array([x["n"] for x in row["words"]], np.int64), np.argsort(words)
    shares = np.append(n[order], max(0, row["n_words"] - n.sum())) / max(1, row["n_words"])
    return Reference(_shares(classes), words[order], shares, row["n_chars"] >= REFERENCE_CHARS, row["n_words"] >= REFERENCE_WORDS)


def _repeat_words(w: S.Words) -> np.ndarray:
    """Per document: words in windows that occur twice or more in it."""
    start, hashes = S.windows(w, REPEAT_WINDOW, 41)
    if not len(start):
        return np.zeros(len(w.first) - 1, np.int64)
    hashes = S.mix(hashes + w.doc()[start].astype(np.uint64), 42)
    order = np.argsort(hashes)
    ranked = hashes[order]
    equal = ranked[1:] == ranked[:-1]
    again = np.zeros(len(start), bool)
    again[order] = np.append(equal, False) | np.append(False, equal)
    step = np.zeros(len(w) + 1, np.int64)
    np.add.at(step, start[again], 1)
    np.add.at(step, start[again] + REPEAT_WINDOW, -1)
    return S.segment_sums(np.cumsum(step)[:-1] > 0, w.first)


def _dup_lines(t: S.Texts, w: S.Words) -> np.ndarray:
    """Per document: lines with a word that equal an earlier line."""
    if not len(t.data):
        return np.zeros(len(t), np.int64)
    start, end = S.edges(t.data != 10, t.offsets)
    has_word = np.searchsorted(w.start, start) < np.searchsorted(w.start, end)
    start, end = start[has_word], end[has_word]
    doc = np.searchsorted(t.offsets, start, "right") - 1
    hashes = S.span_hash(t.data, start, end, 43)
    order = np.lexsort((hashes, doc))
    equal = (doc[order][1:] == doc[order][:-1]) & (hashes[order][1:] == hashes[order][:-1])
    return np.bincount(doc[order][1:][equal], minlength=len(t))


def _word_distance(w: S.Words, rows: np.ndarray, hashes: np.ndarray, shares: np.ndarray) -> np.ndarray:
    n = w.counts[rows]
    own = w.hash[S.ranges(w.first[rows], n)]
    at = np.minimum(np.searchsorted(hashes, own), max(0, len(hashes) - 1))
    bins = np.where(hashes[at] == own, at, len(hashes)) if len(hashes) else np.zeros(len(own), np.int64)
    bins = bins + np.repeat(np.arange(len(rows)) * len(shares), n)
    return js_distance(_shares(np.bincount(bins, minlength=len(rows) * len(shares)).reshape(len(rows), -1)), shares[None])


def distances(t: S.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Each document's distance from its language's ``reference``, by classes and by words (0 without one), its characters,
    and whether that language judges classes and words."""
    counts = S.histogram(t, _CLASS[t.data], len(CLASSES) + 1)[:, : len(CLASSES)]
    shares, w = _shares(counts), _lower(t)
    by_class, by_word = np.zeros((2, len(t)))
    judges_classes, judges_words = np.zeros((2, len(t)), bool)
    column = t.rows.column(t.rows.schema.get_field_index("reference"))
    _, at, which = np.unique(t.column("lang").astype(str), return_index=True, return_inverse=True)
    for i, one in enumerate(at.tolist()):
        if column[one].is_valid:
            ref, rows = _reference(column[one].as_py()), np.flatnonzero(which == i)
            by_class[rows] = js_distance(shares[rows], ref.classes[None])
            by_word[rows] = _word_distance(w, rows, ref.words, ref.word_shares)
            judges_classes[rows], judges_words[rows] = ref.judges_classes, ref.judges_words
    return by_class, by_word, counts.sum(axis=1), judges_classes, judges_words


def _judge(limits: Limits):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in S.texts(batches):
            w = S.words(t)
            n = w.counts
            # Code points are bytes that don't continue one; ASCII white space lies between the words.
            word_chars = S.segment_sums((_CLASS[t.data] != _SKIPPED) & (_CLASS[t.data] != 3), t.offsets)
            symbols = S.segment_sums(_CLASS[t.data] == 6, t.offsets)
            repeats = _repeat_words(w)
            failed = (n < 20) | (100 * repeats > 30 * n)
            by_class, by_word, chars, judges_classes, judges_words = distances(t)
            odd = judges_classes & (chars >= limits.min_chars) & (by_class > limits.class_distance)
            odd |= judges_words & (n >= limits.min_words) & (by_word > limits.word_distance)
            yield S.with_column(
                t.rows, ("text", "lang", "reference"), n_words=n.astype(np.int64), word_chars=word_chars, n_symbols=symbols,
                n_dup_lines=_dup_lines(t, w), n_repeat_words=repeats, base_failed=failed, kept=~failed & ~odd,
                class_distance=by_class, word_distance=by_word,
            )

    return run


_VERDICT = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "kept boolean, class_distance double, word_distance double"
)


def _with_references(docs: DataFrame, *columns: Column | str) -> DataFrame:
    """The ``columns`` and ``lang`` beside the language's ``reference`` or null. References are joined, so that Spark
    broadcasts them if they are small."""
    return docs.select(*columns, _lang(docs)).join(references(docs), "lang", "left")


def judged(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text`` and, if there, ``lang`` are used): ``doc_id``, the counts
    ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines`` and ``n_repeat_words``, ``base_failed`` (under
    20 words, or over 30 % of them in repeated windows of 8), ``kept`` and the two distances.

    Words end at ASCII white space. A null text has no words and fails; equal rows are judged alike; a text
    under both minimum lengths, or of a language whose texts have too few characters and words for a
    reference, is judged by the counts alone (in the latter case with distances of 0); a null ``lang`` is a language
    of its own; an empty table gives no rows.
    """
    rows = _with_references(docs, F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_judge(limits), f"doc_id long, {_VERDICT}")


def kept(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The rows of ``docs`` that ``judged`` keeps, with all their columns."""
    row = F.struct("*").alias("row")
    verdict = docs.select(row, F.lit(True).alias("kept")).schema

    def run(batches):
        for out in _judge(limits)(batches):
            yield out.select(["row", "kept"]).filter(out.column(out.schema.get_field_index("kept")))

    return _with_references(docs, row).mapInArrow(run, verdict).select("row.*")
