"""Periodic runs of words, by maximal pairs.

A run is a stretch of words with a period that fits into it twice and that no neighbouring word continues. Two
places whose common continuation is ``n`` words, with different words before them, are a maximal pair; if their
distance ``q`` is at most ``n``, the ``q + n`` words from the first one on have period ``q`` and end on both
sides. So the maximal pairs whose distance meets the length constraints are the runs, and nothing has to be
extended. (Multiples of a run's period give the same stretch again; the smallest one is its period.)

Per step of documents:

1. Words become numbers, and suffixes get ranks by their first 1, 2, 4, ... words (prefix doubling), for all
   documents of the step at once; a suffix whose rank nothing shares is left alone from then on. The kept
   ranks give the common prefix of any two suffixes.
2. A place can only be in such a pair if its longest common prefix reaches at least to the nearest place that
   begins alike. Hardly any place of an ordinary text is left by this.
3. The others, in suffix order, are the leaves of a tree of LCP intervals, which is built bottom-up. A node
   holds its places in order, and in lists by the word before them. Where a child joins its node, its places
   meet only those within reach whose word before is another one, whichever is shorter to walk: the places in
   reach or the lists. The smaller side is put into the larger.

Such pairs are at most a few for each word, as the exponents of all runs of a text sum up to no more.
"""

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardbook.llm import spans as S

LEAST = 12
_RUNS = "array<struct<start: long, length: long, period: long>>"


class Suffixes:
    """Ranks of the suffixes of several sequences by their first 1, 2, 4, ... members."""

    def __init__(self, number: np.ndarray, first: np.ndarray):
        n = len(number)
        self.doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
        end = np.repeat(first[1:], np.diff(first))
        rank, active = np.zeros(n, np.int64), np.arange(n)
        second, width = number, 0
        base = self.doc * (int(number.max(initial=0)) + 1)
        self.levels: list[tuple[int, np.ndarray]] = []
        self.shared: dict[int, np.ndarray] = {}  # places whose first so many members another one has too
        while len(active):
            if width:
                after = active + width
                inside = after < end[active]
                second = np.zeros(len(active), np.int64)
                second[inside] = rank[after[inside]] + 1
                base = rank[active] * (n + 1)
            key = base + second
            order = np.argsort(key, kind="stable")
            key, active = key[order], active[order]
            new = np.append(True, key[1:] != key[:-1])
            group = np.append(True, base[order][1:] != base[order][:-1]) if width else np.append(True, np.zeros(len(active) - 1, bool))
            place = np.arange(len(active))
            # A rank is the place of its first member among all suffixes.
            step = np.maximum.accumulate(np.where(new, place, 0)) - np.maximum.accumulate(np.where(group, place, 0))
            fresh = rank.copy()
            fresh[active] += step
            rank = fresh
            width = max(1, 2 * width)
            self.levels.append((width, np.append(rank, -1)))
            several = ~new | ~np.append(new[1:], True)
            active = np.sort(active[several])
            self.shared[width] = active
        self.rank = rank

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Lengths of the common prefixes of the suffixes at ``a`` and ``b``, pair by pair."""
        out = np.zeros(len(a), np.int64)
        for width, rank in reversed(self.levels):
            out += np.where(rank[a + out] == rank[b + out], width, 0)
        return out

    def ranks_of(self, width: int) -> np.ndarray:
        return dict(self.levels)[width]


def _reaching(suffixes: Suffixes, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Places that can be in a pair, in suffix order, and the common prefix of each with the one before."""
    none = np.zeros(0, np.int64)
    shortest = (least + 1) // 2
    width = 4 if shortest >= 4 else 2 if shortest >= 2 else 1
    places = suffixes.shared.get(width, none)
    if len(places) < 2:
        return none, none
    # The nearest place that begins with the same words.
    begin = suffixes.ranks_of(width)[places]
    order = np.argsort(begin, kind="stable")
    gap = np.where(begin[order][1:] == begin[order][:-1], np.diff(places[order]), np.iinfo(np.int64).max)
    nearest = np.empty(len(places), np.int64)
    nearest[order] = np.minimum(np.append(gap, np.iinfo(np.int64).max), np.append(np.iinfo(np.int64).max, gap))
    order = np.argsort(suffixes.rank[places], kind="stable")
    places, nearest = places[order], nearest[order]
    lcp = suffixes.common(places[1:], places[:-1])
    longest = np.maximum(np.append(lcp, 0), np.append(0, lcp))
    places = places[longest >= np.maximum(nearest, shortest)]
    if len(places) < 2:
        return none, none
    return places, np.append(0, suffixes.common(places[1:], places[:-1]))


class _Node:
    """Places in order, and in order by the word before them."""

    __slots__ = ("places", "before")

    def __init__(self, place: int, before: list[int]):
        self.places, self.before = [place], {before[place]: [place]}


def maximal_pairs(places: list[int], lcp: list[int], before: list[int], least: int) -> dict[tuple[int, int], int]:
    """Start and length of each run and its period. ``places`` are in suffix order, ``lcp`` are the common
    prefixes with the place before, and ``before`` has the number of the word before each place."""
    runs: dict[tuple[int, int], int] = {}
    shortest = (least + 1) // 2

    def pair(x: int, y: int, depth: int) -> None:
        period = abs(x - y)
        if period + depth >= least:
            key = (min(x, y), period + depth)
            if runs.get(key, period) >= period:
                runs[key] = period

    def joined(a, b, depth: int):
        a, b = (x if isinstance(x, _Node) else _Node(x, before) for x in (a, b))
        if len(a.places) < len(b.places):
            a, b = b, a
        if depth >= shortest:
            for x in b.places:
                own = before[x]
                lo, hi = bisect_left(a.places, x - depth), bisect_right(a.places, x + depth)
                if hi - lo <= len(a.before):
                    for y in a.places[lo:hi]:
                        if before[y] != own:
                            pair(x, y, depth)
                else:
                    for word, others in a.before.items():
                        if word != own:
                            for y in others[bisect_left(others, x - depth) : bisect_right(others, x + depth)]:
                                pair(x, y, depth)
        for x in b.places:
            insort(a.places, x)
        for word, others in b.before.items():
            mine = a.before.setdefault(word, others)
            if mine is not others:
                for x in others:
                    insort(mine, x)
        return a

    stack: list[list] = []  # depths and nodes of the open intervals; a leaf is its place
    child = None
    for place, depth in zip([*places, None], [*lcp, 0]):
        if child is not None:
            while stack and stack[-1][0] > depth:
                d, node = stack.pop()
                child = joined(node, child, d)
            if depth < shortest:
                stack.clear()  # nothing deeper is open, and what is less deep has no runs
            elif stack and stack[-1][0] == depth:
                stack[-1][1] = joined(stack[-1][1], child, depth)
            else:
                stack.append([depth, child])
        child = place
    return runs


def runs_of(number: np.ndarray, first: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, lengths and periods of the runs of sequences given end to end, by start and period."""
    if not len(number):
        return (np.zeros(0, np.int64),) * 3
    places, lcp = _reaching(Suffixes(number, first), least)
    before = np.append(-1, number[:-1])
    before[first[:-1][first[:-1] < len(number)]] = -1
    found = maximal_pairs(places.tolist(), lcp.tolist(), before.tolist(), least) if len(places) else {}
    out = np.array([(s, n, q) for (s, n), q in found.items()], np.int64).reshape(-1, 3)
    start, length, period = out[np.lexsort((out[:, 2], out[:, 0]))].T
    return start, length, period


def collapsible(n: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Which of ``n`` words some run has after its first period."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, start + period, 1)
    np.add.at(step, start + length, -1)
    return np.cumsum(step)[:-1] > 0


def with_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """Per row of ``docs`` (``doc_id`` and ``text`` are used): ``doc_id``, ``n_words``, ``runs`` (start in words
    from 0, length and smallest period of each, by start and period) and ``collapsed``, the text without the
    words that a run has after its first period, the others joined by single spaces.

    A run has at least ``least`` words and two periods. Words end at ASCII white space and are compared as they
    are. A null or empty text has no words, no runs and an empty ``collapsed``; equal rows are each returned; an
    empty table gives no rows. Documents are worked on whole; nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in S.texts(batches):
            w = S.words(t)
            start, length, period = runs_of(S.word_numbers(t, w), w.first, least)
            keep = ~collapsible(len(w), start, length, period)
            text = S.joined_words(t.data, w.start[keep], w.end[keep], np.append(0, np.cumsum(keep))[w.first])
            doc = np.searchsorted(w.first, start, "right") - 1
            fields = [pa.field(k, pa.int64()) for k in ("start", "length", "period")]
            flat = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start - w.first[doc], length, period)], fields=fields)
            runs = pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(len(t) + 1)), pa.int32()), flat)
            yield S.with_column(t.rows, n_words=w.counts.astype(np.int64), runs=runs, collapsed=pa.array(text, pa.string()))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, f"doc_id long, n_words long, runs {_RUNS}, collapsed string")


def digest(found: DataFrame) -> DataFrame:
    """Of ``with_runs``: ``doc_id``, ``n_runs``, the longest run's ``start``, ``length``, ``period`` and
    ``exponent_milli`` (ties: the first one, then the smallest period; null without runs), and SHA-256 of the
    runs' lines and of the collapsed text."""
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("short"))))
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    rows = found.withColumns({"best": longest, "lines": F.array_join(F.transform("runs", line), "")})
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.before")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.short")).alias("period"), F.expr("1000 * best.length div -best.short").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
