"""Similarity join of documents on the Jaccard similarity of their word n-gram sets.

Two sets are linked when ``100 * intersection >= percent * union``; the result is every document's component
of links. All of it is exact up to 64-bit hashes of n-grams and sets.

1. Equal sets are one set from here on, so copies cost nothing further.
2. T-occurrence as a prefix filter: linked sets of n tokens share at least ``T = percent * n`` tokens, so
   of the ``n - T + t`` tokens with the smallest hashes they share ``t`` or more. Inverted lists are made of
   these alone. A set with fewer than ``t`` tokens in any other list has no partner.
3. The rest skips its longest lists: of its prefix in rare-first order only so many tokens are needed that
   one of the ``t`` must be among them. Sets in one of these short lists form a family. Families of more than
   one block are divided once more in this way, by all tokens of their sets.
4. Families are searched in blocks of at most ``BLOCK`` sets, with DivideSkip over the full sets: short
   lists are merged on a heap with skips, long ones are probed by binary search. Only edges that join two
   parts of a block leave a task.
5. A family of more than one block is first compared with one central set. Sets linked to it need no
   comparison with each other, and the distance to it (a metric) rules out pairs of blocks.
"""

import heapq
from bisect import bisect_left
from collections.abc import Iterator
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardbook.llm import spans as S
from wardbook.llm.components import components
from wardbook.llm.scratch import stored

BLOCK = 512
# Cost of probing a long list against merging it, as DivideSkip's authors set it.
_MU = 0.0085
_SHARED_PERCENT = 5


def token_sets(t: S.Texts, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of each document in ascending order, end to end, and where each starts.

    A text of fewer than ``n`` words has its whole sequence as the one token; without words, none.
    """
    w = S.words(t, S.lower_ascii(t.data))
    start, token = S.windows(w, n, 31)
    doc = w.doc()[start] if len(start) else start
    few = np.flatnonzero((w.counts > 0) & (w.counts < n))
    whole = S.word_prefix(w.hash).hash(w.first[few], w.first[few + 1], 31)
    doc, token = np.append(doc, few), np.append(token, whole)
    order = np.lexsort((token, doc))
    doc, token = doc[order], token[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (token[1:] != token[:-1])
    doc, token = doc[new], token[new]
    return token, np.searchsorted(doc, np.arange(len(t) + 1))


def _need(n, percent: int):
    """The least overlap of a set of ``n`` tokens with any set it is linked to."""
    return (percent * n + 99) // 100


def _slack(n, percent: int):
    """``t`` for sets of ``n`` tokens: so many shared tokens a prefix is long enough to show."""
    return np.minimum(n * _SHARED_PERCENT // 100 + 1, _need(n, percent))


def _marks(n: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in S.texts(batches):
            token, first = token_sets(t, n)
            size = np.diff(first)
            set_id = S.word_prefix(token).hash(first[:-1], first[1:], 32).view(np.int64)
            length = np.minimum(size - _need(size, percent) + _slack(size, percent), size)
            prefix = pa.ListArray.from_arrays(
                pa.array(np.append(0, np.cumsum(length)), pa.int32()), pa.array(token[S.ranges(first[:-1], length)].view(np.int64))
            )
            yield pa.RecordBatch.from_arrays([t.rows.column(0), pa.array(size.astype(np.int64)), pa.array(set_id), prefix], names=["doc_id", "n", "set_id", "prefix"])

    return run


def _sets(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in S.texts(batches):
            token, first = token_sets(t, n)
            set_id = S.word_prefix(token).hash(first[:-1], first[1:], 32).view(np.int64)
            tokens = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(token.view(np.int64)))
            names = [x for x in t.rows.schema.names if x != "text"]
            cols = [t.rows.column(t.rows.schema.get_field_index(x)) for x in names]
            out = pa.RecordBatch.from_arrays([*cols, tokens], names=[*names, "tokens"])
            # Another text under the same id is another set.
            yield out.filter(pa.array(set_id == t.column("set_id")))

    return run


class DivideSkip:
    """T-occurrence search in an inverted index of a block of sets, numbered from 0."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.percent, self.sizes = percent, [len(s) for s in sets]
        own = np.repeat(np.arange(len(sets)), self.sizes)
        token = np.concatenate(sets) if sets else np.zeros(0, np.int64)
        order = np.lexsort((own, token))
        at = np.flatnonzero(np.append(True, token[order][1:] != token[order][:-1])) if len(token) else order
        length = np.diff(np.append(at, len(token)))
        self.lists = np.split(own[order], at[1:])
        number = np.empty(len(token), np.int64)
        number[order] = np.repeat(np.arange(len(at)), length)
        self.length, ends = length, np.cumsum(self.sizes)
        self.numbers = [number[e - s : e] for s, e in zip(self.sizes, ends)]

    def _merge(self, lists: list[list[int]], after: int, least: int) -> dict[int, int]:
        """Members over ``after`` in at least ``least`` of the lists, and in how many."""
        places = [bisect_left(x, after + 1) for x in lists]
        heap = [(x[p], i) for i, (x, p) in enumerate(zip(lists, places)) if p < len(x)]
        heapq.heapify(heap)
        found = {}

        def advance(i, p):
            places[i] = p
            if p < len(lists[i]):
                heapq.heappush(heap, (lists[i][p], i))

        while len(heap) >= least:
            member, popped = heap[0][0], []
            while heap and heap[0][0] == member:
                popped.append(heapq.heappop(heap)[1])
            if len(popped) >= least:
                found[member] = len(popped)
                for i in popped:
                    advance(i, places[i] + 1)
                continue
            # Too few: members before the next possible one are skipped in all popped lists.
            while heap and len(popped) < least - 1:
                popped.append(heapq.heappop(heap)[1])
            if not heap:
                break
            for i in popped:
                advance(i, bisect_left(lists[i], heap[0][0], places[i]))
        return found

    def search(self, r: int, allowed) -> Iterator[tuple[int, int]]:
        """Sets numbered after ``r`` that reach the overlap with it, and the overlap; ``allowed`` says
        which are worth a look."""
        need = _need(self.sizes[r], self.percent)
        numbers = self.numbers[r][self.length[self.numbers[r]] > 1]
        if not need or len(numbers) < need:
            return
        numbers = numbers[np.argsort(self.length[numbers], kind="stable")]
        skip = min(need - 1, int(need / (_MU * log2(self.length[numbers[-1]]) + 1)))
        short, long = numbers[: len(numbers) - skip], numbers[len(numbers) - skip :]
        found = self._merge([self.lists[k].tolist() for k in short], r, need - skip)
        found = {m: c for m, c in found.items() if allowed(m)}
        if not found:
            return
        members = np.array(sorted(found))
        overlap = np.array([found[m] for m in members])
        for k in long:
            x = self.lists[k]
            p = np.searchsorted(x, members)
            overlap += (p < len(x)) & (x[np.minimum(p, len(x) - 1)] == members)
        for m, o in zip(members.tolist(), overlap.tolist()):
            if 100 * o >= self.percent * (self.sizes[r] + self.sizes[m] - o):
                yield m, o


def block_edges(ids: np.ndarray, sets: list[np.ndarray], side: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Edges that connect what links connect in a block. Pairs of one side are left out if there are two."""
    order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
    index = DivideSkip([sets[i] for i in order], percent)
    ids, side = ids[order], side[order]
    two = len(set(side.tolist())) > 1
    root = list(range(len(order)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    edges = []
    for r in range(len(order)):
        largest = 100 * index.sizes[r] // percent
        worth = lambda m: index.sizes[m] <= largest and not (two and side[m] == side[r]) and find(m) != find(r)  # noqa: B023, E731
        for m, _ in index.search(r, worth):
            a, b = find(m), find(r)
            if a != b:
                root[a] = b
                edges.append((int(ids[r]), int(ids[m])))
    return edges


def _search_blocks(percent: int):
    """Of rows (task, set_id, side, tokens) with the rows of a task together: the edges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, ids, sets, side = None, [], [], []

        def result():
            found = block_edges(np.array(ids), sets, np.array(side), percent) if len(ids) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([e[k] for e in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

        for batch in batches:
            tokens = batch.column(3)
            values, at = tokens.flatten().to_numpy(), np.append(0, np.cumsum(tokens.value_lengths().to_numpy()))
            for i, key in enumerate(batch.column(0).to_pylist()):
                if key != task:
                    if ids:
                        yield result()
                    task, ids, sets, side = key, [], [], []
                ids.append(batch.column(1)[i].as_py())
                side.append(batch.column(2)[i].as_py())
                sets.append(values[at[i] : at[i + 1]].copy())
        if ids:
            yield result()

    return run


def _overlap_with_centre(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = (batch.column(batch.schema.get_field_index(k)) for k in ("tokens", "centre_tokens"))
        n = [len(np.intersect1d(x.values.to_numpy(), y.values.to_numpy(), assume_unique=True)) for x, y in zip(a, b)]
        keep = [batch.column(batch.schema.get_field_index(k)) for k in ("family", "set_id", "centre", "n", "centre_n")]
        yield pa.RecordBatch.from_arrays([*keep, pa.array(n, pa.int64())], names=["family", "set_id", "centre", "n", "centre_n", "overlap"])


def _families(sets: DataFrame) -> DataFrame:
    """``set_id``, ``family`` and ``weight`` (higher for sets of common tokens) of the sets that may have a
    partner.

    ``sets`` has ``set_id``, ``tokens`` and ``t``, the number of its tokens that any partner's row shows too.
    Of the tokens in rare-first order all but ``t - 1`` are kept, so partners share one of these.
    """
    postings = sets.select("set_id", "t", F.size("tokens").alias("n"), F.explode("tokens").alias("token"))
    lists = postings.groupBy("token").agg(F.count("*").alias("length")).filter("length > 1")
    own = W.partitionBy("set_id")
    ranked = {"place": F.row_number().over(own.orderBy("length", "token")), "shared": F.count("*").over(own), "weight": F.avg("length").over(own)}
    found = postings.join(lists, "token").withColumns(ranked).filter("shared >= t")
    # Tokens in no other list come first.
    short = stored(found.filter("place <= shared - t + 1").select("set_id", "weight", "token"), "short_lists")
    hubs = short.groupBy("token").agg(F.min("set_id").alias("hub"))
    edges = short.join(hubs, "token").select(F.col("hub").alias("a"), F.col("set_id").alias("b"))
    members = components(edges).withColumnsRenamed({"node": "set_id", "component": "family"})
    return stored(members.join(short.select("set_id", "weight").distinct(), "set_id"), "families")


def _sized(sets: DataFrame, family: DataFrame) -> DataFrame:
    """Sets with their family, its size and its centre, the set of the most common tokens."""
    sizes = family.groupBy("family").agg(F.count("*").alias("size"), F.max_by("set_id", F.struct("weight", "set_id")).alias("centre"))
    return sets.join(family.join(sizes, "family").select("set_id", "family", "size", "centre"), "set_id")


def _block_pairs(placed: DataFrame, percent: int) -> DataFrame:
    """Sets of large families (family, set_id, tokens, distance, settled) dealt to pairs of blocks."""
    # A family's sets in order of distance from its centre, by the sizes of at most 34 cells.
    placed = placed.withColumn("cell", F.when(F.col("settled"), 0).otherwise(100) + F.floor(F.col("distance") * 16).cast("int"))
    cells = placed.groupBy("family", "cell").agg(F.count("*").alias("size"))
    before = F.sum("size").over(W.partitionBy("family").orderBy("cell").rowsBetween(W.unboundedPreceding, -1))
    cells = cells.withColumn("before", F.coalesce(before, F.lit(0)))
    place = F.col("before") + F.pmod(F.xxhash64("set_id"), F.col("size"))
    rows = placed.join(cells, ["family", "cell"]).withColumn("block", F.floor(place / BLOCK))
    rows = rows.select("family", "block", "set_id", "tokens", "settled", "distance")
    blocks = rows.groupBy("family", "block").agg(F.min("settled").alias("settled"), F.min("distance").alias("near"), F.max("distance").alias("far"))
    blocks = stored(blocks, "blocks")
    x, y = (blocks.select("family", F.struct("block", "settled", "near", "far").alias(k)) for k in "xy")
    reach = (100 - percent) / 100 + 1e-9
    pairs = x.join(y, "family").filter(
        (F.col("x.block") <= F.col("y.block")) & ~(F.col("x.settled") & F.col("y.settled"))
        & (F.col("x.near") <= F.col("y.far") + reach) & (F.col("y.near") <= F.col("x.far") + reach)
    )
    task = F.concat_ws("/", F.col("family").cast("string"), F.col("x.block").cast("string"), F.col("y.block").cast("string"))
    sides = pairs.select("family", task.alias("task"), F.explode(F.array_distinct(F.array("x.block", "y.block"))).alias("block"), F.col("y.block").alias("second"))
    out = rows.join(sides, ["family", "block"])
    return out.select("task", "set_id", (F.col("block") == F.col("second")).cast("int").alias("side"), "tokens")


def links(docs: DataFrame, marks: DataFrame, n: int, percent: int) -> DataFrame:
    """Edges ``a``, ``b`` of set ids that connect what links connect."""
    firsts = marks.filter("n > 0 and doc_id is not null").groupBy("set_id").agg(F.min("doc_id").alias("doc_id"))
    # A row that is there twice only adds candidates; to drop it would shuffle all prefixes once more.
    sets = marks.join(firsts, ["doc_id", "set_id"], "left_semi")
    need = lambda n: F.floor((n * percent + 99) / 100)
    # A partner may be smaller, and its prefix shows fewer shared tokens.
    smaller = F.floor(F.col("n") * percent / 100)
    t = F.greatest(F.lit(1), F.least(F.floor(smaller * _SHARED_PERCENT / 100) + 1, need(smaller)))
    family = _families(sets.select("set_id", F.col("prefix").alias("tokens"), t.alias("t")))

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    wanted = family.select("set_id").join(firsts, "set_id")
    full = texts.join(wanted, "doc_id").select("doc_id", "text", "set_id")
    full = stored(full.mapInArrow(_sets(n), "doc_id long, set_id long, tokens array<long>").drop("doc_id"), "sets")

    # Large families are told apart once more, by all tokens of their sets.
    first = _sized(full, family)
    large = first.filter(F.col("size") > BLOCK).select("set_id", "tokens", need(F.size("tokens")).alias("t"))
    second = _sized(full, _families(large))
    columns = ["task", "set_id", "side", "tokens"]
    small = first.filter(F.col("size") <= BLOCK).unionByName(second.filter(F.col("size") <= BLOCK))
    small = small.withColumns({"task": F.col("family").cast("string"), "side": F.lit(0)}).select(*columns)

    large = second.filter(F.col("size") > BLOCK).withColumn("n", F.size("tokens").cast("long"))
    centres = large.filter("set_id = centre").select("family", F.col("n").alias("centre_n"), F.col("tokens").alias("centre_tokens")).dropDuplicates(["family"])
    compared = large.join(centres, "family").select("family", "set_id", "centre", "n", "centre_n", "tokens", "centre_tokens")
    compared = compared.mapInArrow(_overlap_with_centre, "family long, set_id long, centre long, n long, centre_n long, overlap long")
    union = F.col("n") + F.col("centre_n") - F.col("overlap")
    compared = compared.withColumns({"distance": 1 - F.col("overlap") / union, "settled": 100 * F.col("overlap") >= percent * union})
    compared = stored(compared.select("family", "set_id", "centre", "distance", "settled"), "centres")
    to_centre = compared.filter("settled and set_id != centre").select(F.col("centre").alias("a"), F.col("set_id").alias("b"))
    placed = compared.join(full, "set_id")

    tasks = small.unionByName(_block_pairs(placed, percent))
    tasks = tasks.repartition("task").sortWithinPartitions("task")
    return tasks.mapInArrow(_search_blocks(percent), "a long, b long").unionByName(to_centre)


def _placed(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``set_id`` and ``component_id`` per row."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    marks = stored(own.mapInArrow(_marks(n, percent), "doc_id long, n long, set_id long, prefix array<long>"), "marks")
    component = components(links(docs, marks, n, percent)).select(F.col("node").alias("set_id"), "component")
    firsts = marks.filter("n > 0").groupBy("set_id").agg(F.min("doc_id").alias("first_id"))
    placed = firsts.join(component, "set_id", "left").withColumn("component", F.coalesce("component", "set_id"))
    ids = placed.groupBy("component").agg(F.min("first_id").alias("component_id"))
    placed = stored(placed.join(ids, "component").select("set_id", "component_id"), "components")
    rows = marks.select("doc_id", F.col("n").alias("n_shingles"), "set_id").join(placed, "set_id", "left")
    linked: Column = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.select("doc_id", "n_shingles", "set_id", F.when(F.col("doc_id").isNotNull(), linked).alias("component_id"))


def joined(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """Per row of ``docs`` (``doc_id`` and ``text`` are used): ``doc_id``, ``n_shingles``, ``component_id``.

    ``component_id`` is the smallest id that links lead to, the own one included. Words end at ASCII white
    space, A-Z are lower-cased. Null, empty and blank texts have no shingles and are linked with nothing; a
    row without an id links nothing and has no component; rows of one id count each with their own text; an
    empty table gives no rows.
    """
    return _placed(docs, n, percent).drop("set_id")


def one_per_group(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without the documents that links lead from to a smaller id. Rows without an id stay; of rows
    that share an id each goes or stays by its own text."""

    def with_set(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in S.texts(batches):
            token, first = token_sets(t, n)
            yield S.with_column(t.rows, set_id=S.word_prefix(token).hash(first[:-1], first[1:], 32).view(np.int64))

    gone = F.coalesce(F.col("component_id") < F.col("doc_id"), F.lit(False))
    sets = stored(_placed(docs, n, percent).filter("doc_id is not null").select("doc_id", "set_id", gone.alias("gone")).distinct(), "gone")
    by_id = sets.groupBy("doc_id").agg(F.bool_or("gone").alias("some"), F.bool_and("gone").alias("whole")).filter("some")
    by_id = stored(by_id.select("doc_id", "whole"), "gone_ids")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.struct("*").alias("row"))
    kept = rows.join(by_id, "doc_id", "left_anti")
    # Ids of which one text goes and another stays.
    mixed = rows.join(by_id.filter("not whole"), "doc_id", "left_semi")
    mixed = mixed.mapInArrow(with_set, mixed.withColumn("set_id", F.lit(0).cast("long")).schema)
    kept_too = mixed.join(sets.filter("gone").select("doc_id", "set_id"), ["doc_id", "set_id"], "left_anti")
    return kept.select("row").unionByName(kept_too.select("row")).select("row.*")
