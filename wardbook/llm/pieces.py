"""SentencePiece encoding by unigram Viterbi over a double-array trie, and decoding.

The file's pieces with their scores (taken as log scores) are put into a double-array trie over UTF-8 bytes.
A text gets a blank in front, and blanks become the white-space marker. The best path over the text is the
highest sum of scores; a character that no piece begins costs the lowest score less 10 and falls back to its
bytes' pieces. No piece has the marker after another character, so the best path of a text is those of its
words, and equal words are searched once by each worker, up to a table of fixed size.
"""

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardbook.llm import spans as S
from wardbook.llm.byte_bpe import Memory

MARKER = "▁"
_BLANK, _MARKER_BYTES = b" ", MARKER.encode()
# Fixed value: what an unknown character scores under the lowest piece.
_UNKNOWN_PENALTY = 10.0
_LOWEST = float("-inf")


class DoubleArray:
    """A trie in two arrays: the child of state s by byte c is ``base[s] + c``, if ``check`` of it is s."""

    def __init__(self, keys: dict[bytes, int]):
        children: list[dict[int, int]] = [{}]
        values = [-1]
        for key, value in keys.items():
            node = 0
            for c in key:
                node = children[node].setdefault(c, len(children))
                if node == len(children):
                    children.append({})
                    values.append(-1)
            values[node] = value
        self.base, self.check, self.value = [0] * 1024, [-1] * 1024, [-1] * 1024
        self.check[0], self.value[0] = 0, values[0]
        # Where the search for a place starts: at the first free one for a single child, and for several
        # children past stretches that were searched long without success.
        place, queue, free, several = {0: 0}, [0], 256, 256
        for node in queue:
            own = sorted(children[node])
            if not own:
                continue
            state = place[node]
            while self.check[free] >= 0:
                free += 1
                self._room(free)
            b = begin = (free if len(own) == 1 else max(free, several)) - own[0] or 1
            while True:
                self._room(b + 256)
                if all(self.check[b + c] < 0 for c in own):
                    break
                b += 1
            if len(own) > 1 and b - begin > 64:
                several = b
            self.base[state] = b
            for c in own:
                child = children[node][c]
                self.check[b + c], self.value[b + c], place[child] = state, values[child], b + c
                queue.append(child)
        self._room(max(self.base) + 255)  # any byte may follow any state

    def _room(self, at: int) -> None:
        while at >= len(self.check):
            n = len(self.check)
            self.base += [0] * n
            self.check += [-1] * n
            self.value += [-1] * n


@dataclass
class Pieces:
    """What encoding and decoding need of a model file."""

    trie: DoubleArray
    gain: list[float | None]  # by the trie's states, of those that end a piece its score
    longest: int  # piece, in bytes
    unknown: int
    unknown_score: float
    byte_ids: list[int] | None
    shown: list[bytes]  # each piece's bytes in a decoded text
    by_words: bool

    @staticmethod
    def load(path: str) -> "Pieces":
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        if model.normalize(" a  b\t") != f"{MARKER * 2}a{MARKER * 2}b\t":
            raise ValueError("a model that normalises texts is not supported")
        n = model.vocab_size()
        piece = [model.id_to_piece(i) for i in range(n)]
        special = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) for i in range(n)]
        keys = {piece[i].encode(): i for i in range(n) if not special[i] and not model.is_unused(i)}
        scores = [model.get_score(i) for i in range(n)]
        of_byte = {int(piece[i][1:-1], 16): i for i in range(n) if model.is_byte(i)}
        shown = [piece[i].replace(MARKER, " ").encode() for i in range(n)]
        for b, i in of_byte.items():
            shown[i] = bytes([b])
        for i in range(n):
            if model.is_control(i):
                shown[i] = b""
            elif model.is_unknown(i):
                shown[i] = " ⁇ ".encode()
        by_words = all(MARKER not in p.lstrip(MARKER) for p in (k.decode() for k in keys))
        low = min(scores[i] for i in keys.values()) - _UNKNOWN_PENALTY
        trie = DoubleArray(keys)
        gain = [scores[i] if i >= 0 else None for i in trie.value]
        return Pieces(trie, gain, max(map(len, keys)), model.unk_id(), low, [of_byte[b] for b in range(256)] if len(of_byte) == 256 else None, shown, by_words)

    def best_path(self, raw: bytes) -> list[int]:
        """Identifiers of the best segmentation; of equal ones, that whose last pieces start earliest."""
        raw = raw.replace(_BLANK, _MARKER_BYTES)
        n = len(raw)
        base, check, gain, longest = self.trie.base, self.trie.check, self.gain, self.longest
        score = [_LOWEST] * (n + 1)
        came, by = [0] * (n + 1), [0] * (n + 1)
        score[0], at = 0.0, 0
        while at < n:
            lead = raw[at]
            char = at + (1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4)
            here, state, p, single = score[at], 0, at, False
            for c in raw[at : at + longest]:
                child = base[state] + c
                if check[child] != state:
                    break
                state, p = child, p + 1
                own = gain[state]
                if own is not None:
                    if p == char:
                        single = True
                    total = here + own
                    if total > score[p]:
                        score[p], came[p], by[p] = total, at, state
            if not single:
                total = here + self.unknown_score
                if total > score[char]:
                    score[char], came[char], by[char] = total, at, 0
            at = char
        out, at, value = [], n, self.trie.value
        while at:
            start, state = came[at], by[at]
            if state:
                out.append(value[state])
            elif self.byte_ids:
                out.extend(self.byte_ids[b] for b in reversed(raw[start:at]))
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
            at = start
        return out[::-1]


@lru_cache(2)
def _worker(path: str) -> tuple[Pieces, Memory, np.ndarray, np.ndarray]:
    pieces = Pieces.load(path)
    ends = np.append(0, np.cumsum([len(x) for x in pieces.shown]))
    return pieces, Memory(pieces.best_path), np.frombuffer(b"".join(pieces.shown), np.uint8), ends


def _encode(t: S.Texts, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Identifiers of the documents, end to end, and where each document's start."""
    pieces, memory, *_ = _worker(path)
    data, offsets = t.data, t.offsets
    if _MARKER_BYTES in data.tobytes():  # the marker itself in a text is a blank
        texts = [t.text_bytes(i).replace(_MARKER_BYTES, _BLANK) for i in range(len(t))]
        data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.append(0, np.cumsum([len(x) for x in texts]))
    full = np.flatnonzero(np.diff(offsets))
    data = np.insert(data, offsets[full], 32)
    offsets = offsets + np.append(0, np.cumsum(np.diff(offsets) > 0))
    start = offsets[full]
    if pieces.by_words:
        blank = data == 32
        starts = blank.copy()
        starts[1:] &= ~blank[:-1]
        starts[start] = True
        start = np.flatnonzero(starts)
    end = np.append(start[1:], len(data))[: len(start)]
    at, length = memory.look_up(S.span_hash(data, start, end, 71), data, start, end)
    ends = np.append(0, np.cumsum(length))
    return memory.values[S.ranges(at, length.astype(np.int64))], ends[np.searchsorted(start, offsets)]


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """Per row of ``docs`` (``doc_id`` and ``text`` are used): ``doc_id``, ``text`` and ``ids`` under the model
    file ``path``, which every worker must have.

    A null or empty text has no identifiers; equal rows are each encoded; an empty table gives no rows. Scores
    are summed in double precision.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in S.texts(batches):
            ids, first = _encode(t, path)
            yield S.with_column(t.rows, drop=(), ids=pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids, pa.int32())))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, text string, ids array<int>")


def _decoded_bytes(ids: np.ndarray, first: np.ndarray, shown: np.ndarray, ends: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The bytes that lists of identifiers show, end to end, and where each list's start. The blank in front
    of a text is left out."""
    if len(ids) and (ids.min() < 0 or ids.max() >= len(ends) - 1):
        raise ValueError("an identifier is not in the vocabulary")
    length = ends[ids + 1] - ends[ids]
    at = np.append(0, np.cumsum(length))[first]
    data = shown[S.ranges(ends[ids], length)]
    drop = at[:-1][(at[:-1] < at[1:])]
    drop = drop[data[drop] == 32]
    keep = np.ones(len(data), bool)
    keep[drop] = False
    return data[keep].tobytes(), at - np.append(0, np.cumsum(~keep))[at]


def decoded(rows: DataFrame, path: str) -> DataFrame:
    """``rows`` with ``decoded``, the text that ``ids`` stand for, at the end; a column of that name is replaced.

    The marker becomes a blank, but the first one goes; byte pieces become their bytes, and bytes that are no
    UTF-8 the replacement character; null or empty identifiers give an empty text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, _, shown, ends = _worker(path)
        for batch in batches:
            for begin in range(0, len(batch), S.MAX_ROWS):
                part = batch.slice(begin, S.MAX_ROWS)
                lists = part.column(part.schema.get_field_index("ids"))
                size = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
                raw, at = _decoded_bytes(lists.flatten().to_numpy().astype(np.int64), np.append(0, np.cumsum(size)), shown, ends)
                text = [raw[a:b].decode(errors="replace") for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
                yield S.with_column(part, drop=("decoded",), decoded=pa.array(text, pa.string()))

    rows = rows.drop("decoded")
    schema = T.StructType([*rows.schema.fields, T.StructField("decoded", T.StringType())])
    return rows.mapInArrow(run, schema)


def digest(rows: DataFrame) -> DataFrame:
    """Of encoded and decoded rows: ``doc_id``, ``n_pieces``, ``ids_crc32`` (little-endian unsigned 32-bit
    identifiers) and ``decodes_back``, whether the text comes back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            size = lists.value_lengths().to_numpy()
            raw, at = lists.flatten().to_numpy().astype("<u4"), np.append(0, np.cumsum(size))
            crc = [zlib.crc32(raw[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size, pa.int64()), pa.array(crc, pa.int64()), batch.column(2)], names=["doc_id", "n_pieces", "ids_crc32", "decodes_back"])

    same = (F.coalesce("text", F.lit("")) == F.col("decoded")).alias("same")
    return rows.select("doc_id", "ids", same).mapInArrow(run, "doc_id long, n_pieces long, ids_crc32 long, decodes_back boolean")
