"""Byte-level BPE vocabularies of the tokenizers library: splitting texts into pre-tokens, and pair merging.

Texts are split by numpy over all documents of a step at once, following the fixed pattern below without a
regular expression; equal pre-tokens (by a 64-bit hash) are merged once and remembered in a table of fixed
size.
"""

import heapq
import json
import re
import sys
import unicodedata
from collections.abc import Callable
from functools import lru_cache
from itertools import chain

import numpy as np
import regex
from tokenizers.pre_tokenizers import ByteLevel

from wardbook.llm import spans as S

# Fixed value, the pattern that the library's byte-level splitting follows:
#   's|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+
_CONTRACTIONS = ["s", "t", "re", "ve", "m", "ll", "d"]
# Fixed value: the characters of Unicode's White_Space property.
_WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_OTHER, _LETTER, _NUMBER, _SPACE = 0, 1, 2, 3
# Numbers or bytes that a step's texts add at most, unless one text is longer.
_STEP = S.MAX_BYTES


@lru_cache(1)
def _kinds() -> np.ndarray:
    """Each code point's kind. Where two editions of Unicode differ, the library is asked for its own."""
    by_category = {"L": _LETTER, "N": _NUMBER}
    chars = [chr(c) if not 0xD800 <= c < 0xE000 else "\0" for c in range(sys.maxunicode + 1)]
    kinds = np.array([by_category.get(unicodedata.category(c)[0], _OTHER) for c in chars], np.uint8)
    newer = np.zeros(len(kinds), np.uint8)
    for kind, pattern in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+")):
        for m in regex.finditer(pattern, "".join(chars)):
            newer[m.start() : m.end()] = kind
    alone = ByteLevel(add_prefix_space=False).pre_tokenize_str
    for c in np.flatnonzero(kinds != newer).tolist():
        kinds[c] = _LETTER if len(alone(f"a{chr(c)}")) == 1 else _NUMBER if len(alone(f"1{chr(c)}")) == 1 else _OTHER
    kinds[_WHITE] = _SPACE
    return kinds


def byte_letters() -> list[str]:
    """The character that stands for each byte in vocabulary files: printable bytes themselves, others from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in printable else next(spare)) for b in range(256)]


class Vocabulary:
    """Merges and identifiers of a vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model = file["model"]
        splitter = file.get("pre_tokenizer") or {}
        if model["type"] != "BPE" or splitter.get("type") != "ByteLevel" or splitter.get("add_prefix_space") or file.get("normalizer"):
            raise ValueError("not a plain byte-level BPE vocabulary")
        ids = model["vocab"]
        self.byte_ids = [ids[c] for c in byte_letters()]
        pairs = [pair.split(" ") if isinstance(pair, str) else pair for pair in model["merges"]]
        self.made = [ids[a + b] for a, b in pairs]
        self.ranks = {}
        for rank, (a, b) in enumerate(pairs):
            self.ranks.setdefault(ids[a] << 32 | ids[b], rank)
        self.special = {t["content"].encode(): t["id"] for t in file.get("added_tokens", [])}
        found = sorted(self.special, key=len, reverse=True)
        self.special_pattern = re.compile(b"|".join(map(re.escape, found))) if found else None


def merged(raw: bytes, vocabulary: Vocabulary) -> list[int]:
    """The symbols left of a pre-token when adjacent pairs are merged, the lowest rank first and of one rank
    the leftmost; a symbol that went into its left neighbour is -1.

    A heap holds the pairs and a linked list the symbols that are left; an entry whose pair has changed
    since is dropped when it is popped.
    """
    symbols = [vocabulary.byte_ids[b] for b in raw]
    rank_of, n = vocabulary.ranks.get, len(symbols)
    heap = []
    for i in range(n - 1):
        rank = rank_of(symbols[i] << 32 | symbols[i + 1])
        if rank is not None:
            heap.append(rank << 32 | i)
    if not heap:
        return symbols
    heapq.heapify(heap)
    push, pop, made = heapq.heappush, heapq.heappop, vocabulary.made
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    while heap:
        entry = pop(heap)
        i = entry & 0xFFFFFFFF
        j, own = after[i], symbols[i]
        if own < 0 or j >= n or rank_of(own << 32 | symbols[j]) != entry >> 32:
            continue
        symbols[i], symbols[j] = own, _ = made[entry >> 32], -1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            rank = rank_of(own << 32 | symbols[k])
            if rank is not None:
                push(heap, rank << 32 | i)
        h = before[i]
        if h >= 0:
            rank = rank_of(symbols[h] << 32 | own)
            if rank is not None:
                push(heap, rank << 32 | h)
    return symbols


def count_merged(raw: bytes, vocabulary: Vocabulary) -> int:
    """How many symbols there are at first less the merges."""
    symbols = merged(raw, vocabulary)
    return len(symbols) - symbols.count(-1)


def pre_tokens(t: S.Texts, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the pre-tokens, and the identifiers of special ones (-1 for the rest)."""
    raw = t.data.tobytes()
    borders, special = t.offsets, {}
    if vocabulary.special_pattern:
        for m in vocabulary.special_pattern.finditer(raw):
            a, b = m.span()
            if np.searchsorted(t.offsets, a, "right") == np.searchsorted(t.offsets, b - 1, "right"):
                special[a] = b, vocabulary.special[m.group()]
    if special:
        borders = np.union1d(borders, [x for a, (b, _) in special.items() for x in (a, b)])
    ascii_only = not (t.data & 0x80).any()
    char = t.data if ascii_only else np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32)
    at = None if ascii_only else np.append(np.flatnonzero((t.data & 0xC0) != 0x80), len(raw))
    kind = _kinds()[char]
    n = len(char)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.zeros(n + 1, bool)
    cut[borders if ascii_only else np.searchsorted(at, borders)] = True
    fresh = cut[:n].copy()  # a run of one kind starts
    fresh[1:] |= kind[1:] != kind[:-1]
    starts = fresh.copy()
    # The last white space before a word: a blank goes with the word, anything else is a token of its own.
    word = np.flatnonzero(fresh & (kind != _SPACE))
    word = word[(word > 0) & ~cut[word]]
    space = word[kind[word - 1] == _SPACE] - 1
    starts[space] = True
    blank = space[char[space] == 32]
    starts[blank + 1] = False
    # Contractions: a lone apostrophe without a blank before it, and the letters after it.
    mark = np.flatnonzero(fresh & (char == 39))
    mark = mark[(mark + 1 < n) & starts[mark]]
    mark = mark[fresh[mark + 1] & ~cut[mark + 1] & (kind[mark + 1] == _LETTER)]
    padded = np.append(char, [0, 0, 0])
    for tail in _CONTRACTIONS:
        own = mark
        for k, c in enumerate(tail):
            own = own[(padded[own + 1 + k] == ord(c)) & ((own + 1 + k >= n) | ~cut[np.minimum(own + 1 + k, n)])]
        starts[own + 1] = False
        ends = own + 1 + len(tail)
        starts[ends[ends < n]] = True
    first = np.flatnonzero(starts)
    start = first if ascii_only else at[first]
    end = np.append(start[1:], len(raw))
    fixed = np.full(len(start), -1)
    if special:
        where = np.array(sorted(special))
        inside = np.searchsorted(where, start, "right") - 1
        last = np.array([special[a][0] for a in where])
        within = (inside >= 0) & (start < last[inside])
        keep = ~within | np.isin(start, where)
        start, fixed = start[keep], np.where(within, [special[a][1] for a in where][0] if len(where) == 1 else np.array([special[a][1] for a in where])[inside], -1)[keep]
        end = np.append(start[1:], len(raw))
    return start, end, fixed


class Memory:
    """A table of fixed size from pre-tokens to values; a later one replaces an earlier one in its place.

    Places are found by 64-bit hashes; bytes are compared before a remembered value is taken. ``value_of`` gives
    a pre-token's value, a list of numbers. What is remembered is dropped beyond ``store`` numbers or bytes.
    """

    def __init__(self, value_of: Callable[[bytes], list[int]], places: int = 1 << 20, store: int = 1 << 23):
        self.value_of, self.mask, self.limit = value_of, np.uint64(places - 1), store
        self.clear(places)

    def clear(self, places: int) -> None:
        self.hash = np.zeros(places, np.uint64)
        self.at, self.length = np.zeros(places, np.int64), np.zeros(places, np.int32)
        # Reserved whole, so that nothing is copied to grow; the system gives pages as they are filled.
        self.values, self.used = np.zeros(self.limit + _STEP, np.int32), 0
        # The remembered pre-tokens themselves.
        self.key_at, self.key_length = np.zeros(places, np.int64), np.full(places, -1, np.int32)
        self.keys, self.keys_used = np.zeros(2 * self.limit + _STEP, np.uint8), 0

    def _add(self, lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        length = np.fromiter(map(len, lists), np.int32, len(lists))
        flat = np.fromiter(chain.from_iterable(lists), np.int32, int(length.sum()))
        if self.used + len(flat) > len(self.values):
            self.values = np.append(self.values[: self.used], np.zeros(len(flat), np.int32))
        at = self.used + np.cumsum(length) - length
        self.values[self.used : self.used + len(flat)] = flat
        self.used += len(flat)
        return at, length

    def _add_keys(self, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        flat = data[S.ranges(start, length)]
        if self.keys_used + len(flat) > len(self.keys):
            self.keys = np.append(self.keys[: self.keys_used], np.zeros(len(flat), np.uint8))
        at = self.keys_used + np.cumsum(length) - length
        self.keys[self.keys_used : self.keys_used + len(flat)] = flat
        self.keys_used += len(flat)
        return at

    def look_up(self, hashes: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place in ``values`` and length of each pre-token's value; valid until the next call."""
        if self.used > self.limit or self.keys_used > 2 * self.limit:
            self.clear(len(self.hash))
        place, size = (hashes & self.mask).astype(np.int64), end - start
        at, length = self.at[place], self.length[place]
        known = (self.hash[place] == hashes) & (self.key_length[place] == size)
        hit = np.flatnonzero(known)
        known[hit] = S.same_bytes(self.keys, self.key_at[place[hit]], data, start[hit], size[hit])
        missing = np.flatnonzero(~known)
        if len(missing):
            _, one, back = np.unique(hashes[missing], return_index=True, return_inverse=True)
            own = missing[one][back]
            alike = size[own] == size[missing]
            alike[alike] = S.same_bytes(data, start[own[alike]], data, start[missing[alike]], size[missing[alike]])
            # Pre-tokens of one hash and other bytes stand for themselves.
            one, odd = missing[one], missing[~alike]
            made = np.append(one, odd)
            new_at, new_length = self._add([self.value_of(data[a:b].tobytes()) for a, b in zip(start[made].tolist(), end[made].tolist())])
            at[missing], length[missing] = new_at[back], new_length[back]
            at[odd], length[odd] = new_at[len(one) :], new_length[len(one) :]
            place, n = place[one], len(one)
            self.hash[place], self.at[place], self.length[place] = hashes[one], new_at[:n], new_length[:n]
            self.key_at[place], self.key_length[place] = self._add_keys(data, start[one], size[one]), size[one]
        return at, length


def values_of(t: S.Texts, vocabulary: Vocabulary, memory: Memory, special_value: Callable[[int], int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places and lengths in ``memory.values`` of all pre-tokens, and where each document's start."""
    start, end, fixed = pre_tokens(t, vocabulary)
    at, length = memory.look_up(S.span_hash(t.data, start, end, 61), t.data, start, end)
    special = np.flatnonzero(fixed >= 0)
    if len(special):
        new_at, new_length = memory._add([[special_value(int(i))] for i in fixed[special]])
        at[special], length[special] = new_at, new_length
    return at, length, np.searchsorted(start, t.offsets)
