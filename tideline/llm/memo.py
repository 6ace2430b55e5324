"""Ids of repeated words, for the operators that encode whole texts.

Texts are cut into words at places where a match of a byte-level tokenizer's
split pattern is certain to start, whatever stands around:

* before a single space between two visible characters (`` ?\\p{L}+`` and the
  like take one space with what follows it),
* before one of ``,.;:!?`` after an ASCII letter,
* before an ASCII letter after a single line feed after a visible character.

So the ids of a text are those of its words, one after the other. Words are
told apart by a 64-bit hash; a table of the words seen so far, of at most
``size`` entries, gives the place of their ids in a common array.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np

from tideline.llm.hashing import U64, mix, powers, prefix_hash

MEMO_SIZE = 1_000_000
BATCH_BYTES = 1 << 21

_VISIBLE = np.zeros(256, bool)  # ASCII, and lead bytes of blocks without white space
_VISIBLE[0x21:0x7F] = True
_VISIBLE[0xC3:] = True
_VISIBLE[[0xE1, 0xE2, 0xE3]] = False
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_STOP = np.zeros(256, bool)
_STOP[list(b",.;:!?")] = True


def _leads(data: np.ndarray) -> np.ndarray:
    """The lead byte of the character before each place from the second on: the byte itself, or one to three further back."""
    lead = data[:-2].copy()
    for back in (1, 2, 3):
        tail = np.flatnonzero((lead & 0xC0) == 0x80)
        tail = tail[tail >= back]
        lead[tail] = data[tail - back]
    return lead


def space_cuts(data: np.ndarray) -> np.ndarray:
    """Whether each byte is a single space between two visible characters."""
    start = np.zeros(len(data), bool)
    if len(data) >= 3:
        start[1:-1] = (data[1:-1] == 32) & _VISIBLE[_leads(data)] & _VISIBLE[data[2:]]
    return start


def cuts(data: np.ndarray) -> np.ndarray:
    """Whether a word starts at each byte, by the rules above (row starts come on top)."""
    start = space_cuts(data)
    if len(data) < 3:
        return start
    letter, stop = _LETTER[data], _STOP[data]
    start[1:] |= stop[1:] & letter[:-1]
    start[2:] |= letter[2:] & (data[1:-1] == 10) & _VISIBLE[_leads(data)]
    return start


class Memo:
    """Ids of the words a worker has encoded, ``size`` of them at most (then it starts anew)."""

    def __init__(self, encode: Callable[[list[str]], Sequence[Sequence[int]]], size: int = MEMO_SIZE,
                 whole: Callable[[str], bool] = lambda text: False):
        self.encode, self.size, self.whole = encode, size, whole
        self.slots = 1 << max(4, (2 * size).bit_length())
        self._clear()

    def _clear(self) -> None:
        self.n = 0
        self.keys, self.at = np.zeros(self.slots, U64), np.full(self.slots, -1, np.int32)
        self.start, self.count = np.zeros(self.size, np.int64), np.zeros(self.size, np.int32)
        self.pool, self.used = np.zeros(1 << 16, np.uint32), 0

    def _find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry or -1, slot where the search ended) of each key."""
        slot = (keys & U64(self.slots - 1)).astype(np.int64)
        open_ = np.flatnonzero((self.at[slot] >= 0) & (self.keys[slot] != keys))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & (self.slots - 1)
            s = slot[open_]
            open_ = open_[(self.at[s] >= 0) & (self.keys[s] != keys[open_])]
        return self.at[slot].astype(np.int64), slot

    def _add(self, keys: np.ndarray, words: list[str]) -> None:
        ids = self.encode(words)
        count = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter((i for x in ids for i in x), np.uint32, int(count.sum()))
        while self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.used:self.used + len(flat)] = flat
        new = np.arange(self.n, self.n + len(keys))
        self.count[new] = count
        self.start[new] = self.used + np.cumsum(count) - count
        self.used += len(flat)
        self.n += len(keys)
        left, entry = keys, new
        while len(left):  # two keys that want one slot: the first takes it, the other looks on
            _, slot = self._find(left)
            _, one = np.unique(slot, return_index=True)
            self.keys[slot[one]], self.at[slot[one]] = left[one], entry[one]
            rest = np.ones(len(left), bool)
            rest[one] = False
            left, entry = left[rest], entry[rest]

    def encode_texts(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        cut = [not self.whole(t) for t in texts]
        found = self._cut_texts([t for t, c in zip(texts, cut) if c])
        for t, c in zip(texts, cut):
            yield next(found) if c else np.array(self.encode([t])[0], "<u4").tobytes()

    def _cut_texts(self, texts: list[str]) -> Iterator[bytes]:
        raw = [t.encode() for t in texts]
        data = np.frombuffer(b"".join(raw), np.uint8)
        offsets = np.cumsum([0, *map(len, raw)])
        begin = cuts(data)
        begin[offsets[:-1][offsets[:-1] < len(data)]] = True
        a = np.flatnonzero(begin)
        z = np.append(a[1:], len(data))[:len(a)]
        cum = prefix_hash(data)
        _, inv = powers(len(data) + 1)
        h = mix((cum[z] - cum[a]) * inv[a] + (z - a).astype(U64))
        u, first, back = np.unique(h, return_index=True, return_inverse=True)
        # at most ``size`` words at a time: a batch with more goes in parts
        count, where, ids = np.zeros(len(u), np.int64), np.zeros(len(u), np.int64), []
        held = 0
        for lo in range(0, len(u), max(1, self.size // 2)):
            part = slice(lo, lo + max(1, self.size // 2))
            entry, _ = self._find(u[part])
            new = np.flatnonzero(entry < 0)
            if self.n + len(new) > self.size:
                self._clear()
                new = np.arange(len(entry))
            if len(new):
                words = [data[i:j].tobytes().decode() for i, j in zip(a[first[part]][new], z[first[part]][new])]
                self._add(u[part][new], words)
                entry, _ = self._find(u[part])
            count[part] = self.count[entry]
            where[part] = held + np.cumsum(count[part]) - count[part]
            ids.append(self.pool[ranges(self.start[entry], count[part])])
            held += len(ids[-1])
        pool = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
        flat = pool[ranges(where[back], count[back])].astype("<u4")
        ends = np.append(0, np.cumsum(count[back]))[np.searchsorted(a, offsets)]
        for i, j in zip(ends[:-1], ends[1:]):
            yield flat[i:j].tobytes()


def ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, … count[0] of them, then those of start[1], …"""
    ends = np.cumsum(count)
    return np.repeat(start - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)


def batches_of(texts: list[str], chars: int = BATCH_BYTES) -> Iterator[list[str]]:
    """Runs of texts of about ``chars`` characters, at least one text each."""
    run, n = [], 0
    for t in texts:
        run.append(t)
        n += len(t)
        if n >= chars:
            yield run
            run, n = [], 0
    if run:
        yield run
