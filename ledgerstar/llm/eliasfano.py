"""Elias-Fano sequences and an n-gram trie over them.

Both are plain byte strings. A reader maps them: its arrays are views on the
buffer, whether that is a row of a model table or a memory-mapped file, and
nothing is unpacked beforehand. All searches take arrays of queries.
"""

from __future__ import annotations

import struct

import numpy as np

_HEAD = "<QQQQ"
_POP = np.array([bin(b).count("1") for b in range(256)], np.uint8)
#: Position of the r-th zero bit of a byte, [byte][r].
_ZERO = np.array([([k for k in range(8) if not b >> k & 1] + [8] * 8)[:8] for b in range(256)], np.uint8)


def _padded(raw: bytes) -> bytes:
    return raw + bytes(-len(raw) % 8 + 8)  # eight spare bytes: words are read at any byte


class EliasFano:
    """A sequence of ascending unsigned numbers: the low bits of each as they
    are, the high bits as a bit vector with a one per number and a zero per
    step of the high part."""

    @staticmethod
    def encode(values: np.ndarray) -> bytes:
        values = values.astype(np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        low = max(0, min(56, (top // max(1, n)).bit_length() - 1))
        high = (values >> np.uint64(low)).astype(np.int64)
        size = n + (int(high[-1]) if n else 0) + 1
        bits = np.zeros(size + -size % 64, np.uint8)
        bits[high + np.arange(n)] = 1
        words = np.packbits(bits, bitorder="little").view("<u8")
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.uint64)]).astype("<u8")
        lows = []
        for at in range(0, n if low else 0, 1 << 16):  # 2**16 numbers fill whole bytes
            part = values[at:at + (1 << 16)]
            lows.append(np.packbits(((part[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8), bitorder="little").tobytes())
        raw_low = _padded(b"".join(lows))
        return struct.pack(_HEAD, n, low, len(words), len(raw_low)) + words.tobytes() + ones.tobytes() + raw_low

    def __init__(self, buffer, at: int = 0):
        self.n, self.low, n_words, n_low = struct.unpack_from(_HEAD, buffer, at)
        at += struct.calcsize(_HEAD)
        self.words = np.frombuffer(buffer, "<u8", n_words, at)
        at += 8 * n_words
        self.ones = np.frombuffer(buffer, "<u8", n_words + 1, at)
        at += 8 * (n_words + 1)
        raw = np.frombuffer(buffer, np.uint8, n_low, at)
        self.lows = np.ndarray((max(0, n_low - 7),), "<u8", raw, strides=(1,))  # a word from every byte on
        self.end = at + n_low
        self.zeros = None

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low:
            return np.zeros(len(i), np.uint64)
        bit = i.astype(np.int64) * self.low
        return (self.lows[bit >> 3] >> (bit & 7).astype(np.uint64)) & np.uint64((1 << self.low) - 1)

    def _before_zero(self, j: np.ndarray) -> np.ndarray:
        """How many ones stand before the j-th zero (from 0)."""
        if self.zeros is None:
            self.zeros = 64 * np.arange(len(self.ones), dtype=np.int64) - self.ones.astype(np.int64)
        w = np.searchsorted(self.zeros, j, side="right") - 1
        w = np.minimum(w, len(self.words) - 1)
        left = j - self.zeros[w]
        word, place, searching = self.words[w], np.zeros(len(j), np.int64), np.ones(len(j), bool)
        for b in range(8):
            byte = ((word >> np.uint64(8 * b)) & np.uint64(255)).astype(np.int64)
            free = 8 - _POP[byte].astype(np.int64)
            here = searching & (left < free)
            place[here] = 8 * b + _ZERO[byte[here], left[here]]
            searching &= ~here
            left = np.where(searching, left - free, left)
        return 64 * w + place - j

    def get(self, i: np.ndarray) -> np.ndarray:
        """The numbers at the places ``i``."""
        i = i.astype(np.int64)
        w = np.searchsorted(self.ones, i.astype(np.uint64), side="right") - 1
        left = i - self.ones[w].astype(np.int64)
        word, place, searching = self.words[w], np.zeros(len(i), np.int64), np.ones(len(i), bool)
        for b in range(8):
            byte = ((word >> np.uint64(8 * b)) & np.uint64(255)).astype(np.int64)
            held = _POP[byte].astype(np.int64)
            here = searching & (left < held)
            place[here] = 8 * b + _ZERO[255 - byte[here], left[here]]
            searching &= ~here
            left = np.where(searching, left - held, left)
        return ((64 * w + place - i).astype(np.uint64) << np.uint64(self.low)) | self._low(i)

    def successor(self, values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """For each value, the first place in [start, end) that holds as much or more; end if none does."""
        values = values.astype(np.uint64)
        n_zeros = 64 * len(self.words) - int(self.ones[-1])
        high = np.minimum(values >> np.uint64(self.low), np.uint64(n_zeros)).astype(np.int64)
        want = values & np.uint64((1 << self.low) - 1)
        past = high >= n_zeros
        high = np.minimum(high, n_zeros - 1)
        lo = np.where(high > 0, self._before_zero(np.maximum(high - 1, 0)), 0)
        hi = np.minimum(self._before_zero(high), self.n)
        lo, hi = np.clip(np.where(past, self.n, lo), start, end), np.clip(np.where(past, self.n, hi), start, end)
        while True:
            open_ = lo < hi
            if not open_.any():
                return lo
            mid = (lo + hi) >> 1
            less = open_ & (self._low(np.minimum(mid, max(0, self.n - 1))) < want)
            lo = np.where(less, mid + 1, lo)
            hi = np.where(open_ & ~less, mid, hi)


#: Codes per unit of log10; a code is -log10(p) times this, rounded.
PER_UNIT = 2048
#: The code of what is not in the trie.
MISS = 65535


def quantise(log10p: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(-log10p * PER_UNIT), 0, MISS - 1).astype("<u2")


def probability(code: np.ndarray) -> np.ndarray:
    """The probability of a code; 0 for MISS."""
    return np.where(code == MISS, 0.0, 10.0 ** (code.astype(np.float64) / -PER_UNIT))


class Trie:
    """Two levels. Contexts: ascending ids, each with the code of its back-off
    weight and a pointer to its successors. Successors: ascending ids in each
    context, stored relative to the last one of the context before, so that
    the whole level ascends; each has the code of its probability."""

    @staticmethod
    def encode(contexts: np.ndarray, backoff: np.ndarray, owner: np.ndarray, successor: np.ndarray, code: np.ndarray) -> bytes:
        """``owner`` numbers the context of each successor; pairs ascend."""
        pointer = np.searchsorted(owner, np.arange(len(contexts) + 1))
        filled = np.flatnonzero(np.diff(pointer))
        last = successor[pointer[filled + 1] - 1].astype(np.uint64) + np.uint64(1)
        base = np.concatenate([[0], np.cumsum(last)[:-1]]).astype(np.uint64) if len(filled) else np.zeros(0, np.uint64)
        level = successor.astype(np.uint64) + np.repeat(base, np.diff(pointer)[filled])
        parts = [EliasFano.encode(contexts), EliasFano.encode(pointer), EliasFano.encode(level),
                 *(_padded(c.astype("<u2").tobytes()) for c in (backoff, code))]
        return struct.pack("<5Q", *map(len, parts)) + b"".join(parts)

    def __init__(self, buffer, at: int = 0):
        sizes = struct.unpack_from("<5Q", buffer, at)
        places = at + 40 + np.concatenate([[0], np.cumsum(sizes)])
        self.contexts, self.pointer, self.level = (EliasFano(buffer, int(p)) for p in places[:3])
        self.backoff, self.code = (np.frombuffer(buffer, "<u2", k, int(p)) for k, p in zip((self.contexts.n, self.level.n), places[3:5], strict=True))

    def numbers(self, contexts: np.ndarray) -> np.ndarray:
        """The numbers of contexts by id; -1 if there is none."""
        n = self.contexts.n
        if not n:
            return np.full(len(contexts), -1, np.int64)
        i = self.contexts.successor(contexts, np.zeros(len(contexts), np.int64), np.full(len(contexts), n, np.int64))
        found = i < n
        found[found] = self.contexts.get(i[found]) == contexts[found].astype(np.uint64)
        return np.where(found, i, -1)

    def codes(self, context: np.ndarray, word: np.ndarray, chunk: int = 1 << 17) -> np.ndarray:
        """The codes of (context id, word id) pairs; MISS for those not stored."""
        out = np.full(len(word), MISS, "<u2")
        for at in range(0, len(word) if self.level.n else 0, chunk):
            w, number = word[at:at + chunk], self.numbers(context[at:at + chunk])
            known = np.flatnonzero(number >= 0)
            w, number = w[known].astype(np.uint64), number[known]
            start, end = self.pointer.get(number).astype(np.int64), self.pointer.get(number + 1).astype(np.int64)
            base = np.zeros(len(w), np.uint64)
            inner = start > 0
            base[inner] = self.level.get(start[inner] - 1) + np.uint64(1)
            i = self.level.successor(base + w, start, end)
            hit = i < end
            hit[hit] = self.level.get(i[hit]) == (base + w)[hit]
            out[at + known[hit]] = self.code[i[hit]]
        return out
