"""Elias-Fano sequences and a trie of n-grams over them, held in flat byte buffers.

A monotone sequence of n numbers below u takes about 2 + log2(u/n) bits each: the low bits
packed side by side, the high bits in unary. The buffers are plain memory without pointers,
so a level can be mapped from shared memory, a file or an Arrow buffer without parsing.
"""

from __future__ import annotations

import mmap

import numpy as np

from helixmill.llm.shared import U

_ONE = U(1)


def mapped(array: np.ndarray) -> np.ndarray:
    """A copy in an anonymous memory mapping, outside Python's heap."""
    raw = np.ascontiguousarray(array)
    if not raw.nbytes:
        return raw
    area = mmap.mmap(-1, raw.nbytes)
    area.write(raw.tobytes())
    return np.frombuffer(area, dtype=raw.dtype)


class EliasFano:
    """A non-decreasing sequence of numbers below 2**64 with random access and search."""

    def __init__(self, values: np.ndarray):
        values = np.asarray(values, dtype=np.uint64)
        self.n = n = len(values)
        self.top = top = int(values[-1]) if n else 0
        self.low_bits = low = max(0, (top // max(1, n)).bit_length() - 1)
        self.low = mapped(self._pack(values & U((1 << low) - 1), low))
        high = (values >> U(low)).astype(np.int64)
        ones = high + np.arange(n)
        words = (int(ones[-1]) // 64 if n else 0) + 2
        bits = np.zeros(words * 64, dtype=np.uint8)
        bits[ones] = 1
        packed = np.packbits(bits, bitorder="little").view(np.uint64)
        self.high = mapped(packed)
        counts = np.bitwise_count(packed).astype(np.int64)
        #: Zeros and ones before each 64-bit word: the directory for select.
        self.ones = mapped(np.concatenate(([0], np.cumsum(counts))))
        self.zeros = mapped(np.arange(words + 1) * 64 - self.ones)

    @staticmethod
    def _pack(values: np.ndarray, width: int) -> np.ndarray:
        out = np.zeros(len(values) * width // 64 + 2, dtype=np.uint64)
        if width and len(values):
            at = np.arange(len(values)) * width
            word, shift = at >> 6, (at & 63).astype(np.uint64)
            np.bitwise_or.at(out, word, values << shift)
            over = (at & 63) + width > 64
            np.bitwise_or.at(out, word[over] + 1, values[over] >> (U(64) - shift[over]))
        return out

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        at = i * self.low_bits
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        first = self.low[word] >> shift
        second = np.where(shift > 0, self.low[word + 1] << ((U(64) - shift) & U(63)), U(0))
        return (first | second) & U((1 << self.low_bits) - 1)

    def _select(self, k: np.ndarray, one: bool) -> np.ndarray:
        """Positions of the k-th (from 0) ones or zeros of the high bits."""
        before = self.ones if one else self.zeros
        word = np.minimum(np.searchsorted(before, k, side="right") - 1, len(self.high) - 1)
        left = k - before[word]
        bits = self.high[word] if one else ~self.high[word]
        place = np.zeros(len(k), np.int64)
        for step in (32, 16, 8, 4, 2, 1):  # halves the word that holds the bit
            part = bits & U((1 << step) - 1)
            count = np.bitwise_count(part).astype(np.int64)
            right = left >= count
            left = np.where(right, left - count, left)
            bits = np.where(right, bits >> U(step), part)
            place += np.where(right, step, 0)
        return word * 64 + place

    def get(self, i: np.ndarray) -> np.ndarray:
        i = np.asarray(i, dtype=np.int64)
        high = self._select(i, True) - i
        return (high.astype(np.uint64) << U(self.low_bits)) | self._low(i)

    def successor(self, values: np.ndarray, begin: np.ndarray | None = None, stop: np.ndarray | None = None) -> np.ndarray:
        """Index of the first element that is not less than each value; n if there is none.

        With begin and stop only elements of [begin, stop) are looked at, and stop is the answer
        where none of them will do.
        """
        values = np.asarray(values, dtype=np.uint64)
        if not self.n:
            return np.zeros(len(values), np.int64)
        beyond = values > U(self.top)
        values = np.minimum(values, U(self.top))
        high = (values >> U(self.low_bits)).astype(np.int64)
        low = values & U((1 << self.low_bits) - 1)
        # Elements of a high part stand between its zero and the one before.
        at = np.where(high > 0, self._select(np.maximum(high, 1) - 1, False) + 1 - high, 0)
        at = np.where(beyond, self.n, at)
        end = np.minimum(self._select(high, False) - high, self.n)
        if begin is not None:  # the bucket's part inside the range
            at, end = np.clip(at, begin, stop), np.clip(end, begin, stop)
        while True:  # halves the part of the bucket that each value may be in
            live = np.flatnonzero(at < end)
            if not len(live):
                return at
            middle = (at[live] + end[live]) // 2
            less = self._low(middle) < low[live]
            at[live] = np.where(less, middle + 1, at[live])
            end[live] = np.where(less, end[live], middle)


QUANTA = 254


def floor_of(tokens: int, discount: float) -> float:
    """log10 of the least probability or weight above 0 that counts up to `tokens` can give, so
    that none has to be raised to the scale's end, however large the corpus."""
    least = min(x for x in (discount, 1 - discount) if x > 0)
    return float(np.log10(least / max(tokens, 1)))


def quantised(p: np.ndarray, floor: float) -> np.ndarray:
    """Probabilities as bytes: 0 for none, else 1 + steps of log10 from floor to 0."""
    with np.errstate(divide="ignore"):
        logs = np.log10(p)
    code = 1 + np.rint((np.maximum(logs, floor) - floor) / -floor * QUANTA)
    return np.where(p > 0, code, 0).astype(np.uint8)


def values_of(floor: float) -> np.ndarray:
    """The probability of each byte."""
    return np.concatenate(([0.0], 10.0 ** (floor + np.arange(QUANTA + 1) / QUANTA * -floor)))


class Trie:
    """N-grams of one shard with their counts' discounted probabilities.

    Level 1 holds words (64-bit hashes) and counts; below, a node's children stand together,
    found through monotone pointers, with 32-bit ids made monotone by adding the number of
    the context times 2**32. A lookup goes to its context and searches for the id's successor
    among the context's children only.
    """

    def __init__(self, words: np.ndarray, counts: np.ndarray, levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]], discount: float, floor: float):
        """levels: per further order (parent index, id, count), sorted; all counts above 0. floor
        is the bytes' scale, see floor_of."""
        self.words, self.counts = EliasFano(words), mapped(counts.astype(np.int64))
        self.pointers, self.ids, self.codes, self.children, self.backoffs = [], [], [], [], []
        above = counts
        for parent, ids, own in levels:
            kinds = np.bincount(parent, minlength=len(above))
            self.children.append(mapped(kinds))
            self.pointers.append(EliasFano(np.concatenate(([0], np.cumsum(kinds)))))
            self.ids.append(EliasFano((parent.astype(np.uint64) << U(32)) | ids.astype(np.uint64)))
            self.codes.append(mapped(quantised((own - discount) / above[parent], floor)))
            self.backoffs.append(mapped(quantised(discount * kinds / np.maximum(above, 1), floor)))
            above = own

    def roots(self, words: np.ndarray) -> np.ndarray:
        """Index of each word on level 1, -1 for unknown ones."""
        at = self.words.successor(words)
        found = at < self.words.n
        found[found] = self.words.get(at[found]) == words[found]
        return np.where(found, at, -1)

    def find(self, level: int, context: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Index on level (from 0 below the words) of each id under its context, or -1."""
        out = np.full(len(context), -1)
        known = np.flatnonzero(context >= 0)
        at = context[known]
        begin, end = (self.pointers[level].get(x).astype(np.int64) for x in (at, at + 1))
        value = (at.astype(np.uint64) << U(32)) | ids[known].astype(np.uint64)
        place = self.ids[level].successor(value, begin, end)
        found = place < end
        found[found] = self.ids[level].get(place[found]) == value[found]
        out[known[found]] = place[found]
        return out
