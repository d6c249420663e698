"""A compressed full-text index over word sequences, searched for many words at once."""

from __future__ import annotations

import numpy as np


class BitVector:
    """Packed bits with counts of ones before each word of 64."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        ones = np.bitwise_count(self.words)
        self.before = np.concatenate(([0], np.cumsum(ones, dtype=np.int64)[:-1]))

    def ones(self, at: np.ndarray) -> np.ndarray:
        """How many ones stand before each place."""
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        low = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[word] + np.bitwise_count(low)


class WaveletTree:
    """Ranks of symbols, one bit vector per bit of the alphabet, the highest first."""

    def __init__(self, symbols: np.ndarray, size: int):
        self.levels = []
        current = symbols
        for shift in reversed(range(max(1, int(size - 1).bit_length()))):
            bits = (current >> shift) & 1
            zeros = int(len(bits) - bits.sum())
            self.levels.append((shift, BitVector(bits), zeros))
            current = np.concatenate((current[bits == 0], current[bits == 1]))
        # Where each symbol's block starts on the last level.
        self.first = self._descend(np.arange(size), np.zeros(size, np.int64))

    def _descend(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for shift, bits, zeros in self.levels:
            ones = bits.ones(at)
            at = np.where((symbols >> shift) & 1, ones + zeros, at - ones)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        return self._descend(symbols, at) - self.first[symbols]


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Start places of the suffixes in sorted order, by doubling the compared length."""
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    length = 1
    while True:
        after = np.zeros(len(rank), np.int64)
        after[: max(0, len(rank) - length)] = rank[length:] + 1
        pair = rank * (len(rank) + 1) + after
        order = np.argsort(pair, kind="stable")
        sorted_pair = pair[order]
        steps = np.concatenate(([0], np.cumsum(sorted_pair[1:] != sorted_pair[:-1])))
        rank = np.empty(len(rank), np.int64)
        rank[order] = steps
        length *= 2
        if not len(steps) or steps[-1] == len(steps) - 1:
            return order


class FMIndex:
    """Index of several sequences of symbols above zero; nothing matches across their ends."""

    def __init__(self, sequences: list[np.ndarray]):
        self.starts = np.cumsum([0] + [len(s) + 1 for s in sequences], dtype=np.int64)[:-1]
        size = 1 + max((int(s.max()) for s in sequences if len(s)), default=0)
        count = len(sequences)
        text = np.zeros(int(sum(len(s) + 1 for s in sequences)), np.int64)
        ends = np.zeros(len(text), bool)
        for start, sequence in zip(self.starts, sequences):
            text[start : start + len(sequence)] = sequence
            ends[start + len(sequence)] = True
        # Every end mark sorts before all words, and differs from the other marks.
        distinct = text + count
        distinct[ends] = np.arange(count)
        order = suffix_order(distinct)
        before = text[order - 1]
        self.text = text
        self.tree = WaveletTree(before, size)
        occurrences = np.bincount(text, minlength=size)
        self.before = np.concatenate(([0], np.cumsum(occurrences)[:-1]))
        self.occurrences = occurrences

    def matching_statistics(self, ends: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(lengths, rows): the longest repeated sequence that ends at each place of the text.

        Backward search from each place, for all places together: the range of rows
        shrinks as the match grows to the left. A match ends before its range has shrunk
        to the place itself, or at ``most`` words. ``rows`` is the first row of a match's
        range; matches of one length with the same words, and only those, have the same.
        """
        lengths, rows = np.zeros(len(ends), np.int64), np.full(len(ends), -1, np.int64)
        left = np.flatnonzero(most > 0)
        last = self.text[ends[left]]
        low, high = self.before[last], self.before[last] + self.occurrences[last]
        length = 1
        while len(left):
            several = high - low > 1
            left, low, high = left[several], low[several], high[several]
            lengths[left], rows[left] = length, low
            further = most[left] > length
            left, low, high = left[further], low[further], high[further]
            if not len(left):
                break
            symbol = self.text[ends[left] - length]
            ranks = self.tree.rank(np.concatenate((symbol, symbol)), np.concatenate((low, high)))
            base = self.before[symbol]
            low, high = base + ranks[: len(left)], base + ranks[len(left) :]
            length += 1
        return lengths, rows

    def matches(self, starts: np.ndarray, length: int) -> np.ndarray:
        """For the window at each place of the text, the first row of its range, or -1.

        Windows whose matching statistic is below their length occur once.
        """
        lengths, rows = self.matching_statistics(starts + length - 1, np.full(len(starts), length))
        return np.where(lengths == length, rows, -1)
