"""A family of suffix arrays whose sizes double, to find long matches as texts arrive."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np

#: Suffixes of the arrays that new texts make, and of those compared at a time.
BATCH = 1 << 17


class SuffixFamily:
    """Finds the sequences of ``width`` bytes that occur twice in all texts added.

    Texts arrive in batches. A batch gets an array of its suffixes of at least ``width``
    bytes, sorted by their first ``width``. The array is merged in order with those of the
    levels below the first free one, which it then fills, and is scanned in order along
    the larger ones. Equal neighbours are matches. Of equal suffixes one stays in the
    family, so a level holds each sequence once and copies cost nothing later.
    """

    def __init__(self, width: int, batch: int = BATCH):
        self.width, self.batch = width, batch
        self.data = np.zeros(1 << 16, np.uint8)
        self.size = 0
        self.matched = np.zeros(1 << 16, bool)
        self.levels: list[np.ndarray | None] = []
        self.waiting: list[np.ndarray] = []
        self.count = 0  # of suffixes that wait

    def add(self, text: bytes | memoryview, known: bool = False) -> int:
        """The place of the text; ``known`` marks all its sequences as matched."""
        at, end = self.size, self.size + len(text)
        if end > len(self.data):
            room = max(end, 2 * len(self.data))
            self.data = np.concatenate((self.data[:at], np.zeros(room - at, np.uint8)))
            self.matched = np.concatenate((self.matched[:at], np.zeros(room - at, bool)))
        self.data[at:end] = np.frombuffer(text, np.uint8)
        self.size = end
        suffixes = max(0, len(text) - self.width + 1)
        if suffixes:
            self.matched[at : at + suffixes] = known
            self.waiting.append(np.arange(at, at + suffixes))
            self.count += suffixes
            if self.count >= self.batch:
                self.flush()
        return at

    def flush(self) -> None:
        """Index the texts that wait."""
        if not self.waiting:
            return
        suffixes, self.waiting, self.count = np.concatenate(self.waiting), [], 0
        for at in range(0, len(suffixes), self.batch):
            self._insert(suffixes[at : at + self.batch])

    def _insert(self, suffixes: np.ndarray) -> None:
        keys = self._keys(suffixes)
        order = np.argsort(keys, kind="stable")
        new = self._different(suffixes[order], keys[order])
        free = next((i for i, level in enumerate(self.levels) if level is None), len(self.levels))
        for level in self.levels[free + 1 :]:
            if level is not None:
                new = self._scanned(new, level)
        for i in range(free):
            new = self._merged(new, self.levels[i])
            self.levels[i] = None
        self.levels[free : free + 1] = [new]

    def _keys(self, suffixes: np.ndarray) -> np.ndarray:
        rows = np.lib.stride_tricks.sliding_window_view(self.data[: self.size], self.width)[suffixes]
        return np.ascontiguousarray(rows).view(f"S{self.width}").ravel()

    def _different(self, suffixes: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """The first of each run of equal suffixes; all of a longer run are matched."""
        same = keys[1:] == keys[:-1]
        self.matched[suffixes[1:][same]] = True
        self.matched[suffixes[:-1][same]] = True
        return suffixes[np.concatenate(([True], ~same))]

    def _sequence(self, suffix: int) -> bytes:
        return self.data[suffix : suffix + self.width].tobytes()

    def _stretches(self, a: np.ndarray, b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Both arrays in stretches between the same sequences, none longer than a batch."""
        every = [*a[self.batch :: self.batch].tolist(), *b[self.batch :: self.batch].tolist()]
        a0 = b0 = 0
        for cut in sorted({self._sequence(suffix) for suffix in every}):
            a1, b1 = (bisect_left(array, cut, key=self._sequence) for array in (a, b))
            yield a[a0:a1], b[b0:b1]
            a0, b0 = a1, b1
        yield a[a0:], b[b0:]

    def _merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        parts = []
        for x, y in self._stretches(a, b):
            both = np.concatenate((x, y))
            if len(both):
                keys = self._keys(both)
                order = np.argsort(keys, kind="stable")  # merges two sorted runs
                parts.append(self._different(both[order], keys[order]))
        return np.concatenate(parts) if parts else a

    def _scanned(self, a: np.ndarray, level: np.ndarray) -> np.ndarray:
        """The suffixes of ``a`` that the level does not hold; the others are matched."""
        parts = []
        for x, y in self._stretches(a, level):
            if len(x) and len(y):
                held, keys = self._keys(y), self._keys(x)
                at = np.minimum(np.searchsorted(held, keys), len(y) - 1)
                same = held[at] == keys
                self.matched[x[same]] = True
                self.matched[y[at[same]]] = True
                x = x[~same]
            parts.append(x)
        return np.concatenate(parts)

    def intervals(self) -> tuple[np.ndarray, np.ndarray]:
        """(start, end) of the bytes that matched sequences cover, by run of their starts."""
        self.flush()
        marks = np.concatenate(([0], self.matched[: self.size].view(np.int8), [0]))
        steps = np.diff(marks)
        return np.flatnonzero(steps == 1), np.flatnonzero(steps == -1) + self.width - 1
