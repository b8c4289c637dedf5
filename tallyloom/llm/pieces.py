"""Distinct pieces of texts and what is known of each, kept by a Python worker as growing NumPy arrays."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

#: Pieces kept per worker; beyond it the store starts anew. It bounds memory only, not results.
KEPT_PIECES = 600_000


class Grown:
    """An array that grows at its end."""

    def __init__(self, dtype):
        self.data, self.n = np.empty(1 << 16, dtype), 0

    def add(self, more: np.ndarray) -> None:
        need = self.n + len(more)
        if need > len(self.data):
            wider = np.empty(max(need, 2 * len(self.data)), self.data.dtype)
            wider[: self.n] = self.data[: self.n]
            self.data = wider
        self.data[self.n : need] = more
        self.n = need

    @property
    def values(self) -> np.ndarray:
        return self.data[: self.n]


class Ragged:
    """Lists of numbers, one after the other."""

    def __init__(self, dtype):
        self.flat, self.ends = Grown(dtype), Grown(np.int64)
        self.ends.add(np.zeros(1, np.int64))

    def add(self, flat: np.ndarray, lengths: np.ndarray) -> None:
        self.ends.add(self.flat.n + np.cumsum(lengths, dtype=np.int64))
        self.flat.add(flat)

    def take(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lists of ``codes`` put together, and their lengths."""
        ends = self.ends.values
        starts = ends[codes]
        lengths = ends[codes + 1] - starts
        after = np.cumsum(lengths)
        index = np.arange(after[-1] if len(after) else 0) + np.repeat(starts - after + lengths, lengths)
        return self.flat.values[index], lengths


class Codes:
    """Numbers 0, 1, ... of pieces in order of first sight; ``learn`` is told of new ones, in that order."""

    def __init__(self, learn: Callable[[list[str]], None]):
        self.known: dict[str, int] = {}
        self.learn = learn

    def __call__(self, pieces: pa.Array) -> np.ndarray:
        coded = pieces.dictionary_encode()
        words = coded.dictionary.to_pylist()
        new = [w for w in words if w not in self.known]
        if new:
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
            self.learn(new)
        own = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        return own[coded.indices.to_numpy()]


def sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sum of each of the runs of ``lengths`` values, exact for integers."""
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(lengths)
    return total[ends] - total[ends - lengths]
