"""Words and word shingles of many texts at once, as 64-bit hashes in numpy."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa

#: Bytes hashed in one go.
_STEP = 1 << 20
_BASE = 0x9E3779B97F4A7C15
#: White space that separates words.
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def constants(n: int, seed: int) -> np.ndarray:
    """Odd 64-bit numbers; the same on every machine."""
    with np.errstate(over="ignore"):
        return mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_BASE) + np.uint64(seed)) | np.uint64(1)


class Hasher:
    """Hashes of the lower-cased (A-Z) words of texts; the same text has the same hashes anywhere."""

    def __init__(self, separators: Iterable[int] = SPACES):
        self.separates = np.zeros(256, bool)
        self.separates[list(separators)] = True
        self.letters = constants(256, 1)
        self.letters[65:91] = self.letters[97:123]
        self._grow(_STEP + 1)

    def _grow(self, n: int) -> None:
        steps = np.full(n, _BASE, np.uint64)
        steps[0] = 1
        self.powers = np.multiply.accumulate(steps)
        steps[1:] = pow(_BASE, -1, 1 << 64)
        self.inverse = np.multiply.accumulate(steps)

    def words(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(hash of each word, offsets of the texts in it: one more than texts)."""
        data, begin, end, offsets = self.spans(column)
        return self.hashes(data, begin, end), offsets

    def spans(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(bytes of all texts, where each word begins and ends in them, offsets of the texts)."""
        binary = column.cast(pa.large_binary()).fill_null(b"")
        bounds = np.frombuffer(binary.buffers()[1], np.int64)[binary.offset : binary.offset + len(binary) + 1]
        data = binary.buffers()[2]
        data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]]
        bounds = bounds - bounds[0]
        if not len(data):
            none = np.zeros(0, np.int64)
            return data, none, none, np.zeros(len(bounds), np.int64)
        inside = ~self.separates[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[bounds] = True
        begin = inside.copy()
        begin[1:] &= ~inside[:-1] | edge[1:-1]
        end = inside.copy()
        end[:-1] &= ~inside[1:] | edge[1:-1]
        begin, end = np.flatnonzero(begin), np.flatnonzero(end) + 1
        return data, begin, end, np.searchsorted(begin, bounds)

    def hashes(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        out, i = np.empty(len(begin), np.uint64), 0
        while i < len(begin):
            j = max(i + 1, int(np.searchsorted(end, begin[i] + _STEP, "right")))
            a, b = int(begin[i]), int(end[j - 1])
            if b - a >= len(self.powers):
                self._grow(b - a + 1)
            values = np.zeros(b - a + 1, np.uint64)
            np.multiply(self.letters[data[a:b]], self.powers[: b - a], out=values[:-1])
            cuts = np.empty(2 * (j - i), np.int64)
            cuts[::2], cuts[1::2] = begin[i:j] - a, end[i:j] - a
            out[i:j] = np.add.reduceat(values, cuts)[::2] * self.inverse[begin[i:j] - a]
            i = j
        return mixed(out)


def shingles(words: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of each text, offsets); a shorter text is one shingle."""
    times = constants(size + 1, 2)
    grams = np.zeros(max(len(words) - size + 1, 0), np.uint64)
    for k in range(size):
        grams += words[k : k + len(grams)] * times[k]
    grams = mixed(grams)
    out, bounds = [], [0]
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        if b - a >= size:
            found = np.sort(grams[a : b - size + 1])
            if len(found) > 1:
                found = found[np.concatenate(([True], found[1:] != found[:-1]))]
        elif b > a:
            length = times[size:] * np.array([b - a], np.uint64)
            found = mixed((words[a:b] * times[: b - a]).sum(keepdims=True) + length)
        else:
            found = grams[:0]
        out.append(found)
        bounds.append(bounds[-1] + len(found))
    return (np.concatenate(out) if out else grams), np.array(bounds, np.int64)
