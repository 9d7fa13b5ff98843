"""64-bit hashes of words for many texts at once, in numpy.

A word's hash is a polynomial of its bytes modulo 2**64, taken from sums over the whole buffer, and
then mixed; it depends on the word alone. Work goes in buffers of about `BUFFER` bytes, so memory
doesn't follow the length of texts.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BUFFER = 1 << 20
BASE = 0x9E3779B97F4A7C15
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class WordHasher:
    """Hashes the words (runs of anything but space and \\t to \\r, A-Z lower-cased) of texts."""

    def __init__(self) -> None:
        self._grow(1 << 16)

    def _grow(self, n: int) -> None:
        def powers(base: int) -> np.ndarray:
            out = np.full(n + 1, base, np.uint64)
            out[0] = 1
            return np.multiply.accumulate(out)

        self.up, self.down = powers(BASE), powers(pow(BASE, -1, 1 << 64))

    def _buffer(self, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Where words start, and their hashes."""
        a = np.frombuffer(raw, np.uint8)
        if len(a) >= len(self.up):
            self._grow(2 * len(a))
        gap = IS_SPACE[a]
        turn = np.flatnonzero(np.diff(gap, prepend=True, append=True))
        starts, ends = turn[::2], turn[1::2]
        sums = np.zeros(len(a) + 1, np.uint64)
        np.cumsum(a * self.up[: len(a)], out=sums[1:])
        return starts, mix((sums[ends] - sums[starts]) * self.down[starts])

    def __call__(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """The hashes of all words in their order, and the number of words of each text."""
        raw = b"\n".join(t or b"" for t in texts).lower()
        firsts = np.concatenate(([0], np.cumsum([len(t or b"") + 1 for t in texts])))
        starts, hashes, at = [], [], 0
        while at < len(raw):
            end = at + BUFFER
            if end < len(raw):  # on to the next gap, so that no word is cut
                cut = next((i for i in range(end, len(raw)) if IS_SPACE[raw[i]]), len(raw))
                end = cut
            s, h = self._buffer(raw[at:end])
            starts.append(s + at)
            hashes.append(h)
            at = end
        if not hashes:
            return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
        return np.concatenate(hashes), np.diff(np.searchsorted(np.concatenate(starts), firsts))


def tidy() -> None:
    """Gives memory that a task has freed back to the machine; workers live on, and would keep it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


#: Texts are worked on so many bytes, and rows, at a time.
PART_BYTES = 1 << 19
PART_ROWS = 256


def groups(texts: list[bytes | None]) -> Iterator[tuple[int, list[bytes | None]]]:
    """The texts some at a time, about `PART_BYTES` of them, with the first one's place."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or b"")
        if size >= PART_BYTES or i + 1 - first >= PART_ROWS:
            yield first, texts[first : i + 1]
            first, size = i + 1, 0
    if first < len(texts):
        yield first, texts[first:]


def parts(batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[int, list[bytes | None]]]:
    """The texts of a batch as bytes, some at a time, with the first row's place."""
    for at in range(0, batch.num_rows, PART_ROWS):
        for i, texts in groups(batch.column(column).slice(at, PART_ROWS).cast(pa.large_binary()).to_pylist()):
            yield at + i, texts
