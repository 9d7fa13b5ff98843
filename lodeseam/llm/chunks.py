"""Texts in chunks, and what chunks ask of ranges of the hash space.

What an operator has to know of the whole corpus about a hash (how many hold it, how often it
occurs) is decided by hash range, so nothing that grows with the corpus is broadcast or collected:

1. `chunked` packs rows into chunks of about `CHUNK_BYTES` of text, one compressed row each.
2. Each chunk sends its distinct hashes once, sorted and delta-coded, to the ranges they fall in
   (`fragments`). A hash that all documents hold is one entry a chunk, so no range is hot.
3. One task holds one range at a time, and answers each chunk in the order of its hashes; an answer
   is a byte a hash, and compresses to a few bits.
4. The chunk meets its answers (`answered`) and works on its texts again.

The number of ranges follows the bytes of text (`Space.of`), so the memory of a task doesn't. Hashes
are sent with `width` bits, eight more than the logarithm of the bytes of text: two different hashes
of a corpus are one cell with a probability below 1/256 each, and operators must hold for that.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_BYTES = 4_000_000
ROW_BITS = 16
#: Bytes of text for each range, and the fewest ranges.
RANGE_BYTES = 1 << 24
LEAST_RANGES = 16
CHUNK = "chunk long, bytes long, blob binary"


def pressed(raw: bytes | np.ndarray, level: int = 1) -> bytes:
    return zstandard.ZstdCompressor(level=level).compress(raw)


def unpressed(blob: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(blob)


def _blob(held: list[pa.RecordBatch]) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, held[0].schema) as out:
        for batch in held:
            out.write_batch(batch)
    return pressed(sink.getvalue(), 3)


def opened(blob: bytes) -> pa.Table:
    """The rows of a chunk."""
    return pa.ipc.open_stream(unpressed(blob)).read_all().combine_chunks()


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    chunk, held, rows, size = TaskContext.get().partitionId() << 20, [], 0, 0

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.array([size], pa.int64()), pa.array([_blob(held)], pa.binary())], names=["chunk", "bytes", "blob"])

    for batch in batches:
        upto = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
        at = 0
        while at < batch.num_rows:
            done = int(upto[at - 1]) if at else 0
            end = min(batch.num_rows, int(np.searchsorted(upto, done + CHUNK_BYTES - size)) + 1, at + (1 << ROW_BITS) - rows)
            held.append(batch.slice(at, end - at))
            rows, size, at = rows + end - at, size + int(upto[end - 1]) - done, end
            if size >= CHUNK_BYTES or rows >= 1 << ROW_BITS:
                yield out()
                chunk, held, rows, size = chunk + 1, [], 0, 0
    if held:
        yield out()


def chunked(df: DataFrame, then: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]] | None = None, schema: str = CHUNK) -> DataFrame:
    """chunk, bytes (of text, and one a row), blob: the rows of `df`, which has a column text, in chunks. To be written once: the numbers of chunks hold for the written table.

    `then` makes rows of `schema` of the chunks, in the same worker.
    """
    return df.mapInArrow((lambda batches: then(_pack(batches))) if then else _pack, schema)


class Space(NamedTuple):
    """How hashes are dealt: ranges (a power of two), and the bits of a hash that are sent."""

    range_bits: int
    width: int

    @classmethod
    def of(cls, text_bytes: int) -> Space:
        ranges = max(LEAST_RANGES, -(-text_bytes // RANGE_BYTES))
        return cls((ranges - 1).bit_length(), min(64, max(32, text_bytes.bit_length() + 8)))

    def cells(self, hashes: np.ndarray) -> np.ndarray:
        return hashes >> np.uint64(64 - self.width)

    def fragments(self, cells: np.ndarray, notes: np.ndarray, whole: bool = False) -> Iterator[tuple[int, bytes, bytes]]:
        """(range, sorted cells, their notes) of the ranges that these distinct sorted cells (or whole hashes) fall in."""
        first = cells >> np.uint64((64 if whole else self.width) - self.range_bits)
        ends = np.searchsorted(first, np.arange((1 << self.range_bits) + 1, dtype=np.uint64))
        for r in np.flatnonzero(np.diff(ends)):
            at = slice(ends[r], ends[r + 1])
            yield int(r), packed(cells[at]), wide(notes[at])


def wide(numbers: np.ndarray) -> bytes:
    """Numbers from 0 up, compressed byte plane by byte plane."""
    return pressed(numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes())


def unwide(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(unpressed(blob), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def packed(cells: np.ndarray) -> bytes:
    """Sorted numbers as compressed differences."""
    return wide(np.diff(cells, prepend=np.uint64(0)))


def unpacked(blob: bytes) -> np.ndarray:
    return np.cumsum(unwide(blob), dtype=np.uint64)


def summed(cells: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All distinct cells of some fragments, sorted, and the sums of their counts."""
    every = np.concatenate(cells)
    order = np.argsort(every, kind="stable")
    every = every[order]
    start = np.flatnonzero(np.concatenate(([True], every[1:] != every[:-1])))
    return every[start], np.add.reduceat(np.concatenate(counts)[order].astype(np.int64), start)


def text_bytes(chunks: DataFrame) -> int:
    return chunks.agg(F.sum("bytes")).first()[0] or 0


def texts_of(table: pa.Table) -> list[bytes | None]:
    return table.column("text").cast(pa.large_binary()).to_pylist()
