"""Two Bloom filters over 64-bit hashes: cells seen once, and cells seen at least twice.

Every task sends the cells it met, sorted, delta-coded and compressed, in 256 ranges; one task for
each range adds up their counts (a cell that two tasks met, or one task met twice, goes to the second
filter; more filters for higher counts can be had). Only these go back to the workers. A hash that was added twice is always
found in it; a hash added once is found with a small probability that the load of the filter sets,
so what is found has to be confirmed exactly.

Size: the filter has the next power of two over `cells_per_entry` cells an entry, at most
2**`MAX_BITS` cells, i.e. 64 MB. Beyond that the filter fills up and more is left to the exact
confirmation; results stay the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

MAX_BITS = 29
MIN_BITS = 16
RANGES = 256
#: Counts in a fragment go up to this.
MOST = 127
FRAGMENT = "range int, entries long, blob binary"


def _cells(hashes: np.ndarray, probes: int) -> np.ndarray:
    """The 32-bit cell numbers of each hash, one row for each probe (1 or 2)."""
    parts = [(hashes >> np.uint64(32)).astype(np.uint32), hashes.astype(np.uint32)]
    return np.stack(parts[:probes])


class SeenBuilder:
    """Gathers the hashes of one task; take() returns the fragments to send."""

    def __init__(self, probes: int = 1, flush_at: int = 3_000_000) -> None:
        self.probes, self.flush_at, self.held, self.n = probes, flush_at, [], 0

    def add(self, hashes: np.ndarray) -> bool:
        """Adds hashes, each meant once; true when it is time to take()."""
        self.held.append(hashes)
        self.n += len(hashes)
        return self.n >= self.flush_at

    def take(self) -> pa.RecordBatch:
        rows: list[tuple[int, int, bytes]] = []
        if self.n:
            cells = _cells(np.concatenate(self.held).astype(np.uint64), self.probes).ravel()
            cells.sort()
            new = np.concatenate(([True], cells[1:] != cells[:-1]))
            at = np.flatnonzero(new)
            times = np.minimum(np.diff(np.append(at, len(cells))), MOST).astype(np.uint64)
            marked = (cells[at].astype(np.uint64) << np.uint64(7)) | times
            ends = np.searchsorted(marked >> np.uint64(31), np.arange(RANGES + 1))
            packer = zstandard.ZstdCompressor(level=1)
            for r in np.flatnonzero(np.diff(ends)):
                part = marked[ends[r] : ends[r + 1]] & np.uint64((1 << 31) - 1)
                deltas = np.diff(part, prepend=np.uint64(0)).astype("<u4")
                rows.append((int(r), len(part), packer.compress(deltas.view(np.uint8).reshape(-1, 4).T.tobytes())))
        self.held, self.n = [], 0
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in rows], pa.int32()), pa.array([x[1] for x in rows], pa.int64()), pa.array([x[2] for x in rows], pa.binary())], names=["range", "entries", "blob"])


class CellFilter:
    """Bits for the cells that were met often enough, for one or more bounds."""

    def __init__(self, bits: list[np.ndarray], width: int, probes: int) -> None:
        self.bits, self.width, self.probes = bits, width, probes

    def parts(self) -> tuple:
        """What makes the filter again: plain values, which workers can read without this module."""
        return self.bits, self.width, self.probes

    def found(self, hashes: np.ndarray, bound: int = 0) -> np.ndarray:
        """Which hashes may have been met as often as the bound of this number says."""
        out, bits = np.ones(len(hashes), bool), self.bits[bound]
        for cells in _cells(hashes, self.probes):
            at = cells >> np.uint32(32 - self.width)
            out &= (bits[at >> np.uint32(3)] >> (at & np.uint32(7)).astype(np.uint8)) & np.uint8(1) != 0
        return out


def _merge(width: int, bounds: tuple[int, ...]):
    size = 1 << (width - 8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, np.ndarray] = {}
        opened = zstandard.ZstdDecompressor()
        for batch in batches:
            for r, n, blob in zip(*(batch.column(c).to_pylist() for c in ("range", "entries", "blob")), strict=True):
                planes = np.frombuffer(opened.decompress(blob), np.uint8).reshape(4, n)
                marked = np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.uint64))
                at = ((marked >> np.uint64(7)) >> np.uint64(32 - width)).astype(np.int64)
                seen = counts.setdefault(r, np.zeros(size, np.uint8))
                # cells of one fragment may fall together in a narrower filter
                start = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
                met = np.add.reduceat((marked & np.uint64(127)).astype(np.int64), start)
                seen[at[start]] = np.minimum(255, seen[at[start]] + met)
        for bound, least in enumerate(bounds):
            if counts:
                keys = sorted(counts)
                packed = [np.packbits(counts[r] >= least, bitorder="little").tobytes() for r in keys]
                yield pa.RecordBatch.from_arrays([pa.array([bound] * len(keys), pa.int32()), pa.array(keys, pa.int32()), pa.array(packed, pa.binary())], names=["bound", "range", "bits"])

    return run


def merged(fragments: DataFrame, probes: int = 1, cells_per_entry: int = 6, bounds: tuple[int, ...] = (2,)) -> CellFilter:
    """Merges the fragments of all tasks into a filter of the cells met at least so many times. The driver gets 64 MB at most."""
    fragments = written(fragments)
    entries = fragments.agg(F.sum("entries")).first()[0] or 0
    width = min(MAX_BITS - (len(bounds) - 1).bit_length(), max(MIN_BITS, (entries * cells_per_entry).bit_length()))
    tasks = fragments.sparkSession.conf.get("spark.sql.shuffle.partitions")
    ranges = fragments.repartition(min(RANGES, int(tasks)), "range").mapInArrow(_merge(width, bounds), "bound int, range int, bits binary")
    bits = [np.zeros(1 << (width - 3), np.uint8) for _ in bounds]
    step = 1 << (width - 11)
    for row in ranges.toLocalIterator():
        bits[row["bound"]][row["range"] * step : (row["range"] + 1) * step] = np.frombuffer(row["bits"], np.uint8)
    return CellFilter(bits, width, probes)
