"""Chroma audio fingerprints for columns of recordings.

A recording's samples become frames of `FRAME` samples every `HOP`; each frame's spectrum is folded
into twelve pitch classes. Over the integral image of frames and pitch classes, sixteen rectangle
filters compare areas; each answer is two bits (a Gray code of three thresholds), and the answers
at one place make one packed 32-bit integer.

A query and a recording are aligned by the histogram of their offsets: at each offset (those at which
less than half of the query overlaps don't count) the equal bits of the integers that meet are its votes,
so that noise that leaves no integer whole loses no pair. The peak is the offset, and the share of bits that differ there
says how alike the two are; all pairs within `max_error` are returned. Pairs whose projections on a few directions are
too far apart can't be within it and aren't compared bit by bit; none that is within it is left out. Queries go to the
workers in blocks; the work is queries times recordings, a stated query set against all rows. Recordings with equal fingerprints are one class; the index and the queries hold classes
only, so copies cost nothing more.

The tables here hold no recordings, so the query renders each vector of `embeddings` as a melody
of as many notes, and takes every recording whose id is divisible by 50 as a query, played late
(cut by `LATE` frames) and with noise.

Defined cases. A null or empty vector or recording, or one shorter than the filters, has no integers;
all of these are one class, and match nothing. Values that aren't numbers count as 0. Equal rows are
of one class. Ties in the offset go to the smaller offset, ties in the match to the smaller id. Null
ids are no queries. Columns other than the two read are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import written

RATE = 4000
NOTE = 256
FRAME = 1024
HOP = 256
LATE = 3
NOISE = 0.02
LOWEST, HIGHEST = 100.0, 1800.0
THRESHOLD = 0.08
WIDEST = 12
#: The bound of `align`: at this share of differing bits recordings of ordinary length are commonly taken for the same.
MAX_ERROR = 0.35
#: The bound for melodies of 64 notes. Of the 50 integers of so short a recording, unrelated ones differ in 17 to 30 % of
#: their bits at their best offset, replays in 0.4 % at most; at 35 % every recording would be a match of every query.
SAME_MELODY = 0.1
#: Queries sent to the workers at once, and recordings and queries that are compared at once.
QUERY_BLOCK = 50_000
PIECE = 1000
#: Integers of a window, and the directions on which windows are projected; more directions cost more and leave fewer pairs.
WINDOW = 4
AXES = 16
#: If more than one pair in so many is left at an offset, all are compared there.
DENSE = 16


def _filters() -> list[tuple[int, int, int, int]]:
    """Sixteen filters (kind, first pitch class, height, width in frames) by rule."""
    out = []
    for i in range(16):
        height = 3 + i * 5 % 10
        out.append((i % 5, i * 7 % (13 - height), height, 3 + i * 4 % (WIDEST - 2)))
    return out


FILTERS = _filters()


def _chroma(samples: np.ndarray) -> np.ndarray:
    """Frames of twelve pitch classes, each of length one."""
    n = (len(samples) - FRAME) // HOP + 1
    if n < 1:
        return np.zeros((0, 12))
    frames = np.lib.stride_tricks.sliding_window_view(samples, FRAME)[::HOP] * np.hanning(FRAME)
    power = np.abs(np.fft.rfft(frames, axis=1)) ** 2
    hertz = np.fft.rfftfreq(FRAME, 1 / RATE)
    use = (hertz >= LOWEST) & (hertz <= HIGHEST)
    pitch = np.round(12 * np.log2(hertz[use] / 440)).astype(int) % 12
    fold = np.zeros((int(use.sum()), 12))
    fold[np.arange(len(pitch)), pitch] = 1
    chroma = power[:, use] @ fold
    return chroma / np.maximum(np.linalg.norm(chroma, axis=1, keepdims=True), 1e-9)


def fingerprint(samples: np.ndarray) -> np.ndarray:
    """The packed integers of a recording (uint32), one for each place where all filters fit."""
    chroma = _chroma(np.nan_to_num(np.asarray(samples, np.float64)))
    n = len(chroma) - WIDEST + 1
    if n < 1:
        return np.empty(0, np.uint32)
    image = np.zeros((len(chroma) + 1, 13))
    image[1:, 1:] = chroma.cumsum(0).cumsum(1)
    at = np.arange(n)

    def area(x0: int, x1: int, y0: int, y1: int) -> np.ndarray:
        return image[at + x1, y1] - image[at + x0, y1] - image[at + x1, y0] + image[at + x0, y0]

    out = np.zeros(n, np.uint32)
    for kind, y, height, width in FILTERS:
        whole = area(0, width, y, y + height)
        if kind == 0:  # lower half against upper half
            one = area(0, width, y, y + height // 2)
        elif kind == 1:  # first half against second half
            one = area(0, width // 2, y, y + height)
        elif kind == 2:  # opposite quarters
            one = area(0, width // 2, y, y + height // 2) + area(width // 2, width, y + height // 2, y + height)
        elif kind == 3:  # the middle third of the pitches
            one = area(0, width, y + height // 3, y + height - height // 3)
        else:  # the middle third of the time
            one = area(width // 3, width - width // 3, y, y + height)
        value = np.log((1 + one) / (1 + whole - one))
        step = np.searchsorted([-THRESHOLD, 0.0, THRESHOLD], value, "right").astype(np.uint32)
        out = (out << np.uint32(2)) | (step ^ (step >> np.uint32(1)))
    return out


def render(vector: np.ndarray) -> np.ndarray:
    """A melody: each value is a note, around 220 Hz by 48 semitones a unit."""
    v = np.nan_to_num(np.asarray(vector, np.float64), posinf=0, neginf=0)
    semitones = np.clip(np.round(v * 48), -11, 24)
    phase = 2 * np.pi * np.cumsum(np.repeat(220 * 2 ** (semitones / 12), NOTE)) / RATE
    return np.sin(phase) + 0.4 * np.sin(2 * phase)


def played_again(samples: np.ndarray) -> np.ndarray:
    """The same recording, begun late and with noise that only its own length decides."""
    noise = np.random.default_rng(len(samples)).standard_normal(len(samples))
    return (samples + NOISE * noise)[LATE * HOP :]


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc, vector, asked in zip(*(batch.column(c).to_pylist() for c in ("id", "vector", "asked")), strict=True):
            samples = render(np.array([0.0 if x is None else x for x in vector or ()]))
            ints = fingerprint(samples)
            again = fingerprint(played_again(samples)).view(np.int32) if asked else None
            rows.append((doc, ints.view(np.int32), xxhash.xxh3_128_digest(ints.tobytes()), again))
        kinds = [pa.int64(), pa.list_(pa.int32()), pa.binary(), pa.list_(pa.int32())]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["id", "ints", "digest", "again"])


def _by_length(ids: list, ints: list) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pieces of rows of one length: their ids, and their integers (length, rows)."""
    sizes = np.array([len(x) for x in ints])
    for size in np.unique(sizes[sizes > 0]):
        at = np.flatnonzero(sizes == size)
        for i in range(0, len(at), PIECE):
            part = at[i : i + PIECE]
            yield np.array(ids, np.int64)[part], np.array([ints[k] for k in part]).astype(np.int32).view(np.uint32).T


def _words(ints: np.ndarray) -> np.ndarray:
    """Columns of integers, two in a word."""
    even = np.pad(ints, ((0, len(ints) % 2), (0, 0))).astype(np.uint64)
    return even[::2] | (even[1::2] << np.uint64(32))


def _signs(ints: np.ndarray) -> np.ndarray:
    """The bits of columns of integers as -1 and 1 (rows, places, 32)."""
    length, rows = ints.shape
    bits = np.unpackbits(np.ascontiguousarray(ints.T).view(np.uint8).reshape(rows, -1), axis=1)
    return bits.reshape(rows, length, 32).astype(np.float32) * 2 - 1


def axes(pieces: list[np.ndarray]) -> np.ndarray:
    """The directions (WINDOW, 32, AXES) in which windows of integers spread most; of length one and at right angles."""
    windows = [np.concatenate([s[:, i : len(x) - WINDOW + 1 + i] for i in range(WINDOW)], 2).reshape(-1, WINDOW * 32) for x in pieces if len(x) >= WINDOW for s in [_signs(x)]]
    spread = np.cov(np.concatenate(windows), rowvar=False, bias=True) if windows else np.zeros((WINDOW * 32, WINDOW * 32))
    return np.linalg.eigh(spread)[1][:, -AXES:].reshape(WINDOW, 32, AXES).astype(np.float32)


def _shadows(ints: np.ndarray, along: np.ndarray) -> np.ndarray:
    """The projection of each row's window at each place (rows, places, AXES)."""
    signs, n = _signs(ints), max(0, len(ints) - WINDOW + 1)
    return sum(signs[:, i : i + n] @ along[i] for i in range(WINDOW))


def _side(shadows: np.ndarray, skip: int, n: int, first: bool) -> np.ndarray:
    """The projections of the windows side by side in n integers, with two columns by which a product is minus half a squared distance."""
    x = shadows[:, skip : skip + n - WINDOW + 1 : WINDOW].reshape(len(shadows), -1) if n >= WINDOW else np.zeros((len(shadows), 0), np.float32)
    half, one = -0.5 * (x * x).sum(1, keepdims=True), np.ones((len(x), 1), np.float32)
    return np.concatenate([x, half, one] if first else [x, one, half], 1)


def nearest(q: np.ndarray, r: np.ndarray, max_error: float, along: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest share of differing bits and its (smallest) offset, for each column of r and of q; 2 where it is above max_error.

    The squared distance of two rows of -1 and 1 is four times their differing bits, and no projection
    on directions at right angles makes it larger. So only what is near enough in projection, with
    a bit's room for rounding, is compared bit by bit.
    """
    nq, nr = len(q), len(r)
    error, offset = np.full((r.shape[1], q.shape[1]), 2.0), np.zeros((r.shape[1], q.shape[1]), np.int32)
    flat_error, flat_offset = error.reshape(-1), offset.reshape(-1)
    shadow_q, shadow_r, rows_q, rows_r = _shadows(q, along), _shadows(r, along), np.ascontiguousarray(q.T), np.ascontiguousarray(r.T)
    for off in range(-nq + 1, nr):
        skip_q, skip_r = max(0, -off), max(0, off)
        n = min(nq - skip_q, nr - skip_r)
        if n * 2 < nq:
            continue
        product = _side(shadow_r, skip_r, n, True) @ _side(shadow_q, skip_q, n, False).T
        near = np.flatnonzero(product.reshape(-1) >= -2 * (max_error * 32 * n + 1))
        if len(near) * DENSE <= error.size:
            k, i = np.divmod(near, q.shape[1])
            now = np.bitwise_count(rows_r[k, skip_r : skip_r + n] ^ rows_q[i, skip_q : skip_q + n]).sum(1, dtype=np.uint32) / (32 * n)
            better = (now <= max_error) & (now < flat_error[near])
            flat_error[near[better]] = now[better]
            flat_offset[near[better]] = off
            continue
        a, b = _words(q[skip_q : skip_q + n]), _words(r[skip_r : skip_r + n])
        for k in range(r.shape[1]):
            now = np.bitwise_count(a ^ b[:, k : k + 1]).sum(0, dtype=np.uint32) / (32 * n)
            better = (now <= max_error) & (now < error[k])
            error[k][better] = now[better]
            offset[k][better] = off
    return error, offset


MATCHES = "query long, matches array<struct<bit_error: double, id: long, offset: int>>"


def _scan(shared, max_error: float):
    """For each query and piece of recordings all matches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = list(_by_length(*shared.value))
        along = axes([q for _, q in asked[:1]])
        for batch in batches:
            for ids, r in _by_length(batch.column("id").to_pylist(), batch.column("ints").to_pylist()):
                for queries, q in asked:
                    error, offset = nearest(q, r, max_error, along)
                    hit = (error <= max_error).T
                    ends = np.append(0, np.cumsum(hit.sum(1))).astype(np.int32)
                    _, at = np.nonzero(hit)
                    pairs = pa.StructArray.from_arrays([pa.array(error.T[hit]), pa.array(ids[at]), pa.array(offset.T[hit])], names=["bit_error", "id", "offset"])
                    yield pa.RecordBatch.from_arrays([pa.array(queries), pa.ListArray.from_arrays(pa.array(ends), pairs)], names=["query", "matches"])

    return run


def _matches(queries: DataFrame, recordings: DataFrame, max_error: float) -> DataFrame:
    """Rows (query, matches): all recordings within `max_error`, in any number of rows for each query."""
    spark, n = queries.sparkSession, queries.count()
    blocks, out = -(-n // QUERY_BLOCK), spark.createDataFrame([], MATCHES)
    for block in range(blocks):
        rows = queries.filter(F.pmod(F.xxhash64("query"), F.lit(blocks)) == block).select("query", "ints").toArrow()
        shared = spark.sparkContext.broadcast((rows.column("query").to_pylist(), [np.array(x, np.int32) for x in rows.column("ints").to_pylist()]))
        out = out.unionByName(recordings.select("id", "ints").mapInArrow(_scan(shared, max_error), MATCHES))
    return out


def align(queries: DataFrame, recordings: DataFrame, max_error: float = MAX_ERROR) -> DataFrame:
    """query, id, offset, bit_error: for each row of (query, ints) all recordings (id, ints) with few enough differing bits."""
    return _matches(queries, recordings, max_error).select("query", F.inline("matches")).select("query", "id", "offset", "bit_error")


def melodies(df: DataFrame, every: int = 50, max_error: float = SAME_MELODY) -> DataFrame:
    """One row for each (vec_id, embedding): its integers' number and hash, its class, and for queries the best match, and all matches but the own class (best first)."""
    source = df.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("vector"))
    source = source.withColumn("asked", F.coalesce(F.col("id") % every == 0, F.lit(False)))
    prints = written(source.mapInArrow(_fingerprints, "id long, ints array<int>, digest binary, again array<int>"))
    classes = written(prints.groupBy("digest").agg(F.min("id").alias("class_id"), F.any_value("ints").alias("ints"), F.min("again").alias("again")))
    queries = classes.filter("again IS NOT NULL AND size(again) > 0").select(F.col("class_id").alias("query"), F.col("again").alias("ints"))
    pieces = _matches(queries, classes.filter("class_id IS NOT NULL").select(F.col("class_id").alias("id"), "ints"), max_error)
    every = pieces.groupBy("query").agg(F.sort_array(F.flatten(F.collect_list("matches"))).alias("m")).withColumn("first", F.get("m", F.lit(0)))
    others = F.filter("m", lambda x: x["id"] != F.col("query")).alias("others")
    found = every.select("query", F.col("first.id").alias("match"), F.col("first.offset").alias("offset"), F.col("first.bit_error").alias("bit_error"), others)
    named = prints.join(classes.select("digest", "class_id"), "digest").withColumn("query", F.when(F.col("again").isNotNull(), F.col("class_id")))
    # rows that ask nothing stay out of the join: they would all meet under the null key
    asked = named.filter("query IS NOT NULL").join(found, "query", "left").unionByName(named.filter("query IS NULL"), allowMissingColumns=True)
    return asked.select(F.col("id").alias("vec_id"), F.size("ints").cast("long").alias("n_ints"), F.crc32("digest").alias("print_crc32"), "class_id", "match", "offset", "bit_error", "others")


def op4_audio_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return melodies(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
