"""Best-fit packing by swap-based local search.

Documents become pieces of at most `size` tokens (only longer ones are cut); whole pieces fill a
sequence alone. What matters of the others is their length, so the search works on the histogram
of lengths: a bin is a pattern of lengths, and equal bins are one entry with a count. It starts
from best-fit decreasing, and then improves underfull bins: a piece of the emptiest bin moves into
another, or goes there in exchange for a shorter one, or two go for one, whichever raises the sum of
squared fills most, until the emptiest bins are empty and no exchange of any two bins helps, or the
bound of tokens / `size` is reached. The sum of squares rises with each exchange, so it ends without a
limit of steps. Patterns and lengths are bounded by `size`, not by the corpus.

Pieces then get a rank among those of their length (`gapless_rank`), and the plan turns a length
and a rank into a sequence and an offset.

Defined cases. Null and empty texts are one piece, the closing id alone. Equal rows are packed one
by one. Columns other than doc_id and text are not looked at. An empty table gives an empty result.
"""

from __future__ import annotations

import os
import sys
import types
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, gapless_rank, written
from .tokens import tidy

SIZE = 2048
END = 0
CACHE = 400_000
MARKS = b".,!?;:%*#$&|"
#: Texts with this mark may name special tokens, whose letter case counts.
SPECIAL = b"<|"
PIECE = "doc_id long, piece int, start long, length int, ids_crc32 long"
PLACE = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


class WordIds(dict):
    """The token ids of words, as bytes, remembered up to a bound. Exact where no token crosses white space.

    A word that is letters and then punctuation has the ids of the one and of the other, so only the
    letters are encoded anew; words of letters alone go to the tokenizer many at once, and are told
    apart by the tokens that end words.
    """

    def __init__(self, file: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.ends[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")]] = True

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, new: set[bytes]) -> None:
        if len(self) + len(new) > CACHE:  # the words that were met first stay: most of them are frequent
            kept = list(islice(self.items(), CACHE // 3))
            self.clear()
            self.update(kept)
        cut = {w: len(w.rstrip(MARKS)) for w in new}
        plain, rest = set(), set()
        for w, n in cut.items():
            core = w[:n]
            if core.isalpha() or core.decode().isalpha():
                plain.add(core)
                if n < len(w):
                    rest.add(w[n:])
            else:
                rest.add(w)
                cut[w] = len(w)
        plain, rest = [w for w in plain if w not in self], [w for w in rest if w not in self]
        groups = [plain[i : i + 256] for i in range(0, len(plain), 256)]
        for group, ids in zip(groups, self._encode([b" ".join(g).decode() for g in groups]), strict=True):
            last = np.flatnonzero(self.ends[ids]) + 1
            raw = ids.tobytes()
            if len(last) != len(group):  # not told apart: one by one
                rest += group
                continue
            at = 0
            for w, end in zip(group, (last * 4).tolist(), strict=True):
                self[w] = raw[at:end]
                at = end
        for w, ids in zip(rest, self._encode([w.decode() for w in rest]), strict=True):
            self[w] = ids.tobytes()
        for w, n in cut.items():
            if n < len(w):
                self[w] = self[w[:n]] + self[w[n:]]

    def ids(self, texts: list[str]) -> list[bytes]:
        """The ids of whole texts, each a little-endian unsigned 32-bit number."""
        raw = [t.encode() for t in texts]
        split = [(r if SPECIAL in r else r.lower()).split() for r in raw]
        new = {w for words in split for w in words if w not in self}
        if new:
            self._learn(new if len(self) + len(new) <= CACHE else {w for words in split for w in words})
        return [b"".join(map(self.__getitem__, words)) for words in split]


def worker_words(file: str) -> WordIds:
    """One cache for all tasks of a worker process."""
    held = sys.modules.setdefault("_lodeseam_worker", types.ModuleType("_lodeseam_worker"))
    if file not in held.__dict__:
        held.__dict__[file] = WordIds(file)
    return held.__dict__[file]


def _pieces(file: str, size: int, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end = worker_words(file), np.array([END], "<u4").tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                cols: list[list] = [[] for _ in range(6)]
                ids = part.column("doc_id").to_pylist()
                for doc_id, got in zip(ids, words.ids([t or "" for t in part.column("text").to_pylist()]), strict=True):
                    raw = got + end
                    for k, start in enumerate(range(0, len(raw), 4 * size)):
                        piece = raw[start : start + 4 * size]
                        for col, x in zip(cols, (doc_id, k, start // 4, len(piece) // 4, zlib.crc32(piece), piece), strict=True):
                            col.append(x)
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
                n = 6 if keep_ids else 5
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols[:n], kinds[:n], strict=True)], names=names[:n])
            tidy()

    return run


def pieces(df: DataFrame, file: str, size: int = SIZE, keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of each piece of each row of (doc_id, text)."""
    source = df.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return source.mapInArrow(_pieces(file, size, keep_ids), PIECE + ", ids binary" * keep_ids)


def best_fit(lengths: dict[int, int], size: int) -> Counter:
    """Best-fit decreasing over a histogram: bins (lengths, longest first) with their counts."""
    by_room: dict[int, Counter] = defaultdict(Counter)
    for length in sorted(lengths, reverse=True):
        left = lengths[length]
        while left:
            room = min((r for r in by_room if r >= length and by_room[r]), default=size)
            if room == size:
                by_room[size] = Counter({(): left})
            bins = by_room[room]
            bin_, count = next(iter(bins.items()))
            each = min(room // length, left)
            taken = min(count, left // each)
            bins[bin_] -= taken
            if not bins[bin_]:
                del bins[bin_]
            if not bins or room == size:
                del by_room[room]
            by_room[room - each * length][bin_ + (length,) * each] += taken
            left -= taken * each
    out: Counter = Counter()
    for bins in by_room.values():
        out.update(bins)
    return out


def _exchange(a: tuple, b: tuple, size: int) -> tuple[int, tuple, tuple]:
    """The exchange from bin a into bin b that brings b most: (tokens, what leaves a, what leaves b)."""
    room, fill_a, fill_b = size - sum(b), sum(a), sum(b)
    best: tuple[int, tuple, tuple] = (0, (), ())
    own = sorted(set(a), reverse=True)
    counts = Counter(a)
    pairs = [(x, y) for i, x in enumerate(own) for y in own[i:] if x != y or counts[x] > 1]
    for give in [(x,) for x in own] + pairs:
        for back in [(), *((y,) for y in sorted(set(b)))] if len(give) == 1 else [(y,) for y in sorted(set(b))]:
            gain = sum(give) - sum(back)
            if best[0] < gain <= room and (fill_b + gain) ** 2 + (fill_a - gain) ** 2 > fill_a**2 + fill_b**2:
                best = gain, give, back
                if gain == room:
                    return best
    return best


def _without(bin_: tuple, out: tuple, into: tuple) -> tuple:
    left = list(bin_)
    for x in out:
        left.remove(x)
    return tuple(sorted(left + list(into), reverse=True))


def local_search(bins: Counter, size: int) -> Counter:
    """Exchanges between underfull bins while the sum of squared fills rises and bins can still be saved.

    A source that no target helps is tried again with the patterns that have come up since.
    """
    bins = Counter(bins)
    least = -(-sum(sum(b) * n for b, n in bins.items()) // size)
    born = {b: 0 for b in bins}  # when a pattern came up
    tried = dict.fromkeys(bins, -1)  # up to when a source's targets have been tried in vain
    now = 0
    while bins.total() > least:
        open_ = sorted((b for b in bins if sum(b) < size), key=lambda b: (-sum(b), b))
        for source in reversed(open_):
            best: tuple = (0, (), (), None)
            for target in open_:
                if born[target] > tried[source] and (target != source or bins[source] > 1):
                    got = _exchange(source, target, size)
                    if got[0] > best[0]:
                        best = *got, target
            if best[0]:
                break
            tried[source] = now
        else:
            break
        _, give, back, target = best
        now += 1
        times = bins[source] // 2 if source == target else min(bins[source], bins[target])
        for old in (source, target):
            bins[old] -= times
            if not bins[old]:
                del bins[old]
        for new in (_without(source, give, back), _without(target, back, give)):
            if new:
                if new not in bins:
                    born[new], tried[new] = now, -1
                bins[new] += times
    return bins


class Plan:
    """Where the r-th piece of a length goes."""

    def __init__(self, bins: Counter) -> None:
        used: Counter = Counter()
        rows, sequence = [], 0
        for bin_, n in sorted(bins.items(), reverse=True):
            offset = 0
            for length in bin_:
                rows.append((length, used[length], sequence, offset))
                used[length] += n
                offset += length
            sequence += n
        rows.sort()
        self.sequences = sequence
        length, first, sequences, offsets = (np.array(c, np.int64) for c in zip(*rows, strict=True)) if rows else (np.empty(0, np.int64),) * 4
        self.places = (length << 48) + first, first, sequences, offsets


def find(places: tuple[np.ndarray, ...], length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sequence and the offset of the pieces with these lengths and ranks."""
    key, first, sequence, offset = places
    at = np.searchsorted(key, (length << 48) + rank, "right") - 1
    return sequence[at] + rank - first[at], offset[at]


def _place(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = shared.value
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False).astype(np.int64)
            sequence, offset = find(places, length, batch.column("rank").to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), pa.array(length), batch.column(4), pa.array(sequence), pa.array(offset)], names=[x.split()[0] for x in PLACE.split(", ")])

    return run


def pack(df: DataFrame, file: str, size: int = SIZE) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of each piece of each row of (doc_id, text)."""
    cut = written(pieces(df, file, size))
    lengths = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = Plan(local_search(best_fit(lengths, size), size))
    salt = F.xxhash64("doc_id", "piece", "ids_crc32")
    ranked = gapless_rank(cut, "length", salt, [F.col("doc_id"), F.col("piece"), F.col("ids_crc32")])
    shared = df.sparkSession.sparkContext.broadcast(plan.places)
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(_place(shared), PLACE)


def word_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op8_best_fit_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), word_tokenizer())
