"""LM scoring with a log-frequency Bloom filter.

1. Texts are packed into chunks; each chunk sends its distinct words and n-grams (n >= 2), with how
   often its training rows have them, once to the hash ranges they fall in (`chunks`). Words are
   counted exactly, by 64-bit hashes; n-grams of every count go on, those seen once too.
2. Each range adds up its n-grams, and keeps a count c as the level q(c) = 1 + floor(2 log2 c): the
   n-gram is put into the range's slice of the Bloom filter with each level up to q (level 2, which no
   count has, is left out). A lookup probes level after level until the first miss, so an error can
   only raise a count, by one level in most cases. A slice has 16 to 32 bits for each (n-gram, level), four probes
   each, whatever the size of the corpus: an unseen n-gram is found with a probability below 0.3 %.
3. While the whole filter is proven to fit in `BROADCAST_BYTES` (no text of so few bytes has more
   n-grams), its slices are broadcast to the workers, which probe them. Beyond that the slices stay
   where they are, and the chunks' n-grams, which are there already, are probed in their range; the
   answers are a level each. Slices, probes and so the scores are the same on both ways.
4. P(w | v) = (c(vw) + MU * P(w)) / (c(v) + MU), with P(w) = (c(w) + 1) / (N + V + 1), back from the
   longest n-gram to words; before the first token of a text stands the end token. A level stands for
   the mean of its counts. MU is the one of `GRID` under which the training rows, each token left out
   of the counts in its turn, are most probable; held-out rows have no part in it.

Words are known by 64-bit hashes, n-grams by the cells of their hashes that `Space` sends, and the
end token by a number.

Defined cases. A null text is empty: one token, the end. A null id counts as the empty text in the
fold. Without training rows N and V are 0, and every token has probability 1 / 1. Equal rows are
scored one by one. Columns other than doc_id, held_out and text are not looked at. An empty table
gives an empty result. A null held_out is false.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chunks import Space, chunked, opened, summed, text_bytes, texts_of, unpacked, unwide, wide
from .common import discard, doc_crc, documents, written
from .tokens import WordHasher, groups, mix, tidy

ORDER = 2
GRID = (1.0, 4.0, 16.0, 64.0, 256.0, 1024.0, 4096.0, 16384.0, 65536.0)
BITS = 16
PROBES = 4
BROADCAST_BYTES = 64 << 20
END = 0x51E5D0F7A3C24B19
STEP = 0x9E3779B97F4A7C15
WORDS, GRAMS, SLICE, TOTAL = range(4)
ASKED = "chunk long, range int, kind int, keys binary, counts binary"
ANSWER = "chunk long, range int, kind int, found binary, n long, v long"
SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, scores array<double>, left_out array<double>"


def _tokens(texts: list[bytes | None], hasher: WordHasher) -> tuple[np.ndarray, np.ndarray]:
    """All token hashes (each text with its end), and the number of tokens of each text."""
    words, counts = hasher(texts)
    sizes = counts + 1
    out = np.full(int(sizes.sum()), END, np.uint64)
    keep = np.ones(len(out), bool)
    keep[np.cumsum(sizes) - 1] = False
    out[keep] = words
    return out, sizes


def _ngrams(tokens: np.ndarray, sizes: np.ndarray, order: int) -> list[np.ndarray]:
    """Hashes of the n-grams that end at each token, for n = 2 to order; shorter ones at the start of a text begin with its end token."""
    place = np.arange(len(tokens)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out, gram = [], tokens
    for n in range(1, order):
        before = np.where(place >= n, np.roll(tokens, n), np.uint64(END))
        gram = mix(gram * np.uint64(3) + before)
        out.append(mix(gram + np.uint64((n + 1) * STEP % 2**64)))
    return out


def _distinct(chunk: pa.Table, space: Space, order: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """The sorted distinct words, and cells of n-grams, of a chunk, with their counts in its training rows."""
    hasher, learn = WordHasher(), ~chunk.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
    held: list[list[tuple[np.ndarray, np.ndarray]]] = [[], []]
    for at, texts in groups(texts_of(chunk)):
        tokens, sizes = _tokens(texts, hasher)
        weight = np.repeat(learn[at : at + len(texts)], sizes).astype(np.int64)
        held[0].append(summed([tokens], [weight]))
        grams = _ngrams(tokens, sizes, order)
        if grams:
            held[1].append(summed([space.cells(g) for g in grams], [weight] * len(grams)))
    return [summed([k for k, _ in x], [n for _, n in x]) if x else (np.empty(0, np.uint64), np.empty(0, np.int64)) for x in held]


def _batch(schema: str, kinds: list[pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in schema.split(", ")])


def _ask(space: Space, order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        for batch in batches:
            for chunk, blob in zip(batch.column("chunk").to_pylist(), batch.column("blob").to_pylist(), strict=True):
                for kind, (keys, counts) in enumerate(_distinct(opened(blob), space, order)):
                    yield _batch(ASKED, kinds, [(chunk, r, kind, cells, note) for r, cells, note in space.fragments(keys, counts, kind == WORDS)])
                tidy()

    return run


def level(counts: np.ndarray) -> np.ndarray:
    return 1 + np.floor(2 * np.log2(counts) + 1e-9).astype(np.int64)


def counts_of(levels: np.ndarray) -> np.ndarray:
    """The mean of the counts of each level; 0 for level 0."""
    low, high = np.ceil(2.0 ** ((levels - 1) / 2) - 1e-9), np.ceil(2.0 ** (levels / 2) - 1e-9) - 1
    return np.where(levels > 0, (low + high) / 2, 0.0)


class Slice:
    """The part of the filter for one hash range: a Bloom filter over pairs of an n-gram and a level."""

    def __init__(self, bits: np.ndarray, top: int) -> None:
        self.bits, self.top, self.mask = bits, top, np.uint64(8 * len(bits) - 1)

    @classmethod
    def of(cls, keys: np.ndarray, counts: np.ndarray) -> Slice:
        levels = level(counts) if len(counts) else np.empty(0, np.int64)
        size = 1 << max(6, (int(np.maximum(levels - 1, 1).sum()) * BITS).bit_length())
        marks, top = np.zeros(size, bool), int(levels.max(initial=0))
        out = cls(np.empty(size // 8, np.uint8), top)
        for lev in cls.ladder(top):
            keys, levels = keys[levels >= lev], levels[levels >= lev]
            for at in out._places(keys, lev):
                marks[at] = True
        out.bits = np.packbits(marks, bitorder="little")
        return out

    @staticmethod
    def ladder(top: int) -> list[int]:
        return [lev for lev in range(1, top + 1) if lev != 2]

    def _places(self, keys: np.ndarray, lev: int) -> Iterator[np.ndarray]:
        h = mix(keys ^ mix(np.array([lev], np.uint64) + np.uint64(STEP)))
        step = (h >> np.uint64(32)) | np.uint64(1)
        for i in range(PROBES):
            yield (h + np.uint64(i) * step) & self.mask

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """The level of each n-gram by probing until the first miss; 0 where the first probe misses."""
        out, at = np.zeros(len(keys), np.uint8), np.arange(len(keys))
        for lev in self.ladder(self.top):
            hit = np.ones(len(at), bool)
            for p in self._places(keys[at], lev):
                hit &= (self.bits[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8)) & np.uint8(1) != 0
            at = at[hit]
            if not len(at):
                break
            out[at] = lev
        return out

    def raw(self) -> bytes:
        return bytes([self.top]) + self.bits.tobytes()

    @classmethod
    def parse(cls, raw: bytes) -> Slice:
        return cls(np.frombuffer(raw, np.uint8)[1:], raw[0])


def _answer(route: bool):
    """Of a range: N and V of its words, the counts of each chunk's words, and its slice, or what that says of each chunk's n-grams."""
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64()]

    def run(asked: pa.Table) -> pa.Table:
        r, rows = asked.column("range")[0].as_py(), []
        for kind in (WORDS, GRAMS):
            of_kind = asked.filter(pa.array(asked.column("kind").to_numpy() == kind))
            if not of_kind.num_rows:
                continue
            chunks, keys = of_kind.column("chunk").to_pylist(), [unpacked(b) for b in of_kind.column("keys").to_pylist()]
            every, counts = summed(keys, [unwide(b) for b in of_kind.column("counts").to_pylist()])
            if kind == WORDS:
                rows.append((None, r, TOTAL, None, int(counts.sum()), int((counts > 0).sum())))
                rows += [(c, r, kind, wide(counts[np.searchsorted(every, k)]), None, None) for c, k in zip(chunks, keys, strict=True)]
                continue
            cells = Slice.of(every[counts > 0], counts[counts > 0])
            if route:
                levels = cells.levels(every)
                rows += [(c, r, kind, wide(levels[np.searchsorted(every, k)]), None, None) for c, k in zip(chunks, keys, strict=True)]
            else:
                rows.append((None, r, SLICE, cells.raw(), None, None))
        del keys, every, counts
        tidy()
        return pa.Table.from_batches([_batch(ANSWER, kinds, rows)])

    return run


def _joined(answers: pa.Table, kind: int) -> np.ndarray:
    """The answers of all ranges, in the order of the chunk's keys."""
    own = answers.filter(pa.array(answers.column("kind").to_numpy() == kind)).sort_by("range")
    return np.concatenate([unwide(b) for b in own.column("found").to_pylist()])


def _probed(cells: np.ndarray, space: Space, slices: dict[int, bytes]) -> np.ndarray:
    """Levels of sorted cells out of the broadcast slices."""
    ends = np.searchsorted(cells >> np.uint64(space.width - space.range_bits), np.arange((1 << space.range_bits) + 1, dtype=np.uint64))
    return np.concatenate([Slice.parse(slices[r]).levels(cells[ends[r] : ends[r + 1]]) if r in slices else np.zeros(ends[r + 1] - ends[r], np.uint8) for r in range(1 << space.range_bits)])


def _before(counts: np.ndarray, starts: np.ndarray, at_start: float) -> np.ndarray:
    """What stands one token before each token."""
    out = np.roll(counts, 1)
    out[starts] = at_start
    return out


def log_probabilities(words: np.ndarray, grams: list[np.ndarray], starts: np.ndarray, ends: float, n: int, v: int, mu: float, left_out: bool = False) -> np.ndarray:
    """log10 of the probability of each token from the counts of words, n-grams, and the end token; `left_out`: with the token itself taken out of them."""
    less = 1 if left_out else 0
    p = np.minimum(1.0, (np.maximum(words - less, 0) + 1) / max(1, n - less + v + 1))
    history = _before(words, starts, ends)
    for c in grams:
        c_less = np.maximum(c - less, 0)
        p = np.minimum(1.0, (c_less + mu * p) / (np.maximum(np.maximum(history, c) - less, 0) + mu))
        history = _before(c, starts, 0.0)
    return np.log10(p)


def _scores(space: Space, order: int, n: int, v: int, shared):
    kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.float64()), pa.list_(pa.float64())]

    def run(chunks: pa.Table, answers: pa.Table) -> pa.Table:
        out = [_batch(SCORED, kinds, [])]
        for blob in chunks.column("blob").to_pylist():
            table, hasher = opened(blob), WordHasher()
            (known, _), (cells, _) = _distinct(table, space, order)
            counts = _joined(answers, WORDS).astype(np.int64)
            levels = np.empty(0, np.uint8) if order < 2 else _joined(answers, GRAMS).astype(np.uint8) if shared is None else _probed(cells, space, shared.value)
            value, low = counts_of(levels.astype(np.int64)), np.log10(n + v + 1.0)
            ends = float(counts[np.searchsorted(known, np.uint64(END))])
            ids, held = table.column("doc_id").to_pylist(), table.column("held_out").to_pylist()
            for at, texts in groups(texts_of(table)):
                tokens, sizes = _tokens(texts, hasher)
                starts = np.cumsum(sizes) - sizes
                c = counts[np.searchsorted(known, tokens)]
                grams = [value[np.searchsorted(cells, space.cells(g))] for g in _ngrams(tokens, sizes, order)]
                base = np.add.reduceat(np.log10(c + 1.0), starts) - sizes * low
                scores, left = (np.stack([np.add.reduceat(log_probabilities(c, grams, starts, ends, n, v, mu, less), starts) for mu in GRID], 1) for less in (False, True))
                here = slice(at, at + len(texts))
                out.append(_batch(SCORED, kinds, list(zip(ids[here], held[here], sizes.tolist(), np.add.reduceat((c > 0).astype(np.int64), starts).tolist(), base.tolist(), scores.tolist(), left.tolist(), strict=True))))
        tidy()
        return pa.Table.from_batches(out)

    return run


def score(df: DataFrame, order: int = ORDER, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for each row of (doc_id, held_out, text), learned from those not held out."""
    sc = df.sparkSession.sparkContext
    chunks = written(chunked(df.select(F.col("doc_id").cast("long"), F.coalesce("held_out", F.lit(False)).alias("held_out"), F.col("text").cast("string"))))
    size = text_bytes(chunks)
    # a text of so many bytes (and one a row) has no more tokens, its n-grams' levels are no more than tokens, of four bytes each
    route, space = 4 * (order - 1) * size > broadcast_bytes, Space.of(size)
    answers = written(chunks.select("chunk", "blob").mapInArrow(_ask(space, order), ASKED).groupBy("range").applyInArrow(_answer(route), ANSWER))
    n, v = answers.filter(F.col("kind") == TOTAL).agg(F.sum("n"), F.sum("v")).first()
    shared = None
    if not route:
        shared = sc.broadcast({r["range"]: bytes(r["found"]) for r in answers.filter(F.col("kind") == SLICE).select("range", "found").toLocalIterator()})
    own = answers.filter(F.col("chunk").isNotNull()).select("chunk", "range", "kind", "found")
    scored = written(chunks.groupBy("chunk").cogroup(own.groupBy("chunk")).applyInArrow(_scores(space, order, n or 0, v or 0, shared), SCORED))
    discard(chunks)
    discard(answers)
    sums = scored.filter("NOT held_out").agg(*(F.sum(F.get("left_out", F.lit(i))).alias(f"s{i}") for i in range(len(GRID)))).first()
    best = max(range(len(GRID)), key=lambda i: (sums[i] if sums[i] is not None else 0.0, -i))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n or 0).cast("long").alias("train_tokens"), "base_score", F.get("scores", F.lit(best)).alias("score"))


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return score(docs.withColumn("held_out", F.pmod(doc_crc(F.col("doc_id")), F.lit(7)) == 2))
