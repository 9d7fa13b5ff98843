"""Jaccard join on word shingles by partitioning the universe of shingles.

Two sets x and y with Jaccard similarity at least t differ in at most T = (1-t)/(1+t) * (|x|+|y|)
shingles. A hash deals the universe into m segments, so at most T segments of such a pair differ.

* Size bands: band b holds sizes from 2**b up to 2**(b+1), so for t of 1/2 or more a partner lies in
  the same or the next band. The larger set's band gives the segments; a set is indexed for its own
  band, and for the next one if that holds sizes within its reach.
* Large bands: m is `SLACK` times T+1. Of x's segment subsets the T+1 first, under one order for all
  documents, must hold a common one. The order is by cost: how many sets have the subset, as decided
  by hash range over the whole corpus (`chunks`); empty segments come last. Subsets that one set has
  alone cost nothing, since nobody can share them. A set with T+1 subsets of its own has no partner,
  and sends nothing.
* Small bands: (T+1)/2 segments, each with its one-deletion neighbourhood: some segment differs in
  one shingle at most, so the subsets or their neighbours meet.

Equal sets form a class first (by a 128-bit hash of the set), and one row of each class is joined.
In a bucket of classes with one signature, not all pairs are compared at once: all members are
compared with the hub, the class with the largest share of signatures that many others have (near
copies of one text have it in common, even where they differ too much from each other), and links
join classes into components; where a bucket's components still differ, all members are compared
with `PIVOTS` more; then all whose components still differ are compared in blocks, once for all
buckets with the same members, so no link between components is lost. Each comparison is first held
against a parity bitmap (a lower bound of the difference), then made exactly on the whole shingle
sets (64-bit hashes of the shingles).

Defined cases. Documents without words have an empty set, and are linked with nothing, not even with
each other. Fewer words than a shingle make one shingle. Null ids never become a component's name
unless it has no other. Equal rows belong to one class. Columns other than the two named are not
looked at. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chunks import ROW_BITS, Space, chunked, opened, packed, pressed, summed, text_bytes, texts_of, unpacked, unwide, wide
from .common import discard, documents, written
from .tokens import BASE, WordHasher, groups, mix, tidy

PIVOTS = 6
SLACK = 1.5
SMALL = 48
#: Signatures in so many sets (a power of two) or more are the costly ones.
OFTEN = 8
PARITY_WORDS = 32
BLOCK = 2048
#: The level of empty segments in the order of costs.
EMPTY = 255


class Shingler:
    """The sorted distinct shingle hashes of texts, A-Z lower-cased."""

    def __init__(self, words: int) -> None:
        self.words, self.hasher = words, WordHasher()
        self.factors = mix(np.arange(1, words + 1, dtype=np.uint64) * np.uint64(BASE)) | np.uint64(1)

    def _join(self, columns: list[np.ndarray]) -> np.ndarray:
        total = np.full(len(columns[0]), len(columns), np.uint64)
        for column, factor in zip(columns, self.factors, strict=False):
            total += column * factor
        return mix(total)

    def __call__(self, texts: list[bytes | None]) -> list[np.ndarray]:
        h, counts = self.hasher(texts)
        n = self.words
        every = self._join([h[i : len(h) - n + 1 + i] for i in range(n)]) if len(h) >= n else np.empty(0, np.uint64)
        out, at = [], 0
        for c in counts:
            if c >= n:
                s = np.sort(every[at : at + c - n + 1])
                new = np.empty(len(s), bool)
                new[0] = True
                np.not_equal(s[1:], s[:-1], out=new[1:])
                out.append(s[new])
            elif c:
                out.append(self._join([h[at + i : at + i + 1] for i in range(c)]))
            else:
                out.append(np.empty(0, np.uint64))
            at += c
        return out


class Bands:
    """Sizes, segments and signatures for the threshold num/den."""

    def __init__(self, num: int, den: int) -> None:
        self.num, self.den = num, den
        if den > 2 * num:
            raise ValueError("the threshold has to be 1/2 at least")

    def differ(self, a: int, b: int) -> int:
        """The most shingles in which linked sets of these sizes differ."""
        return (self.den - self.num) * (a + b) // (self.den + self.num)

    def schemes(self, size: int) -> list[tuple[int, int, int]]:
        """(band, segments, T) for each band in which a set of this size is indexed; segments < 0: with neighbourhoods."""
        out, own = [], size.bit_length() - 1
        most = size * self.den // self.num
        for b in (own, own + 1):
            top = (2 << b) - 1
            t = self.differ(size, min(top, most))
            if t and most >= 1 << b:
                widest = self.differ(top, top) + 1
                out.append((b, -((widest + 1) // 2) if top < SMALL else int(np.ceil(SLACK * widest)), t))
        return out

    def signatures(self, sets: list[np.ndarray]) -> Iterator[tuple[int, int, int, np.ndarray, np.ndarray]]:
        """(place in `sets`, segments, T, signatures, which are of empty segments) for each set and band, made for all sets at once."""
        use = [(i, *x) for i, s in enumerate(sets) if len(s) for x in self.schemes(len(s))]
        if not use:
            return
        one = np.concatenate(sets)
        starts = np.cumsum([0] + [len(s) for s in sets])
        key, value = mix(one ^ np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32), mix(one + np.uint64(0x632BE59BD9B4E019))
        sizes = np.array([len(sets[u[0]]) for u in use])
        counts = np.array([abs(u[2]) for u in use])
        first = np.cumsum(counts) - counts
        row = np.repeat(np.arange(len(use)), sizes)
        item = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(starts[[u[0] for u in use]], sizes)
        place = ((key[item] * counts[row].astype(np.uint64)) >> np.uint64(32)).astype(np.int64) + first[row]
        total = np.zeros(int(counts.sum()), np.uint64)
        np.add.at(total, place, value[item])
        number = np.arange(len(total)) - np.repeat(first, counts)
        salt = mix((number + np.repeat(np.array([u[1] for u in use], np.int64) << 32, counts)).astype(np.uint64))
        sigs, empty = mix(total ^ salt), np.bincount(place, minlength=len(total)) == 0
        at = 0
        for k, (i, _, segments, t) in enumerate(use):
            lo, hi = first[k], first[k] + counts[k]
            if segments > 0:
                yield i, segments, t, sigs[lo:hi], empty[lo:hi]
            else:
                own = slice(at, at + sizes[k])
                near = mix((total[place[own]] - value[item[own]]) ^ salt[place[own]])
                every = np.unique(np.concatenate((sigs[lo:hi], near)))
                yield i, segments, t, every, np.zeros(len(every), bool)
            at += sizes[k]


def _parity(s: np.ndarray) -> np.ndarray:
    """A bitmap whose bits tell whether an odd number of shingles falls on them."""
    odd = np.bincount((mix(s ^ np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(40)).astype(np.int64) % (64 * PARITY_WORDS), minlength=64 * PARITY_WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


TEXTS = -1
FIRST = "chunk long, bytes long, blob binary, uid long, doc_id long, n long, cls binary"
ASKED = "chunk long, range int, keys binary, counts binary"
ANSWER = "chunk long, range int, keys binary, levels binary"
SECOND = "uid long, rare int, n long, sigs array<long>, parity array<long>, shingles binary"


def _batch(schema: str, kinds: list[pa.DataType], columns: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in schema.split(", ")])


def _classes(words: int):
    """The chunks as they are, and for each of their documents the size and the hash of its set."""
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(words)
        for batch in batches:
            for chunk, size, blob in zip(*(batch.column(c).to_pylist() for c in ("chunk", "bytes", "blob")), strict=True):
                yield _batch(FIRST, kinds, [[chunk], [size], [blob], [None], [None], [None], [None]])
                table = opened(blob)
                ids = table.column("doc_id").to_pylist()
                for at, texts in groups(texts_of(table)):
                    sets = shingles(texts)
                    none, n = [None] * len(sets), len(sets)
                    yield _batch(FIRST, kinds, [none, none, none, [chunk << ROW_BITS | at + i for i in range(n)], ids[at : at + n], [len(s) for s in sets], [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]])
                tidy()

    return run


def _ask(words: int, num: int, den: int, space: Space):
    """Of a chunk: its rows that stand for their class, and how many of these have each signature, by range."""
    kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary()]

    def run(chunks: pa.Table, wanted: pa.Table) -> pa.Table:
        empty = pa.Table.from_batches([_batch(ASKED, kinds, [[], [], [], []])])
        if not chunks.num_rows or not wanted.num_rows:
            return empty
        shingles, bands = Shingler(words), Bands(num, den)
        chunk, rows = chunks.column("chunk")[0].as_py(), np.sort(wanted.column("uid").to_numpy()) & ((1 << ROW_BITS) - 1)
        table = opened(chunks.column("blob")[0].as_py()).select(["text"]).take(pa.array(rows)).append_column("row", pa.array(rows))
        held = []
        for _, texts in groups(texts_of(table)):
            found = [sigs[~void] for _, _, _, sigs, void in bands.signatures(shingles(texts))]
            if found:
                held.append(np.sort(space.cells(np.concatenate(found))))
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as out:
            out.write_table(table)
        rows_out = [(chunk, TEXTS, pressed(sink.getvalue(), 3), None)]
        if held:
            cells, counts = summed(held, [np.ones(len(h), np.int64) for h in held])
            rows_out += [(chunk, *x) for x in space.fragments(cells, np.minimum(counts, EMPTY).astype(np.uint8))]
        out = pa.Table.from_batches([_batch(ASKED, kinds, [list(c) for c in zip(*rows_out, strict=True)])])
        del table, held
        tidy()
        return out

    return run


def _answer(asked: pa.Table) -> pa.Table:
    """For each chunk, those of its cells in this range that more than one set has, and their levels (the logarithms of how many have them)."""
    cells = [unpacked(b) for b in asked.column("keys").to_pylist()]
    every, counts = summed(cells, [unwide(b) for b in asked.column("counts").to_pylist()])
    levels = (np.frexp(counts.astype(float))[1] - 1).astype(np.uint8)
    rows = []
    for chunk, r, own in zip(asked.column("chunk").to_pylist(), asked.column("range").to_pylist(), cells, strict=True):
        level = levels[np.searchsorted(every, own)]
        if (held := level > 0).any():
            rows.append((chunk, r, packed(own[held]), wide(level[held])))
    del cells, every, counts, levels
    tidy()
    return pa.Table.from_batches([_batch(ANSWER, [pa.int64(), pa.int32(), pa.binary(), pa.binary()], [list(c) for c in zip(*rows, strict=True)] if rows else [[]] * 4)])


def _suspects(words: int, num: int, den: int, space: Space):
    """Classes that may have a partner: the signatures that have to meet, the parity bitmap and the whole set."""
    long = pa.list_(pa.int64())
    kinds = [pa.int64(), pa.int32(), pa.int64(), long, long, pa.binary()]

    def run(chunks: pa.Table, answers: pa.Table) -> pa.Table:
        out = [_batch(SECOND, kinds, [[]] * 6)]
        if chunks.num_rows and answers.num_rows:
            shingles, bands = Shingler(words), Bands(num, den)
            answers = answers.sort_by("range")
            every, levels = _both(answers)
            chunk, table = chunks.column("chunk")[0].as_py(), opened(chunks.column("keys")[0].as_py())
            rows = table.column("row").to_pylist()
            for at, texts in groups(texts_of(table)):
                sets = shingles(texts)
                send: dict[int, list[np.ndarray]] = {}
                own = np.zeros((len(sets), 2), np.int64)
                for i, segments, t, sigs, void in bands.signatures(sets):
                    cells = space.cells(sigs)
                    place = np.minimum(np.searchsorted(every, cells), len(every) - 1)
                    level = np.where(void, np.uint8(EMPTY), np.where(every[place] == cells, levels[place], np.uint8(0)))
                    found = level > 0
                    own[i] += int((~void).sum()), int((level[~void] >= OFTEN.bit_length() - 1).sum())
                    if segments < 0:
                        chosen = sigs[found]
                    elif (need := t + 1 - int((~found).sum())) > 0:
                        others = sigs[found]
                        chosen = others[np.lexsort((others, level[found]))][:need]
                    else:
                        continue
                    if len(chosen):
                        send.setdefault(i, []).append(chosen)
                if send:
                    rare = [min(31, 32 * int(own[i, 0] - own[i, 1]) // max(1, int(own[i, 0]))) for i in send]
                    out.append(_batch(SECOND, kinds, [[chunk << ROW_BITS | rows[at + i] for i in send], rare, [len(sets[i]) for i in send], [np.concatenate(x).view(np.int64) for x in send.values()], [_parity(sets[i]) for i in send], [sets[i].tobytes() for i in send]]))
            del every, levels, table
        tidy()
        return pa.Table.from_batches(out)

    return run


def _both(answers: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The cells of a chunk that others have, in their order, and their levels, out of the answers of all ranges."""
    return np.concatenate([unpacked(b) for b in answers.column("keys").to_pylist()]), np.concatenate([unwide(b) for b in answers.column("levels").to_pylist()]).astype(np.uint8)


def _linked(num: int, den: int):
    """Keeps pairs whose whole sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("sx"), batch.column("sy"), strict=True):
                a, b = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(den * both >= num * (len(a) + len(b) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _verified(pairs: DataFrame, suspects: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) of classes that are linked. Bitmaps go first; whole sets only to pairs that pass."""
    x = suspects.select(F.col("uid").alias("a"), F.col("n").alias("na"), F.col("parity").alias("pa"))
    y = suspects.select(F.col("uid").alias("b"), F.col("n").alias("nb"), F.col("parity").alias("pb"))
    differ = F.aggregate(F.zip_with("pa", "pb", lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda t, v: t + v)
    near = pairs.join(x, "a").join(y, "b").filter((F.least("na", "nb") * den >= F.greatest("na", "nb") * num) & (differ * (den + num) <= (F.col("na") + F.col("nb")) * (den - num)))
    near = written(near.select("a", "b"))
    asked = near.select(F.explode(F.array("a", "b")).alias("uid")).distinct()
    sets = suspects.select("uid", "shingles").join(asked, "uid", "left_semi")
    whole = near.join(sets.select(F.col("uid").alias("a"), F.col("shingles").alias("sx")), "a").join(sets.select(F.col("uid").alias("b"), F.col("shingles").alias("sy")), "b")
    links = written(whole.select("a", "b", "sx", "sy").mapInArrow(_linked(num, den), "a long, b long"))
    discard(near)
    return links


def components(links: DataFrame) -> DataFrame:
    """cls, comp: the smallest class that each class of the links reaches. Labels spread along links and are then shortened."""
    edges = written(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    new = written(edges.groupBy(F.col("a").alias("cls")).agg(F.min("b").alias("m")).select("cls", F.col("cls").alias("old"), F.least("cls", "m").alias("comp")))
    while new.filter("old <> comp").limit(1).count():
        last, labels = new, new.select("cls", "comp")
        spread = edges.join(labels.select(F.col("cls").alias("b"), "comp"), "b").groupBy(F.col("a").alias("cls")).agg(F.min("comp").alias("heard"))
        heard = labels.join(spread, "cls").select("cls", F.col("comp").alias("old"), F.least("comp", "heard").alias("via"))
        jump = labels.select(F.col("cls").alias("via"), F.col("comp").alias("far"))
        new = written(heard.join(jump, "via", "left").select("cls", "old", F.least("via", F.coalesce("far", "via")).alias("comp")))
        discard(last)
    discard(edges)
    return new.select("cls", "comp")


def _pairs(members: DataFrame, tried: DataFrame | None) -> DataFrame:
    """Distinct ordered pairs (a, b) out of (x, y), without those already tried."""
    pairs = members.filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    return pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti")


def _open_buckets(entries: DataFrame, comps: DataFrame, known: int) -> DataFrame:
    """sig, uid, comp: the buckets of more than one component and more than `known` classes, one of those with the same members each."""
    named = entries.join(comps.withColumnRenamed("cls", "uid"), "uid", "left").select("sig", "uid", F.coalesce("comp", "uid").alias("comp"))
    mark = F.xxhash64("uid")
    buckets = named.groupBy("sig").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("n"), F.bit_xor(mark).alias("m1"), F.sum(F.pmod(mark, F.lit(2**31 - 1))).alias("m2"))
    buckets = buckets.filter((F.col("lo") != F.col("hi")) & (F.col("n") > known))
    chosen = buckets.groupBy("n", "m1", "m2", "lo", "hi").agg(F.min("sig").alias("sig")).select("sig")
    return written(named.join(chosen, "sig"))


def _compared(num: int, den: int):
    """For each block of members, or pair of blocks, the pairs (x, y) of different components whose sizes and bitmaps allow a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            members = batch.column("members")
            ends, flat = np.asarray(members.offsets) - members.offsets[0].as_py(), members.flatten()
            name, comp, n, side = (np.asarray(flat.field(c)) for c in ("cls", "comp", "n", "side"))
            maps = np.asarray(flat.field("parity").flatten()).view(np.uint64).reshape(-1, PARITY_WORDS)
            xs, ys = [], []
            for lo, hi in zip(ends[:-1], ends[1:], strict=True):
                for i in range(lo, hi - 1):
                    at = np.arange(i + 1, hi)
                    small, large = np.minimum(n[i], n[at]), np.maximum(n[i], n[at])
                    at = at[(comp[at] != comp[i]) & (small * den >= large * num) & ((side[at] < 0) | (side[at] != side[i]))]
                    if len(at):
                        differ = np.bitwise_count(maps[at] ^ maps[i]).sum(axis=1)
                        at = at[differ * (den + num) <= (n[i] + n[at]) * (den - num)]
                        xs += [name[i]] * len(at)
                        ys.append(name[at])
            yield pa.RecordBatch.from_arrays([pa.array(xs, pa.int64()), pa.array(np.concatenate(ys) if ys else np.empty(0, np.int64), pa.int64())], names=["x", "y"])

    return run


def _near_in_blocks(open_: DataFrame, suspects: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (x, y) of members of one bucket that may be linked, out of all whose components differ.

    Members meet in blocks of about `BLOCK`, and blocks in pairs, so no task holds a large bucket; only
    pairs that pass are rows.
    """
    sizes = open_.groupBy("sig").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    x = open_.join(sizes, "sig").withColumn("mine", F.pmod(F.xxhash64("uid"), F.col("blocks").cast("long")).cast("int"))
    x = x.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    x = x.withColumns({"i": F.least("mine", "other"), "j": F.greatest("mine", "other"), "side": F.when(F.col("mine") == F.col("other"), -1).otherwise((F.col("mine") < F.col("other")).cast("int"))})
    member = F.struct(F.col("uid").alias("cls"), "comp", "n", "side", "parity")
    blocks = x.join(suspects.select("uid", "n", "parity"), "uid").groupBy("sig", "i", "j").agg(F.collect_list(member).alias("members"))
    return blocks.select("members").mapInArrow(_compared(num, den), "x long, y long")


def _linked_classes(suspects: DataFrame, num: int, den: int) -> DataFrame:
    """cls, comp of all classes that have a link."""
    # every member of a bucket against its hub
    entries = written(suspects.select("uid", "rare", F.explode("sigs").alias("sig")))
    hubs = entries.groupBy("sig").agg(F.min(F.struct("rare", "uid")).alias("hub"), F.min("uid").alias("lo"), F.max("uid").alias("hi")).filter("lo <> hi").select("sig", F.col("hub.uid").alias("hub"))
    tried = written(_pairs(entries.join(hubs, "sig").select(F.col("uid").alias("x"), F.col("hub").alias("y")), None))
    links = _verified(tried, suspects, num, den)
    comps = components(links)
    # where components still differ: against pivots, of which all buckets with the same members choose the same
    open_ = _open_buckets(entries.select("sig", "uid"), comps, 2)
    discard(entries)
    seeds = [int.from_bytes(xxhash.xxh3_64_digest(bytes([i])), "big", signed=True) for i in range(PIVOTS)]
    pivots = open_.groupBy("sig").agg(*(F.min(F.col("uid").bitwiseXOR(F.lit(k))).alias(f"p{i}") for i, k in enumerate(seeds)))
    pivots = pivots.select("sig", F.array_distinct(F.array(*(F.col(f"p{i}").bitwiseXOR(F.lit(k)) for i, k in enumerate(seeds)))).alias("pivots"))
    asked = open_.join(pivots, "sig").select(F.col("uid").alias("x"), F.explode("pivots").alias("y"))
    more = written(_pairs(asked, tried))
    if not more.limit(1).count():
        return comps
    tried = tried.union(more)
    links = links.union(_verified(more, suspects, num, den))
    comps = components(links)
    still = _open_buckets(open_.select("sig", "uid"), comps, 2)
    discard(open_)
    rest = written(_pairs(_near_in_blocks(still, suspects, num, den), tried))
    discard(still)
    return components(links.union(_verified(rest, suspects, num, den))) if rest.limit(1).count() else comps


def _grouped(df: DataFrame, words: int, num: int, den: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Chunks of all rows; uid, doc_id, n, cls of each row; and cls, n, comp, low (the smallest id of each class), uid (its row)."""
    first = written(chunked(df, _classes(words), FIRST))
    docs = written(first.filter("uid IS NOT NULL").select("uid", "doc_id", "n", "cls"))
    chunks = first.filter("blob IS NOT NULL").select("chunk", "bytes", "blob")
    space = Space.of(text_bytes(chunks))
    head = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "uid"))
    classes = written(docs.groupBy("cls").agg(head.alias("head"), F.max("n").alias("n")).select("cls", "n", F.col("head.uid").alias("uid"), F.col("head.doc_id").alias("low")))
    wanted = classes.filter("n > 0").select(F.shiftright("uid", ROW_BITS).alias("chunk"), "uid")
    asked = written(chunks.groupBy("chunk").cogroup(wanted.groupBy("chunk")).applyInArrow(_ask(words, num, den, space), ASKED))
    answers = asked.filter(F.col("range") != TEXTS).groupBy("range").applyInArrow(_answer, ANSWER)
    texts = asked.filter(F.col("range") == TEXTS).select("chunk", "keys")
    suspects = written(texts.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_suspects(words, num, den, space), SECOND))
    discard(asked)
    comps = _linked_classes(suspects, num, den)
    discard(suspects)
    known = classes.join(comps.withColumnRenamed("cls", "uid"), "uid", "left").select("cls", "n", "uid", "low", F.coalesce("comp", "uid").alias("comp"))
    return chunks, docs, known


def join_components(df: DataFrame, words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable by links) for each row of (doc_id, text)."""
    chunks, docs, known = _grouped(df.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), words, num, den)
    heads = known.groupBy("comp").agg(F.min("low").alias("component_id"))
    names = written(known.join(heads, "comp").select("cls", "component_id"))
    discard(chunks)
    return docs.join(names, "cls").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def _picked(chunks: pa.Table, wanted: pa.Table) -> pa.Table:
    rows = np.sort(wanted.column("uid").to_numpy()) & ((1 << ROW_BITS) - 1)
    return opened(chunks.column("blob")[0].as_py()).take(pa.array(rows))


def one_of_each(df: DataFrame, words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of `df` (doc_id, text and any others): one of each component, and all without words.

    The row with the smallest id stays, null ids come last; among rows of one id it is one of them, so
    repeated ids and null ids are decided row by row.
    """
    chunks, docs, known = _grouped(df.withColumns({"doc_id": F.col("doc_id").cast("long"), "text": F.col("text").cast("string")}), words, num, den)
    head = F.min(F.struct(F.col("low").isNull().alias("last"), "low", "uid"))
    kept = known.filter("n > 0").groupBy("comp").agg(head.alias("head")).select(F.col("head.uid").alias("uid")).union(docs.filter("n = 0").select("uid"))
    wanted = written(kept.select(F.shiftright("uid", ROW_BITS).alias("chunk"), "uid"))
    held = chunks.select("chunk", "blob").join(wanted.select("chunk").distinct(), "chunk", "left_semi")
    schema = ", ".join(f"`{n.replace('`', '``')}` {({'doc_id': 'long', 'text': 'string'}).get(n, t)}" for n, t in df.dtypes)
    return held.groupBy("chunk").cogroup(wanted.groupBy("chunk")).applyInArrow(_picked, schema)


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_components(documents(spark, sf_dir))
