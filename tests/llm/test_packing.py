import zlib
from collections import Counter, defaultdict

import numpy as np
from small_docs import sample
from hypothesis import given, settings
from hypothesis import strategies as st

from lodeseam.llm import packing


def check(df, size):
    from tokenizers import Tokenizer

    file = packing.word_tokenizer()
    whole = Tokenizer.from_file(file)
    want = Counter()
    for r in df.collect():
        ids = np.array([*whole.encode(r["text"] or "", add_special_tokens=False).ids, 0], "<u4")
        for k in range(0, len(ids), size):
            piece = ids[k : k + size]
            want[r["doc_id"], k // size, k, len(piece), zlib.crc32(piece.tobytes())] += 1
    rows = packing.pack(df, file, size).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for b in bins.values():
        b.sort()
        assert [o for o, _ in b] == [sum(n for _, n in b[:i]) for i in range(len(b))] and sum(n for _, n in b) <= size
    return len(bins), -(-sum(n * c for (_, _, _, n, _), c in want.items()) // size)


def test_pieces_and_places(docs, edge, nothing):
    used, least = check(docs(sample(200)), 256)
    assert used <= least * 1.02 + 1
    check(edge, 2048)
    assert packing.pack(nothing, packing.word_tokenizer()).count() == 0


def test_odd_words_like_the_tokenizer_itself(docs):
    texts = ["It's can't 'tis", "e\u0301 é\u200d ß\u00a0x\u2003y", "\u0301start", "<|endoftext|> x<|startoftext|>y", "12 a1b2 ---==", "日本 語"]
    check(docs([(i, t, None, None, 0) for i, t in enumerate(texts)]), 2048)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30), min_size=1, max_size=12))
def test_best_fit_and_search_keep_every_piece(lengths):
    bins = packing.best_fit(lengths, 40)
    found = packing.local_search(bins, 40)
    for b in (bins, found):
        count = Counter()
        for pattern, n in b.items():
            assert 0 < sum(pattern) <= 40 and n > 0
            for x in pattern:
                count[x] += n
        assert count == Counter(lengths)
    assert found.total() <= bins.total()


def test_search_empties_bins():
    start = Counter({(6, 1): 2, (5,): 2, (4,): 2, (3, 2): 1})
    assert packing.local_search(start, 10).total() < start.total()


def test_search_reaches_what_best_fit_does_not():
    """Lengths on which best fit leaves a gap that the exchanges close in part."""
    r = np.random.default_rng(0)
    r.integers(0, 60, 20_000)
    lengths = Counter((600 + 400 * r.random(120)).astype(int).tolist())
    start = packing.best_fit(lengths, 2048)
    found = packing.local_search(start, 2048)
    assert found.total() < start.total()


def test_plan_places_every_rank():
    bins = Counter({(5, 5): 3, (5, 3, 2): 4})
    plan = packing.Plan(bins)
    length = np.array([5] * 10 + [3] * 4 + [2] * 4)
    rank = np.array([*range(10), *range(4), *range(4)])
    sequence, offset = packing.find(plan.places, length, rank)
    assert len({*zip(sequence.tolist(), offset.tolist(), strict=True)}) == 18 and set(sequence.tolist()) == set(range(7))
