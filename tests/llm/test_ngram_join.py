import numpy as np
import pytest
from small_docs import LOW, sample, words_of

from lodeseam.llm import ngram_join
from lodeseam.llm.tokens import WordHasher


def brute(rows, num=80, den=100):
    sets = []
    for _, text in rows:
        w = words_of((text or "").translate(LOW))
        sets.append({tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)})
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and den * both >= num * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        group = [rows[k][0] for k in range(len(rows)) if find(k) == find(i) and rows[k][0] is not None] if sets[i] else [doc_id]
        out.append((doc_id, len(sets[i]), min(group, default=None) if group and group[0] is not None else doc_id))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("num", "seed"), [(80, 1), (80, 2), (60, 3), (95, 4)])
def test_like_brute_force(docs, num, seed):
    df = docs(sample(350, seed))
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    got = sorted((tuple(r) for r in ngram_join.join_components(df, num=num).collect()), key=repr)
    assert got == brute(rows, num)


def test_edges(edge, nothing):
    rows = [(r["doc_id"], r["text"]) for r in edge.collect()]
    assert sorted((tuple(r) for r in ngram_join.join_components(edge).collect()), key=repr) == brute(rows)
    assert ngram_join.join_components(nothing).count() == 0


def test_one_of_each(docs, edge, nothing):
    """One row of each component stays with all its columns: repeated ids and null ids are decided row by row."""
    w = [f"w{i}" for i in range(60)]
    a, b, c = " ".join(w), " ".join(w[:-1] + ["x"]), " ".join(reversed(w))
    rows = [(5, a, "en", "s", 1), (3, b, "de", "s", 2), (3, c, "fr", "s", 3), (None, a, "es", "s", 4), (None, None, None, None, 5), (7, "", "en", "s", 6), (8, "", "en", "s", 7), (None, c, None, "t", 8)]
    assert sorted(r["n_chars"] for r in ngram_join.one_of_each(docs(rows)).collect()) == [2, 3, 5, 6, 7]
    kept = ngram_join.one_of_each(edge)
    assert kept.columns == edge.columns and kept.count() == 9
    assert ngram_join.one_of_each(nothing).count() == 0


def test_many_near_copies(docs):
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(300):
        w = list(base)
        w[i % 100] = f"x{i}"
        rows.append((i, " ".join(w), "en", "s", 1))
    got = ngram_join.join_components(docs(rows)).collect()
    assert {r["component_id"] for r in got} == {0}


@pytest.mark.parametrize("size", [1, 2, 3, 5, 8, 13, 20, 33, 47, 48, 64, 90, 200, 700])
def test_a_common_signature_for_every_allowed_difference(size):
    """Pairs at the bound of the difference share a signature; those just over it aren't promised one."""
    r = np.random.default_rng(size)
    bands = ngram_join.Bands(80, 100)
    for other in range(size, size * 5 // 4 + 1):
        for _ in range(3):
            common = next(c for c in range(size + 1) if 100 * c >= 80 * (size + other - c)) if 100 * size >= 80 * other else None
            if common is None or size == other == common:
                continue
            pool = r.integers(0, 2**63, size + other, dtype=np.uint64)
            x, y = np.sort(pool[:size]), np.sort(np.concatenate((pool[size - common : size], pool[size : size + other - common])))
            sigs = [{(s, k) for _, s, _, g, _ in bands.signatures([z]) for k in g.tolist()} for z in (x, y)]
            assert sigs[0] & sigs[1]


def test_words_are_known_by_themselves():
    h = WordHasher()
    a, n = h([b"Alpha beta\x0bgamma", None, b"", b" beta  alpha "])
    assert n.tolist() == [3, 0, 0, 2] and a[0] == a[4] and a[1] == a[3] and len(set(a.tolist())) == 3
    long = b"word " * 700_000 + b"y" * 2_000_000 + b" end"
    a, n = h([long, b"end word"])
    assert n.tolist() == [700_002, 2] and a[-1] == a[0] and a[-2] == a[-3]
