import hashlib
from collections import defaultdict

import pytest
from small_docs import lines_of, sample

from lodeseam.llm import line_dedup


def brute(rows, min_docs, keep):
    """doc -> (lines, dropped, kept text), by the contract."""
    where = defaultdict(set)
    for k, (_, text) in enumerate(rows):
        for key in {key for _, key in lines_of(text)} - {""}:
            where[key].add(k)
    first = {key: min((rows[k][0] if rows[k][0] is not None else 2**63 - 1) for k in ks) for key, ks in where.items()}
    out = []
    for doc_id, text in rows:
        lines = lines_of(text)
        me = 2**63 - 1 if doc_id is None else doc_id
        kept = [line for line, key in lines if not key or len(where[key]) < min_docs or (keep == "first" and first[key] == me)]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("bound", [300_000, 0])
def test_like_brute_force(docs, edge, keep, bound):
    for df in (docs(sample(300)), edge):
        rows = [(r["doc_id"], r["text"]) for r in df.collect()]
        want = brute(rows, 3, keep)
        got = line_dedup.line_digest(df, 3, keep, bound).collect()
        assert sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_sha256"]) for r in got), key=repr) == sorted(((a, b, c, hashlib.sha256(t.encode()).hexdigest()) for a, b, c, t in want), key=repr)
        whole = line_dedup.dedup_lines(df, min_docs=3, keep=keep, max_broadcast_keys=bound)
        assert {*df.columns} <= {*whole.columns}
        assert sorted(((r["doc_id"], r["_n_lines"], r["_n_dropped"], r["text"] or "") for r in whole.collect()), key=repr) == want


def test_empty(nothing):
    assert line_dedup.line_digest(nothing, 2).count() == 0


def test_bad_mode(nothing):
    with pytest.raises(ValueError, match="keep"):
        line_dedup.line_digest(nothing, 2, "all")
