import hashlib
from collections import defaultdict
from fractions import Fraction

from small_docs import sample, words_of
from pyspark.sql import functions as F

from lodeseam.llm import mixing


def fill(have, children):
    """Water filling of whole tokens over {name: (weight, cap)}."""
    got, left, rest = {}, have, dict(children)
    while rest:
        rate = Fraction(left, sum(w for w, _ in rest.values()))
        full = [k for k, (w, cap) in rest.items() if cap <= rate * w]
        if not full:
            got |= {k: int(rate * w) for k, (w, _) in rest.items()}
            for k in sorted(rest)[: left - sum(got[k] for k in rest)]:
                got[k] += 1
            return got
        for k in full:
            got[k] = rest.pop(k)[1]
            left -= got[k]
    return got


def brute(rows, domain_weights, lang_weights, per_mille, epochs, seed):
    leaves = defaultdict(list)
    for doc_id, text, lang, source, _ in rows:
        n = source[3:] if source and source[3:].isdigit() else ""
        domain = "crawl" if source == "src0" else "forums" if not n else ("books", "news", "forums")[int(n) % 3]
        leaves[domain, lang or "", source or ""].append((doc_id, len(words_of(text))))
    supply = {k: sum(n for _, n in v) for k, v in leaves.items()}
    d_cap, l_cap = defaultdict(int), defaultdict(int)
    for (d, lang, _), n in supply.items():
        d_cap[d] += n * epochs
        l_cap[d, lang] += n * epochs
    by_domain = fill(sum(supply.values()) * per_mille // 1000, {d: (domain_weights.get(d, 1), c) for d, c in d_cap.items()})
    out = []
    for d, have in by_domain.items():
        by_lang = fill(have, {lang: (lang_weights.get(lang, 1), c) for (x, lang), c in l_cap.items() if x == d})
        for lang, part in by_lang.items():
            for s, got in fill(part, {s: (1, n * epochs) for (x, y, s), n in supply.items() if (x, y) == (d, lang)}).items():
                key = d, lang, s
                whole, rest = divmod(got, supply[key]) if supply[key] else (1, -1)
                place = lambda i, w=whole: hashlib.md5(f"{seed}:{w}:{'' if i is None else i}".encode()).hexdigest()
                for i, n in leaves[key]:
                    upto = sum(m for j, m in leaves[key] if place(j) <= place(i))
                    out += [(i, e, n, *key) for e in range(whole + (whole < epochs and upto <= rest))]
    return sorted(out, key=repr)


def check(df, per_mille, epochs):
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"], 0) for r in df.collect()]
    out = mixing.mix(df, mixing.domain_of(F.col("source")), mixing.DOMAIN_WEIGHTS, mixing.LANG_WEIGHTS, {}, per_mille, epochs, 5)
    got = sorted(((r["doc_id"], r["_epoch"], r["_tokens"], r["_domain"], r["_lang"], r["_source"]) for r in out.collect()), key=repr)
    assert got == brute(rows, mixing.DOMAIN_WEIGHTS, mixing.LANG_WEIGHTS, per_mille, epochs, 5)
    assert {*df.columns} <= {*out.columns}


def test_like_brute_force(docs):
    df = docs(sample(260))
    for per_mille, epochs in ((1000, 2), (300, 1), (5000, 3)):
        check(df, per_mille, epochs)


def test_edges(edge, nothing):
    check(edge, 1000, 2)
    assert mixing.mix(nothing, F.lit("d")).count() == 0
