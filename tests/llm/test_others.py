import math
import zlib
from collections import Counter

import numpy as np
import pytest
from small_docs import LOW, sample, words_of
from oracle import assert_same
from pyspark.sql import functions as F

from lodeseam.llm import audio, language_id, lm_score, quality, queries, sharding, url_filter

DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle()))
def test_same_rows_as_duckdb(spark, name):
    assert_same(queries.QUERIES[name](spark, DIR), queries.oracle()[name], DIR)


def test_added_names_never_clash(docs):
    """Columns of the very names that operators add pass through unchanged."""
    from lodeseam.llm import line_dedup, mixing

    names = ["_score", "_lang_pred", "_n_lines", "_n_dropped", "_sha", "_found", "_tokens", "_epoch", "_domain", "_lang", "_source", "_row", "__score", "__SHA"]
    df = docs(sample(40)).withColumns({n: F.concat(F.lit(n), F.col("doc_id")) for n in names})
    model = language_id.train(df)
    for out, added in [(language_id.identify(df, model), ["___lang_pred", "___rejected"]), (line_dedup.dedup_lines(df), ["___n_lines"]), (line_dedup.dedup_lines(df, max_broadcast_keys=0), ["___n_dropped"]), (mixing.mix(df, F.lit("d"), max_epochs=1), ["__tokens", "__epoch", "__lang"])]:
        assert set(added) <= set(out.columns) and out.columns[: len(df.columns)] == df.columns or set(df.columns) <= set(out.columns)
        assert all(r[n] == f"{n}{r['doc_id']}" for r in out.collect() for n in names)


# ---------------------------------------------------------------- language ID

def test_predictions_like_brute_force(spark):
    """Language, score and rejection of each text, from sizes that plain compressors give."""
    import zstandard

    df = spark.read.parquet(f"{DIR}/documents.parquet")
    model = language_id.train(language_id.training_fold(df))
    coders = {k: zstandard.ZstdCompressor(level=5, dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_content_size=False, write_checksum=False, write_dict_id=False) for k, d in model.items()}
    close = 0
    for r in language_id.identify(df, model).collect():
        text = r["text"].lower().encode()
        size = {k: sum(len(c.compress(text[i : i + 1024])) for i in range(0, len(text), 1024)) for k, c in coders.items()}
        best, second = sorted(size.values())[:2]
        if any(c.isalpha() for c in r["text"]):
            assert size[r["_lang_pred"]] <= best + 2 and r["_rejected"] == (second == best or (second - best) / second < 0.002) or abs(second - best) < 3
            close += size[r["_lang_pred"]] == best
        else:
            assert r["_lang_pred"] == "und" and r["_rejected"]
    assert close > 0.9 * df.count()


def test_dictionaries_come_from_whole_texts(docs):
    """Pieces of every place of the sampled texts, and as many languages as there are."""
    rows = [(i, " ".join(f"{'a' if k < 2000 else 'z'}{k}" for k in range(4000)), f"l{i % 500}", "s", 1) for i in range(500)]
    got = language_id.train(docs(rows))
    assert len(got) == 500 and all(b" z" in d and b" a" in d and len(d) <= language_id.DICT_BYTES for d in got.values())


def test_language_accuracy(spark):
    out = language_id.op9_language_id(spark, "/root/testdata/sf0.01").filter("held_out")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    right = out.join(docs, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.96


def test_language_edges(spark, edge, nothing):
    model = language_id.train(edge)
    rows = language_id.identify(edge, model).collect()
    for r in rows:
        no_letter = r["text"] is None or not any(c.isalpha() for c in r["text"])
        assert (r["_lang_pred"] == "und") == no_letter and 0 <= r["_score"] <= 1 and (not no_letter or r["_rejected"])
    assert language_id.identify(nothing, model).count() == 0
    assert language_id.train(nothing) == {}
    assert {r["_lang_pred"] for r in language_id.identify(edge, {}).collect()} == {"und"}
    assert {r["_score"] for r in language_id.identify(edge.filter("doc_id = 3"), {"en": b"abc"}).collect()} == {1.0}


def test_language_is_the_smallest_code(docs):
    model = {"a": b"the cat sat on the mat " * 20, "b": b"der hund lief in den wald " * 20}
    got = language_id.identify(docs([(1, "The cat sat on the mat", None, None, 0), (2, "DER HUND LIEF", None, None, 0)]), model).collect()
    assert [r["_lang_pred"] for r in got] == ["a", "b"]


# ---------------------------------------------------------------- URL filter

URLS = [
    ("https://a.example.org/es/1", "a.example.org", "/es/1", "example.org/es/", "block"), ("http://EXAMPLE.org/en/12?x#y", "example.org", "/en/12", "example.org/en/1", "block"),
    ("http://x.org/en/2", "x.org", "/en/2", "org/", "allow"), ("http://x.org", "x.org", "", None, None), ("http://a.com/fr/", "a.com", "/fr/", "com/fr/", "allow"), ("http://a.com/de/x", "a.com", "/de/x", "com/de/", "block"),
    ("http://notexample.org/es/1", "notexample.org", "/es/1", "org/", "allow"), (None, "", "", None, "allow"), ("no scheme", "", "", None, "allow"), ("http://", "", "", None, "allow"), ("x://h?/p", "h", "", None, None),
]


def test_rules(spark):
    df = spark.createDataFrame([(i, u[0], "clash") for i, u in enumerate(URLS)], "page_id int, url string, host string")
    got = url_filter.judge(df.select("page_id", "url"), url_filter.RULES, url_filter.default_model(spark)).orderBy("page_id").collect()
    for r, (_, host, path, rule, verdict) in zip(got, URLS, strict=True):
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule) and verdict in (None, r["verdict"])
    assert url_filter.judge(df.limit(0).select("page_id", "url"), url_filter.RULES, ([0] * url_filter.BUCKETS, 0)).count() == 0


def test_url_model_on_held_out_urls(spark):
    """Every third row of the labelled table is held out."""
    rows = url_filter.labelled_urls()
    model = url_filter.train(spark.createDataFrame([r for i, r in enumerate(rows) if i % 3], "url string, label int"))
    held = spark.createDataFrame([r for i, r in enumerate(rows) if i % 3 == 0], "url string, label int")
    got = url_filter.judge(held, [("no.test/", "allow")], model).collect()
    assert sum((r["verdict"] == "block") == (r["label"] == 1) for r in got) / len(got) > 0.95
    assert url_filter.train(held.limit(0)) == ([0] * url_filter.BUCKETS, -1)


# ---------------------------------------------------------------- quality rules

def test_quality_edges(edge, nothing, spark):
    import pyarrow as pa

    df = edge.withColumn("doc_id", F.row_number().over(__import__("pyspark").sql.Window.orderBy(F.monotonically_increasing_id())))
    rows = [(r["doc_id"], r["text"], r["source"]) for r in df.collect()]
    view = pa.table({"doc_id": [r[0] for r in rows], "text": [r[1] for r in rows], "source": [r[2] or "" for r in rows]})
    assert_same(quality.judge(df.withColumnRenamed("source", "host")), quality.SQL, views={"documents": view})
    assert quality.judge(nothing.withColumnRenamed("source", "host")).count() == 0


def test_documents_of_common_lines_go(docs):
    common = [f"this line number {c} is on every page of the host" for c in "abcd"]
    rows = [(i, "\n".join([*common, f"own words {i}"]), "en", "h1", 1) for i in range(40)] + [(100 + i, f"clean text with its own twelve words or more about thing {chr(97 + i % 26) * 3} and {chr(97 + i // 26) * 4}", "en", "h2", 1) for i in range(40)]
    got = {r["doc_id"]: r["kept"] for r in quality.judge(docs(rows).withColumnRenamed("source", "host")).collect()}
    assert [got[i] for i in range(40)] == [False] * 40 and all(got[100 + i] for i in range(40))


def test_common_lines_are_taken_out_of_the_text(docs):
    own = "own words of this page that stay where they are in the text, number"
    rows = [(i, f"Menu line {i % 7} of all pages\n\n{own} {chr(97 + i % 26)}{chr(97 + i // 26)} \n  menu LINE 3 of all pages", "en", "h1", 1) for i in range(40)] + [(99, None, "en", "h1", 0)]
    got = {r["doc_id"]: (r["text"], r["kept"]) for r in quality.cleaned(docs(rows).withColumnRenamed("source", "host")).collect()}
    assert got == {99: (None, False)} | {i: (f"\n{own} {chr(97 + i % 26)}{chr(97 + i // 26)} ", True) for i in range(40)}


# ---------------------------------------------------------------- sharding

def shards(df, n=4):
    rows = sharding.shard(df, n).collect()
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r)
    for part in by.values():
        assert sorted(r["slot"] for r in part) == list(range(len(part)))
    assert set(by) <= set(range(n))
    return rows, {s: sum(r["size"] for r in part) for s, part in by.items()}


def test_shards(docs, edge, nothing):
    df = docs(sample(3000))
    rows, sizes = shards(df)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == Counter((r["doc_id"], len(r["text"].encode()) + 1, zlib.crc32(r["text"].encode())) for r in df.collect())
    assert max(sizes.values()) < 1.02 * min(sizes.values())
    together = {}
    for r in rows:
        together.setdefault(r["text_crc32"], set()).add(r["shard"])
    assert all(len(s) == 1 for s in together.values())
    rows, _ = shards(edge)
    assert len(rows) == edge.count()
    assert sharding.shard(nothing).count() == 0


def test_placement_like_brute_force(docs):
    """Every document's shard, from a plain version of the packing: heavy groups by themselves, the others by cells of their hash."""
    import hashlib

    rows, n = sample(1500), 4
    groups = {}
    for _, t, *_ in rows:
        g = groups.setdefault(hashlib.md5(t.encode()).digest(), [0, 0, 0, t])
        for i, x in enumerate((len(t.encode()) + 1, len(words_of(t)), 1)):
            g[i] += x
    whole = [sum(g[i] for g in groups.values()) for i in range(3)]
    cell = lambda key: int.from_bytes(key[:2], "big") % 4096
    heavy = [k for k in sorted(groups) if max(groups[k][i] * 1024 / whole[i] for i in range(3)) > 1]
    cells = [[0] * 3 for _ in range(4096)]
    for k in set(groups) - set(heavy):
        for i in range(3):
            cells[cell(k)][i] += groups[k][i]
    units = [[x[i] / whole[i] for i in range(3)] for x in [groups[k] for k in heavy] + cells]
    left, where = [[1 / n] * 3 for _ in range(n)], {}
    for u in sorted(range(len(units)), key=lambda u: -max(units[u])):  # sorting keeps the order of ties
        where[u] = max(range(n), key=lambda s: sum(a * b for a, b in zip(units[u], left[s])))
        left[where[u]] = [a - b for a, b in zip(left[where[u]], units[u])]
    want = {g[3]: where[heavy.index(k)] if k in heavy else where[len(heavy) + cell(k)] for k, g in groups.items()}
    texts = {i: t for i, t, *_ in rows}
    got = sharding.shard(docs(rows), n).collect()
    assert len(heavy) > 10 and all(want[texts[r["doc_id"]]] == r["shard"] for r in got)


def test_a_group_larger_than_a_shard_is_split(docs):
    rows = sample(400) + [(10_000 + i, "the same text " * 30, "en", "s", 1) for i in range(900)]
    _, sizes = shards(docs(rows))
    assert max(sizes.values()) < 1.25 * min(sizes.values())


# ---------------------------------------------------------------- quality beyond the broadcast bound

def test_long_lists_of_frequent_lines(docs, edge):
    """Lists that aren't broadcast give the same rows."""
    for df in (docs(sample(300)), edge):
        df = df.select("doc_id", "text", F.col("source").alias("host"))
        few, many = (sorted(map(tuple, quality.cleaned(df, 2, 10, 3, broadcast_lines=n).collect()), key=repr) for n in (10**6, 0))
        assert few == many and (df.count() < 300 or any("\n" in r[1] for r in few if r[1]))


# ---------------------------------------------------------------- LM scoring

def lm_brute(rows):
    counts, out = Counter(), []
    held = {i: zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2 for i, (d, _) in enumerate(rows)}
    tokens = [[*words_of((t or "").translate(LOW)), None] for _, t in rows]
    for i, t in enumerate(tokens):
        if not held[i]:
            counts.update(t)
    n, v = sum(counts.values()), len(counts)
    for i, t in enumerate(tokens):
        out.append((rows[i][0], held[i], len(t), sum(counts[w] > 0 for w in t), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t)))
    return sorted(out, key=repr)


def folded(df):
    return df.select("doc_id", "text").withColumn("held_out", F.pmod(lm_score.doc_crc(F.col("doc_id")), F.lit(7)) == 2)


@pytest.mark.parametrize("broadcast_bytes", [64 << 20, 0])
def test_base_scores(docs, edge, broadcast_bytes):
    for df in (docs(sample(300)), edge):
        got = sorted((tuple(r) for r in lm_score.score(folded(df), broadcast_bytes=broadcast_bytes).collect()), key=repr)
        want = lm_brute([(r["doc_id"], r["text"]) for r in df.collect()])
        assert [g[:5] for g in sorted(got, key=lambda g: repr(g[:5]))] == [w[:5] for w in sorted(want, key=lambda w: repr(w[:5]))]
        assert sorted(round(g[5], 6) for g in got) == sorted(round(w[5], 6) for w in want)
        assert all(g[6] <= 0 and math.isfinite(g[6]) for g in got)


def test_model_is_better_than_words_alone(spark):
    out = lm_score.op10_lm_score(spark, "/root/testdata/sf0.01").filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert out[0] > out[1]


def test_counts_of_the_filter():
    """Levels are never below that of the true count, seldom above it, and n-grams that nobody has are seldom found."""
    r = np.random.default_rng(1)
    keys = np.unique(r.integers(0, 2**50, 20_000, dtype=np.uint64))
    true = np.minimum(r.zipf(1.6, len(keys)), 10**9)
    cells = lm_score.Slice.parse(lm_score.Slice.of(keys, true).raw())
    got = cells.levels(keys).astype(int)
    assert (true == 1).mean() > 0.3 and (got >= lm_score.level(true)).all() and (got > lm_score.level(true)).mean() < 0.01
    assert (cells.levels(r.integers(2**50, 2**51, 100_000, dtype=np.uint64)) > 0).mean() < 0.005
    full = lm_score.Slice(np.full(8, 255, np.uint8), 9)  # with all bits set the probing ends at the top level
    assert (full.levels(keys[:9]) == 9).all()
    assert lm_score.Slice.of(keys[:0], true[:0]).levels(keys).max() == 0


def test_levels_stand_for_the_mean_of_their_counts():
    counts = np.arange(1, 3000)
    levels = lm_score.level(counts)
    for lev in np.unique(levels):
        own = counts[levels == lev]
        if own[-1] < 2000:
            assert lm_score.counts_of(np.array([lev]))[0] == own.mean()
    assert lm_score.counts_of(np.array([0]))[0] == 0


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_like_brute_force(docs, edge, order):
    """The score of every text by counts of its own, on both ways; only a false hit of the filter may make a difference."""
    for df in (docs(sample(300)), edge):
        rows = [(r["doc_id"], [*words_of((r["text"] or "").translate(LOW)), None], r["held_out"]) for r in folded(df).collect()]
        counts = [Counter() for _ in range(order)]
        grams = lambda t, k: zip(*([None] * (k - i) + t for i in range(k + 1)))  # n-grams of k + 1 words; None is the end
        for _, t, held in rows:
            if not held:
                for k in range(order):
                    counts[k].update(grams(t, k))
        q = lambda c: float(lm_score.counts_of(lm_score.level(np.array([c])))[0]) if c else 0.0
        n, v = counts[0].total(), len(counts[0])

        def score(t, mu, less):
            total = 0.0
            for i in range(len(t)):
                hist = [None] * order + t[: i + 1]
                p = min(1.0, (max(counts[0][(t[i],)] - less, 0) + 1) / max(1, n - less + v + 1))
                for k in range(1, order):
                    gram = tuple(hist[-k - 1 :])
                    c, before = q(counts[k][gram]), counts[0][gram[:-1]] if k == 1 else q(counts[k - 1][gram[:-1]]) if i else 0.0
                    p = min(1.0, (max(c - less, 0) + mu * p) / (max(max(c, before) - less, 0) + mu))
                total += math.log10(p)
            return total

        best = max(lm_score.GRID, key=lambda mu: (sum(score(t, mu, 1) for _, t, held in rows if not held), -mu))
        want = sorted((score(t, best, 0) for _, t, _ in rows), reverse=True)
        for broadcast_bytes in (64 << 20, 0):
            got = sorted((r["score"] for r in lm_score.score(folded(df), order, broadcast_bytes).collect()), reverse=True)
            near = sum(abs(a - b) < 1e-6 * max(1, abs(b)) for a, b in zip(got, want, strict=True))
            assert near >= 0.8 * len(want) and all(abs(a - b) <= 0.02 * max(1, abs(b)) for a, b in zip(got, want, strict=True))


def test_both_ways_give_the_same_scores(spark):
    x = folded(spark.read.parquet(f"{DIR}/documents.parquet"))
    assert sorted(lm_score.score(x).collect()) == sorted(lm_score.score(x, broadcast_bytes=0).collect())


def test_lm_of_nothing(nothing):
    assert lm_score.score(folded(nothing)).count() == 0


# ---------------------------------------------------------------- audio

def test_fingerprints_find_recordings_again(spark):
    out = audio.op4_audio_fingerprint(spark, DIR)
    rows = out.collect()
    asked = [r for r in rows if r["vec_id"] % 50 == 0]
    right = [r for r in asked if r["match"] == r["class_id"] and r["offset"] == audio.LATE]
    assert len(rows) == 500 and len(right) / len(asked) >= 0.9


def test_alignment_against_brute_force(spark):
    """The best match over all offsets of all recordings, by bit errors alone."""
    emb = spark.read.parquet(f"{DIR}/embeddings.parquet").limit(200).collect()
    prints = {r["vec_id"]: audio.fingerprint(audio.render(np.array(r["embedding"]))) for r in emb}
    asked = {i: audio.fingerprint(audio.played_again(audio.render(np.array(r["embedding"])))) for r in emb if (i := r["vec_id"]) % 50 == 0}
    got = {r["vec_id"]: r for r in audio.melodies(spark.createDataFrame(emb)).collect()}
    same = 0
    for i, q in asked.items():
        best = (2.0, None)
        for j, p in prints.items():
            for off in range(-len(q) // 2, len(p) // 2):
                a, b = q[max(0, -off) :], p[max(0, off) :]
                n = min(len(a), len(b))
                if n >= 20:
                    best = min(best, (int(np.bitwise_count(a[:n] ^ b[:n]).sum()) / (32 * n), j))
        same += got[i]["match"] == best[1]
    assert same >= 0.9 * len(asked)


def test_all_pairs_within_the_error_at_any_noise(spark):
    """All pairs against brute force; copies with up to 30 % of their bits turned are among them, without equal runs."""
    r = np.random.default_rng(3)
    held = [r.integers(0, 2**32, 50 - i % 3, dtype=np.uint64).astype(np.uint32) for i in range(30)] + [r.integers(0, 2**32, 3, dtype=np.uint64).astype(np.uint32)]
    turned = lambda x, share: x ^ np.packbits(r.random((len(x), 32)) < share, axis=1).view(np.uint32)[:, 0]
    asked = {100 + i: turned(x, (0.05, 0.15, 0.3)[i % 3])[i % 4 :] for i, x in enumerate(held)}
    frame = lambda rows, name: spark.createDataFrame([(i, x.view(np.int32).tolist()) for i, x in rows], f"{name} long, ints array<int>")
    got = {(g["query"], g["id"]): (g["offset"], g["bit_error"]) for g in audio.align(frame(asked.items(), "query"), frame(enumerate(held), "id")).collect()}
    want = {}
    for i, q in asked.items():
        for j, p in enumerate(held):
            for off in range(-len(q), len(p)):
                a, b = q[max(0, -off) :], p[max(0, off) :]
                n = min(len(a), len(b))
                if n and 2 * n >= len(q):
                    e = int(np.bitwise_count(a[:n] ^ b[:n]).sum()) / (32 * n)
                    if e <= audio.MAX_ERROR and e < want.get((i, j), (0, 2))[1]:
                        want[i, j] = off, e
    assert got == want and all((100 + i, i) in got for i in range(30))


def test_other_recordings_are_reported(spark):
    emb = spark.read.parquet(f"{DIR}/embeddings.parquet").filter("vec_id = 50").first()["embedding"]
    near = list(emb)
    near[40] += 0.1
    rows = audio.melodies(spark.createDataFrame([(50, list(emb)), (51, near)], "vec_id long, embedding array<float>")).collect()
    row = next(r for r in rows if r["vec_id"] == 50)
    assert row["match"] == 50 and [m["id"] for m in row["others"]] == [51]


def test_audio_edges(spark):
    df = spark.createDataFrame([(0, None, 1), (50, [], 1), (1, [0.1] * 64, 1), (1, [0.1] * 64, 1), (None, [0.2, None, float("nan")] * 20, 1), (100, [0.1] * 64, 1)], "vec_id long, embedding array<float>, query int")
    got = audio.melodies(df).collect()
    assert len(got) == 6
    by = {r["vec_id"]: r for r in got}
    assert by[0]["n_ints"] == by[50]["n_ints"] == 0 and by[50]["class_id"] == 0 and by[0]["match"] is None
    assert by[100]["class_id"] == 1 and by[100]["match"] == 1
    assert audio.melodies(df.limit(0)).count() == 0


def test_only_near_projections_are_compared_and_none_is_lost(monkeypatch):
    """Bits are counted for few pairs of unrelated melodies, and each pair within the bound is found at its offset, at any bound and length."""
    r = np.random.default_rng(5)
    vectors = r.normal(0, 0.125, (120, 64))
    held = np.array([audio.fingerprint(audio.render(v)) for v in vectors]).T
    asked = np.array([audio.fingerprint(audio.played_again(audio.render(v))) for v in vectors[:40]]).T
    turned = asked ^ np.packbits(r.random((*asked.shape, 32)) < r.random((1, asked.shape[1], 1)) * 0.2, axis=2).view(np.uint32)[:, :, 0]
    compared = []
    monkeypatch.setattr(audio, "np", type("counted", (), {"__getattr__": lambda _, k: (lambda x: (compared.append(x.size), np.bitwise_count(x))[1]) if k == "bitwise_count" else getattr(np, k)})())
    for q, p in ((asked, held), (turned, held), (asked[:5], held), (asked[:3], held), (asked, held[:30])):
        along = audio.axes([q])
        for bound in (0.0, audio.SAME_MELODY, 0.2, audio.MAX_ERROR, 1.0):
            compared.clear()
            error, offset = audio.nearest(q, p, bound, along)
            if q is asked and p is held and bound == audio.SAME_MELODY:
                assert (np.diag(error)[:40] <= bound).all() and sum(compared) < 0.02 * 30 * 50 * error.size
            want, at = np.full(error.shape, 2.0), np.zeros(error.shape, int)
            for off in range(-len(q), len(p)):
                a, b = q[max(0, -off) :], p[max(0, off) :]
                n = min(len(a), len(b))
                if n > 0 and 2 * n >= len(q):
                    now = np.bitwise_count(a[:n, None, :] ^ b[:n, :, None]).sum(0, dtype=int) / (32 * n)
                    better = (now <= bound) & (now < want)
                    want[better], at[better] = now[better], off
            assert (error == want).all() and (offset == at).all()
