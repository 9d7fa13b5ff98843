from collections import Counter

from small_docs import sample, words_of

import corpus_pipeline
from lodeseam.llm import language_id


def test_stages(spark, tmp_path, docs):
    """Each stage against a plain version of its rule, on its own input."""
    rows = sample(260)
    docs(rows + [(900, None, None, None, None), (901, "12 34", "en", "src1", 5)]).write.parquet(str(tmp_path / "documents.parquet"))
    df = spark.read.parquet(str(tmp_path / "documents.parquet"))
    columns = df.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, df, str(tmp_path))
        out.write.parquet(str(tmp_path / name))
        seen[name] = df.collect(), spark.read.parquet(str(tmp_path / name)).collect()
        df = spark.read.parquet(str(tmp_path / name))
        assert name == "packing" or df.columns == columns
    before, after = seen["language_id"]
    model = language_id.Classifier(language_id.train(language_id.training_fold(spark.createDataFrame(before, spark.read.parquet(str(tmp_path / "documents.parquet")).schema))))
    assert Counter(map(tuple, after)) == Counter(tuple(r) for r in before if not model.predict(r["text"], 0.002)[3])
    before, after = seen["line_dedup"]
    where = {}
    for r in before:
        for key in {x.strip().lower() for x in r["text"].split("\n")} - {""}:
            where.setdefault(key, []).append(r["doc_id"])
    want = {}
    for r in before:
        lines = r["text"].split("\n")
        kept = [x for x in lines if not (k := x.strip().lower()) or len(where[k]) < 10 or min(where[k]) == r["doc_id"]]
        if len(kept) == len(lines) or words_of("\n".join(kept)):
            want[r["doc_id"]] = "\n".join(kept)
    assert {r["doc_id"]: r["text"] for r in after} == want
    before, after = seen["near_duplicates"]
    from test_ngram_join import brute

    assert sorted(r["doc_id"] for r in after) == sorted(i for i, _, c in brute([(r["doc_id"], r["text"]) for r in before]) if i == c)
    before, after = seen["mixing"]
    assert {tuple(r) for r in after} <= {tuple(r) for r in before} and max(Counter(r["doc_id"] for r in after).values()) <= 2
    before, after = seen["packing"]
    assert Counter(r["doc_id"] for r in after if r["piece"] == 0) == Counter(r["doc_id"] for r in before)
    again = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter((r["doc_id"], r["piece"], r["ids_crc32"]) for r in again) == Counter((r["doc_id"], r["piece"], r["ids_crc32"]) for r in after)


def test_empty(spark, tmp_path, nothing):
    nothing.write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
