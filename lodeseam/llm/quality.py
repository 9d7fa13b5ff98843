"""Quality rules: base counts for each text, and the frequency of lines across a host's documents.

A line is normalised (A-Z lower-cased, digits as 0, white space stripped at both ends) and hashed.
For each host (here: the source) the documents are counted that hold each line. Lines in at least
`min_docs` documents and more than `per_mille` thousandths of the host's documents are removed, and
a document that keeps fewer than `min_words` words, or less than half of its own, is rejected
(`cleaned` returns the texts without these lines, `judge` the verdicts alone).
A host's list of such lines is at most 1000 / `per_mille` times its mean lines a document; all lists are
broadcast up to `BROADCAST_LINES` lines in all, and joined by line and text beyond.

All of it is DataFrame functions. Repeated five-word windows are found within each row by sorting
64-bit hashes, so words are never shuffled; across documents only line hashes are, counted for each
task first.

Defined cases. A null text has no words and fails. Null hosts are one host. Equal rows count as
documents of their own. Columns other than doc_id, text and the host are not looked at. An empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, documents, words_of, written

WINDOW = 5
MIN_WORDS = 10
MAX_REPEATED = 20
MIN_DOCS = 20
PER_MILLE = 10
BROADCAST_LINES = 200_000
NORMAL_FROM = "ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789"
NORMAL_TO = "abcdefghijklmnopqrstuvwxyz000000000"


def _has_word(line: Column) -> Column:
    return F.translate(line, SPACE, "") != ""


def _base(df: DataFrame) -> DataFrame:
    """Adds the counts that need one text only."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), _has_word)
    x = df.withColumns({"_words": words_of(F.col("text")), "_lines": lines})
    hashed = F.transform(F.sequence(F.lit(0), F.size("_words") - WINDOW), lambda i: F.xxhash64(*(F.get("_words", i + k) for k in range(WINDOW))))
    x = x.withColumn("_h", F.when(F.size("_words") >= WINDOW, hashed).otherwise(F.array().cast("array<bigint>")))
    x = x.withColumn("_sorted", F.when(F.size(F.array_distinct("_h")) < F.size("_h"), F.sort_array(F.transform("_h", lambda v, i: F.struct(v.alias("v"), i.alias("i"))))))
    same = F.filter("_sorted", lambda p, i: (F.get("_sorted", i + 1)["v"] == p["v"]) | ((i > 0) & (F.get("_sorted", i - 1)["v"] == p["v"])))
    x = x.withColumn("_at", F.sort_array(F.transform(same, lambda p: p["i"])))
    covered = F.aggregate(F.transform("_at", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get("_at", i + 1) - p, F.lit(WINDOW)))), F.lit(0), lambda t, v: t + v)
    return x.select(
        "doc_id", "host", "text", "frequent",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.translate(text, SPACE, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def _normal(text: Column) -> Column:
    return F.btrim(F.translate(text, NORMAL_FROM, NORMAL_TO), F.lit(SPACE))


def _normal_lines(text: Column) -> Column:
    """The normalised lines that have a word."""
    lines = F.split(F.translate(F.coalesce(text, F.lit("")), NORMAL_FROM, NORMAL_TO), "\n")
    return F.filter(F.transform(lines, lambda s: F.btrim(s, F.lit(SPACE))), lambda s: s != "")


def _hashes(text: Column) -> Column:
    return F.transform(_normal_lines(text), lambda s: F.xxhash64(s))


def frequent_lines(df: DataFrame, min_docs: int, per_mille: int) -> DataFrame:
    """host, h: the hashes of each host's frequent lines."""
    keys = df.select("host", F.explode(F.array_distinct(_hashes(F.col("text")))).alias("h"))
    often = written(keys.groupBy("host", "h").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_docs))
    hosts = written(df.groupBy("host").agg(F.count(F.lit(1)).alias("docs")))
    return written(often.join(hosts, "host").filter(F.col("n") * 1000 > F.col("docs") * per_mille).select("host", "h"))


def _with_frequent(df: DataFrame, often: DataFrame, broadcast_lines: int) -> DataFrame:
    """Adds `frequent`: the frequent lines that a row may have, or null.

    A short list goes to all workers, by host. Beyond that the distinct lines of each distinct text meet the
    list by (host, line), and what is found goes back to the text by its hash, so no task needs a whole host.
    """
    if often.count() <= broadcast_lines:
        return df.join(F.broadcast(often.groupBy("host").agg(F.collect_list("h").alias("frequent"))), "host", "left")
    keyed = df.withColumn("_sha", F.sha2(F.coalesce("text", F.lit("")), 256))
    own = keyed.select("host", "_sha", F.explode(F.array_distinct(_hashes(F.col("text")))).alias("h")).distinct()
    found = own.join(often, ["host", "h"]).groupBy("host", "_sha").agg(F.collect_list("h").alias("frequent"))
    return keyed.join(found, ["host", "_sha"], "left").drop("_sha")


def cleaned(df: DataFrame, min_docs: int = MIN_DOCS, per_mille: int = PER_MILLE, min_words: int = MIN_WORDS, broadcast_lines: int = BROADCAST_LINES) -> DataFrame:
    """doc_id, text without the frequent lines, the counts (of the whole text), base_failed and kept for each row of (doc_id, text, host)."""
    df = df.select("doc_id", "text", F.coalesce("host", F.lit("")).alias("host"))
    x = _base(_with_frequent(df, frequent_lines(df, min_docs, per_mille), broadcast_lines))
    x = x.withColumn("_hits", F.when(F.col("frequent").isNotNull(), F.array_intersect(_hashes(F.col("text")), "frequent")))
    rest = F.array_join(F.filter(F.split("text", "\n"), lambda s: ~F.array_contains("_hits", F.xxhash64(_normal(s)))), "\n")
    x = x.withColumn("text", F.when(F.size("_hits") > 0, rest).otherwise(F.col("text")))
    x = x.withColumn("_left", F.when(F.size("_hits") > 0, F.size(words_of(F.col("text")))).otherwise(F.col("n_words")))
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED)
    kept = ~failed & (F.col("_left") >= min_words) & (F.col("_left") * 2 >= F.col("n_words"))
    return x.select("doc_id", "text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), kept.alias("kept"))


def judge(df: DataFrame, min_docs: int = MIN_DOCS, per_mille: int = PER_MILLE, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, the counts, base_failed and kept for each row of (doc_id, text, host)."""
    return cleaned(df, min_docs, per_mille, min_words).drop("text")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(documents(spark, sf_dir).withColumnRenamed("source", "host"))


_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
SQL = f"""
WITH w AS (SELECT doc_id, source, coalesce(text, '') AS t, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
win AS (SELECT doc_id, i, list_aggregate(ws[i : i + 4], 'string_agg', chr(10)) AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)),
rep AS (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n > 1),
cov AS (SELECT doc_id, sum(least(5, coalesce(nxt - i, 5))) AS r FROM rep GROUP BY doc_id),
ln AS (SELECT doc_id, source, unnest(string_split(t, chr(10))) AS l FROM w),
dup AS (SELECT doc_id, count(*) - count(DISTINCT l) AS d FROM ln WHERE trim(l, {_WHITE}) <> '' GROUP BY doc_id),
nl AS (SELECT doc_id, source, trim(translate(l, '{NORMAL_FROM}', '{NORMAL_TO}'), {_WHITE}) AS k FROM ln),
often AS (SELECT source, k FROM nl JOIN (SELECT source, count(*) AS docs FROM documents GROUP BY source) USING (source) WHERE k <> '' GROUP BY source, k, docs
  HAVING count(DISTINCT doc_id) >= {MIN_DOCS} AND count(DISTINCT doc_id) * 1000 > docs * {PER_MILLE}),
gone AS (SELECT doc_id, sum(len(list_filter(regexp_split_to_array(k, '[\\x20\\x09-\\x0D]+'), lambda x: x <> ''))) AS g FROM nl JOIN often USING (source, k) GROUP BY doc_id),
m AS (SELECT w.doc_id, len(ws) AS n_words, length(translate(t, {_WHITE}, '')) AS word_chars, length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols,
  coalesce(d, 0) AS n_dup_lines, coalesce(r, 0)::BIGINT AS n_repeat_words, len(ws) - coalesce(g, 0) AS rest
  FROM w LEFT JOIN cov USING (doc_id) LEFT JOIN dup USING (doc_id) LEFT JOIN gone USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 10 OR n_repeat_words * 100 > n_words * 20 AS base_failed,
  NOT (n_words < 10 OR n_repeat_words * 100 > n_words * 20) AND rest >= {MIN_WORDS} AND rest * 2 >= n_words AS kept FROM m
"""
