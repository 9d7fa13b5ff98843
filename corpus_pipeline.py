"""A training-data pipeline over `documents`: language ID, line dedup, near-duplicate removal, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of documents. Every stage works on all rows that the one before kept.

* language_id: documents without a letter, or whose two best languages are within a narrow margin, go.
* line_dedup: a line found in ten documents or more stays only in the one with the smallest id.
  Documents that had words and lose all of them go.
* near_duplicates: of each component of the n-gram Jaccard join one row stays, that of the smallest id (null ids last).
* mixing: documents are chosen, or repeated in a second epoch, by the weights of their domain, language and source.
* packing: the tokens of what is left, in sequences of at most 2048.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeseam.llm import language_id, line_dedup, mixing, ngram_join, packing
from lodeseam.llm.common import documents, new_prefix, words_of, written

#: SQL has no zstandard and no tokenizer, so the pipeline is held against a brute-force version in the tests.
ORACLE_SQL = None


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language_id.train(language_id.training_fold(docs))
    return language_id.identify(docs, model).filter(~F.col(f"{new_prefix(docs, language_id.NAMES)}rejected")).select(*docs.columns)


def without_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(docs, min_docs=10, keep="first")
    left = F.size(words_of(F.col("text"))) > 0
    return out.filter((F.col(f"{new_prefix(docs, line_dedup.NAMES)}n_dropped") == 0) | left).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = mixing.mix(docs, mixing.domain_of(F.col("source")), mixing.DOMAIN_WEIGHTS, mixing.LANG_WEIGHTS, {}, mixing.BUDGET_PER_MILLE, mixing.MAX_EPOCHS, mixing.SEED)
    return out.select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, packing.word_tokenizer())


STAGES = [
    ("language_id", identified),
    ("line_dedup", without_common_lines),
    ("near_duplicates", without_near_duplicates),
    ("mixing", mixed),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
