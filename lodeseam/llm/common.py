"""What several operators of this subpackage share: the shared folder, tables written to it, ranks."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

#: The characters between words: space and \t \n \v \f \r. Python's bytes.split() uses the same six.
SPACE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset, a temporary one in local mode; an error on a cluster."""
    sc = spark.sparkContext
    got = sc.getCheckpointDir()
    if not got:
        named = sc.getConf().get("spark.checkpoint.dir")
        if not named and not re.match(r"local($|\[)", sc.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="lodeseam-"))
        got = sc.getCheckpointDir()
    return got


def new_prefix(df: DataFrame, names: tuple[str, ...]) -> str:
    """One _ or more: with them before the names, columns that are added clash with none of `df`, whatever the letter case."""
    out, there = "_", {c.lower() for c in df.columns}
    while any(out + n in there for n in names):
        out += "_"
    return out


def written(df: DataFrame) -> DataFrame:
    """The same rows, read back from Parquet in the shared folder: lineage ends there, and lost executors cost nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Deletes a table made by `written`, once what was made of it is written."""
    jvm = df.sparkSession._jvm
    conf = df.sparkSession._jsparkSession.sessionState().newHadoopConf()
    for file in df.inputFiles():
        folder = file.rsplit("/", 1)[0]
        if "/table-" in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)
            return


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def words_of(text: Column) -> Column:
    """The words of a text as an array; empty for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def lower_az(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def doc_crc(doc_id: Column) -> Column:
    """crc32 of the id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def gapless_rank(df: DataFrame, group: str, salt: Column, order: list[Column], name: str = "rank", target: int = 256) -> DataFrame:
    """Adds a rank from 0 without gaps within each group, with no task that needs all rows of a group.

    Each group is cut into sub-groups of about `target` rows by the hash `salt`; a count for each
    sub-group gives its first rank, and only sub-groups are sorted. `df` is read more than once, so
    it should be a written table.
    """
    largest = df.groupBy(group).count().agg(F.max("count")).first()[0] or 0
    parts = max(1, -(-largest // target))
    cut = df.withColumn("_sub", F.pmod(salt, F.lit(parts)))
    counts = cut.groupBy(group, "_sub").agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(group).orderBy("_sub").rowsBetween(W.unboundedPreceding, -1)
    firsts = counts.select(group, "_sub", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    ranked = cut.withColumn("_rn", F.row_number().over(W.partitionBy(group, "_sub").orderBy(*order)) - 1)
    return ranked.join(firsts, [group, "_sub"]).withColumn(name, F.col("_first") + F.col("_rn")).drop("_sub", "_rn", "_first")
