"""Language ID by compression: the language whose dictionary encodes a text in the fewest bytes.

Each language has a zstandard raw-content dictionary made of lower-cased training texts. A text is
lower-cased and cut into blocks of `BLOCK` bytes, each block is compressed with every dictionary, and the sums of the sizes
over the whole text are compared. The verdict is rejected where the margin between the smallest and
the second smallest is narrow.

Training takes a bounded sample of rows: about `docs_per_lang` documents for each language, chosen by
the hash of the id. Their whole texts are cut into pieces of `PIECE` characters, and the pieces, from all
places of the texts, come in the order of a hash into a dictionary of `DICT_BYTES` bytes. Any number of
languages can be learned; a worker holds about 0.3 MB for each.

Defined cases. Null texts and texts without a letter are `und`, score 0, rejected. Rows with a null
lang are never learned from. Without any learned language all rows are `und`. With one language its
score is 1. Ties go to the language of more training rows, and are rejected. A null id counts as the
empty text in the fold. Equal rows get equal verdicts. Other columns are not looked at;
`identify` passes them through, whatever their names: it puts its own under `new_prefix` of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import doc_crc, documents, new_prefix

BLOCK = 1024
PIECE = 300
DICT_BYTES = 32 * 1024
LEVEL = 5
#: In the score, languages are weighed by 2 to the power of minus the bytes that they need more.
UND = "und"
ADDED = [("lang_pred", "string"), ("score", "double"), ("margin", "double"), ("rejected", "boolean")]
NAMES = tuple(n for n, _ in ADDED)


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", docs_per_lang: int = 400) -> dict[str, bytes]:
    """A dictionary for each language of `labelled`, from a sample of bounded size; the language of most rows first."""
    rows = labelled.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).filter("lang IS NOT NULL AND text IS NOT NULL")
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    wanted = F.broadcast(counts.filter("n > 0"))  # a row for each language
    place = F.pmod(F.xxhash64("id", F.lit("language sample")), F.lit(1_000_000))
    sample = rows.join(wanted, "lang").filter(place * F.col("n") < 1_000_000 * 2 * docs_per_lang)
    pieces = sample.select("lang", "n", "id", F.posexplode(F.regexp_extract_all(F.lower("text"), F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))).alias("at", "piece"))
    turn = F.row_number().over(W.partitionBy("lang").orderBy(F.xxhash64("id", "at", "piece"), "piece"))
    most = -(-DICT_BYTES // (PIECE // 2))
    taken = pieces.withColumn("turn", turn).filter(F.col("turn") <= most).select("lang", "n", "turn", "piece").collect()
    out: dict[str, bytes] = {}
    for r in sorted(taken, key=lambda r: (-r["n"], r["lang"], r["turn"])):
        held = out.get(r["lang"], b"")
        if len(held) < DICT_BYTES:
            out[r["lang"]] = held + r["piece"].encode() + b"\n"
    return {k: v[:DICT_BYTES] for k, v in out.items()}


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes]) -> None:
        self.langs = list(dictionaries)
        self.letter = regex.compile(r"\p{L}")
        self.coders = []
        for lang in self.langs:
            d = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            self.coders.append(zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False))

    def sizes(self, text: str) -> list[int]:
        """Bytes that each language's coder needs for the whole text."""
        raw = text.lower().encode()
        blocks = [raw[i : i + BLOCK] for i in range(0, len(raw), BLOCK)]
        return [sum(len(c.compress(b)) for b in blocks) for c in self.coders]

    def predict(self, text: str | None, min_margin: float) -> tuple[str, float, float, bool]:
        if text is None or not self.langs or not self.letter.search(text):
            return UND, 0.0, 0.0, True
        if len(self.langs) == 1:
            return self.langs[0], 1.0, 1.0, False
        sizes = self.sizes(text)
        order = sorted(range(len(sizes)), key=lambda i: (sizes[i], i))
        best, second = sizes[order[0]], sizes[order[1]]
        margin = (second - best) / second
        score = 1 / sum(2.0 ** max(-60, best - s) for s in sizes)
        return self.langs[order[0]], score, margin, second == best or margin < min_margin


def _predict(shared, text_col: str, min_margin: float, prefix: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Classifier(shared.value)
        kinds = [pa.string(), pa.float64(), pa.float64(), pa.bool_()]
        for batch in batches:
            got = [model.predict(t, min_margin) for t in batch.column(text_col).to_pylist()]
            cols = [batch.column(i) for i in range(batch.num_columns)]
            added = [pa.array([x[i] for x in got], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*cols, *added], names=[*batch.schema.names, *(prefix + n for n, _ in ADDED)])

    return run


def identify(df: DataFrame, dictionaries: dict[str, bytes], text_col: str = "text", min_margin: float = 0.002) -> DataFrame:
    """The rows of `df` with lang_pred, score, margin and rejected, their names under `new_prefix(df, NAMES)`: mostly `_lang_pred` and so on."""
    prefix = new_prefix(df, NAMES)
    schema = ", ".join(f"`{n.replace('`', '``')}` {t}" for n, t in [*df.dtypes, *((prefix + n, t) for n, t in ADDED)])
    shared = df.sparkSession.sparkContext.broadcast(dictionaries)
    return df.mapInArrow(_predict(shared, text_col, min_margin, prefix), schema)


def training_fold(df: DataFrame) -> DataFrame:
    return df.filter(F.pmod(doc_crc(F.col("doc_id")), F.lit(5)) != 0)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held = docs.select("doc_id", (F.pmod(doc_crc(F.col("doc_id")), F.lit(5)) == 0).alias("held_out"), "text")
    out = identify(held, train(training_fold(docs)))
    return out.select("doc_id", "held_out", F.col("_lang_pred").alias("lang_pred"), F.col("_score").alias("score"), F.col("_margin").alias("margin"), F.col("_rejected").alias("rejected"))
