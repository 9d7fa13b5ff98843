"""Line dedup with two Bloom filters (once-seen and twice-seen hashes of lines).

1. Every document's distinct line keys are hashed into the pair of filters (`seen_filter`).
2. Lines whose key the second filter holds are suspects; only their keys leave the map tasks,
   already counted for each task, and are counted exactly.
3. Keys found in `min_docs` documents or more lose their lines: everywhere, or (`keep="first"`)
   everywhere but in the first document that has them (the smallest id).

The confirmed keys go to the workers as 16-byte digests while there are at most
`max_broadcast_keys` of them. Beyond that they are joined by the digest of the text, so that equal
texts are decided once and no list of keys is held anywhere.

Defined cases. A text that is null or empty is one empty line. The empty key (a line of white space)
is never a repeat. A line repeated in one document counts once. Each row is a document, also where
ids or whole rows are equal; null ids come last in the choice of the first. An empty table gives an
empty result. Columns other than the id and the text are not looked at; `dedup_lines` passes them
through, whatever their names, and puts its own under `new_prefix` of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, new_prefix, written
from .seen_filter import FRAGMENT, CellFilter, SeenBuilder, merged

WHITE = b" \t\n\x0b\x0c\r"
NO_ID = 2**63 - 1
#: What `dedup_lines` adds, or uses on the way.
NAMES = ("n_lines", "n_dropped", "sha", "found")
DIGEST = "doc_id long, n_lines long, n_dropped long, kept_sha256 string"


def _keys(text: bytes | None) -> list[bytes]:
    """The key of every line: white space stripped, A-Z lower-cased."""
    return [line.strip(WHITE) for line in (text or b"").lower().split(b"\n")]


def _hashes(keys: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))


def _texts(batch: pa.RecordBatch, column: str) -> list[bytes | None]:
    return batch.column(column).cast(pa.large_binary()).to_pylist()


def _send_fragments(text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        builder = SeenBuilder(probes=2)
        for batch in batches:
            for text in _texts(batch, text_col):
                if builder.add(_hashes(list({*_keys(text)} - {b""}))):
                    yield builder.take()
        yield builder.take()

    return run


def _send_suspects(text_col: str, id_col: str, twice, flush_at: int = 50_000):
    """Rows (key, n, first): suspects with their documents counted for this task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list[int]] = {}

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array([x[0] for x in held.values()], pa.int64()), pa.array([x[1] for x in held.values()], pa.int64())], names=["key", "n", "first"])
            held.clear()
            return batch

        seen = CellFilter(*twice.value)
        for batch in batches:
            ids = batch.column(id_col).to_pylist()
            for doc_id, text in zip(ids, _texts(batch, text_col), strict=True):
                keys = list({*_keys(text)} - {b""})
                doc_id = NO_ID if doc_id is None else doc_id
                for key in [keys[i] for i in np.flatnonzero(seen.found(_hashes(keys)))]:
                    if got := held.get(key):
                        got[0] += 1
                        got[1] = min(got[1], doc_id)
                    else:
                        held[key] = [1, doc_id]
                if len(held) >= flush_at:
                    yield out()
        yield out()

    return run


def repeated_lines(df: DataFrame, id_col: str, text_col: str, min_docs: int) -> DataFrame:
    """key binary, n (documents that have it), first (the smallest id): every line key in at least `min_docs` documents."""
    spark = df.sparkSession
    source = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    twice = merged(source.select("text").mapInArrow(_send_fragments("text"), FRAGMENT), probes=2)
    suspects = source.mapInArrow(_send_suspects("text", "id", spark.sparkContext.broadcast(twice.parts())), "key binary, n long, first long")
    return suspects.groupBy("key").agg(F.sum("n").alias("n"), F.min("first").alias("first")).filter(F.col("n") >= min_docs)


def _drop(texts, ids, drop_of) -> Iterator[tuple[int, int, bytes | None]]:
    """For each text: lines, dropped lines, what is kept. drop_of(text, id) gives a test for keys."""
    for doc_id, text in zip(ids, texts, strict=True):
        lines = (text or b"").split(b"\n")
        drop = drop_of(text, doc_id)
        kept = [line for line, key in zip(lines, _keys(text), strict=True) if not key or not drop(key)]
        yield len(lines), len(lines) - len(kept), text if len(kept) == len(lines) else b"\n".join(kept)


def _apply(id_col: str, text_col: str, keep_first: bool, digest: bool, prefix: str, confirmed=None, list_col: str | None = None):
    """Drops the confirmed lines: `confirmed` holds digests for all rows, or `list_col` those of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = confirmed.value if confirmed else {}
        for batch in batches:
            ids = batch.column(id_col).to_pylist()
            texts = _texts(batch, text_col)
            own = iter(batch.column(list_col).to_pylist() if list_col else ())

            def drop_of(_, doc_id):
                known = {x["digest"]: x["first"] for x in next(own) or ()} if list_col else common
                me = NO_ID if doc_id is None else doc_id
                if keep_first:
                    return lambda key: (first := known.get(xxhash.xxh3_128_digest(key))) is not None and first != me
                return lambda key: xxhash.xxh3_128_digest(key) in known

            done = list(_drop(texts, ids, drop_of))
            if digest:
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([x[0] for x in done], pa.int64()), pa.array([x[1] for x in done], pa.int64()), pa.array([hashlib.sha256(x[2] or b"").hexdigest() for x in done], pa.string())], names=["doc_id", "n_lines", "n_dropped", "kept_sha256"])
            else:
                cols = {n: batch.column(n) for n in batch.schema.names if n not in (text_col, list_col)}
                yield pa.RecordBatch.from_pydict({**cols, text_col: pa.array([x[2] for x in done], pa.binary()).cast(pa.string()), f"{prefix}n_lines": pa.array([x[0] for x in done], pa.int64()), f"{prefix}n_dropped": pa.array([x[1] for x in done], pa.int64())})

    return run


def _run(df: DataFrame, id_col: str, text_col: str, min_docs: int, keep: str, max_broadcast_keys: int, digest: bool, schema: str) -> DataFrame:
    if keep not in ("none", "first"):
        raise ValueError("keep must be none or first")
    spark, first, prefix = df.sparkSession, keep == "first", new_prefix(df, NAMES)
    sha, listed = f"{prefix}sha", f"{prefix}found"
    found = written(repeated_lines(df, id_col, text_col, min_docs))
    if found.count() <= max_broadcast_keys:
        known = {xxhash.xxh3_128_digest(bytes(r["key"])): r["first"] for r in found.toLocalIterator()}
        return df.mapInArrow(_apply(id_col, text_col, first, digest, prefix, spark.sparkContext.broadcast(known)), schema)
    text_sha = F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)
    own = df.select(text_sha.alias("_sha"), F.col(text_col).alias("text")).mapInArrow(_send_text_keys, "_sha string, key binary")
    lists = own.distinct().join(found, "key").groupBy("_sha").agg(F.collect_list(F.struct(F.col("key"), F.col("first"))).alias("_found"))
    lists = lists.mapInArrow(_digest_lists, "_sha string, _found array<struct<digest:binary,first:long>>")
    joined = df.withColumn(sha, text_sha).join(lists.toDF(sha, listed), sha, "left").drop(sha)
    return joined.mapInArrow(_apply(id_col, text_col, first, digest, prefix, list_col=listed), schema)


def _send_text_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sha, keys = [], []
        for s, text in zip(batch.column("_sha").to_pylist(), _texts(batch, "text"), strict=True):
            own = {*_keys(text)} - {b""}
            keys += own
            sha += [s] * len(own)
        yield pa.RecordBatch.from_arrays([pa.array(sha, pa.string()), pa.array(keys, pa.binary())], names=["_sha", "key"])


def _digest_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("digest", pa.binary()), ("first", pa.int64())]))
    for batch in batches:
        found = [[{"digest": xxhash.xxh3_128_digest(x["key"]), "first": x["first"]} for x in row] for row in batch.column("_found").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("_sha"), pa.array(found, kind)], names=["_sha", "_found"])


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 2, keep: str = "first", max_broadcast_keys: int = 300_000) -> DataFrame:
    """The rows of `df` with repeated lines taken out of the text, and n_lines, n_dropped for each row under `new_prefix(df, NAMES)`: mostly `_n_lines`, `_n_dropped`."""
    prefix = new_prefix(df, NAMES)
    schema = ", ".join(f"`{n.replace('`', '``')}` {t}" for n, t in [*((n, t) for n, t in df.dtypes if n != text_col), (text_col, "string"), (f"{prefix}n_lines", "long"), (f"{prefix}n_dropped", "long")])
    return _run(df, id_col, text_col, min_docs, keep, max_broadcast_keys, False, schema)


def line_digest(df: DataFrame, min_docs: int, keep: str = "none", max_broadcast_keys: int = 300_000) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 (of the kept lines joined by newlines, UTF-8) for each row of (doc_id, text)."""
    df = df.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return _run(df, "doc_id", "text", min_docs, keep, max_broadcast_keys, True, DIGEST)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more go everywhere."""
    return line_digest(documents(spark, sf_dir), min_docs=10)


SQL = r"""
WITH lines AS (
  SELECT doc_id, i, l, translate(trim(l, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(ls) AS l, unnest(range(len(ls))) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))),
often AS (SELECT k FROM lines WHERE k <> '' GROUP BY k HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE k IN (SELECT k FROM often)) AS n_dropped,
  sha256(coalesce(string_agg(l, chr(10) ORDER BY i) FILTER (WHERE k NOT IN (SELECT k FROM often)), '')) AS kept_sha256
FROM lines GROUP BY doc_id
"""
