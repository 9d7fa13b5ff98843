"""Sharding by vector bin packing: bytes, tokens (words) and rows are balanced together.

Equal texts form a group. A group that holds more than 1/`UNITS` of all bytes, tokens or rows is
placed by itself (there are fewer than 3 * UNITS of them); all others are placed by `CELLS` cells of
their hash. Units go, the largest first, to the shard where the dot product of what they need with
what the shard has left is highest. A group larger than a shard is split, by the hash of the id,
into parts that are placed singly.

Slots in a shard are ranks by `gapless_rank`, so no task needs all rows of a shard.

Defined cases. A null text is none (size 1), and the same group as the empty text. Equal rows are
placed one by one. Null ids are allowed. Columns other than doc_id and text are not looked at. An
empty table gives an empty result.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, gapless_rank, words_of, written

UNITS = 1024
CELLS = 4096


def place(units: list[tuple[float, float, float]], n_shards: int) -> list[int]:
    """The shard of each unit; a unit is what it needs of the whole of each of three dimensions."""
    left = [[1 / n_shards] * 3 for _ in range(n_shards)]
    out = [0] * len(units)
    for i in sorted(range(len(units)), key=lambda i: (-max(units[i]), i)):
        need = units[i]
        best = max(range(n_shards), key=lambda s: (sum(a * b for a, b in zip(need, left[s], strict=True)), -s))
        out[i] = best
        for d in range(3):
            left[best][d] -= need[d]
    return out


def shard(df: DataFrame, n_shards: int = 16) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot for each row of (doc_id, text)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    raw = text.cast("binary")
    base = written(df.select(F.col("doc_id").cast("long"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"), F.size(words_of(text)).cast("long").alias("tokens"), F.unhex(F.md5(raw)).alias("key")))
    groups = base.groupBy("key").agg(F.sum("size").alias("b"), F.sum("tokens").alias("t"), F.count(F.lit(1)).alias("n"))
    groups = written(groups.withColumn("cell", F.expr(f"cast(conv(hex(substring(key, 1, 2)), 16, 10) AS int) % {CELLS}")))
    total = groups.agg(F.sum("b"), F.sum("t"), F.sum("n")).first()
    whole = [max(1, x or 0) for x in total]
    large = F.greatest(*(F.col(c) * UNITS / x for c, x in zip("btn", whole, strict=True))) > 1
    heavy = sorted(groups.filter(large).select("key", "b", "t", "n").collect(), key=lambda r: bytes(r["key"]))
    cells = {r["cell"]: r for r in groups.filter(~large).groupBy("cell").agg(*(F.sum(c).alias(c) for c in "btn")).collect()}
    units, owner = [], []
    for r in heavy:
        need = [r[c] / x for c, x in zip("btn", whole, strict=True)]
        parts = -(-int(max(need) * 1e6) * 4 * n_shards // 1_000_000) if max(need) > 1 / n_shards else 1
        for p in range(parts):
            units.append(tuple(x / parts for x in need))
            owner.append((bytes(r["key"]), p))
    for c in range(CELLS):
        units.append(tuple(cells[c][k] / x for k, x in zip("btn", whole, strict=True)) if c in cells else (0.0, 0.0, 0.0))
    placed = place(units, n_shards)
    own: dict[bytes, list[int]] = {}
    for (key, _), s in zip(owner, placed, strict=False):
        own.setdefault(key, []).append(s)
    table = df.sparkSession.createDataFrame([(bytearray(k), v) for k, v in own.items()], "key binary, own array<int>")
    by_cell = F.from_json(F.lit(json.dumps(placed[len(owner) :])), "array<int>")
    cell = F.expr(f"cast(conv(hex(substring(key, 1, 2)), 16, 10) AS int) % {CELLS}")
    mine = F.get("own", F.pmod(F.xxhash64("doc_id", F.lit("part")), F.size("own").cast("long")).cast("int"))
    out = base.join(F.broadcast(table), "key", "left").withColumn("shard", F.coalesce(mine, F.get(by_cell, cell)))
    out = written(out.select("doc_id", "size", "text_crc32", "shard"))
    return gapless_rank(out, "shard", F.xxhash64("doc_id", "text_crc32"), [F.col("doc_id"), F.col("text_crc32")], "slot")


def op6_vector_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard(documents(spark, sf_dir), 16)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
