"""The audit stream: decisions appended as JSON lines, and events counted in windows, by Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vocabulary as V


def decision_records(decisions: DataFrame, run_id: str) -> DataFrame:
    """Evaluated links (source_id, page_url, target, in_domain, ...) as audit records with nested evidence."""
    return decisions.select(
        F.lit(run_id).alias("run_id"), F.lit(V.DECISION_SCHEMA).alias("schema_version"), F.lit(V.RULE_VERSION).alias("rule_version"),
        "source_id", F.col("page_url").alias("referring_url"), F.col("target").alias("candidate_url"), "href",
        F.col("decision_title").alias("title"), (F.col("accepted") & F.col("in_domain")).alias("accepted"), "score", "reasons",
        F.when(F.col("in_domain"), F.col("rejection_reason")).otherwise("invalid or external URL").alias("rejection_reason"),
        "subject", "grade", "document_type",
        F.struct(F.col("text").alias("anchor"), F.col("title"), F.col("before"), F.col("after")).alias("evidence"),
        F.current_timestamp().alias("observed_at_utc"),
    )


def write_records(records: DataFrame, path: str, checkpoint: str | None = None):
    """Appends a batch, or starts a stream (available data, then stop) for a streaming frame."""
    if not records.isStreaming:
        records.write.mode("append").partitionBy("run_id").json(path)
        return None
    return records.writeStream.format("json").partitionBy("run_id").option("checkpointLocation", checkpoint).option("path", path).outputMode("append").trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, ts: str, key: str, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events of each key in windows; late data is taken up to the watermark."""
    x = events.withWatermark(ts, late) if events.isStreaming else events
    return x.groupBy(F.window(ts, width), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), key, "n")
