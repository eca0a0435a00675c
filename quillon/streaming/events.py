"""Extensions for event streams; the batch engine has no counterpart.

Late rows are dropped behind the watermark, so state stays bounded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_counts(events: DataFrame, window: str = "1 hour", slide: str | None = None, late: str = "2 hours", by: str = "event_type") -> DataFrame:
    """Counts and sums per window and ``by``, over a stream or a table."""
    rows = events.withColumn("ts", F.col("ts").cast("timestamp"))
    if rows.isStreaming:
        rows = rows.withWatermark("ts", late)
    w = F.window("ts", window, slide) if slide else F.window("ts", window)
    return rows.groupBy(w.alias("w"), by).agg(F.count("*").alias("counts"), F.sum("value").alias("total")).select(F.col("w.start").alias("window_start"), by, "counts", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "2 hours", by: str = "user_id") -> DataFrame:
    """Sessions of a user: start, end and number of events."""
    rows = events.withColumn("ts", F.col("ts").cast("timestamp"))
    if rows.isStreaming:
        rows = rows.withWatermark("ts", late)
    return rows.groupBy(F.session_window("ts", gap).alias("w"), by).agg(F.count("*").alias("counts")).select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), by, "counts")


def write_batches(stream: DataFrame, path: str, checkpoint: str, max_rows: int = 50_000, once: bool = False):
    """Append a stream to Parquet in files of bounded size; ``once`` ends it with what is there now."""
    def save(batch: DataFrame, _: int) -> None:
        batch.write.mode("append").option("maxRecordsPerFile", max_rows).parquet(path)

    writer = stream.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
