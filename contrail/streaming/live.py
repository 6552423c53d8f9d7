"""Live position reports: watermark, duplicates within it, sessions, and a sink with a batch ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def state_vectors(raw: DataFrame, dedup: bool = True, late: str = "10 minutes") -> DataFrame:
    """Reports with event_time (position time, else last contact), late and repeated ones dropped."""
    rows = raw.withColumn("event_time", F.timestamp_seconds(F.coalesce("time_position", "last_contact"))).where("event_time is not null")
    rows = rows.withWatermark("event_time", late)
    return rows.dropDuplicatesWithinWatermark(["icao24", "event_time"]) if dedup else rows


def sessions(rows: DataFrame, key: str = "aircraft", time: str = "ts", gap: str = "60 minutes", late: str = "10 minutes") -> DataFrame:
    """(key, start, end, n): sessions that end after `gap` without a report; within a day, as in batch."""
    rows = rows.withColumn("_t", F.col(time).cast("timestamp")).withColumn("day", F.to_date("_t"))
    rows = rows.withWatermark("_t", late) if rows.isStreaming else rows
    g = rows.groupBy(key, "day", F.session_window("_t", gap)).agg(F.count("*").alias("n"), F.max("_t").alias("last_seen"))
    return g.select(key, "day", F.col("session_window.start").alias("start_ts"), F.col("last_seen").alias("end_ts"), "n")


def tumbling(rows: DataFrame, time: str, width: str, late: str = "10 minutes") -> DataFrame:
    """Counts by fixed windows and kind."""
    rows = rows.withColumn("_t", F.col(time).cast("timestamp"))
    rows = rows.withWatermark("_t", late) if rows.isStreaming else rows
    g = rows.groupBy(F.window("_t", width), "kind").agg(F.count("*").alias("n"))
    return g.select(F.col("window.start").alias("start_ts"), "kind", "n")


def ledgered(path: str, ledger: str):
    """A foreachBatch sink: appends each batch once, by its number, and notes it in the ledger.

    A batch that is run again after a failure finds its own folder and replaces it.
    """

    def write(df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/batch={batch}")
        done = df.sparkSession.createDataFrame([(batch, df.count(), "completed")], "batch long, rows long, status string")
        done.write.mode("overwrite").parquet(f"{ledger}/batch={batch}")

    return write
