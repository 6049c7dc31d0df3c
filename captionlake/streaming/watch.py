"""The polling loop as Structured Streaming (T01, T03, T09): status events in, state and throughput out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from captionlake.config import WatchParams
from captionlake.sources.tables import VersionedTable


def event_stream(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int = 100) -> DataFrame:
    """New Parquet files of status events below ``path``."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def windowed_counts(events: DataFrame, width: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Events by time window and status; late ones beyond the watermark are left out."""
    rows = events.withWatermark("ts", late).groupBy(F.window("ts", width), "status").agg(F.count("*").alias("n"))
    return rows.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), "status", "n")


def idle_files(events: DataFrame, params: WatchParams = WatchParams(), late: str = "10 minutes") -> DataFrame:
    """Sessions of files' events; a session ends after the timeout without one, which is when a file counts as stuck."""
    gap = f"{params.stuck_sec} seconds"
    rows = events.withWatermark("ts", late).groupBy(F.session_window("ts", gap), "file_id").agg(F.max_by("status", "ts").alias("status"), F.count("*").alias("n"))
    return rows.select("file_id", F.col("session_window.end").alias("idle_since"), "status", "n")


def upsert_stream(stream: DataFrame, table: VersionedTable, key: str, checkpoint: str, params: WatchParams = WatchParams(), once: bool = False, order: list[str] | None = None) -> StreamingQuery:
    """Keep the last row of each key, by ``order`` (``ts`` alone if none is given), in a versioned table.

    A batch that runs again, after it was lost at any moment, changes nothing more (T09): it upserts the same rows.
    """

    def put(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            last = batch.groupBy(key).agg(F.max_by(F.struct(*batch.columns), F.struct(*(order or ["ts"]))).alias("r")).select("r.*")
            table.upsert(last, key)

    writer = stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=f"{params.poll_sec} seconds")).start()
