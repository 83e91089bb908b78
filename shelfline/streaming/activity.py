"""Incremental ingest of landed activity documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shelfline.sources.landed import activity_events


def read_documents(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json",
                   *, max_files: int | None = None, **options: str) -> DataFrame:
    """New files below ``path`` as a stream of documents."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def event_stream(documents: DataFrame, *, dedupe_within: str | None = None) -> DataFrame:
    """Declared event columns; works on a stream and on a batch of documents.

    ``dedupe_within`` (off by default, the daily pull keeps repeats) drops an Id
    seen again within that delay; the watermark bounds the state kept for it.
    """
    events = activity_events(documents)
    if dedupe_within is None:
        return events
    timed = events.withColumn("event_time", F.try_to_timestamp("CreationTime"))
    return timed.withWatermark("event_time", dedupe_within).dropDuplicatesWithinWatermark(["Id"])


def activity_ingest(documents: DataFrame, target: str, checkpoint: str,
                    *, dedupe_within: str | None = None) -> StreamingQuery:
    """Append all new events to ``target`` and stop; a restart reads only new files."""
    return (
        event_stream(documents, dedupe_within=dedupe_within)
        .writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint).option("path", target)
        .trigger(availableNow=True).start()
    )
