"""The two streams and how they run together.

Neither stream keeps operator state: late and repeated events are settled by the
batch marts, which keep the latest row per event and upsert whole dates.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from ..operators import parsing, storage
from ..schemas import BRONZE, MESSAGE

# Trigger intervals.
BRONZE_TRIGGER, SILVER_TRIGGER = "5 seconds", "10 seconds"


def kafka_source(spark: SparkSession, servers: str, topic: str, max_rows: int | None = None) -> DataFrame:
    """Broker source; needs the Kafka package on the class path. It begins with what the
    broker still holds and fails rather than skip lost offsets; ``max_rows`` bounds a
    micro-batch where memory asks for it, and must exceed what arrives between triggers."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("failOnDataLoss", "true")
    )
    if max_rows:
        reader = reader.option("maxOffsetsPerTrigger", str(max_rows))
    return reader.load()


def file_source(
    spark: SparkSession, path: str, schema: str = MESSAGE, max_files: int | None = None, max_bytes: int | None = None, archive: str | None = None
) -> DataFrame:
    """Files as a stream. ``max_files`` or ``max_bytes`` bounds a micro-batch; a file larger than
    ``max_bytes`` is a batch of its own. With ``archive`` files are moved there once a later batch
    is planned behind them, so nothing there is read again."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes))
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.parquet(path)


def bronze_source(spark: SparkSession, path: str, max_files: int | None = None, max_bytes: int | None = None) -> DataFrame:
    """A bronze table read as a stream; what has been read becomes part of its closed files."""
    return file_source(spark, path, BRONZE, max_files, max_bytes, f"{storage.closed_dir(path)}/open")


def _start(writer: DataStreamWriter, interval: str, once: bool) -> StreamingQuery:
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)
    return writer.start()


def bronze_ingest(messages: DataFrame, path: str, checkpoint: str, name: str, once: bool = False, few_files: bool = False) -> StreamingQuery:
    """Append every message with its coordinates and the ingest time. Many tasks read a
    batch and write it, or with ``few_files`` as few as fill files, for a stream that takes them one at a time."""

    def append(batch: DataFrame, batch_id: int) -> None:
        storage.write_batch(parsing.bronze_envelope(batch).hint("rebalance", "partition", "offset"), path, batch_id, few_files)

    writer = messages.writeStream.queryName(name).option("checkpointLocation", checkpoint).foreachBatch(append)
    return _start(writer, BRONZE_TRIGGER, once)


def route_batch(batch: DataFrame, batch_id: int, topic: str, silver_path: str, dlq_path: str) -> None:
    """Split one micro-batch. Each side is published once under its ``batch_id``, so a batch
    that runs again after a failure leaves no second copy. The batch itself is
    only read through the persisted rows: its progress report counts each row read."""
    classified = parsing.classify(parsing.parse_permissive(batch, topic), topic).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        sides = [
            (parsing.valid_rows(classified, topic).withColumn("transformed_at", F.current_timestamp()), silver_path),
            (parsing.quarantined_rows(classified).withColumn("quarantined_at", F.current_timestamp()), dlq_path),
        ]
        for rows, path in sides:
            if not rows.isEmpty():
                storage.write_batch(rows.hint("rebalance"), path, batch_id)
    finally:
        classified.unpersist()


def silver_validate(
    bronze: DataFrame, topic: str, silver_path: str, dlq_path: str, checkpoint: str, name: str, once: bool = False
) -> StreamingQuery:
    writer = (
        bronze.writeStream.queryName(name)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, batch_id: route_batch(batch, batch_id, topic, silver_path, dlq_path))
    )
    return _start(writer, SILVER_TRIGGER, once)


def run_together(queries: list[StreamingQuery]) -> None:
    """Wait for all; if one fails, stop the others and raise its error."""
    try:
        waiting = list(queries)
        while waiting:
            for q in list(waiting):
                if q.awaitTermination(1):  # raises if the query failed
                    waiting.remove(q)
    finally:
        for q in queries:
            if q.isActive:
                q.stop()
