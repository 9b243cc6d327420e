"""Bronze to silver: envelope, JSON parsing, error rules, quarantine split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import EVENT_SCHEMAS, SALES

ENVELOPE = ["kafka_key", "raw_payload", "topic", "partition", "offset", "kafka_timestamp", "ingested_at"]


def bronze_envelope(messages: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Readable key and payload with broker coordinates and the ingest time."""
    return messages.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("value").cast("string").alias("raw_payload"),
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("kafka_timestamp"),
        (F.current_timestamp() if ingested_at is None else ingested_at).alias("ingested_at"),
    )


def _once(parsed: Column) -> Column:
    """Parse in one place: as a generated row the result is computed once, while
    a plain projection is repeated for every field a later filter mentions."""
    return F.explode(F.array(parsed))


def parse_permissive(bronze: DataFrame, topic: str) -> DataFrame:
    """Envelope plus ``data``; unreadable text lands in ``data._corrupt_record``."""
    schema = EVENT_SCHEMAS[topic] + ", _corrupt_record string"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    return bronze.select(*ENVELOPE, _once(F.from_json("raw_payload", schema, options)).alias("data"))


def parse_flat(bronze: DataFrame, topic: str) -> DataFrame:
    """Event fields only, for jobs that read bronze directly."""
    return bronze.select(_once(F.from_json("raw_payload", EVENT_SCHEMAS[topic])).alias("d")).select("d.*")


def error_reason(topic: str) -> Column:
    """Ordered rules; the first that applies names the defect."""
    d = lambda name: F.col(f"data.{name}")
    rules = [
        (d("_corrupt_record").isNotNull(), "MALFORMED_JSON"),
        (d("event_id").isNull(), "MISSING_EVENT_ID"),
        (d("product_id").isNull(), "MISSING_PRODUCT_ID"),
    ]
    if topic == SALES:
        rules.append((d("revenue").isNull() | (d("revenue") < 0), "INVALID_REVENUE"))
    else:
        rules.append((d("warehouse_id").isNull(), "MISSING_WAREHOUSE_ID"))
    # A chain built from the last rule outwards keeps the order of the list.
    reason = F.lit(None).cast("string")
    for cond, label in reversed(rules):
        reason = F.when(cond, F.lit(label)).otherwise(reason)
    return reason


def classify(parsed: DataFrame, topic: str) -> DataFrame:
    return parsed.withColumn("error_reason", error_reason(topic))


def valid_rows(classified: DataFrame, topic: str) -> DataFrame:
    """Silver rows: typed fields, epoch seconds as a timestamp, ingest time."""
    names = [f.split()[0] for f in EVENT_SCHEMAS[topic].split(", ")]
    fields = [
        F.col("data.timestamp").cast("timestamp").alias("timestamp") if n == "timestamp" else F.col(f"data.{n}").alias(n)
        for n in names
    ]
    return classified.where(F.col("error_reason").isNull()).select(*fields, "ingested_at")


def quarantined_rows(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("error_reason").isNotNull()).select(
        "kafka_key", "raw_payload", "error_reason", "topic", "partition", "offset", "kafka_timestamp", "ingested_at"
    )


def payload_preview(payload, width: int = 75) -> Column:
    """Leading characters for display; the stored payload stays whole."""
    p = F.coalesce(F.col(payload), F.lit(""))
    return F.when(F.length(p) > width, F.concat(F.substring(p, 1, width), F.lit("..."))).otherwise(p)
