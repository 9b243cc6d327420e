"""Streaming queries: each drains its input once and returns what the sink holds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import storage
from ..schemas import INVENTORY, SALES
from ..session import scratch_path
from ..sources.star import DerivedStar
from ..streaming import jobs, progress
from .registry import query

TOPICS = (SALES, INVENTORY)
MESSAGE_COLUMNS = ["key", "value", "topic", "partition", "offset", "timestamp"]
FILES_PER_TOPIC = 4
EVENT_BYTES = 2 << 20  # of the event table, for each file that a batch takes


def files_a_batch(star: DerivedStar) -> int:
    """So many that every core has one to write, but one for a small table."""
    wanted = storage.stored_bytes(star.spark, f"{star.sf_dir}/events.parquet") // EVENT_BYTES
    return max(1, min(wanted, star.spark.sparkContext.defaultParallelism))


def publish(star: DerivedStar, topic: str, path: str, condition: str = "true", files: int = FILES_PER_TOPIC) -> None:
    """Stand-in for the broker: the topic's messages as files, each of which many tasks can read."""
    rows = star.lake.messages(topic).where(condition).select(*MESSAGE_COLUMNS)
    rows.repartition(files, "partition", "offset").write.mode("append").options(**storage.ROW_GROUPS).parquet(path)


def ingest(star: DerivedStar, topic: str, base: str, max_files: int | None = None, max_bytes: int | None = None):
    source = jobs.file_source(star.spark, f"{base}/{topic}", max_files=max_files, max_bytes=max_bytes)
    q = jobs.bronze_ingest(source, f"{base}/bronze_{topic}", f"{base}/chk_bronze_{topic}", f"bronze_{topic}", once=True)
    q.awaitTermination()
    return q


def validate(star: DerivedStar, topic: str, base: str, max_files: int | None = None):
    q = jobs.silver_validate(
        jobs.bronze_source(star.spark, f"{base}/bronze_{topic}", max_files), topic, f"{base}/silver_{topic}", f"{base}/dlq_{topic}",
        f"{base}/chk_silver_{topic}", f"silver_{topic}", once=True,
    )
    q.awaitTermination()
    return q


def _flow(star: DerivedStar, topics, silver: bool) -> str:
    base = scratch_path(star.spark, "stream")
    for t in topics:
        publish(star, t, f"{base}/{t}")
        ingest(star, t, base)
        if silver:
            validate(star, t, base)
    return base


@query
def stream_bronze(star: DerivedStar) -> DataFrame:
    base = _flow(star, TOPICS, silver=False)
    bronze = [storage.read_fed(star.spark, f"{base}/bronze_{t}") for t in TOPICS]
    return bronze[0].unionByName(bronze[1]).drop("ingested_at")


def _silver(star: DerivedStar, topic: str) -> DataFrame:
    base = _flow(star, [topic], silver=True)
    return storage.read_fed(star.spark, f"{base}/silver_{topic}").drop("ingested_at", "transformed_at")


@query
def stream_silver(star: DerivedStar) -> DataFrame:
    """The sales topic; the topics' silver columns differ, so each has a query."""
    return _silver(star, SALES)


@query
def stream_silver_inventory(star: DerivedStar) -> DataFrame:
    return _silver(star, INVENTORY)


@query
def stream_dlq(star: DerivedStar) -> DataFrame:
    base = _flow(star, TOPICS, silver=True)
    dlq = [storage.read_fed(star.spark, f"{base}/dlq_{t}") for t in TOPICS]
    return dlq[0].unionByName(dlq[1]).select("kafka_key", "raw_payload", "error_reason", "topic", "partition", "offset", "kafka_timestamp")


def _restart(star: DerivedStar, topic: str) -> DataFrame:
    """Messages arrive in two halves with a stop between them; the second run
    resumes from the checkpoint."""
    base = scratch_path(star.spark, "stream")
    for half in ("partition < 8", "partition >= 8"):
        publish(star, topic, f"{base}/{topic}", half)
        ingest(star, topic, base, max_files=3)
    bronze = storage.read_fed(star.spark, f"{base}/bronze_{topic}")
    per_message = bronze.groupBy("topic", "partition", "offset").agg(F.count("*").alias("copies"))
    return per_message.agg(
        F.sum("copies").alias("rows"), F.count("*").alias("messages"), F.count_if(F.col("copies") > 1).alias("repeated")
    )


@query
def stream_restart(star: DerivedStar) -> DataFrame:
    return _restart(star, SALES)


@query
def stream_restart_inventory(star: DerivedStar) -> DataFrame:
    return _restart(star, INVENTORY)


KINDS = ("bronze", "silver", "dlq")


def maintained(star: DerivedStar, base: str, topics) -> dict[str, str]:
    """Maintenance of the topics' tables that hold files; a table it fails on is an error here."""
    paths = {f"{base}/{kind}_{t}": t for t in topics for kind in KINDS}
    tables = {p: None for p in paths if storage.read_fed(star.spark, p) is not None}
    followed = {p: f"{base}/chk_silver_{t}" for p, t in paths.items() if p != f"{base}/bronze_{t}"}
    report = storage.maintain(star.spark, tables, followed=followed)
    failed = {p: said for p, said in report.items() if not said.startswith("ok")}
    if failed:
        raise RuntimeError(f"maintenance failed: {failed}")
    return report


def _rows(star: DerivedStar, path: str) -> DataFrame:
    """Rows of a stream-fed table as a count; 0 if no batch had any."""
    found = storage.read_fed(star.spark, path)
    return (star.spark.range(0) if found is None else found).agg(F.count("*").alias("rows"))


@query
def stream_compacted(star: DerivedStar) -> DataFrame:
    """Both topics through the streams, in several batches, with maintenance while the silver
    stream lags and again behind it; all six tables hold what they were given."""
    base, each = scratch_path(star.spark, "stream"), files_a_batch(star)
    for t in TOPICS:
        for half in ("partition < 8", "partition >= 8"):
            publish(star, t, f"{base}/{t}", half, files=FILES_PER_TOPIC * each)
            ingest(star, t, base, max_files=each)
            if storage.read_fed(star.spark, f"{base}/silver_{t}") is not None:
                maintained(star, base, [t])  # bronze is a half ahead of the silver stream
            found = len(star.spark.read.parquet(f"{base}/bronze_{t}").inputFiles())
            validate(star, t, base, max_files=-(-found // FILES_PER_TOPIC))
    maintained(star, base, TOPICS)
    counts = [_rows(star, f"{base}/{kind}_{t}").select(F.lit(t).alias("topic"), F.lit(kind).alias("table_name"), "rows") for t in TOPICS for kind in KINDS]
    return reduce(DataFrame.unionByName, counts)


BATCH_BYTES = 8 << 10  # far below the size of a file: each is a batch of its own


@query
def stream_bounded(star: DerivedStar, max_bytes: int = BATCH_BYTES) -> DataFrame:
    """Micro-batches bounded by bytes: rows and batches as the recorder saw them, and whether
    a batch took more files than the bound allows."""
    base = scratch_path(star.spark, "stream")
    with progress.recorded(star.spark) as recorder:
        runs = []
        for t in TOPICS:
            publish(star, t, f"{base}/{t}")
            runs.append(ingest(star, t, base, max_bytes=max_bytes))
        seen = recorder.rows(runs).where("input_rows > 0").groupBy("query_name").agg(F.sum("input_rows").alias("rows"), (F.count("*") > 1).alias("several_batches"))
        return seen.select("query_name", "rows", "several_batches")


@query
def stream_metrics(star: DerivedStar) -> DataFrame:
    base = scratch_path(star.spark, "stream")
    with progress.recorded(star.spark) as recorder:
        runs = []
        for t in TOPICS:
            publish(star, t, f"{base}/{t}")
            runs += [ingest(star, t, base, max_files=2), validate(star, t, base)]
        return progress.stream_metrics(recorder.rows(runs))


@query
def stream_backpressure(star: DerivedStar, cap: int = 50_000, trigger_ms: int = 5000) -> DataFrame:
    """Batches of both topics over ``cap`` rows or slower than the trigger interval."""
    base = scratch_path(star.spark, "stream")
    with progress.recorded(star.spark) as recorder:
        runs = []
        for t in TOPICS:
            publish(star, t, f"{base}/{t}")
            runs.append(ingest(star, t, base, max_files=1))
        return progress.backpressure(recorder.rows(runs), cap, trigger_ms)
