"""Stream progress as data: rates, batch times and the backpressure check."""

from __future__ import annotations

import json
import threading
import time
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..operators.storage import write_text
from ..session import scratch_path

SCHEMA = (
    "query_name string, batch_id bigint, input_rows bigint, input_rows_per_second double, "
    "processed_rows_per_second double, batch_ms bigint"
)
NAMES = [c.split()[0] for c in SCHEMA.split(", ")]
ENDED_WAIT_S = 120


def _row(p: dict) -> tuple:
    return p["name"], p["batchId"], p["numInputRows"], p.get("inputRowsPerSecond"), p.get("processedRowsPerSecond"), p["batchDuration"]


def progress_rows(spark: SparkSession, queries: list[StreamingQuery]) -> DataFrame:
    """The recent progress reports only: Spark keeps a bounded number per query, so sums
    over a longer run need a ``Recorder``."""
    return spark.createDataFrame([_row(json.loads(r.json)) for q in queries for r in q.recentProgress], SCHEMA)


class Recorder(StreamingQueryListener):
    """Appends each progress report to a table in the shared folder as it arrives, one file
    for each report, so neither Spark's bounded list nor the driver's memory limits it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.ended: set[str] = set()
        self.failed: Exception | None = None
        self.changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        try:
            p = json.loads(event.progress.json)
            line = json.dumps({"run_id": p["runId"], **dict(zip(NAMES, _row(p)))})
            # a run may report a batch more than once: the report's own time tells them apart
            write_text(self.spark, f"{self.path}/{p['runId']}-{p['batchId']}-{p['timestamp'].replace(':', '')}.json", line)
        except Exception as e:  # Spark only logs what a listener raises
            self.failed = e

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self.changed:
            self.ended.add(str(event.runId))
            self.changed.notify_all()

    def rows(self, queries: list[StreamingQuery]) -> DataFrame:
        """All reports of ``queries``, which have ended. A run's end is told after its reports."""
        runs = {str(q.runId) for q in queries}
        deadline = time.monotonic() + ENDED_WAIT_S
        with self.changed:
            while not runs <= self.ended:
                if not self.changed.wait(deadline - time.monotonic()):
                    raise TimeoutError("progress reports of a stream are missing: its end was not reported")
        if self.failed:
            raise self.failed
        return self.spark.read.schema(f"run_id string, {SCHEMA}").json(self.path).where(F.col("run_id").isin(*runs)).drop("run_id")


@contextmanager
def recorded(spark: SparkSession) -> Iterator[Recorder]:
    """A ``Recorder`` of the streams that run inside the block."""
    recorder = Recorder(spark, scratch_path(spark, "progress"))
    spark.streams.addListener(recorder)
    try:
        yield recorder
    finally:
        spark.streams.removeListener(recorder)


def stream_metrics(progress: DataFrame) -> DataFrame:
    with_rows = F.col("input_rows") > 0
    return progress.groupBy("query_name").agg(
        F.count_if(with_rows).alias("batches"),
        F.sum("input_rows").alias("input_rows"),
        F.avg("input_rows_per_second").alias("avg_input_rows_per_second"),
        F.avg("processed_rows_per_second").alias("avg_processed_rows_per_second"),
        F.avg(F.when(with_rows, F.col("batch_ms"))).alias("mean_batch_ms"),
    )


def backpressure(progress: DataFrame, cap: int, trigger_ms: int) -> DataFrame:
    """Batches over the row cap or slower than the trigger interval."""
    return progress.groupBy("query_name").agg(
        F.count("*").alias("batches"),
        F.max("input_rows").alias("largest_batch"),
        F.count_if(F.col("input_rows") > cap).alias("over_cap"),
        F.count_if(F.col("batch_ms") > trigger_ms).alias("over_trigger"),
    )
