"""Micro-batch behaviour: empty and repeated batches, restart, failure."""

import datetime as dt

import pytest
from pyspark.errors import StreamingQueryException

from tidewater.plans import streams
from tidewater.plans.registry import all_queries
from tidewater.schemas import BRONZE, INVENTORY, SALES
from tidewater.session import scratch_path
from tidewater.sources.events import EventLake
from tidewater.sources.star import DerivedStar
from tidewater.streaming import jobs, progress

T0 = dt.datetime(2024, 1, 5)


def bronze_rows(spark, payloads):
    return spark.createDataFrame([("k", p, SALES, 0, i, T0, T0) for i, p in enumerate(payloads)], BRONZE)


GOOD = '{"event_id": "e", "timestamp": 1.5, "product_id": "p", "customer_id": "c", "revenue": 2.0, "units_sold": 1}'


def test_empty_batch_writes_nothing(spark):
    silver, dlq = scratch_path(spark, "s"), scratch_path(spark, "d")
    jobs.route_batch(bronze_rows(spark, []), 0, SALES, silver, dlq)
    from tidewater.operators.storage import exists

    assert not exists(spark, silver) and not exists(spark, dlq)


def test_clean_batch_leaves_no_quarantine(spark):
    silver, dlq = scratch_path(spark, "s"), scratch_path(spark, "d")
    jobs.route_batch(bronze_rows(spark, [GOOD]), 0, SALES, silver, dlq)
    from tidewater.operators.storage import exists

    assert spark.read.parquet(silver).count() == 1 and not exists(spark, dlq)


def test_repeated_batch_leaves_one_copy(spark):
    silver, dlq = scratch_path(spark, "s"), scratch_path(spark, "d")
    for _ in range(2):
        jobs.route_batch(bronze_rows(spark, [GOOD, "{", GOOD]), 7, SALES, silver, dlq)
    assert spark.read.parquet(silver).count() == 2
    assert spark.read.parquet(dlq).count() == 1


def test_silver_and_quarantine_add_up(spark, small):
    lake = EventLake(spark, small)
    for topic in (SALES, INVENTORY):
        total = lake.bronze(topic).count()
        assert lake.silver(topic).count() + lake.quarantine(topic).count() == total


def test_a_failed_stream_stops_the_others(spark, small):
    base = scratch_path(spark, "f")
    lake = EventLake(spark, small)
    columns = ["key", "value", "topic", "partition", "offset", "timestamp"]
    lake.messages(SALES).select(*columns).write.parquet(f"{base}/in")
    healthy = jobs.bronze_ingest(jobs.file_source(spark, f"{base}/in"), f"{base}/out", f"{base}/c1", "healthy")

    def broken(batch, batch_id):
        raise ValueError("broken on purpose")

    failing = (
        jobs.file_source(spark, f"{base}/in").writeStream.queryName("failing")
        .option("checkpointLocation", f"{base}/c2").foreachBatch(broken).start()
    )
    with pytest.raises(StreamingQueryException):
        jobs.run_together([healthy, failing])
    assert not healthy.isActive


def test_progress_rows_add_up(spark, small):
    base = scratch_path(spark, "p")
    lake = EventLake(spark, small)
    columns = ["key", "value", "topic", "partition", "offset", "timestamp"]
    lake.messages(SALES).select(*columns).repartition(3).write.parquet(f"{base}/in")
    q = jobs.bronze_ingest(jobs.file_source(spark, f"{base}/in", max_files=1), f"{base}/out", f"{base}/c", "metered", once=True)
    q.awaitTermination()
    rows = progress.progress_rows(spark, [q])
    metrics = progress.stream_metrics(rows).first()
    assert metrics.input_rows == lake.bronze(SALES).count() and metrics.batches == 3
    assert progress.backpressure(rows, 10, 10**9).first().over_cap == 3


def test_recorded_progress_outlives_the_bounded_list(spark, small):
    base = scratch_path(spark, "r")
    lake = EventLake(spark, small)
    columns = ["key", "value", "topic", "partition", "offset", "timestamp"]
    lake.messages(SALES).select(*columns).repartition(5).write.parquet(f"{base}/in")
    key = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(key)
    spark.conf.set(key, "2")
    try:
        with progress.recorded(spark) as recorder:
            q = jobs.bronze_ingest(jobs.file_source(spark, f"{base}/in", max_files=1), f"{base}/out", f"{base}/c", "long", once=True)
            q.awaitTermination()
            rows = recorder.rows([q])
        assert len(q.recentProgress) < 5
    finally:
        spark.conf.set(key, before)
    metrics = progress.stream_metrics(rows).first()
    assert metrics.batches == 5 and metrics.input_rows == lake.bronze(SALES).count()


def test_progress_queries_cover_both_topics(spark, small):
    lake = EventLake(spark, small)
    totals = {t: lake.bronze(t).count() for t in (SALES, INVENTORY)}
    metrics = {r.query_name: r.input_rows for r in all_queries()["stream_metrics"](spark, small).collect()}
    assert metrics == {f"{kind}_{t}": n for t, n in totals.items() for kind in ("bronze", "silver")}
    pressed = {r.query_name: r for r in all_queries()["stream_backpressure"](spark, small).collect()}
    assert set(pressed) == {f"bronze_{t}" for t in totals} and all(r.over_cap == 0 and 0 < r.largest_batch <= totals[n[7:]] for n, r in pressed.items())
    tight = streams.stream_backpressure(DerivedStar(spark, small), cap=1).collect()
    assert all(r.over_cap > 0 for r in tight)


@pytest.mark.parametrize("lost", ["the commit", "the batch"])
def test_a_batch_killed_between_write_and_commit_runs_again_without_a_second_copy(spark, small, lost):
    """The silver stream reads bronze while the bronze batch is published but not committed."""
    base, whole = scratch_path(spark, "k"), scratch_path(spark, "w")
    lake = EventLake(spark, small)
    columns = ["key", "value", "topic", "partition", "offset", "timestamp"]
    lake.messages(SALES).select(*columns).repartition(4).write.parquet(f"{base}/in")

    def ingest(root, fail_at=None):
        source = jobs.file_source(spark, f"{base}/in", max_files=1)

        def append(batch, batch_id):
            if batch_id == fail_at and lost == "the batch":
                jobs.storage._writer(jobs.parsing.bronze_envelope(batch), "overwrite", []).parquet(f"{root}/bronze/_staged-{batch_id}-x")
                raise RuntimeError("killed while writing")
            jobs.storage.write_batch(jobs.parsing.bronze_envelope(batch), f"{root}/bronze", batch_id)
            if batch_id == fail_at:
                raise RuntimeError("killed before the commit")

        return source.writeStream.option("checkpointLocation", f"{root}/c").foreachBatch(append).trigger(availableNow=True).start()

    def silver(root):
        source = jobs.bronze_source(spark, f"{root}/bronze", max_files=2)
        jobs.silver_validate(source, SALES, f"{root}/silver", f"{root}/dlq", f"{root}/s", "silver", once=True).awaitTermination()

    with pytest.raises(StreamingQueryException):
        ingest(base, fail_at=2).awaitTermination()
    silver(base)
    ingest(base).awaitTermination()
    silver(base)
    ingest(whole).awaitTermination()
    silver(whole)
    for table in ("bronze", "silver", "dlq"):
        a, b = (jobs.storage.read_fed(spark, f"{root}/{table}").drop("ingested_at", "transformed_at", "quarantined_at") for root in (base, whole))
        assert a.count() == b.count() and a.exceptAll(b).isEmpty(), table


def test_batches_stay_below_the_bytes_bound(spark, small):
    base = scratch_path(spark, "b")
    lake = EventLake(spark, small)
    columns = ["key", "value", "topic", "partition", "offset", "timestamp"]
    lake.messages(SALES).select(*columns).repartition(8).write.parquet(f"{base}/in")
    files = spark.read.parquet(f"{base}/in").select("_metadata.file_path", "_metadata.file_size").distinct().collect()
    bound = 3 * max(f.file_size for f in files)
    with progress.recorded(spark) as recorder:
        q = jobs.bronze_ingest(jobs.file_source(spark, f"{base}/in", max_bytes=bound), f"{base}/out", f"{base}/c", "bounded", once=True)
        q.awaitTermination()
        rows = [r.input_rows for r in recorder.rows([q]).where("input_rows > 0").collect()]
    assert len(rows) >= 3 and sum(rows) == lake.bronze(SALES).count()
    sizes = {}
    for f in spark.read.parquet(f"{base}/in").groupBy("_metadata.file_path", "_metadata.file_size").count().collect():
        sizes[f["count"]] = f.file_size
    assert max(rows) <= max(sizes) * 3 + max(sizes)
