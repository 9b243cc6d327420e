"""Lake directory end to end, and stored against derived star tables."""

import datetime as dt

import pytest
from compare import canonical
from pyspark.sql import functions as F

from tidewater.operators import quality, storage
from tidewater.plans import derived as derived_plans
from tidewater.plans import joins, measures, pipeline, planning
from tidewater.schemas import INVENTORY, SALES
from tidewater.session import finish, scratch_path
from tidewater.sources.events import EventLake
from tidewater.sources.star import DerivedStar, StarTables, materialize
from tidewater.streaming import jobs


COLUMNS = ["key", "value", "topic", "partition", "offset", "timestamp"]


@pytest.fixture(scope="module")
def lake(spark, small):
    root = scratch_path(spark, "lake")
    source = EventLake(spark, small)
    for topic in (SALES, INVENTORY):
        source.messages(topic).select(*COLUMNS).repartition(6).write.parquet(f"{root}/in/{topic}")
        ingest(spark, root, topic)
    return root, source


def ingest(spark, root, topic):
    messages = jobs.file_source(spark, f"{root}/in/{topic}", max_files=2)
    jobs.bronze_ingest(messages, f"{root}/{topic}/raw_events", f"{root}/chk/in_{topic}", f"in_{topic}", once=True).awaitTermination()


def validate(spark, root, topic):
    q = jobs.silver_validate(
        jobs.bronze_source(spark, f"{root}/{topic}/raw_events", max_files=4), topic, f"{root}/{topic}/structured_events",
        f"{root}/{topic}/dlq_events", f"{root}/chk/{topic}", f"silver_{topic}", once=True,
    )
    q.awaitTermination()


def same(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    assert canonical([tuple(r) for r in a.collect()], a.columns) == canonical([tuple(r) for r in b.collect()], b.columns)


def test_marts_from_bronze_then_silver_then_lookback(spark, lake):
    root, source = lake
    assert pipeline.refresh_marts(spark, root) == {SALES: "ok", INVENTORY: "ok"}
    first = pipeline.audit(spark, root).collect()
    assert all(r.total_rows > 0 for r in first)

    for topic in (SALES, INVENTORY):
        validate(spark, root, topic)
    pipeline.refresh_marts(spark, root)
    from tidewater.operators import marts

    want = marts.sales_daily_summary(source.silver_sales())
    got = spark.read.parquet(f"{root}/{pipeline.SALES_MART}")
    # Keys of rejected rows stay from the first load, as in any keyed upsert.
    same(got.join(want.select("event_date", "product_id"), ["event_date", "product_id"], "left_semi").select(*want.columns), want)

    before = got.agg(F.count("*")).first()[0]
    pipeline.refresh_marts(spark, root, lookback_days=3)
    assert spark.read.parquet(f"{root}/{pipeline.SALES_MART}").count() == before
    same(spark.read.parquet(f"{root}/{pipeline.SALES_MART}").join(want.select("event_date", "product_id"), ["event_date", "product_id"], "left_semi").select(*want.columns), want)

    tables = [f"{root}/{t}/{n}" for t in (SALES, INVENTORY) for n in ("raw_events", "structured_events", "dlq_events")]
    rows = [storage.read_fed(spark, t).count() for t in tables]
    report = pipeline.maintain_lake(spark, root, checkpoints={t: f"{root}/chk/{t}" for t in (SALES, INVENTORY)})
    assert len(report) == 8 and all(v.startswith("ok") for v in report.values()), report
    assert [storage.read_fed(spark, t).count() for t in tables] == rows
    # The streams go on after maintenance and see nothing twice.
    for topic in (SALES, INVENTORY):
        ingest(spark, root, topic)
        validate(spark, root, topic)
    assert [storage.read_fed(spark, t).count() for t in tables] == rows


def follow(spark, path, out, batches=None):
    """A stream behind a stream-fed table, which archives what it has read."""
    source = jobs.file_source(spark, path, "id long", max_files=1, archive=f"{storage.closed_dir(path)}/open")
    writer = source.writeStream.option("checkpointLocation", f"{out}-chk").foreachBatch(lambda df, i: storage.write_batch(df, out, i) and None)
    return writer.trigger(availableNow=True).start()


def ids(spark, path):
    return sorted(r.id for r in storage.read_fed(spark, path, "id long").collect())


def test_maintenance_leaves_a_lagging_stream_its_rows(spark):
    path, out = scratch_path(spark, "fed"), scratch_path(spark, "lag")
    for i in range(4):
        storage.write_batch(spark.range(i * 10, i * 10 + 10).coalesce(1), path, i)
    storage.maintain(spark, {path: None})
    follow(spark, path, out).awaitTermination()
    for i in range(4, 7):  # files that were read go to the closed ones, new ones arrive
        storage.write_batch(spark.range(i * 10, i * 10 + 10).coalesce(1), path, i)
    follow(spark, path, out).awaitTermination()
    report = storage.maintain(spark, {path: None, out: None}, followed={out: f"{out}-chk"})
    assert "files_before 6" in report[out] or "files_before 5" in report[out], report
    assert int(report[path].split("files_before ")[1].split(",")[0]) >= 4 and "files_after 1" in report[path], report
    storage.write_batch(spark.range(70, 80).coalesce(1), path, 7)
    follow(spark, path, out).awaitTermination()
    assert ids(spark, path) == ids(spark, out) == list(range(80))
    storage.maintain(spark, {path: None, out: None}, followed={out: f"{out}-chk"})
    assert ids(spark, path) == ids(spark, out) == list(range(80))


@pytest.mark.parametrize("stop", ["before the result", "behind the result"])
def test_compaction_that_stops_is_taken_up_again(spark, monkeypatch, stop):
    path = scratch_path(spark, "fed")
    for i in range(5):
        storage.write_batch(spark.range(i * 10, i * 10 + 10).coalesce(1), path, i)
    storage.close_batches(spark, path, 4)

    def broken(*args):
        raise RuntimeError("executor lost")

    with monkeypatch.context() as m:
        m.setattr(storage, "_rewrite" if stop == "before the result" else "_drop", broken)
        with pytest.raises(RuntimeError):
            storage.compact_closed(spark, path)
    assert ids(spark, path) == list(range(50))
    storage.compact_closed(spark, path)
    assert ids(spark, path) == list(range(50)) and [n[:6] for n in storage._children(spark, storage.closed_dir(path))] == ["merged"]


def test_current_stock_is_one_number(stars):
    """All positions stand on the last day, and enterprise = warehouses = categories."""
    for star in stars:
        snap = star.table("FactInventorySnapshot", "SnapshotDate", "ProductKey", "WarehouseKey", "CategoryName", "OnHandQuantity")
        last = snap.where(F.col("SnapshotDate") == star.last_event_day())
        assert last.count() == snap.select("ProductKey", "WarehouseKey").distinct().count()
        total = last.agg(F.sum("OnHandQuantity")).first()[0]
        for by in ("WarehouseKey", "CategoryName"):
            assert measures.stock_by(star, [by], "OnHandQuantity").agg(F.sum("OnHandQuantity")).first()[0] == total
        assert star.position("OnHandQuantity").agg(F.sum("OnHandQuantity")).first()[0] == total


def test_planner_lists_hold_stock_without_sales_and_sales_without_stock(stars):
    star = stars[0]
    below = {tuple(r) for r in planning.below_rop(star).select("ProductKey", "WarehouseKey").collect()}
    stocked = {tuple(r) for r in star.position().select("ProductKey", "WarehouseKey").collect()}
    sold = {tuple(r) for r in planning.policies(star).select("ProductKey", "WarehouseKey").collect()}
    assert below - stocked and stocked - sold
    inbound = {(r.ProductKey, r.WarehouseKey): r.InTransitInboundQuantity for r in star.open_inbound().collect()}
    queues = {r.queue: r for r in planning.planner_queues(star).collect()}
    empty = {tuple(r) for r in star.position("OnHandQuantity").where("OnHandQuantity = 0").select("ProductKey", "WarehouseKey").collect()}
    urgent = [k for k in inbound if k not in stocked or k in empty]
    assert queues[planning.EXPEDITE].positions == len(urgent) and queues[planning.EXPEDITE].inbound_units == sum(inbound[k] for k in urgent)
    assert sum(r.positions for q, r in queues.items() if q != planning.REBALANCE) == len(stocked | sold | set(inbound))
    moves = planning.rebalance_candidates(star).collect()
    ends = {(m.ProductKey, w) for m in moves for w in (m.origin, m.destination)}
    assert queues[planning.REBALANCE].positions == len(ends) and {(m.ProductKey, m.destination) for m in moves} - stocked


@pytest.mark.parametrize("plan", [planning.reorder_point, measures.storage_utilization, measures.service_levels, measures.inventory_position, derived_plans.stockout_episodes])
def test_no_rows_per_day_outside_the_snapshot(stars, plan):
    text = plan(stars[0])._jdf.queryExecution().optimizedPlan().toString()
    assert "SnapshotDate" not in text and "sequence(" not in text


def test_a_stored_snapshot_without_intervals_serves_as_well(stars, spark):
    older = StarTables(spark, stars[1].path)
    plain, table = older.table, older._days_as_intervals()
    older.table = lambda name, *c: (table.select(*c) if c else table) if name == "FactStockInterval" else plain(name, *c)
    for plan in (measures.inventory_turns, measures.inventory_position, measures.inventory_aging, planning.reorder_point):
        same(finish(plan(older)), finish(plan(stars[0])))


def test_upsert_keeps_rows_without_a_partition_value(spark):
    path = scratch_path(spark, "nulls")
    schema = "day date, k string, v int"
    day = dt.date(2024, 1, 1)
    storage.upsert(spark, path, spark.createDataFrame([(None, "a", 1), (None, "b", 1), (day, "a", 1), (None, None, 1)], schema), ["day", "k"], "day")
    storage.upsert(spark, path, spark.createDataFrame([(None, "c", 2), (None, "b", 2), (None, None, 2)], schema), ["day", "k"], "day")
    rows = sorted(map(tuple, spark.read.parquet(path).select("k", "v", "day").collect()), key=str)
    assert rows == sorted([("a", 1, None), ("b", 2, None), ("c", 2, None), (None, 2, None), ("a", 1, day)], key=str)
    storage.upsert(spark, path, spark.createDataFrame([], schema), ["day", "k"], "day")
    storage.upsert(spark, path, spark.createDataFrame([(day, "z", 3)], schema), ["day", "k"], "day")
    assert spark.read.parquet(path).count() == 6


def test_writers_of_the_marts_wait_for_each_other(spark):
    root = scratch_path(spark, "locked")
    with storage.exclusive(spark, root):
        with pytest.raises(TimeoutError):
            with storage.exclusive(spark, root, wait_s=0.5):
                pass
    with pytest.raises(ValueError):
        with storage.exclusive(spark, root, wait_s=0.5):
            raise ValueError("the holder fails")
    with storage.exclusive(spark, root, wait_s=0.5):
        with storage.exclusive(spark, root, wait_s=0.5, stale_s=-1):  # the first one counts as dead
            pass


def test_no_source_is_skipped(spark):
    report = pipeline.refresh_marts(spark, scratch_path(spark, "nothing"))
    assert all(v.startswith("skipped") for v in report.values())


STORED = [
    "DimProduct", "DimWarehouse", "DimSupplier", "DimCustomerChannel", "DimRegion", "FactSales", "FactPurchaseOrder",
    "FactDemandForecast", "FactInventoryMovement", "FactInventorySnapshot", "FactStockInterval", "FactStockout",
]


@pytest.fixture(scope="module")
def stars(spark, small):
    derived = DerivedStar(spark, small)
    return derived, materialize(derived, scratch_path(spark, "star"), STORED)


@pytest.mark.parametrize(
    "plan", [joins.star_join, measures.procurement_kpis, measures.inventory_aging, measures.forecast_accuracy, measures.sales_kpis, planning.safety_stock, measures.service_levels],
)
def test_stored_star_gives_the_derived_answers(stars, plan):
    derived, stored = stars
    same(finish(plan(stored)), finish(plan(derived)))


def test_stored_fact_prunes_months(spark, stars):
    df = spark.read.parquet(f"{stars[1].path}/FactSales").where("_month = '1997-03'")
    assert "PartitionFilters: [isnotnull(_month" in df._jdf.queryExecution().executedPlan().toString()


def test_gates_stop_at_the_first_failure(spark):
    good = quality.rules("a", "t", spark.range(3).toDF("x"), {"negative": F.col("x") < 0})
    bad = quality.rules("b", "t", spark.range(3).toDF("x"), {"positive": F.col("x") > 0})
    ran = []

    def gate(name, checks):
        def run():
            ran.append(name)
            return checks
        return name, run

    assert quality.first_failed_gate([gate("keys", good), gate("rules", bad), gate("later", good)]) == "rules"
    assert ran == ["keys", "rules"]
    assert quality.first_failed_gate([gate("keys", good)]) is None
