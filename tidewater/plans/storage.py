"""Queries on stored tables: upsert, incremental and as-of reads, maintenance, audits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import keys, marts, storage
from ..operators.running import running_totals
from ..schemas import INVENTORY, SALES
from ..session import scratch_path
from ..sources import landing
from ..sources.star import DerivedStar
from .registry import query

LATE_FROM = "2024-01-18"


def _upserted(star: DerivedStar, mart, first_load: DataFrame, all_rows: DataFrame, keys, partition) -> DataFrame:
    """A first load from early deliveries, then an upsert of the late dates."""
    path = scratch_path(star.spark, "mart")
    storage.create_mart(mart(first_load), path, [partition])
    storage.upsert(star.spark, path, mart(all_rows).where(F.col(partition) >= LATE_FROM), keys, partition)
    return star.spark.read.parquet(path)


def _parsed_once(star: DerivedStar, silver: DataFrame) -> DataFrame:
    """Silver rows as a table, so that the first load and the upsert do not parse twice."""
    path = scratch_path(star.spark, "silver")
    silver.write.parquet(path)
    return star.spark.read.parquet(path)


def _first_deliveries(silver: DataFrame) -> DataFrame:
    return silver.where("ingested_at < TIMESTAMP '2024-01-20 00:00:00'")


@query
def upsert_sales_mart(star: DerivedStar) -> DataFrame:
    silver = _parsed_once(star, star.lake.silver_sales())
    return _upserted(star, marts.sales_daily_summary, _first_deliveries(silver), silver, ["event_date", "product_id"], "event_date")


@query
def upsert_inventory_mart(star: DerivedStar) -> DataFrame:
    silver = _parsed_once(star, star.lake.silver_inventory())
    keys = ["snapshot_date", "warehouse_id", "product_id"]
    return _upserted(star, marts.inventory_health_daily, _first_deliveries(silver), silver, keys, "snapshot_date")


@query
def incremental_lookback(star: DerivedStar) -> DataFrame:
    """New and late events of both topics for marts that were loaded up to January 20."""
    silver = {SALES: star.lake.silver_sales(), INVENTORY: star.lake.silver_inventory()}
    day = F.to_date("timestamp")

    def new(topic: str) -> DataFrame:
        loaded = silver[topic].where("timestamp < TIMESTAMP '2024-01-21 00:00:00'").agg(F.max(day)).first()[0]
        recent = landing.since_lookback(silver[topic], "timestamp", loaded)
        return recent.groupBy(F.lit(topic).alias("topic"), day.alias("event_date")).agg(F.count("*").alias("rows"))

    return new(SALES).unionByName(new(INVENTORY))


@query
def as_of_read(star: DerivedStar) -> DataFrame:
    bronze = star.lake.bronze(SALES).unionByName(star.lake.bronze(INVENTORY))
    then = landing.as_of(bronze, "ingested_at", "2024-01-15 12:00:00")
    return then.groupBy("topic").agg(F.count("*").alias("rows"), F.max("offset").alias("last_offset"), F.max("ingested_at").alias("last_ingest"))


@query
def compaction(star: DerivedStar) -> DataFrame:
    """Quarantine table written as many small files, compacted, read back."""
    path = scratch_path(star.spark, "dlq")
    rows = star.lake.quarantine(SALES).unionByName(star.lake.quarantine(INVENTORY))
    rows.repartition(16).write.partitionBy("topic").parquet(path)
    storage.compact(star.spark, path, ["topic"])
    return star.spark.read.parquet(path).groupBy("topic", "error_reason").agg(
        F.count("*").alias("rows"), F.sum("offset").alias("offset_sum")
    )


@query
def offset_audit(star: DerivedStar) -> DataFrame:
    return storage.offset_audit(star.lake.bronze(SALES).unionByName(star.lake.bronze(INVENTORY)))


@query
def offset_rate(star: DerivedStar) -> DataFrame:
    """Two readings of both topics one hour apart."""
    bronze = star.lake.bronze(SALES).unionByName(star.lake.bronze(INVENTORY))
    earlier, later = (landing.as_of(bronze, "ingested_at", f"2024-01-15 {h}:00:00") for h in (12, 13))
    return storage.offset_rate(earlier, later, 3600)


@query
def ingest_history(star: DerivedStar) -> DataFrame:
    """Commits of each topic, newest first: rows added and the running total of rows."""
    bronze = star.lake.bronze(SALES).unionByName(star.lake.bronze(INVENTORY))
    per_batch = bronze.groupBy("topic", "ingested_at").agg(F.count("*").alias("added"))
    later = running_totals(per_batch, ["topic"], "ingested_at", ["added"])
    return later.select(
        "topic", "ingested_at", F.col("added").alias("added_records"),
        (F.col("all_added") - F.col("run_added") + F.col("added")).alias("total_records"),
    )


@query
def file_layout(star: DerivedStar) -> DataFrame:
    return storage.file_layout(star.raw("lineitem"))


@query
def file_layout_summary(star: DerivedStar) -> DataFrame:
    return storage.layout_summary(star.raw("lineitem"))


@query
def storage_footprint(star: DerivedStar) -> DataFrame:
    path = scratch_path(star.spark, "bronze")
    storage.append(star.lake.bronze(SALES).unionByName(star.lake.bronze(INVENTORY)), path)
    return storage.storage_footprint(star.spark.read.parquet(path))


@query
def surrogate_keys(star: DerivedStar) -> DataFrame:
    """Keys of product versions from a stored map: the first versions, then all, the second load
    twice. Known keys stay, new ones follow in order of the business key."""
    products = star.table("DimProductHistory").select("ProductSKU", "EffectiveFrom")
    path, business = scratch_path(star.spark, "keymap"), ["ProductSKU", "EffectiveFrom"]
    keys.assign(star.spark, path, products.where("EffectiveFrom < DATE'1998-01-01'"), business, "ProductKey", "first")
    for _ in range(2):
        known = keys.assign(star.spark, path, products, business, "ProductKey", "second")
    return known
