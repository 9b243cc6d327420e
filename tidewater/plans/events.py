"""Queries on the event flow: bronze, silver, quarantine and the gold marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import safe_divide, stable_round
from ..operators import dedup, marts, parsing
from ..operators.running import previous, ranked
from ..schemas import INVENTORY, SALES
from ..sources import landing
from ..sources.star import DerivedStar
from .registry import query

TOPICS = (SALES, INVENTORY)


def _both(make) -> DataFrame:
    first, second = (make(t) for t in TOPICS)
    return first.unionByName(second)


# -- parsing ----------------------------------------------------------------


@query
def bronze_envelope(star: DerivedStar) -> DataFrame:
    return _both(star.lake.bronze)


@query
def json_parse_permissive(star: DerivedStar) -> DataFrame:
    parsed = parsing.parse_permissive(star.lake.bronze(SALES), SALES)
    return parsed.select("partition", "offset", "data.*")


@query
def json_parse_flat(star: DerivedStar) -> DataFrame:
    return parsing.parse_flat(star.lake.bronze(INVENTORY), INVENTORY)


@query
def event_classify(star: DerivedStar) -> DataFrame:
    return _both(lambda t: star.lake.classified(t).select("topic", "partition", "offset", "error_reason"))


@query
def valid_dlq_split(star: DerivedStar) -> DataFrame:
    """Every message goes to exactly one side."""
    return _both(
        lambda t: star.lake.classified(t)
        .groupBy("topic", F.when(F.col("error_reason").isNull(), "silver").otherwise("quarantine").alias("destination"))
        .agg(F.count("*").alias("rows"), F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"))
    )


@query
def epoch_cast(star: DerivedStar) -> DataFrame:
    seconds = F.col("timestamp")
    return parsing.parse_flat(star.lake.bronze(SALES), SALES).where("event_id IS NOT NULL").select(
        "event_id", "timestamp",
        seconds.cast("timestamp").alias("event_time"),
        F.to_date(seconds.cast("timestamp")).alias("event_date"),
        F.to_date(F.from_unixtime(seconds.cast("long"))).alias("fallback_date"),
    )


@query
def null_guards(star: DerivedStar) -> DataFrame:
    e = star.lake.silver_inventory()
    g = e.groupBy("product_id").agg(
        F.coalesce(F.sum("quantity_change"), F.lit(0)).alias("net"),
        F.sum(F.when(F.col("event_type") == "PICK", F.abs("quantity_change"))).alias("picks"),
    )
    return g.select(
        "product_id", "net", F.coalesce("picks", F.lit(0)).alias("picks"),
        F.greatest("net", F.lit(1)).alias("floored"),
        stable_round(safe_divide("picks", F.greatest("net", F.lit(1)), None), 4).alias("turnover"),
        safe_divide("net", "picks", -1.0).alias("cover"),
    )


@query
def payload_preview(star: DerivedStar) -> DataFrame:
    return star.lake.quarantine(SALES).select(
        "partition", "offset", "error_reason", parsing.payload_preview("raw_payload").alias("preview")
    )


@query
def staging_normalize(star: DerivedStar) -> DataFrame:
    raw = star.raw("customer").withColumn(
        "c_nationkey", F.when(F.col("c_custkey") % 11 == 0, F.lit(None)).otherwise(F.col("c_nationkey").cast("string"))
    ).withColumn("c_mktsegment", F.concat(F.lit("  "), F.lower("c_mktsegment"), F.lit(" ")))
    return landing.normalize(raw, ["c_mktsegment"], ["c_name"], ["c_nationkey"], ["c_custkey"]).select(
        "c_custkey", "c_name", "c_mktsegment", "c_nationkey", "c_acctbal"
    )


@query
def landing_audit(star: DerivedStar) -> DataFrame:
    landed = landing.with_audit(star.raw("lineitem"), "batch-1")
    return landed.groupBy("_source_file_name", "_batch_id").agg(
        F.count("*").alias("rows"), F.count("_ingested_at").alias("stamped_rows")
    )


def _from_bronze(star: DerivedStar, topic: str, mart) -> DataFrame:
    """Silver is empty here, so the mart is computed from bronze payloads."""
    silver = star.lake.silver(topic).where("false")
    name, df = landing.first_usable([("silver", silver), ("bronze", star.lake.bronze(topic))])
    if name == "bronze":
        df = parsing.parse_flat(df, topic).withColumn("timestamp", F.from_unixtime(F.col("timestamp").cast("long")).cast("timestamp"))
    return mart(df)


@query
def source_fallback(star: DerivedStar) -> DataFrame:
    return _from_bronze(star, SALES, marts.sales_daily_summary)


@query
def source_fallback_inventory(star: DerivedStar) -> DataFrame:
    return _from_bronze(star, INVENTORY, marts.inventory_health_daily)


@query
def dedup_latest_event(star: DerivedStar) -> DataFrame:
    return dedup.latest_event(star.lake.silver_sales())


@query
def dedup_latest_natural_key(star: DerivedStar) -> DataFrame:
    return dedup.latest(
        star.lake.silver_sales(), ["customer_id", "product_id"], ["ingested_at", "timestamp", "event_id"]
    )


# -- marts and serving ------------------------------------------------------


def sales_mart(star: DerivedStar) -> DataFrame:
    return marts.sales_daily_summary(star.lake.silver_sales())


def inventory_mart(star: DerivedStar) -> DataFrame:
    return marts.inventory_health_daily(star.lake.silver_inventory())


@query
def sales_daily_summary(star: DerivedStar) -> DataFrame:
    return sales_mart(star)


@query
def inventory_health_daily(star: DerivedStar) -> DataFrame:
    return inventory_mart(star)


@query
def product_sales_topn(star: DerivedStar) -> DataFrame:
    return marts.product_sales(parsing.parse_flat(star.lake.bronze(SALES), SALES))


@query
def movement_by_type(star: DerivedStar) -> DataFrame:
    return marts.movement_by_type(parsing.parse_flat(star.lake.bronze(INVENTORY), INVENTORY))


@query
def sales_mart_latest(star: DerivedStar) -> DataFrame:
    return marts.latest_sales(sales_mart(star))


@query
def stockout_alerts(star: DerivedStar) -> DataFrame:
    return marts.stockout_alerts(inventory_mart(star))


@query
def risk_filter(star: DerivedStar) -> DataFrame:
    return marts.risky(inventory_mart(star))


@query
def mart_totals(star: DerivedStar) -> DataFrame:
    return marts.mart_totals(sales_mart(star))


@query
def risk_status_counts(star: DerivedStar) -> DataFrame:
    return marts.risk_status_counts(inventory_mart(star))


@query
def top_risks(star: DerivedStar) -> DataFrame:
    return marts.top_risks(inventory_mart(star))


@query
def row_counts(star: DerivedStar) -> DataFrame:
    """Rows per layer and topic from one pass over each topic, plus a total."""
    counted = _both(
        lambda t: star.lake.classified(t).agg(
            F.count("*").alias("bronze"),
            F.count_if(F.col("error_reason").isNull()).alias("silver"),
            F.count_if(F.col("error_reason").isNotNull()).alias("quarantine"),
        ).withColumn("topic", F.lit(t))
    )
    long = counted.unpivot("topic", ["bronze", "silver", "quarantine"], "layer", "rows")
    named = long.select(F.concat_ws(".", "topic", "layer").alias("table_name"), "rows")
    return named.rollup("table_name").agg(F.sum("rows").alias("rows")).select(
        F.coalesce("table_name", F.lit("total")).alias("table_name"), "rows"
    )


@query
def dlq_recent(star: DerivedStar) -> DataFrame:
    return (
        star.lake.quarantine(SALES)
        .select("kafka_timestamp", "topic", "partition", "offset", "error_reason", parsing.payload_preview("raw_payload").alias("raw_payload"))
        .orderBy(F.desc("kafka_timestamp"), "partition", "offset")
        .limit(10)
    )


@query
def dlq_by_reason(star: DerivedStar) -> DataFrame:
    return _both(star.lake.quarantine).groupBy("topic", "error_reason").agg(F.count("*").alias("rows"))


@query
def mart_audit(star: DerivedStar) -> DataFrame:
    def count(name, df):
        return df.agg(F.count("*").alias("total_rows")).select(F.lit(name).alias("mart_name"), "total_rows")

    return count("fact_sales_summary", sales_mart(star)).unionByName(count("fact_inventory_health", inventory_mart(star)))


@query
def current_stock_view(star: DerivedStar) -> DataFrame:
    return marts.current_stock(star.lake.silver_inventory())


@query
def rank_in_warehouse(star: DerivedStar) -> DataFrame:
    stock = dedup.latest_event(star.lake.silver_inventory()).groupBy("warehouse_id", "product_id").agg(
        F.sum("quantity_change").alias("quantity")
    )
    cost = star.table("DimProduct", "ProductSKU", "UnitStandardCost")
    valued = stock.join(cost, stock["product_id"] == cost["ProductSKU"], "left").select(
        "warehouse_id", "product_id", "quantity", (F.col("quantity").cast("decimal(18,0)") * F.col("UnitStandardCost")).alias("stock_value")
    )
    return ranked(valued, ["warehouse_id"], "quantity", "rank_in_warehouse")


@query
def ingest_rate(star: DerivedStar) -> DataFrame:
    """Rows per second between consecutive ingest batches (one row per batch hour)."""
    per_batch = _both(star.lake.bronze).groupBy("ingested_at").agg(F.count("*").alias("rows"))
    rows = previous(per_batch, "ingested_at", ["ingested_at"])
    seconds = F.unix_seconds("ingested_at") - F.unix_seconds("prev_ingested_at")
    return rows.select(
        "ingested_at", "rows", F.greatest(F.lit(0.0), safe_divide("rows", seconds, 0.0)).alias("rows_per_second")
    )
