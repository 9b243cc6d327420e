"""The two gold marts and the questions asked of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import safe_divide, stable_round, sum_when, tier
from .dedup import latest_event

CRITICAL, LOW, OPTIMAL = "CRITICAL_STOCKOUT", "LOW_STOCK_WARNING", "OPTIMAL"


def sales_daily_summary(silver: DataFrame) -> DataFrame:
    """Date x product; the order value is a mean of per-event ratios."""
    ratio = F.try_divide(F.col("revenue"), F.col("units_sold").cast("double"))
    return (
        latest_event(silver.select("event_id", "timestamp", "product_id", "revenue", "units_sold"))
        .groupBy(F.to_date("timestamp").alias("event_date"), "product_id")
        .agg(
            stable_round(F.sum("revenue"), 2).alias("total_revenue"),
            F.sum("units_sold").alias("total_units_sold"),
            F.count("event_id").alias("transaction_count"),
            stable_round(F.avg(ratio), 2).alias("avg_order_value"),
        )
    )


def inventory_health_daily(silver: DataFrame) -> DataFrame:
    """Date x warehouse x product; ``current_on_hand`` is that day's net movement."""
    change, kind = F.col("quantity_change"), F.col("event_type")
    grouped = (
        latest_event(silver.drop("ingested_at"))
        .groupBy(F.to_date("timestamp").alias("snapshot_date"), "warehouse_id", "product_id")
        .agg(
            F.coalesce(F.sum(change), F.lit(0)).alias("current_on_hand"),
            sum_when(kind == "RECEIPT", change).alias("total_receipts"),
            sum_when(kind == "PICK", F.abs(change)).alias("total_picks"),
        )
    )
    on_hand, picks = F.col("current_on_hand"), F.col("total_picks")
    return grouped.select(
        "*",
        stable_round(safe_divide(picks, F.greatest(on_hand, F.lit(1)), None), 4).alias("daily_turnover_rate"),
        stable_round(safe_divide(on_hand, picks.cast("double") / 7.0, None), 1).alias("days_of_supply"),
        tier((on_hand <= 10, CRITICAL), (on_hand <= 50, LOW), otherwise=OPTIMAL).alias("stockout_risk_status"),
    )


def product_sales(parsed: DataFrame, n: int = 10) -> DataFrame:
    """Top products by gross revenue over all parsed orders, duplicates included."""
    ts = F.col("timestamp").cast("timestamp")
    return (
        parsed.groupBy("product_id")
        .agg(
            F.count("*").alias("total_orders"),
            F.sum("units_sold").alias("total_units"),
            stable_round(F.sum("revenue"), 2).alias("gross_revenue"),
            F.min(ts).alias("earliest_order"),
            F.max(ts).alias("latest_order"),
        )
        .orderBy(F.desc_nulls_last("gross_revenue"), F.asc_nulls_first("product_id"))
        .limit(n)
    )


def movement_by_type(parsed: DataFrame) -> DataFrame:
    return parsed.groupBy("warehouse_id", "event_type").agg(
        F.count("*").alias("movement_events"), F.sum("quantity_change").alias("net_stock_delta")
    )


def latest_sales(mart: DataFrame, n: int = 20) -> DataFrame:
    return mart.orderBy(F.desc("event_date"), F.desc("total_revenue"), "product_id").limit(n)


def risky(mart: DataFrame) -> DataFrame:
    return mart.where(F.col("stockout_risk_status").isin(CRITICAL, LOW))


def stockout_alerts(mart: DataFrame, n: int = 20) -> DataFrame:
    return risky(mart).orderBy(
        F.asc_nulls_last("days_of_supply"), "snapshot_date", "warehouse_id", "product_id"
    ).limit(n)


def risk_status_counts(mart: DataFrame) -> DataFrame:
    s = F.col("stockout_risk_status")
    return mart.agg(
        F.count("*").alias("total_skus"),
        F.count_if(s == CRITICAL).alias("critical_count"),
        F.count_if(s == LOW).alias("warning_count"),
        F.count_if(s == OPTIMAL).alias("optimal_count"),
    )


def top_risks(mart: DataFrame, n: int = 10) -> DataFrame:
    s = F.col("stockout_risk_status")
    priority = F.when(s == CRITICAL, 1).when(s == LOW, 2).otherwise(3)
    return (
        mart.orderBy(priority, F.asc_nulls_last("days_of_supply"), "snapshot_date", "warehouse_id", "product_id")
        .limit(n)
        .select(
            "snapshot_date", "warehouse_id", "product_id", "current_on_hand",
            "daily_turnover_rate", "days_of_supply", "stockout_risk_status",
        )
    )


def mart_totals(mart: DataFrame) -> DataFrame:
    return mart.agg(
        stable_round(F.sum("total_revenue"), 2).alias("total_revenue"),
        F.sum("total_units_sold").alias("total_units_sold"),
        F.sum("transaction_count").alias("total_transactions"),
    )


def current_stock(silver: DataFrame) -> DataFrame:
    return silver.groupBy("product_id", "warehouse_id").agg(F.sum("quantity_change").alias("current_stock"))
