"""Derived facts and dimensions, classification, trends."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import month_label, safe_divide
from ..operators import dedup, intervals, segments
from ..operators import derived as ops
from ..operators import state
from ..session import cut_lineage, scratch_path
from ..sources.star import DerivedStar
from .measures import enterprise_valuation
from .registry import query

SITE = ["ProductKey", "WarehouseKey"]


@query
def inventory_balance(star: DerivedStar) -> DataFrame:
    return ops.inventory_balance(star.movements(), SITE)


@query
def daily_snapshot(star: DerivedStar) -> DataFrame:
    return star.table(
        "FactInventorySnapshot", "SnapshotDate", "ProductKey", "WarehouseKey", "OnHandQuantity", "ReservedQuantity",
        "AvailableQuantity", "DaysSinceLastMovement", "UnitLandedCost", "InventoryValuation", "IsStockoutFlag",
    )


@query
def stockout_episodes(star: DerivedStar) -> DataFrame:
    return star.table("FactStockout", *SITE, "StartDate", "EndDate", "StockoutDurationDays")


@query
def lost_demand(star: DerivedStar) -> DataFrame:
    return star.table(
        "FactStockout", "StockoutEventKey", *SITE, "StartDate", "StockoutDurationDays", "EstimatedLostDemandUnits",
        "EstimatedLostRevenueAmount", "StockoutAttributedReason",
    )


@query
def supplier_scorecard_monthly(star: DerivedStar) -> DataFrame:
    return star.table("FactSupplierMonthlyPerformance")


def _revenue(star: DerivedStar, keys: list[str]) -> DataFrame:
    return segments.revenue_by(star.table("FactSales", *keys, "NetSalesAmount"), keys)


@query
def abc_class(star: DerivedStar) -> DataFrame:
    return segments.abc_class(_revenue(star, ["ProductKey"]), [])


@query
def xyz_class(star: DerivedStar) -> DataFrame:
    sales = star.table("FactSales", "ProductKey", "OrderDate", "OrderedQuantity")
    return segments.xyz_class(sales, ["ProductKey"], star.order_days())


@query
def abc_transition(star: DerivedStar) -> DataFrame:
    """Class of each SKU per quarter against the quarter before."""
    sales = star.table("FactSales", "ProductKey", "OrderDate", "NetSalesAmount").select(
        "ProductKey", F.trunc("OrderDate", "quarter").alias("quarter"), "NetSalesAmount"
    )
    classes = segments.abc_class(segments.revenue_by(sales, ["quarter", "ProductKey"]), ["quarter"])
    w = Window.partitionBy("ProductKey").orderBy("quarter")
    adjacent = F.lag("quarter").over(w) == F.add_months("quarter", -3)
    previous = F.coalesce(F.when(adjacent, F.lag("abc_class").over(w)), F.lit("NEW"))
    return classes.withColumn("previous_class", previous).groupBy("quarter", "previous_class", "abc_class").agg(
        F.count("*").alias("skus"), F.sum("revenue").alias("revenue")
    )


def _priority_history(star: DerivedStar) -> DataFrame:
    """Service priority per customer and day: the last order of the day decides."""
    rows = star.raw("orders").select(
        F.col("o_custkey").alias("CustomerKey"), F.to_date("o_orderdate").alias("changed_on"), "o_orderkey",
        F.col("o_orderpriority").alias("ServicePriority"),
    )
    return dedup.latest(rows, ["CustomerKey", "changed_on"], ["o_orderkey"]).drop("o_orderkey")


@query
def scd2_build(star: DerivedStar) -> DataFrame:
    return ops.scd2_build(_priority_history(star), "CustomerKey", ["ServicePriority"], "changed_on")


@query
def scd2_apply(star: DerivedStar) -> DataFrame:
    """Dimension as of the year 2000, then one load of everything later."""
    history = _priority_history(star)
    cut = F.lit("2000-01-01").cast("date")
    dim = ops.scd2_build(history.where(F.col("changed_on") < cut), "CustomerKey", ["ServicePriority"], "changed_on")
    incoming = dedup.latest(history.where(F.col("changed_on") >= cut), ["CustomerKey"], ["changed_on"]).drop("changed_on")
    return ops.scd2_apply(dim, incoming, "CustomerKey", ["ServicePriority"], "2000-01-01")


@query
def scd2_late_changes(star: DerivedStar) -> DataFrame:
    """The dimension from three deliveries, the latest days first: each splices its changes into
    versions that are already stored, and the result is that of the whole history."""
    history = _priority_history(star)
    days = F.datediff("changed_on", F.lit("1992-01-01"))
    args = ("CustomerKey", ["ServicePriority"], "changed_on")
    dim = cut_lineage(ops.scd2_versions(history.where(days % 3 == 0), *args))
    for part in (2, 1):
        dim = cut_lineage(ops.scd2_splice(dim, history.where(days % 3 == part), *args))
    return dim.drop("SeenOn")


@query
def scorecard_increments(star: DerivedStar) -> DataFrame:
    """The scorecard from stored partials: early lines, later ones, then late lines of early
    months, the last delivery twice. The lines of all deliveries are derived once."""
    po = star.table("FactPurchaseOrder", "POLineKey", *ops.SCORECARD_INPUT)
    base = scratch_path(star.spark, "scorecard")
    late, early = F.col("POLineKey") % 7 == 0, F.col("POCreationDate") < "1996-01-01"
    loads = {"early": early & ~late, "later": ~early, "late": early & late}
    delivery = F.coalesce(*[F.when(condition, name) for name, condition in loads.items()])
    staged = po.select(*ops.SCORECARD_INPUT, delivery.alias("delivery")).where("delivery IS NOT NULL")
    staged.write.partitionBy("delivery").parquet(f"{base}/lines")
    lines = star.spark.read.schema(staged.schema).parquet(f"{base}/lines")
    for name in (*loads, "late"):
        state.add_increment(star.spark, lines.where(F.col("delivery") == name).drop("delivery"), f"{base}/state", f"{base}/mart", name)
    return star.spark.read.parquet(f"{base}/mart")


@query
def dim_date(star: DerivedStar) -> DataFrame:
    return star.table("DimDate")


@query
def monthly_trend(star: DerivedStar) -> DataFrame:
    """Months of net sales and valuation; windows run over days and months only."""
    daily = star.table("FactSales", "OrderDate", "NetSalesAmount").groupBy("OrderDate").agg(F.sum("NetSalesAmount").alias("net"))
    number = F.unix_date("OrderDate")
    recent = Window.orderBy(number).rangeBetween(-29, 0)
    day_rows = daily.withColumn("t30", safe_divide(F.sum("net").over(recent), F.lit(30)))
    monthly = day_rows.groupBy(F.trunc("OrderDate", "month").alias("m")).agg(
        F.sum("net").alias("net_sales"), F.max_by("t30", "OrderDate").alias("trailing_30d_daily_net")
    )
    valuation = (
        intervals.by_month(enterprise_valuation(star)).groupBy(F.col("month").alias("m"))
        .agg(safe_divide(intervals.over_days("value"), F.sum(intervals.days())).alias("avg_daily_valuation"))
    )
    both = monthly.join(valuation, "m", "full_outer")
    previous = F.lag("net_sales").over(Window.orderBy("m"))
    return both.select(
        month_label("m").alias("month"), "net_sales", previous.alias("previous_net_sales"),
        safe_divide(F.col("net_sales").cast("double") - previous.cast("double"), previous, None).alias("net_sales_change"),
        "trailing_30d_daily_net", "avg_daily_valuation",
    )


@query
def share_of_total(star: DerivedStar) -> DataFrame:
    """Net sales share by region and by category from one grouped pass."""
    pairs = star.table("FactSales", *SITE, "NetSalesAmount").groupBy(*SITE).agg(F.sum("NetSalesAmount").alias("net"))
    named = (
        pairs.join(star.table("DimProduct", "ProductKey", "CategoryName"), "ProductKey")
        .join(star.table("DimWarehouse", "WarehouseKey", "RegionKey"), "WarehouseKey")
        .join(star.table("DimRegion"), "RegionKey")
    )
    cells = named.groupBy("RegionName", "CategoryName").agg(F.sum("net").alias("net"))
    member = F.explode(
        F.array(
            F.struct(F.lit("region").alias("level"), F.col("RegionName").alias("member")),
            F.struct(F.lit("category").alias("level"), F.col("CategoryName").alias("member")),
        )
    )
    sums = cells.select("net", member.alias("x")).groupBy("x.level", "x.member").agg(F.sum("net").alias("net_sales"))
    return sums.withColumn("share", safe_divide("net_sales", F.sum("net_sales").over(Window.partitionBy("level"))))


@query
def trailing90_otif(star: DerivedStar) -> DataFrame:
    """Supplier delivery over the last 90 days; the date filter reaches the order scan."""
    po = star.table(
        "FactPurchaseOrder", "SupplierKey", "POCreationDate", "POStatus", "ExtendedPOAmount",
        "IsDeliveredOnTimeFlag", "IsDeliveredInFullFlag", "IsSupplierOTIFFlag",
    ).where(F.col("POCreationDate") > F.date_sub(star.last_order_day(), 90))
    g = po.groupBy("SupplierKey").agg(
        F.count("*").alias("lines"), F.count_if(F.col("POStatus") == "Completed").alias("completed"),
        F.sum("IsDeliveredOnTimeFlag").alias("on_time"), F.sum("IsDeliveredInFullFlag").alias("in_full"),
        F.sum("IsSupplierOTIFFlag").alias("otif"), F.sum("ExtendedPOAmount").alias("spend"),
    )
    return g.select("*", safe_divide("otif", "completed").alias("otif_rate"), safe_divide("on_time", "completed").alias("on_time_rate"))


@query
def projected_stockout(star: DerivedStar) -> DataFrame:
    """Days until the shelf is empty at the burn rate of the last 30 days, and the next dock date."""
    last = star.last_event_day()
    position = star.position("OnHandQuantity").withColumn("SnapshotDate", last)
    picks = star.movements().where((F.col("event_type") == "PICK") & (F.col("day") > F.date_sub(last, 30))).groupBy(*SITE).agg(F.sum(-F.col("quantity_change")).alias("picked"))
    dock = (
        star.table("FactPurchaseOrder", "ProductKey", "ReceivingWarehouseKey", "POStatus", "PromisedDeliveryDate")
        .where("POStatus = 'Open In-Transit'")
        .groupBy("ProductKey", F.col("ReceivingWarehouseKey").alias("WarehouseKey"))
        .agg(F.min("PromisedDeliveryDate").alias("next_dock_date"))
    )
    burn = safe_divide("picked", F.lit(30))
    days_left = safe_divide("OnHandQuantity", burn, None)
    out = position.join(picks, SITE).join(dock, SITE, "left").select(
        *SITE, "SnapshotDate", "OnHandQuantity", burn.alias("daily_burn"), days_left.alias("days_of_supply"), "next_dock_date"
    )
    whole = F.floor("days_of_supply").cast("int")
    return out.select(
        "*", F.date_add("SnapshotDate", whole).alias("projected_stockout_date"), (F.col("days_of_supply") <= 14).alias("within_14_days"),
        # a dock date that has passed and the day of the outage itself come in time
        F.coalesce(F.col("next_dock_date") <= F.date_add("SnapshotDate", whole), F.lit(False)).alias("inbound_in_time"),
    ).drop("SnapshotDate")
