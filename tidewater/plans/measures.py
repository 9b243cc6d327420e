"""Measures by subject. Semi-additive stock is taken on the latest snapshot day
of each group; day counts cover the whole order calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import between_labels, month_label, safe_divide, stable_round, sum_when, tier
from ..operators import derived, intervals, segments
from ..sources.star import OVERSEAS, TIER_3, DerivedStar
from .registry import query

SITE = ["ProductKey", "WarehouseKey"]
NO_DEMAND = 9999.0  # fixed value: cover shown when there is no demand
UNITS_PER_PALLET = 350  # fixed value
CARRYING_RATE = 0.22  # fixed value: default annual rate
OTIF_TARGET, STOCKOUT_TARGET = 0.85, 0.002  # fixed values


def stock_by(star: DerivedStar, group: list[str], *measures: str) -> DataFrame:
    """Current units or valuation per group: of the intervals that reach the group's last day."""
    ends = star.table("FactStockInterval", "UntilDate", *group, *measures).groupBy(*group, "UntilDate").agg(
        *[F.sum(m).alias(m) for m in measures]
    )
    return ends.groupBy(*group).agg(*[F.max_by(m, "UntilDate").alias(m) for m in measures])


DEAD_AFTER = 181  # fixed value: days without movement from which stock is dead


def valuation_changes(star: DerivedStar, key: str) -> DataFrame:
    """Daily changes of valuation and of dead stock, by product (and its category) or by warehouse.

    Coarser groups are rolled up from these, so one query computes them once.
    """
    v = F.col("InventoryValuation")
    rows = star.table("FactStockInterval", "FromDate", "UntilDate", "LastMovementDate", key, "InventoryValuation")
    found = intervals.changes(rows, [key], {"value": v}, {"dead": (F.date_add("LastMovementDate", DEAD_AFTER), v)})
    return found.join(star.table("DimProduct", key, "CategoryName"), key, "left") if key == "ProductKey" else found


def valuation_by(star: DerivedStar, group: list[str]) -> DataFrame:
    """Average daily and current valuation, and current dead stock (> 180 days)."""
    change = valuation_changes(star, "WarehouseKey" if group == ["WarehouseKey"] else "ProductKey")
    if group not in (["WarehouseKey"], ["ProductKey"]):
        change = intervals.rolled(change, group, ["value", "dead"])
    total = intervals.totals(change, group, ["value", "dead"])
    return total.groupBy(*group).agg(
        safe_divide(intervals.over_days("value"), F.sum(intervals.days())).alias("avg_daily_valuation"),
        intervals.latest("value").alias("current_valuation"), intervals.latest("dead").alias("dead_stock_valuation"),
    )


def enterprise_valuation(star: DerivedStar) -> DataFrame:
    """Valuation of all stock while it does not change."""
    rows = star.table("FactStockInterval", "FromDate", "UntilDate", "InventoryValuation")
    return intervals.totals(intervals.changes(rows, [], {"value": F.col("InventoryValuation")}), [], ["value"])


def turns_by(star: DerivedStar, *group: str) -> DataFrame:
    """Annualised cost of goods, turns and days of inventory per group."""
    v = valuation_by(star, list(group))
    joined = v.join(star.cogs(*group), list(group), "left").withColumn("days", star.order_days())
    annual = safe_divide(F.coalesce("total_cogs", F.lit(0)) * 365, "days")
    rows = joined.withColumn("annualized_cogs", annual).withColumn("turns", safe_divide("annualized_cogs", "avg_daily_valuation"))
    return rows.withColumn("dio", safe_divide(F.lit(365), "turns")).drop("days")


def severe_excess(star: DerivedStar, products: DataFrame, group: str) -> DataFrame:
    """Current valuation of the products with more than a year of inventory."""
    heavy = products.where("dio > 365")
    return heavy.groupBy(group).agg(F.sum("current_valuation").alias("severe_excess_valuation"))


def product_turns(star: DerivedStar) -> DataFrame:
    return turns_by(star, "ProductKey").join(star.table("DimProduct", "ProductKey", "ProductSKU", "CategoryName"), "ProductKey", "left")


# -- sales ------------------------------------------------------------------


@query
def sales_kpis(star: DerivedStar) -> DataFrame:
    s = star.table(
        "FactSales", "CategoryName", "SalesOrderID", "OrderedQuantity", "ShippedQuantity", "CancelledQuantity",
        "GrossSalesAmount", "DiscountAmount", "NetSalesAmount", "CostOfGoodsSold", "OrderLineCycleTimeDays",
    )
    g = s.groupBy("CategoryName").agg(
        F.sum("OrderedQuantity").alias("ordered"), F.sum("ShippedQuantity").alias("shipped"), F.sum("CancelledQuantity").alias("cancelled"),
        F.sum("GrossSalesAmount").alias("gross_sales"), F.sum("DiscountAmount").alias("discount"),
        F.sum("NetSalesAmount").alias("net_sales"), F.sum("CostOfGoodsSold").alias("cogs"),
        F.count_distinct("SalesOrderID").alias("order_count"), F.count("*").alias("line_count"),
        F.sum("OrderLineCycleTimeDays").alias("cycle_days"),
    )
    stock = stock_by(star, ["CategoryName"], "OnHandQuantity")
    outages = star.table("FactStockout", "ProductKey").groupBy("ProductKey").agg(F.count("*").alias("n")).join(
        star.table("DimProduct", "ProductKey", "CategoryName"), "ProductKey"
    ).groupBy("CategoryName").agg(F.sum("n").alias("stockout_events"))
    rows = g.join(stock, "CategoryName", "left").join(outages, "CategoryName", "left").withColumn("days", star.order_days())
    profit = F.col("net_sales") - F.col("cogs")
    daily = safe_divide("shipped", "days")
    rows = rows.select(
        "CategoryName", "ordered", "shipped", "cancelled", "gross_sales", "discount", "net_sales", "cogs",
        profit.alias("gross_profit"), safe_divide(profit, "net_sales").alias("gross_margin_pct"),
        safe_divide("discount", "gross_sales").alias("avg_discount_pct"), "order_count", "line_count",
        safe_divide("cycle_days", "line_count").alias("avg_cycle_days"), daily.alias("daily_demand"),
        F.coalesce("OnHandQuantity", F.lit(0)).alias("on_hand"),
        F.coalesce("stockout_events", F.lit(0)).alias("stockout_events"),
    )
    cover = safe_divide("on_hand", "daily_demand", NO_DEMAND)
    return rows.select(
        "*", cover.alias("forward_days_of_supply"),
        tier(
            (cover > 730, "Freeze Replenishment POs & Rebalance"), (cover > 365, "Cancel Inbound & Mark Clearance"),
            (F.col("stockout_events") > 0, "Expedite Emergency PO"), otherwise="Monitor Run Rate",
        ).alias("recommended_action"),
    )


# -- inventory --------------------------------------------------------------


POSITION_SINCE = "2024-01-08"  # first day of the date filter unless the caller names another


@query
def inventory_position(star: DerivedStar, since: str = POSITION_SINCE) -> DataFrame:
    """By warehouse; ``total_rows_all_dates`` ignores the date filter of the rest."""
    units = ["OnHandQuantity", "AvailableQuantity", "ReservedQuantity", "InTransitInboundQuantity", "InventoryValuation"]
    rows = star.table("FactStockInterval", "FromDate", "UntilDate", "WarehouseKey", *units)
    out = F.when(F.col("AvailableQuantity") <= 0, 1).otherwise(0).cast("long")
    names = [*units, "out"]
    change = intervals.changes(rows, ["WarehouseKey"], {c: out if c == "out" else F.col(c) for c in names})
    total = intervals.totals(change, ["WarehouseKey"], names)
    first, now = F.lit(since).cast("date"), intervals.latest
    summed = intervals.over_days("InventoryValuation", first)
    return total.groupBy("WarehouseKey").agg(
        F.max("UntilDate").alias("latest_snapshot_date"),
        now("OnHandQuantity").alias("on_hand"), now("AvailableQuantity").alias("available"),
        now("ReservedQuantity").alias("reserved"), now("InTransitInboundQuantity").alias("inbound"),
        now("InventoryValuation").alias("current_valuation"), summed.alias("summed_valuation"),
        safe_divide(summed, F.sum(intervals.days_since(first))).alias("avg_daily_valuation"),
        intervals.over_days("n", first).cast("long").alias("snapshot_records"), intervals.over_days("n").cast("long").alias("total_rows_all_dates"),
        intervals.over_days("out", first).cast("long").alias("stockout_records"),
    )


# Names of the aging tiers; their bounds are 60, 120 and 180 days.
AGING = ["Healthy Active", "Slow Moving", "Stagnant At-Risk", "Dead Stock"]


@query
def inventory_aging(star: DerivedStar) -> DataFrame:
    """Valuation per aging tier on the latest day of each category, as rows."""
    v = F.col("InventoryValuation")
    age = F.datediff("UntilDate", "LastMovementDate")
    rows = star.table("FactStockInterval", "UntilDate", "LastMovementDate", "CategoryName", "InventoryValuation")
    bands = [age <= 60, (age > 60) & (age <= 120), (age > 120) & (age <= 180), age > 180]
    names = [f"t{i}" for i in range(len(AGING))]
    ends = rows.groupBy("CategoryName", "UntilDate").agg(F.sum(v).alias("total"), *[sum_when(b, v).alias(n) for b, n in zip(bands, names)])
    latest = ends.groupBy("CategoryName").agg(*[F.max_by(c, "UntilDate").alias(c) for c in ("total", *names)])
    rows = F.array(
        *[F.struct(F.lit(i + 1).alias("tier_order"), F.lit(label).alias("aging_tier"), F.col(n).alias("valuation")) for i, (label, n) in enumerate(zip(AGING, names))]
    )
    return latest.select("CategoryName", "total", F.inline(rows)).select(
        "CategoryName", "tier_order", "aging_tier", "valuation", safe_divide("valuation", "total").alias("share")
    )


@query
def inventory_turns(star: DerivedStar) -> DataFrame:
    by_category = turns_by(star, "CategoryName")
    excess = severe_excess(star, product_turns(star), "CategoryName")
    return by_category.join(excess, "CategoryName", "left").select(
        "CategoryName", "total_cogs", "annualized_cogs", "avg_daily_valuation", "current_valuation", "turns", "dio",
        F.coalesce("severe_excess_valuation", F.lit(0)).alias("severe_excess_valuation"),
    )


def _utilization(star: DerivedStar) -> DataFrame:
    stock = stock_by(star, ["WarehouseKey"], "OnHandQuantity")
    sites = star.table("DimWarehouse", "WarehouseKey", "WarehouseCode", "StorageCapacityPallets")
    pallets = safe_divide("OnHandQuantity", F.lit(UNITS_PER_PALLET))
    return sites.join(stock, "WarehouseKey", "left").select(
        "WarehouseKey", "WarehouseCode", "StorageCapacityPallets", F.coalesce("OnHandQuantity", F.lit(0)).alias("on_hand"),
        pallets.alias("pallets_occupied"), safe_divide(pallets, "StorageCapacityPallets").alias("utilization"),
    )


@query
def storage_utilization(star: DerivedStar) -> DataFrame:
    return _utilization(star)


@query
def velocity_tiers(star: DerivedStar) -> DataFrame:
    """Capital and SKUs per band of days of inventory."""
    dio = F.col("dio")
    # fixed values: bounds and names of the tiers
    bands = [
        (dio > 365, 1, "Severe Excess"), (dio > 180, 2, "Surplus / Slow"), (dio > 60, 3, "Buffer / Seasonal"),
        (dio >= 14, 4, "Optimal / Fast"), (dio < 14, 5, "Depletion Risk"),
    ]
    order = tier(*[(c, str(n)) for c, n, _ in bands], otherwise=None).cast("long")
    label = tier(*[(c, t) for c, _, t in bands], otherwise=None)
    return product_turns(star).groupBy(order.alias("tier_order"), label.alias("tier_name")).agg(
        F.sum("current_valuation").alias("capital"), F.count("*").alias("sku_count")
    )


@query
def warehouse_health(star: DerivedStar) -> DataFrame:
    rows = _utilization(star).join(turns_by(star, "WarehouseKey").select("WarehouseKey", "dio"), "WarehouseKey", "left")
    dio, use = F.coalesce("dio", F.lit(0.0)), F.col("utilization")
    # fixed values: thresholds and names of the health states
    status = tier(
        ((dio > 730) | (use > 0.90), "Severe Excess"), ((dio < 30) | (use < 0.35), "Depletion Risk"), otherwise="Balanced"
    )
    return rows.select("WarehouseKey", "StorageCapacityPallets", "utilization", dio.alias("dio"), status.alias("health_status"))


@query
def facility_summary(star: DerivedStar) -> DataFrame:
    """Facilities and capacity by region, from the warehouse dimension and its stock."""
    stock = stock_by(star, ["WarehouseKey"], "OnHandQuantity")
    sites = star.table("DimWarehouse", "WarehouseKey", "RegionKey", "StorageCapacityPallets").join(stock, "WarehouseKey", "left")
    return sites.groupBy("RegionKey").agg(
        F.count("*").alias("facility_count"), F.sum("StorageCapacityPallets").alias("capacity_pallets"),
        F.coalesce(F.sum("OnHandQuantity"), F.lit(0)).alias("on_hand"),
    )


# -- service ----------------------------------------------------------------


@query
def service_levels(star: DerivedStar) -> DataFrame:
    """By region. Lines are first reduced to one row per order and region: the
    order is on time in full only if its worst line is."""
    s = star.table("FactSales", "WarehouseKey", "SalesOrderID", "OrderedQuantity", "ShippedQuantity", "CancelledQuantity", "OnTimeInFullFlag")
    region = star.table("DimWarehouse", "WarehouseKey", "RegionKey")
    flag = F.col("OnTimeInFullFlag")
    orders = s.join(region, "WarehouseKey", "left").groupBy("RegionKey", "SalesOrderID").agg(
        F.count_if(flag == 1).alias("otif"),
        F.count_if((F.col("ShippedQuantity") > 0) & (F.col("CancelledQuantity") == 0)).alias("fulfilled"),
        F.min(flag).alias("worst"), F.sum("OrderedQuantity").alias("ordered"), F.sum("ShippedQuantity").alias("shipped"),
        F.sum("CancelledQuantity").alias("cancelled"),
    )
    service = orders.groupBy("RegionKey").agg(
        F.sum("otif").alias("otif_lines"), F.sum("fulfilled").alias("fulfilled_lines"),
        F.count_if(F.col("worst") == 1).alias("otif_orders"), F.count("*").alias("orders"),
        F.sum("ordered").alias("ordered"), F.sum("shipped").alias("shipped"), F.sum("cancelled").alias("cancelled"),
    )
    length = intervals.days()
    snaps = star.table("FactStockInterval", "FromDate", "UntilDate", "WarehouseKey", "IsStockoutFlag").groupBy("WarehouseKey").agg(
        F.sum(length).alias("snaps"), F.sum(F.col("IsStockoutFlag") * length).alias("outs")
    ).join(region, "WarehouseKey").groupBy("RegionKey").agg(F.sum("snaps").alias("snaps"), F.sum("outs").alias("outs"))
    outages = star.table(
        "FactStockout", "WarehouseKey", "StockoutDurationDays", "EstimatedLostDemandUnits", "EstimatedLostRevenueAmount"
    ).join(region, "WarehouseKey").groupBy("RegionKey").agg(
        F.count("*").alias("stockout_incidents"), F.sum("StockoutDurationDays").alias("stockout_days"),
        F.sum("EstimatedLostDemandUnits").alias("lost_units"), F.sum("EstimatedLostRevenueAmount").alias("lost_revenue"),
    )
    rows = service.join(snaps, "RegionKey", "left").join(outages, "RegionKey", "left")
    otif, out_rate = safe_divide("otif_lines", "fulfilled_lines", None), safe_divide("outs", "snaps", None)
    return rows.select(
        "RegionKey", "otif_lines", "fulfilled_lines", otif.alias("otif_rate"), "otif_orders", "orders",
        safe_divide("otif_orders", "orders").alias("order_otif_rate"), safe_divide("shipped", "ordered").alias("fill_rate"),
        safe_divide(F.col("ordered") - F.col("shipped") - F.col("cancelled"), "ordered").alias("backorder_rate"),
        out_rate.alias("stockout_rate"), "stockout_incidents", "stockout_days", "lost_units", "lost_revenue",
        F.lit(OTIF_TARGET).alias("otif_target"), F.lit(STOCKOUT_TARGET).alias("stockout_target"),
        tier((otif < OTIF_TARGET, "High"), (out_rate > 0.001, "Moderate"), otherwise="Normal").alias("risk_tier"),
    )


@query
def stockout_by_reason(star: DerivedStar) -> DataFrame:
    return star.table(
        "FactStockout", "StockoutAttributedReason", "WarehouseKey", "StockoutDurationDays", "EstimatedLostRevenueAmount"
    ).groupBy("StockoutAttributedReason", "WarehouseKey").agg(
        F.count("*").alias("incidents"), F.sum("StockoutDurationDays").alias("days"),
        F.sum("EstimatedLostRevenueAmount").alias("lost_revenue"),
    )


@query
def stockout_top_events(star: DerivedStar) -> DataFrame:
    """The three costliest outages. The limit comes first, so the numbering and
    the lookups see three rows."""
    cols = ["StockoutEventKey", *SITE, "StockoutDurationDays", "EstimatedLostRevenueAmount", "StockoutAttributedReason"]
    top = star.table("FactStockout", *cols).orderBy(F.desc("EstimatedLostRevenueAmount"), "StockoutEventKey").limit(3)
    rank = F.row_number().over(Window.orderBy(F.desc("EstimatedLostRevenueAmount"), "StockoutEventKey"))
    severity = star.table("DimProduct", "ProductKey", "ProductSKU", "CategoryName")
    named = (
        top.withColumn("event_rank", rank)
        .join(severity, "ProductKey", "left")
        .join(star.table("DimWarehouse", "WarehouseKey", "WarehouseCode"), "WarehouseKey", "left")
    )
    return named.select(
        "event_rank", F.col("EstimatedLostRevenueAmount").alias("lost_revenue"), "ProductSKU", "CategoryName", "WarehouseCode",
        "StockoutAttributedReason", "StockoutDurationDays",
        F.concat_ws(
            " • ", "ProductSKU", "CategoryName", F.concat(F.lit("Facility: "), F.col("WarehouseCode")),
            F.concat(F.lit("Reason: "), F.replace("StockoutAttributedReason", F.lit("Supplier "), F.lit(""))),
            F.concat(F.col("StockoutDurationDays").cast("string"), F.lit("d Outage")),
        ).alias("details"),
    )


@query
def stockout_severity(star: DerivedStar) -> DataFrame:
    """Outages and lost revenue by ABC class of the SKU."""
    revenue = segments.revenue_by(star.table("FactSales", "ProductKey", "NetSalesAmount"), ["ProductKey"])
    classes = segments.abc_class(revenue, []).select("ProductKey", "abc_class")
    label = tier(
        (F.col("abc_class") == "A", "Critical Tier A"), (F.col("abc_class") == "B", "Moderate Tier B"), otherwise="Low Tier C"
    )
    events = star.table("FactStockout", "ProductKey", "StockoutDurationDays", "EstimatedLostRevenueAmount").groupBy("ProductKey").agg(
        F.count("*").alias("n"), F.sum("StockoutDurationDays").alias("d"), F.sum("EstimatedLostRevenueAmount").alias("r")
    )
    return events.join(classes, "ProductKey", "left").groupBy(label.alias("severity_tier")).agg(
        F.sum("n").alias("incidents"), F.sum("d").alias("days"), F.sum("r").alias("lost_revenue")
    )


# -- procurement and suppliers ----------------------------------------------


def _po_measures(po: DataFrame, group: list[str]) -> DataFrame:
    status = F.col("POStatus")
    promised_done = F.when(status == "Completed", F.col("PromisedLeadTimeDays"))
    return po.groupBy(*group).agg(
        F.sum("ExtendedPOAmount").alias("spend"), F.sum("OrderedQuantity").alias("ordered"),
        F.sum("ReceivedQuantity").alias("received"), F.sum("RejectedQuantity").alias("rejected"),
        F.count_distinct("PurchaseOrderID").alias("po_count"), F.count("*").alias("line_count"),
        F.count_if(status == "Completed").alias("completed"), F.count_if(status == "Open In-Transit").alias("open_lines"),
        F.count_if(status == "Overdue").alias("overdue"),
        safe_divide(F.sum("PromisedLeadTimeDays"), F.count("PromisedLeadTimeDays"), None).alias("avg_contract_lead_time"),
        safe_divide(F.sum(promised_done), F.count(promised_done), None).alias("avg_contract_lead_time_completed"),
        safe_divide(F.sum("ActualLeadTimeDays"), F.count("ActualLeadTimeDays"), None).alias("avg_actual_lead_time"),
        safe_divide(F.sum("LeadTimeVarianceDays"), F.count("LeadTimeVarianceDays"), None).alias("avg_lead_time_variance"),
        F.sum("IsDeliveredOnTimeFlag").alias("on_time"), F.sum("IsDeliveredInFullFlag").alias("in_full"),
        F.sum("IsSupplierOTIFFlag").alias("otif"),
    )


PO_COLUMNS = [
    "SupplierKey", "PurchaseOrderID", "POStatus", "ExtendedPOAmount", "OrderedQuantity", "ReceivedQuantity", "RejectedQuantity",
    "PromisedLeadTimeDays", "ActualLeadTimeDays", "LeadTimeVarianceDays", "IsDeliveredOnTimeFlag", "IsDeliveredInFullFlag",
    "IsSupplierOTIFFlag",
]


@query
def procurement_kpis(star: DerivedStar) -> DataFrame:
    """By supplier tier; rates are over completed lines."""
    po = star.table("FactPurchaseOrder", *PO_COLUMNS).join(star.table("DimSupplier", "SupplierKey", "SupplierTier"), "SupplierKey", "left")
    g = _po_measures(po, ["SupplierTier"])
    otif, defects = safe_divide("otif", "completed"), safe_divide("rejected", "received")
    return g.select(
        "*", otif.alias("otif_rate"), safe_divide("on_time", "completed").alias("on_time_rate"),
        safe_divide("in_full", "completed").alias("in_full_rate"), defects.alias("defect_rate"),
        (F.lit(1.0) - defects).alias("acceptance_rate"), (F.lit(OTIF_TARGET) - otif).alias("otif_gap"),
        tier((otif >= OTIF_TARGET, "SLA Met"), (otif >= 0.70, "Watch Zone"), (otif >= 0.50, "At Risk"), otherwise="SLA Breach").alias("otif_status"),
    )


@query
def procurement_by_dock_month(star: DerivedStar) -> DataFrame:
    """Lead-time variance by the month of arrival: the other date role of the order."""
    po = star.table("FactPurchaseOrder", "ActualDockReceiptDate", "LeadTimeVarianceDays").where("ActualDockReceiptDate IS NOT NULL")
    return po.groupBy(month_label("ActualDockReceiptDate").alias("dock_month")).agg(
        F.count("*").alias("lines"), safe_divide(F.sum("LeadTimeVarianceDays"), F.count("*")).alias("avg_lead_time_variance")
    )


@query
def late_root_cause(star: DerivedStar) -> DataFrame:
    """Cause of each late line and its share; five causes at most."""
    po = star.table("FactPurchaseOrder", "SupplierKey", "LeadTimeVarianceDays", "ExtendedPOAmount").where("LeadTimeVarianceDays > 0")
    per = po.groupBy("SupplierKey", "LeadTimeVarianceDays").agg(F.count("*").alias("n"), F.sum("ExtendedPOAmount").alias("spend"))
    v = F.col("LeadTimeVarianceDays")
    cause = tier(
        ((F.col("RegionZone") == OVERSEAS) & (v >= 7), "Customs & Port Congestion (Overseas)"),
        ((F.col("SupplierTier") == TIER_3) & v.between(3, 5), "Raw Material Shortage (Tier 3)"),
        (v.between(1, 2), "Carrier Capacity & Freight Inefficiency"),
        otherwise="Other Late Delivery",
    )
    g = per.join(star.table("DimSupplier", "SupplierKey", "SupplierTier", "RegionZone"), "SupplierKey", "left").groupBy(
        cause.alias("root_cause")
    ).agg(F.sum("n").alias("late_lines"), F.sum("spend").alias("spend"))
    return g.withColumn("share", safe_divide("late_lines", F.sum("late_lines").over(Window.partitionBy())))


@query
def supplier_scorecard_summary(star: DerivedStar) -> DataFrame:
    """Monthly scorecards by tier."""
    m = star.table("FactSupplierMonthlyPerformance", "SupplierKey", "OTIFLineCount", "TotalPOLines", "AverageLeadTimeDays",
                   "LeadTimeStdDevDays", "LineFillRatePct", "OTIFRatePct", "SupplierMonthlyRiskRating")
    s = star.table("DimSupplier", "SupplierKey", "SupplierTier", "VendorRiskScore")
    breach = F.col("SupplierMonthlyRiskRating") == derived.CRITICAL_BREACH
    per_supplier = m.groupBy("SupplierKey").agg(
        F.count("*").alias("n"), F.sum("OTIFRatePct").alias("otif"), F.sum("AverageLeadTimeDays").alias("lt"), F.count("AverageLeadTimeDays").alias("lt_n"),
        F.sum("LeadTimeStdDevDays").alias("sd"), F.count("LeadTimeStdDevDays").alias("sd_n"), F.sum("LineFillRatePct").alias("fill"),
        F.count_if(breach).alias("breach"),
    )
    g = per_supplier.join(s, "SupplierKey").groupBy("SupplierTier").agg(
        F.count("*").alias("active_suppliers"), F.sum("n").alias("scorecards"),
        stable_round(safe_divide(F.sum("otif"), F.sum("n")), 6).alias("avg_otif_pct"),
        stable_round(safe_divide(F.sum("lt"), F.sum("lt_n"), None), 6).alias("avg_lead_time"),
        stable_round(safe_divide(F.sum("sd"), F.sum("sd_n"), None), 6).alias("avg_lead_time_std"),
        stable_round(safe_divide(F.sum("fill"), F.sum("n")), 6).alias("avg_fill_pct"),
        F.sum("breach").alias("critical_breaches"),
        F.when(F.count("*") == 1, F.max("VendorRiskScore")).otherwise(safe_divide(F.sum("VendorRiskScore"), F.count("*"))).alias("vendor_risk_score"),
    )
    return g.withColumn("critical_breach_pct", safe_divide("critical_breaches", "scorecards"))


@query
def sla_watchlist(star: DerivedStar) -> DataFrame:
    """Suppliers below 15 % on time in full, with the action their numbers call for."""
    g = _po_measures(star.table("FactPurchaseOrder", *PO_COLUMNS), ["SupplierKey"])
    rows = g.join(star.table("DimSupplier", "SupplierKey", "SupplierCode", "SupplierTier", "RegionZone"), "SupplierKey").withColumn(
        "otif_rate", safe_divide("otif", "completed")
    )
    otif, spend, late = F.col("otif_rate"), F.col("spend"), F.col("avg_lead_time_variance")
    action = tier(
        ((otif < 0.09) & (spend > 150000000), "Shift 30% Volume"), ((otif < 0.10) & (F.col("RegionZone") == OVERSEAS), "Dual-Source Mandate"),
        ((otif < 0.10) & (late >= 4.0), "Audit SLA Breach"), ((otif < 0.10) & (late >= 3.5), "Freeze New POs"),
        (otif < 0.15, "Penalty Fee Apply"), (otif < 0.40, "Improve Action Plan"), otherwise="Monitor",
    )
    return rows.where(otif < 0.15).select(
        "SupplierCode", "SupplierTier", "RegionZone", "otif_rate", "spend", "avg_lead_time_variance", action.alias("recommended_action")
    )


# -- forecast ---------------------------------------------------------------

MONTH_SITE = ["month", *SITE]


def forecast_and_actual(star: DerivedStar) -> DataFrame:
    """Both facts at month x product x warehouse in one aggregation.

    The rows of the two facts are stacked and grouped once: one shuffle, reduced
    on the map side, where joining the two would shuffle and sort each of them.
    ``in_forecast`` and ``in_actual`` tell which side a group came from.
    """
    zero, no, yes = F.lit(0).cast("long"), F.lit(False), F.lit(True)
    forecast = star.table(
        "FactDemandForecast", "TargetMonth", *SITE, "ForecastedQuantity", "BaselineStatisticalQuantity", "PlannerAdjustmentQuantity"
    ).select(
        F.col("TargetMonth").alias("month"), *SITE, F.col("ForecastedQuantity").alias("forecast"),
        F.col("BaselineStatisticalQuantity").alias("baseline"), F.col("PlannerAdjustmentQuantity").alias("adjustment"),
        zero.alias("actual"), yes.alias("f"), no.alias("a"),
    )
    actual = star.table("FactSales", "OrderDate", *SITE, "OrderedQuantity").select(
        F.trunc("OrderDate", "month").alias("month"), *SITE, zero.alias("forecast"), zero.alias("baseline"), zero.alias("adjustment"),
        F.col("OrderedQuantity").alias("actual"), no.alias("f"), yes.alias("a"),
    )
    sums = [F.sum(c).alias(c) for c in ("forecast", "baseline", "adjustment", "actual")]
    return forecast.unionByName(actual).groupBy(*MONTH_SITE).agg(
        *sums, F.max("f").alias("in_forecast"), F.max("a").alias("in_actual")
    )


def aligned_forecast(star: DerivedStar) -> DataFrame:
    """Forecast groups with the actual of the same group, 0 if there is none."""
    return forecast_and_actual(star).where("in_forecast")


def _errors(star: DerivedStar) -> DataFrame:
    """Per product that was sold: sums over its forecast groups, and all it sold, from one pass."""
    planned, a = F.col("in_forecast"), F.col("actual")
    part = lambda c: F.sum(F.when(planned, c))
    return forecast_and_actual(star).groupBy("ProductKey").agg(
        part(F.col("forecast")).alias("forecast"), part(F.col("baseline")).alias("baseline"), part(F.col("adjustment")).alias("adjustment"),
        part(F.abs(a - F.col("forecast"))).alias("abs_error"), part(F.abs(a - F.col("baseline"))).alias("baseline_error"), F.sum("actual").alias("actual"),
    ).where("actual > 0")


def _by_category(star: DerivedStar, per_product: DataFrame) -> DataFrame:
    product = star.table("DimProduct", "ProductKey", "CategoryName", "UnitListPrice")
    return per_product.join(product, "ProductKey", "left")


@query
def forecast_accuracy(star: DerivedStar) -> DataFrame:
    rows = _by_category(star, _errors(star))
    g = rows.groupBy("CategoryName").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("forecast", "baseline", "adjustment", "abs_error", "actual")],
        F.sum(F.col("forecast").cast("decimal(18,0)") * F.col("UnitListPrice")).alias("forecast_value"),
    )
    wape = safe_divide("abs_error", "actual")
    return g.select(
        "*", wape.alias("wape"), F.when(F.col("actual") > 0, F.greatest(F.lit(0.0), F.lit(1.0) - wape)).alias("accuracy"),
        safe_divide(F.col("forecast") - F.col("actual"), "actual").alias("bias"),
    )


@query
def forecast_value_add(star: DerivedStar) -> DataFrame:
    """What planner overrides add: baseline WAPE minus consensus WAPE."""
    g = _by_category(star, _errors(star)).groupBy("CategoryName").agg(
        F.sum("abs_error").alias("abs_error"), F.sum("baseline_error").alias("baseline_error"), F.sum("actual").alias("actual")
    )
    consensus, base = safe_divide("abs_error", "actual"), safe_divide("baseline_error", "actual")
    return g.select("CategoryName", base.alias("baseline_wape"), consensus.alias("consensus_wape"), (base - consensus).alias("value_add"))


@query
def forecast_exceptions(star: DerivedStar) -> DataFrame:
    """The ten most under- and the ten most over-forecast SKUs."""
    forecast = star.table("FactDemandForecast", "ProductKey", "ForecastedQuantity").groupBy("ProductKey").agg(F.sum("ForecastedQuantity").alias("forecast"))
    actual = star.table("FactSales", "ProductKey", "OrderedQuantity").groupBy("ProductKey").agg(F.sum("OrderedQuantity").alias("actual"))
    rows = forecast.join(actual, "ProductKey").select("*", (F.col("forecast") - F.col("actual")).alias("error"))

    def worst(cond, kind):
        return rows.where(cond).orderBy(F.desc(F.abs("error")), "ProductKey").limit(10).select(F.lit(kind).alias("exception"), "*")

    both = worst("error < 0", "under-forecast").unionByName(worst("error > 0", "over-forecast"))
    return both.join(star.table("DimProduct", "ProductKey", "ProductSKU", "CategoryName"), "ProductKey", "left").select(
        "exception", "ProductSKU", "CategoryName", "actual", "forecast", "error", safe_divide("error", "actual").alias("error_pct")
    )


@query
def wape_deterioration(star: DerivedStar) -> DataFrame:
    """Class A SKUs whose error grew over three consecutive planning months."""
    monthly = aligned_forecast(star).groupBy("ProductKey", "month").agg(
        F.sum(F.abs(F.col("actual") - F.col("forecast"))).alias("e"), F.sum("actual").alias("a")
    ).where("a > 0").select("ProductKey", "month", safe_divide("e", "a").alias("wape"))
    w = Window.partitionBy("ProductKey").orderBy("month")
    worse = monthly.select(
        "*", F.lag("wape", 1).over(w).alias("previous_wape"), F.lag("wape", 2).over(w).alias("second_previous_wape"),
        F.lag("month", 2).over(w).alias("second_month"),
    ).where("wape > previous_wape AND previous_wape > second_previous_wape AND second_month = add_months(month, -2)").drop("second_month")
    revenue = segments.revenue_by(star.table("FactSales", "ProductKey", "NetSalesAmount"), ["ProductKey"])
    top = segments.abc_class(revenue, []).where("abc_class = 'A'").select("ProductKey", "revenue")
    return worse.join(top, "ProductKey")


# -- working capital --------------------------------------------------------


@query
def working_capital(star: DerivedStar) -> DataFrame:
    products = product_turns(star)
    by_category = turns_by(star, "CategoryName")
    excess = severe_excess(star, products, "CategoryName")
    return by_category.join(excess, "CategoryName", "left").withColumn("days", star.order_days()).select(
        "CategoryName", "total_cogs", safe_divide("total_cogs", "days").alias("daily_cogs"), "annualized_cogs",
        (F.col("avg_daily_valuation") * CARRYING_RATE).alias("annual_carrying_cost"),
        (F.col("current_valuation").cast("double") * CARRYING_RATE).alias("spot_carrying_cost"),
        F.col("current_valuation").alias("capital_in_inventory"), F.col("dead_stock_valuation").alias("potential_release"),
        F.coalesce("severe_excess_valuation", F.lit(0)).alias("severe_excess_valuation"),
    )


# Credit terms in days, and the parts of the 22 % carrying rate.
DSO, DPO = 30.0, 45.0
COST_PARTS = [
    ("Cost of Capital", 0.105), ("Storage & Handling", 0.045), ("Obsolescence & Spoilage", 0.04), ("Taxes, Insurance & Shrink", 0.03),
]


@query
def cash_conversion_cycle(star: DerivedStar) -> DataFrame:
    """Days cash is tied up, and the carrying cost by part, for the whole enterprise."""
    value = enterprise_valuation(star).agg(
        safe_divide(intervals.over_days("value"), F.sum(intervals.days())).alias("avg_valuation"), intervals.latest("value").alias("current_valuation")
    )
    cogs = star.cogs("CategoryName").agg(F.sum("total_cogs")).scalar()
    rows = value.withColumn("annual", safe_divide(cogs * 365, star.order_days()))
    rows = rows.withColumn("dio", safe_divide(F.lit(365), safe_divide("annual", "avg_valuation")))
    parts = F.array(*[F.struct(F.lit(n).alias("cost_part"), F.lit(r).alias("rate")) for n, r in COST_PARTS])
    return rows.select("dio", (F.col("dio") + DSO - DPO).alias("ccc_days"), "current_valuation", F.inline(parts)).select(
        "dio", "ccc_days", "cost_part", "rate", (F.col("current_valuation").cast("double") * F.col("rate")).alias("annual_cost")
    )


# -- multi-level grouping ---------------------------------------------------


@query
def hierarchy_rollup(star: DerivedStar) -> DataFrame:
    """Category > brand with subtotals; lines are summed per product first."""
    per = star.table("FactSales", "ProductKey", "NetSalesAmount", "OrderedQuantity").groupBy("ProductKey").agg(
        F.sum("NetSalesAmount").alias("net"), F.sum("OrderedQuantity").alias("units")
    )
    return per.join(star.table("DimProduct", "ProductKey", "CategoryName", "BrandName"), "ProductKey").rollup("CategoryName", "BrandName").agg(
        F.sum("net").alias("net_sales"), F.sum("units").alias("units"), F.count("*").alias("skus"),
        F.grouping_id().alias("level"),
    )


@query
def calendar_rollup(star: DerivedStar) -> DataFrame:
    """Year > quarter > month with subtotals, from one row per day."""
    per = star.table("FactSales", "OrderDate", "NetSalesAmount").groupBy("OrderDate").agg(F.sum("NetSalesAmount").alias("net"))
    d = F.col("OrderDate")
    return per.rollup(F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month")).agg(F.sum("net").alias("net_sales"))


@query
def abc_xyz_matrix(star: DerivedStar) -> DataFrame:
    """Nine cells with row, column and grand totals."""
    revenue = segments.revenue_by(star.table("FactSales", "ProductKey", "NetSalesAmount"), ["ProductKey"])
    abc = segments.abc_class(revenue, [])
    sales = star.table("FactSales", "ProductKey", "OrderDate", "OrderedQuantity")
    xyz = segments.xyz_class(sales, ["ProductKey"], star.order_days())
    cells = abc.join(xyz, "ProductKey").groupBy("abc_class", "xyz_class").agg(
        F.count("*").alias("skus"), F.sum("revenue").alias("revenue"), F.sum("demand").alias("units")
    )
    return cells.cube("abc_class", "xyz_class").agg(
        F.sum("skus").alias("skus"), F.sum("revenue").alias("revenue"), F.sum("units").alias("units")
    ).select(
        F.coalesce("abc_class", F.lit("All")).alias("abc_class"), F.coalesce("xyz_class", F.lit("All")).alias("xyz_class"),
        "skus", "revenue", "units", F.concat(F.lit("TIER "), F.coalesce("abc_class", F.lit("*")), F.coalesce("xyz_class", F.lit("*"))).alias("badge"),
    )


@query
def aging_brackets(star: DerivedStar) -> DataFrame:
    rows = star.position("CategoryName", "OnHandQuantity", "InventoryValuation", "DaysSinceLastMovement")
    bracket = between_labels("DaysSinceLastMovement", [(30, "0-30"), (60, "31-60"), (90, "61-90"), (180, "91-180")], "180+")
    return rows.groupBy("CategoryName", bracket.alias("bracket")).agg(
        F.count("*").alias("positions"), F.sum("OnHandQuantity").alias("units"), F.sum("InventoryValuation").alias("valuation")
    )


@query
def turns_doi_reconcile(star: DerivedStar) -> DataFrame:
    """Turns times days of inventory must give 365 wherever there are turns."""
    product = F.col("turns") * F.col("dio")
    return turns_by(star, "CategoryName").select(
        "CategoryName", "turns", "dio", ((F.abs(product - 365) < 0.001) | (F.col("turns") == 0)).alias("reconciles")
    )
