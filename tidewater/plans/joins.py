"""Star-schema joins: conformed, role-playing, versioned, secured."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import month_label, safe_divide
from ..operators import security
from ..sources.star import TIER_3, DerivedStar, scenario_structs
from .measures import forecast_and_actual
from ..operators.asof import as_of
from .registry import query


@query
def star_join(star: DerivedStar) -> DataFrame:
    """Net sales by region, channel and category. The lines are summed per
    warehouse before the region is looked up."""
    sales = star.table("FactSales", "CategoryName", "ChannelName", "WarehouseKey", "NetSalesAmount", "OrderedQuantity")
    per_site = sales.groupBy("WarehouseKey", "ChannelName", "CategoryName").agg(
        F.sum("NetSalesAmount").alias("net"), F.sum("OrderedQuantity").alias("units"), F.count("*").alias("n")
    )
    return (
        per_site.join(star.table("DimWarehouse", "WarehouseKey", "RegionKey"), "WarehouseKey", "left")
        .join(star.table("DimRegion"), "RegionKey", "left")
        .groupBy("RegionName", "ChannelName", "CategoryName")
        .agg(F.sum("net").alias("net_sales"), F.sum("units").alias("ordered_units"), F.sum("n").alias("lines"))
    )


@query
def role_date_join(star: DerivedStar) -> DataFrame:
    """One measure by the month of three date roles; every line is read once."""
    sales = star.table("FactSales", "OrderDateKey", "ShipDateKey", "DeliveryDateKey", "NetSalesAmount")
    role = lambda name: F.struct(F.lit(name.lower()).alias("date_role"), F.col(f"{name}DateKey").alias("DateKey"))
    roles = F.explode(F.array(role("Order"), role("Ship"), role("Delivery")))
    per_day = sales.select("NetSalesAmount", roles.alias("r")).groupBy("r.date_role", "r.DateKey").agg(
        F.sum("NetSalesAmount").alias("net_sales"), F.count("*").alias("lines")
    )
    calendar = star.table("DimDate", "DateKey", "MonthYear")
    return per_day.join(calendar, "DateKey", "left").groupBy("date_role", "MonthYear").agg(
        F.sum("net_sales").alias("net_sales"), F.sum("lines").alias("lines")
    )


@query
def scd2_range_join(star: DerivedStar) -> DataFrame:
    """Units at the cost valid on the order day. Summing per SKU and day first
    bounds what a popular SKU sends into the join."""
    sales = star.table("FactSales", "ProductKey", "OrderDate", "ShippedQuantity")
    daily = sales.groupBy("ProductKey", "OrderDate").agg(F.sum("ShippedQuantity").alias("units"))
    versions = star.table("DimProductHistory")
    valid = (
        (F.col("ProductKey") == F.col("NaturalKey"))
        & (F.col("OrderDate") >= F.col("EffectiveFrom"))
        & (F.col("OrderDate") < F.col("EffectiveTo"))
    )
    return daily.join(versions, valid).groupBy("CategoryName", "IsCurrent").agg(
        F.sum("units").alias("units"),
        F.sum(F.col("units").cast("decimal(18,0)") * F.col("UnitStandardCost")).alias("cost_at_order_date"),
    )


@query
def asof_line_cost(star: DerivedStar) -> DataFrame:
    """Every sales line at the cost of its order day, line by line: a product with a third of
    all lines is spread over the months it sold in."""
    lines = star.table("FactSales", "ProductKey", "OrderDate", "ShippedQuantity")
    versions = star.table("DimProductHistory").withColumnRenamed("NaturalKey", "ProductKey")
    priced = as_of(lines, versions, "ProductKey", "OrderDate", "EffectiveFrom", ["CategoryName", "IsCurrent", "UnitStandardCost"])
    return priced.groupBy("CategoryName", "IsCurrent").agg(
        F.count("*").alias("lines"), F.sum("ShippedQuantity").alias("units"),
        F.sum(F.col("ShippedQuantity").cast("decimal(10,0)") * F.col("UnitStandardCost")).alias("cost_at_order_date"),
    )


@query
def orphan_check(star: DerivedStar) -> DataFrame:
    """Keys without a dimension row; lines with an impossible number stand in for broken ones."""
    lines = star.raw("lineitem").select(
        F.when((F.col("l_linenumber") == 7) & (F.col("l_returnflag") == "R"), -F.col("l_partkey") - 1)
        .otherwise(F.col("l_partkey")).alias("ProductKey")
    )
    values = lines.groupBy("ProductKey").agg(F.count("*").alias("lines"))
    return values.join(star.table("DimProduct", "ProductKey"), "ProductKey", "left_anti")


@query
def row_security(star: DerivedStar) -> DataFrame:
    """What each user sees of the sales fact."""
    per_wh = star.table("FactSales", "WarehouseKey", "NetSalesAmount").groupBy("WarehouseKey").agg(
        F.count("*").alias("rows"), F.sum("NetSalesAmount").alias("net_sales")
    )
    allowed = security.allowed_warehouses(star.table("SecurityUser"), star.table("DimWarehouse"))
    return allowed.join(per_wh, "WarehouseKey", "left").groupBy("UserEmail").agg(
        F.count("*").alias("visible_warehouses"), F.sum("rows").alias("sales_rows"), F.sum("net_sales").alias("net_sales")
    )


@query
def secured_sales(star: DerivedStar) -> DataFrame:
    """The sales fact through the filter of one regional planner, by channel account count."""
    fact = star.table("FactSales", "WarehouseKey", "OrderedQuantity")
    seen = security.secure(fact, star.table("SecurityUser"), star.table("DimWarehouse"), "MULTI@tidewater.example")
    return seen.groupBy("WarehouseKey").agg(F.count("*").alias("rows"), F.sum("OrderedQuantity").alias("units"))


@query
def region_visibility(star: DerivedStar) -> DataFrame:
    return security.allowed_regions(star.table("SecurityUser"), star.table("DimWarehouse"), star.table("DimRegion"))


@query
def scalar_lookup(star: DerivedStar) -> DataFrame:
    events = star.table("FactStockout", "ProductKey", "WarehouseKey", "StartDate", "StockoutDurationDays")
    return (
        events.join(star.table("DimProduct", "ProductKey", "ProductSKU", "CategoryName"), "ProductKey", "left")
        .join(star.table("DimWarehouse", "WarehouseKey", "WarehouseCode"), "WarehouseKey", "left")
        .select("ProductSKU", "CategoryName", "WarehouseCode", "StartDate", "StockoutDurationDays")
    )


@query
def cross_fact_align(star: DerivedStar) -> DataFrame:
    """Forecast against actuals at month x product x warehouse, both sides kept."""
    f, a = F.col("forecast"), F.col("actual")
    return forecast_and_actual(star).groupBy(month_label("month").alias("month")).agg(
        F.sum(f).alias("forecast_units"), F.sum(a).alias("actual_units"), F.sum(F.abs(a - f)).alias("absolute_error"),
        F.count_if(~F.col("in_actual")).alias("forecast_only"), F.count_if(~F.col("in_forecast")).alias("actual_only"),
    )


@query
def scenario_cross_join(star: DerivedStar) -> DataFrame:
    """Every category under every preset. The presets are an array literal, so
    they are exploded onto the grouped rows instead of joined."""
    units = star.table("FactSales", "ProductKey", "OrderedQuantity").groupBy("ProductKey").agg(F.sum("OrderedQuantity").alias("u"))
    by_category = units.join(star.table("DimProduct", "ProductKey", "CategoryName"), "ProductKey", "left").groupBy(
        "CategoryName"
    ).agg(F.sum("u").alias("ordered_units"))
    s = by_category.select("*", F.explode(scenario_structs()).alias("s"))
    return s.select(
        "CategoryName", "s.ScenarioCode", "ordered_units",
        (F.col("ordered_units").cast("double") * F.col("s.DemandMultiplier").cast("double")).alias("simulated_demand"),
    )


@query
def supplier_attribution(star: DerivedStar) -> DataFrame:
    """Outages caused by suppliers, by the tier of the SKU's primary supplier."""
    events = star.table("FactStockout", "ProductKey", "StockoutAttributedReason").where(
        "StockoutAttributedReason = 'Supplier Delayed Inbound'"
    ).groupBy("ProductKey").agg(F.count("*").alias("n"))
    tiers = (
        events.join(star.table("DimProduct", "ProductKey", "PrimarySupplierKey"), "ProductKey")
        .join(star.table("DimSupplier", "SupplierKey", "SupplierTier"), F.col("PrimarySupplierKey") == F.col("SupplierKey"))
    )
    return tiers.agg(
        F.sum("n").alias("supplier_caused"),
        F.coalesce(F.sum(F.when(F.col("SupplierTier") == TIER_3, F.col("n"))), F.lit(0)).alias("tier3_caused"),
    ).select("*", safe_divide("tier3_caused", "supplier_caused").alias("tier3_attribution_pct"))


@query
def sourcing_bridge(star: DerivedStar) -> DataFrame:
    """Single- and dual-sourced SKUs by category."""
    pairs = star.table("BridgeProductSupplier", "ProductKey", "SupplierKey").distinct()
    suppliers = pairs.groupBy("ProductKey").agg(F.count("*").alias("suppliers"))
    kind = F.when(F.col("suppliers") == 1, "Single-Sourced").otherwise("Multi-Sourced")
    return suppliers.join(star.table("DimProduct", "ProductKey", "CategoryName"), "ProductKey").groupBy(
        "CategoryName", kind.alias("sourcing")
    ).agg(F.count("*").alias("skus"))


@query
def region_rollup(star: DerivedStar) -> DataFrame:
    """Warehouse -> region -> planner, from one row per warehouse."""
    per_wh = star.table("FactSales", "WarehouseKey", "OrderedQuantity", "NetSalesAmount").groupBy("WarehouseKey").agg(
        F.sum("OrderedQuantity").alias("units"), F.sum("NetSalesAmount").alias("net")
    )
    return (
        per_wh.join(star.table("DimWarehouse", "WarehouseKey", "RegionKey", "StorageCapacityPallets"), "WarehouseKey")
        .join(star.table("DimRegion"), "RegionKey")
        .join(star.table("DimEmployeePlanner", "RegionKey", "PlannerName"), "RegionKey")
        .groupBy("RegionName", "PlannerName")
        .agg(
            F.count("*").alias("warehouses"), F.sum("StorageCapacityPallets").alias("capacity_pallets"),
            F.sum("units").alias("ordered_units"), F.sum("net").alias("net_sales"),
        )
    )


@query
def returns_rate(star: DerivedStar) -> DataFrame:
    """Returned against shipped units by channel; each fact is summed before they meet."""
    channel = star.table("DimCustomerChannel", "CustomerChannelKey", "ChannelName")

    def by_channel(fact, **sums):
        per_account = fact.groupBy("CustomerChannelKey").agg(*[F.sum(c).alias(n) for n, c in sums.items()])
        return per_account.join(channel, "CustomerChannelKey").groupBy("ChannelName").agg(*[F.sum(n).alias(n) for n in sums])

    shipped = by_channel(star.table("FactSales", "CustomerChannelKey", "ShippedQuantity"), shipped="ShippedQuantity")
    returned = by_channel(
        star.table("FactCustomerReturns", "CustomerChannelKey", "ReturnedQuantity", "RestockedQuantity", "ScrappedQuantity"),
        returned="ReturnedQuantity", restocked="RestockedQuantity", scrapped="ScrappedQuantity",
    )
    return shipped.join(returned, "ChannelName", "left").select(
        "ChannelName", "shipped", "returned", "restocked", "scrapped",
        safe_divide("returned", "shipped").alias("return_rate"), safe_divide("restocked", "returned").alias("restock_share"),
    )
