"""Data-quality queries in gate order: keys, references, then business rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import derived, quality
from ..sources.star import DerivedStar
from ..session import scratch_path
from .registry import query

SITE = ["ProductKey", "WarehouseKey"]

PRIMARY_KEYS = {
    "DimDate": "DateKey", "DimRegion": "RegionKey", "DimWarehouse": "WarehouseKey", "DimSupplier": "SupplierKey",
    "DimProduct": "ProductKey", "DimCustomerChannel": "CustomerChannelKey", "DimEmployeePlanner": "PlannerKey",
    "DimScenario": "ScenarioKey", "FactSales": "SalesLineKey", "FactInventorySnapshot": "SnapshotKey",
    "FactPurchaseOrder": "POLineKey", "FactDemandForecast": "ForecastKey", "FactInventoryMovement": "MovementKey",
    "FactStockout": "StockoutEventKey", "FactCustomerReturns": "ReturnLineKey",
    "FactSupplierMonthlyPerformance": "SupplierMonthlyKey",
}


@query
def dq_pk(star: DerivedStar) -> DataFrame:
    return quality.unique_keys({t: (star.table(t, k), k) for t, k in PRIMARY_KEYS.items()})


@query
def dq_fk(star: DerivedStar) -> DataFrame:
    dates, products = (star.table("DimDate", "DateKey"), "DateKey"), (star.table("DimProduct", "ProductKey"), "ProductKey")
    sites = (star.table("DimWarehouse", "WarehouseKey"), "WarehouseKey")
    accounts = (star.table("DimCustomerChannel", "CustomerChannelKey"), "CustomerChannelKey")
    suppliers = (star.table("DimSupplier", "SupplierKey"), "SupplierKey")

    def check(table, **references):
        return quality.foreign_keys(table, star.table(table, *references), references)

    return quality.union(
        [
            check("FactSales", OrderDateKey=dates, ProductKey=products, CustomerChannelKey=accounts, WarehouseKey=sites),
            check("FactInventorySnapshot", SnapshotDateKey=dates, ProductKey=products, WarehouseKey=sites),
            check("FactPurchaseOrder", SupplierKey=suppliers, ProductKey=products, ReceivingWarehouseKey=sites),
        ]
    )


@query
def dq_dates(star: DerivedStar) -> DataFrame:
    sales = star.table("FactSales", "OrderDate", "ShipDate", "DeliveryDate")
    po = star.table("FactPurchaseOrder", "POStatus", "POCreationDate", "ActualDockReceiptDate").where("POStatus = 'Completed'")
    c = F.col
    return quality.union(
        [
            quality.rules("dates", "FactSales", sales, {
                "ship before order": c("ShipDate") < c("OrderDate"), "delivery before ship": c("DeliveryDate") < c("ShipDate")}),
            quality.rules("dates", "FactPurchaseOrder", po, {"dock receipt before creation": c("ActualDockReceiptDate") < c("POCreationDate")}),
        ]
    )


@query
def dq_quantities(star: DerivedStar) -> DataFrame:
    c = F.col
    sales = star.table("FactSales", "OrderedQuantity", "ShippedQuantity", "CancelledQuantity", "CostOfGoodsSold", "UnitStandardCost")
    snap = star.table("FactInventorySnapshot", "OnHandQuantity", "AvailableQuantity", "InventoryValuation")
    return quality.union(
        [
            quality.rules("quantities", "FactSales", sales, {
                "ordered not positive": c("OrderedQuantity") <= 0, "shipped negative": c("ShippedQuantity") < 0,
                "cost of goods negative": c("CostOfGoodsSold") < 0, "unit cost not positive": c("UnitStandardCost") <= 0,
                "ordered not shipped plus cancelled": c("OrderedQuantity") != c("ShippedQuantity") + c("CancelledQuantity")}),
            quality.rules("quantities", "FactInventorySnapshot", snap, {
                "on hand negative": c("OnHandQuantity") < 0, "available negative": c("AvailableQuantity") < 0,
                "valuation negative": c("InventoryValuation") < 0}),
        ]
    )


@query
def dq_stockout(star: DerivedStar) -> DataFrame:
    c = F.col
    events = star.table(
        "FactStockout", "StockoutDurationDays", "EstimatedLostDemandUnits", "EstimatedLostRevenueAmount", "StartDate", "EndDate"
    )
    return quality.rules("stockout", "FactStockout", events, {
        "duration not positive": c("StockoutDurationDays") <= 0, "lost demand not positive": c("EstimatedLostDemandUnits") <= 0,
        "lost revenue negative": c("EstimatedLostRevenueAmount") < 0, "end before start": c("EndDate") < c("StartDate")})


@query
def dq_returns(star: DerivedStar) -> DataFrame:
    c = F.col
    returns = star.table(
        "FactCustomerReturns", "ReturnedQuantity", "RestockedQuantity", "ScrappedQuantity", "ReturnDate", "OriginalOrderDate"
    )
    return quality.rules("returns", "FactCustomerReturns", returns, {
        "returned not positive": c("ReturnedQuantity") <= 0,
        "restocked and scrapped do not add up": c("RestockedQuantity") + c("ScrappedQuantity") != c("ReturnedQuantity"),
        "return before order": c("ReturnDate") < c("OriginalOrderDate")})


@query
def dq_scorecard(star: DerivedStar) -> DataFrame:
    m = star.table("FactSupplierMonthlyPerformance", "OTIFRatePct", "LineFillRatePct")
    return quality.rules("scorecard", "FactSupplierMonthlyPerformance", m, {
        "OTIF rate outside 0-100": (F.col("OTIFRatePct") < 0) | (F.col("OTIFRatePct") > 100),
        "fill rate negative": F.col("LineFillRatePct") < 0})


@query
def dq_balance(star: DerivedStar) -> DataFrame:
    """Each day's balance follows from the day before and that day's flow."""
    keys = ["ProductKey", "WarehouseKey"]
    w = Window.partitionBy(*keys).orderBy("day")
    days = derived.inventory_balance(star.movements(), keys).select(
        "balance", "net_flow", F.coalesce(F.lag("balance").over(w), F.lit(0)).alias("before")
    )
    expected = F.greatest(F.lit(0), F.col("before") + F.col("net_flow"))
    return quality.rules("balance", "FactInventorySnapshot", days, {
        "balance not continuous": F.col("balance") != expected, "balance negative": F.col("balance") < 0})


@query
def dq_domain(star: DerivedStar) -> DataFrame:
    """Mandatory fields and accepted values."""
    c = F.col
    sales = star.table("FactSales", "SalesLineKey", "OrderDate", "ProductKey", "OrderedQuantity")
    po = star.table("FactPurchaseOrder", "POStatus", "SupplierKey")
    moves = star.table("FactInventoryMovement", "MovementType", "MovementQuantity")
    return quality.union(
        [
            quality.rules("domain", "FactSales", sales, {f"{k} missing": c(k).isNull() for k in sales.columns}),
            quality.rules("domain", "FactPurchaseOrder", po, {
                "status not accepted": ~c("POStatus").isin("Completed", "Open In-Transit", "Overdue"), "SupplierKey missing": c("SupplierKey").isNull()}),
            quality.rules("domain", "FactInventoryMovement", moves, {
                "type not accepted": ~c("MovementType").isin("RECEIPT", "PICK", "ADJUSTMENT"), "quantity missing": c("MovementQuantity").isNull()}),
        ]
    )


@query
def dq_on_write(star: DerivedStar) -> DataFrame:
    """The rules of five facts, counted by the jobs that store them: one pass over each."""
    c = F.col
    done = c("POStatus") == "Completed"
    tables = {
        "FactSales": {
            "dates": {"ship before order": c("ShipDate") < c("OrderDate"), "delivery before ship": c("DeliveryDate") < c("ShipDate")},
            "quantities": {
                "ordered not positive": c("OrderedQuantity") <= 0, "shipped negative": c("ShippedQuantity") < 0,
                "cost of goods negative": c("CostOfGoodsSold") < 0, "unit cost not positive": c("UnitStandardCost") <= 0,
                "ordered not shipped plus cancelled": c("OrderedQuantity") != c("ShippedQuantity") + c("CancelledQuantity")},
            "domain": {f"{k} missing": c(k).isNull() for k in ("SalesLineKey", "OrderDate", "ProductKey", "OrderedQuantity")},
        },
        "FactPurchaseOrder": {
            "dates": {"dock receipt before creation": (done, c("ActualDockReceiptDate") < c("POCreationDate"))},
            "domain": {"status not accepted": ~c("POStatus").isin("Completed", "Open In-Transit", "Overdue"), "SupplierKey missing": c("SupplierKey").isNull()},
        },
        "FactStockout": {"stockout": {
            "duration not positive": c("StockoutDurationDays") <= 0, "lost demand not positive": c("EstimatedLostDemandUnits") <= 0,
            "lost revenue negative": c("EstimatedLostRevenueAmount") < 0, "end before start": c("EndDate") < c("StartDate")}},
        "FactCustomerReturns": {"returns": {
            "returned not positive": c("ReturnedQuantity") <= 0,
            "restocked and scrapped do not add up": c("RestockedQuantity") + c("ScrappedQuantity") != c("ReturnedQuantity"),
            "return before order": c("ReturnDate") < c("OriginalOrderDate")}},
        "FactSupplierMonthlyPerformance": {"scorecard": {
            "OTIF rate outside 0-100": (c("OTIFRatePct") < 0) | (c("OTIFRatePct") > 100), "fill rate negative": c("LineFillRatePct") < 0}},
    }
    base = scratch_path(star.spark, "checked")
    return quality.union([quality.written_with_rules(star.table(t), f"{base}/{t}", groups, t) for t, groups in tables.items()])


@query
def dq_snapshot_balance(star: DerivedStar) -> DataFrame:
    """The stored daily snapshot against the movements: each day's stock is the day before's plus
    that day's flow, never below zero, and every day from the first movement on is there."""
    path = f"{scratch_path(star.spark, 'snapshot')}/FactInventorySnapshot"
    star.table("FactInventorySnapshot", "SnapshotDate", *SITE, "OnHandQuantity").write.parquet(path)
    snap = star.spark.read.parquet(path)
    flow = star.movements().groupBy(*SITE, F.col("day").alias("SnapshotDate")).agg(F.sum("quantity_change").alias("flow"))
    w = Window.partitionBy(*SITE).orderBy("SnapshotDate")
    days = snap.join(flow, [*SITE, "SnapshotDate"], "full_outer").select(
        "OnHandQuantity", F.coalesce("flow", F.lit(0)).alias("flow"), F.coalesce(F.lag("OnHandQuantity").over(w), F.lit(0)).alias("before"),
        (F.datediff("SnapshotDate", F.lag("SnapshotDate").over(w)) > 1).alias("gap"),
    )
    c = F.col
    return quality.rules("snapshot", "FactInventorySnapshot", days, {
        "stock not continuous": c("OnHandQuantity") != F.greatest(F.lit(0), c("before") + c("flow")),
        "stock negative": c("OnHandQuantity") < 0, "day missing": c("gap"), "movement without a day": c("OnHandQuantity").isNull()})


@query
def dq_summary(star: DerivedStar) -> DataFrame:
    gates = [dq_pk, dq_fk, dq_dates, dq_quantities, dq_stockout, dq_returns, dq_scorecard, dq_balance, dq_domain]
    return quality.summary(quality.union([gate(star) for gate in gates]))


AS_OF = "2024-02-01"  # day against which ages are taken unless the caller names another


@query
def table_volume(star: DerivedStar, today: str = AS_OF) -> DataFrame:
    """Rows, date range and age of each fact as of ``today``."""
    dated = {
        "FactSales": "OrderDate", "FactPurchaseOrder": "POCreationDate", "FactCustomerReturns": "ReturnDate",
        "FactDemandForecast": "TargetMonth", "FactInventorySnapshot": "SnapshotDate", "FactInventoryMovement": "MovementDate",
        "FactStockout": "StartDate",
    }
    as_of = F.lit(today).cast("date")

    def one(table, day):
        return star.table(table, day).agg(
            F.count("*").alias("rows"), F.min(day).alias("first_date"), F.max(day).alias("last_date")
        ).withColumn("table_name", F.lit(table))

    volumes = quality.union([one(t, d) for t, d in dated.items()])
    return volumes.withColumn("freshness_hours", (F.datediff(as_of, "last_date") * 24).cast("long"))
