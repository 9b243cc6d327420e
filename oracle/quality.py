"""Statements for tidewater.plans.quality."""



def row(group: str, name: str, failures: str, total: str, source: str) -> str:
    return f"""SELECT '{group}' AS check_group, '{name}' AS check_name, coalesce({failures}, 0)::BIGINT AS failures, ({total})::BIGINT AS total,
        CASE WHEN coalesce({failures}, 0) = 0 THEN 'PASSED' ELSE 'FAILED' END AS status FROM {source}"""


def rules(group: str, table: str, source: str, broken: dict[str, str]) -> str:
    return " UNION ALL ".join(row(group, f"{table}: {n}", f"count(*) FILTER ({c})", "count(*)", source) for n, c in broken.items())


PK = {
    "DimDate.DateKey": ("d", "(SELECT unnest(generate_series(first_day, last_day, INTERVAL 1 DAY))::DATE AS d FROM calendar_days)"),
    "DimRegion.RegionKey": ("RegionKey", "dim_region"), "DimWarehouse.WarehouseKey": ("WarehouseKey", "dim_warehouse"),
    "DimSupplier.SupplierKey": ("SupplierKey", "dim_supplier"), "DimProduct.ProductKey": ("ProductKey", "dim_product"),
    "DimCustomerChannel.CustomerChannelKey": ("CustomerChannelKey", "dim_channel"), "DimEmployeePlanner.PlannerKey": ("RegionKey", "dim_region"),
    "DimScenario.ScenarioKey": ("ScenarioKey", "scenarios"), "FactSales.SalesLineKey": ("SalesLineKey", "fact_sales"),
    "FactInventorySnapshot.SnapshotKey": ("(SnapshotDate, ProductKey, WarehouseKey)", "snapshot"), "FactPurchaseOrder.POLineKey": ("POLineKey", "fact_po"),
    "FactDemandForecast.ForecastKey": ("(TargetMonth, ProductKey, WarehouseKey)", "fact_forecast"), "FactInventoryMovement.MovementKey": ("MovementKey", "moves"),
    "FactStockout.StockoutEventKey": ("StockoutEventKey", "stockout"), "FactCustomerReturns.ReturnLineKey": ("ReturnLineKey", "returns"),
    "FactSupplierMonthlyPerformance.SupplierMonthlyKey": ("SupplierMonthlyKey", "supplier_monthly"),
}
DATES = "(SELECT unnest(generate_series(first_day, last_day, INTERVAL 1 DAY))::DATE AS k FROM calendar_days)"
PRODUCTS, SITES = "(SELECT ProductKey AS k FROM dim_product)", "(SELECT WarehouseKey AS k FROM dim_warehouse)"
FK = [
    ("FactSales.OrderDateKey", "OrderDate", "fact_sales", DATES), ("FactSales.ProductKey", "ProductKey", "fact_sales", PRODUCTS),
    ("FactSales.CustomerChannelKey", "CustomerChannelKey", "fact_sales", "(SELECT CustomerChannelKey AS k FROM dim_channel)"),
    ("FactSales.WarehouseKey", "WarehouseKey", "fact_sales", SITES),
    ("FactInventorySnapshot.SnapshotDateKey", "SnapshotDate", "snapshot", DATES), ("FactInventorySnapshot.ProductKey", "ProductKey", "snapshot", PRODUCTS),
    ("FactInventorySnapshot.WarehouseKey", "WarehouseKey", "snapshot", SITES),
    ("FactPurchaseOrder.SupplierKey", "SupplierKey", "fact_po", "(SELECT SupplierKey AS k FROM dim_supplier)"),
    ("FactPurchaseOrder.ProductKey", "ProductKey", "fact_po", PRODUCTS), ("FactPurchaseOrder.ReceivingWarehouseKey", "ReceivingWarehouseKey", "fact_po", SITES),
]

SQL = {
    "dq_pk": " UNION ALL ".join(row("primary key", n, f"count(*) - count(DISTINCT {k})", "count(*)", t) for n, (k, t) in PK.items()),
    "dq_fk": " UNION ALL ".join(
        row("foreign key", n, "count(*) FILTER (d.k IS NULL)", "count(*)", f"(SELECT DISTINCT {c} AS v FROM {t}) f LEFT JOIN {d} d ON f.v = d.k") for n, c, t, d in FK
    ),
    "dq_dates": rules("dates", "FactSales", "fact_sales", {"ship before order": "ShipDate < OrderDate", "delivery before ship": "DeliveryDate < ShipDate"})
    + " UNION ALL " + rules("dates", "FactPurchaseOrder", "(SELECT * FROM fact_po WHERE POStatus = 'Completed')", {"dock receipt before creation": "ActualDockReceiptDate < POCreationDate"}),
    "dq_quantities": rules("quantities", "FactSales", "fact_sales", {
        "ordered not positive": "OrderedQuantity <= 0", "shipped negative": "ShippedQuantity < 0", "cost of goods negative": "CostOfGoodsSold < 0",
        "unit cost not positive": "UnitStandardCost <= 0", "ordered not shipped plus cancelled": "OrderedQuantity <> ShippedQuantity + CancelledQuantity"})
    + " UNION ALL " + rules("quantities", "FactInventorySnapshot", "snapshot", {
        "on hand negative": "OnHandQuantity < 0", "available negative": "AvailableQuantity < 0", "valuation negative": "InventoryValuation < 0"}),
    "dq_stockout": rules("stockout", "FactStockout", "stockout", {
        "duration not positive": "StockoutDurationDays <= 0", "lost demand not positive": "EstimatedLostDemandUnits <= 0",
        "lost revenue negative": "EstimatedLostRevenueAmount < 0", "end before start": "EndDate < StartDate"}),
    "dq_returns": rules("returns", "FactCustomerReturns", "returns", {
        "returned not positive": "ReturnedQuantity <= 0", "restocked and scrapped do not add up": "RestockedQuantity + ScrappedQuantity <> ReturnedQuantity",
        "return before order": "ReturnDate < OriginalOrderDate"}),
    "dq_scorecard": rules("scorecard", "FactSupplierMonthlyPerformance", "supplier_monthly", {
        "OTIF rate outside 0-100": "OTIFRatePct < 0 OR OTIFRatePct > 100", "fill rate negative": "LineFillRatePct < 0"}),
    "dq_balance": rules("balance", "FactInventorySnapshot",
        "(SELECT balance, net_flow, coalesce(lag(balance) OVER (PARTITION BY ProductKey, WarehouseKey ORDER BY day), 0) AS before FROM balance)",
        {"balance not continuous": "balance <> greatest(0, before + net_flow)", "balance negative": "balance < 0"}),
    "dq_domain": rules("domain", "FactSales", "fact_sales", {f"{c} missing": f"{c} IS NULL" for c in ("SalesLineKey", "OrderDate", "ProductKey", "OrderedQuantity")})
    + " UNION ALL " + rules("domain", "FactPurchaseOrder", "fact_po", {
        "status not accepted": "POStatus NOT IN ('Completed', 'Open In-Transit', 'Overdue')", "SupplierKey missing": "SupplierKey IS NULL"})
    + " UNION ALL " + rules("domain", "FactInventoryMovement", "moves", {
        "type not accepted": "event_type NOT IN ('RECEIPT', 'PICK', 'ADJUSTMENT')", "quantity missing": "quantity_change IS NULL"}),
}
ALL_CHECKS = " UNION ALL ".join(SQL.values())
SQL["dq_on_write"] = f"""SELECT * FROM ({' UNION ALL '.join(SQL[k] for k in ('dq_dates', 'dq_quantities', 'dq_domain', 'dq_stockout', 'dq_returns', 'dq_scorecard'))})
    WHERE NOT starts_with(check_name, 'FactInventory')"""
SQL["dq_snapshot_balance"] = rules("snapshot", "FactInventorySnapshot", """(WITH s AS (
        SELECT snapshot_base.ProductKey, snapshot_base.WarehouseKey, SnapshotDate AS d, row_number() OVER (PARTITION BY snapshot_base.ProductKey, snapshot_base.WarehouseKey ORDER BY SnapshotDate) AS k, OnHandQuantity AS q, coalesce(net_flow, 0) AS f
        FROM snapshot_base LEFT JOIN flow ON flow.ProductKey = snapshot_base.ProductKey AND flow.WarehouseKey = snapshot_base.WarehouseKey AND day = SnapshotDate)
    SELECT q, (lag(q) OVER w) AS b, f, date_diff('day', lag(d) OVER w, d) > 1 AS gap FROM s WINDOW w AS (PARTITION BY ProductKey, WarehouseKey ORDER BY k))""", {
    "stock not continuous": "q <> greatest(0, coalesce(b, 0) + f)", "stock negative": "q < 0", "day missing": "gap", "movement without a day": "q IS NULL"})
SQL["dq_summary"] = f"""SELECT *, passed::DOUBLE / checks::DOUBLE AS pass_rate, 100.0::DOUBLE * passed::DOUBLE / checks::DOUBLE AS dq_index FROM
    (SELECT count(*) AS checks, count(*) FILTER (status = 'PASSED') AS passed, count(*) FILTER (status = 'FAILED') AS failed, sum(failures)::BIGINT AS failing_rows FROM ({ALL_CHECKS}))"""
SQL["table_volume"] = " UNION ALL ".join(
    f"""SELECT '{n}' AS table_name, count(*) AS rows, min({d}) AS first_date, max({d}) AS last_date, date_diff('day', max({d}), DATE '2024-02-01') * 24 AS freshness_hours FROM {t}"""
    for n, d, t in [("FactSales", "OrderDate", "fact_sales"), ("FactPurchaseOrder", "POCreationDate", "fact_po"), ("FactCustomerReturns", "ReturnDate", "returns"),
                    ("FactDemandForecast", "TargetMonth", "fact_forecast"), ("FactInventorySnapshot", "SnapshotDate", "snapshot"),
                    ("FactInventoryMovement", "day", "moves"), ("FactStockout", "StartDate", "stockout")]
)
