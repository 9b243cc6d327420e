"""Shared table expressions and a composer that adds those a statement names."""

from __future__ import annotations

import re


def rnd(x: str, digits: int) -> str:
    return f"round(CAST({x} AS DECIMAL(38,10)), {digits})::DOUBLE"


def div(a: str, b: str, alt: str | None = "0.0") -> str:
    ratio = f"(({a})::DOUBLE / nullif(({b})::DOUBLE, 0))"
    return ratio if alt is None else f"coalesce({ratio}, {alt})"


def std(n: str, s: str, q: str) -> str:
    n, s, q = (f"({x})::DOUBLE" for x in (n, s, q))
    return f"CASE WHEN {n} > 1 THEN sqrt(greatest(0.0, {n} * {q} - {s} * {s}) / ({n} * ({n} - 1.0))) END"


def dkey(d: str) -> str:
    return f"(year({d}) * 10000 + month({d}) * 100 + day({d}))::BIGINT"


Z = "CASE WHEN {0} >= 99 THEN 2.33::DOUBLE WHEN {0} >= 98 THEN 2.05::DOUBLE WHEN {0} >= 95 THEN 1.65::DOUBLE WHEN {0} >= 90 THEN 1.28::DOUBLE ELSE 1.65::DOUBLE END"

CTES: dict[str, str] = {}

# ---- events ---------------------------------------------------------------

CTES["ev"] = """
SELECT e.event_id, e.user_id, e.event_type AS raw_type, e.value, c.copy, e.event_id % 97 AS defect,
       e.ts + c.copy * INTERVAL 1 HOUR AS ts,
       epoch_us(e.ts) + c.copy * 3600000000 AS epoch_us,
       'EVT-' || e.event_id AS eid, 'SKU-' || e.user_id AS product_id, 'CUST-' || (e.event_id % 50) AS customer_id,
       'WH-' || (e.event_id % 10) AS warehouse_id, 1 + e.event_id % 5 AS units_sold,
       (CASE WHEN e.event_id % 97 = 3 THEN -e.value ELSE e.value END)::DECIMAL(12,2) + c.copy AS revenue,
       CASE e.event_type WHEN 'purchase' THEN 'PICK' WHEN 'error' THEN 'ADJUSTMENT' ELSE 'RECEIPT' END AS kind,
       CASE e.event_type WHEN 'purchase' THEN -(e.event_id % 50 + 1) WHEN 'error' THEN e.event_id % 41 - 20
            ELSE e.event_id % 100 + 1 END AS quantity_change
FROM events e JOIN (SELECT 0 AS copy UNION ALL SELECT 1) c ON c.copy = 0 OR e.event_id % 10 = 0
"""

_ENV = """'SKU-' || user_id AS kafka_key, {payload} AS raw_payload, '{topic}' AS topic, event_id % 16 AS "partition",
       event_id // 16 * 2 + copy AS "offset", ts AS kafka_timestamp,
       date_trunc('hour', ts) + INTERVAL 1 HOUR AS ingested_at"""


def _payload(own: str) -> str:
    text = (
        "'{' || concat_ws(', ', CASE WHEN defect <> 1 THEN '\"event_id\": \"' || eid || '\"' END, "
        "'\"timestamp\": ' || (epoch_us // 1000000) || '.' || lpad((epoch_us % 1000000)::VARCHAR, 6, '0'), "
        "CASE WHEN defect <> 2 THEN '\"product_id\": \"' || product_id || '\"' END, " + own + ") || '}'"
    )
    return f"CASE WHEN defect = 0 THEN substring({text}, 1, 40) WHEN defect = 4 THEN '' ELSE {text} END"


SALES_PAYLOAD = _payload(
    "'\"customer_id\": \"' || customer_id || '\"', '\"revenue\": ' || revenue::DECIMAL(12,2), '\"units_sold\": ' || units_sold"
)
INV_PAYLOAD = _payload(
    "CASE WHEN defect <> 3 THEN '\"warehouse_id\": \"' || warehouse_id || '\"' END, "
    "'\"quantity_change\": ' || quantity_change, '\"event_type\": \"' || kind || '\"'"
)
CTES["bronze_sales"] = f"SELECT event_id, copy, {_ENV.format(payload=SALES_PAYLOAD, topic='sales')} FROM ev"
CTES["bronze_inv"] = f"SELECT event_id, copy, {_ENV.format(payload=INV_PAYLOAD, topic='inventory')} FROM ev"

_FIELD = "CASE WHEN json_valid(raw_payload) THEN json_extract_string(raw_payload, '$.{0}') END"


def parsed(bronze: str, topic: str) -> str:
    f = _FIELD.format
    common = f"""
      CASE WHEN raw_payload <> '' AND NOT json_valid(raw_payload) THEN raw_payload END AS _corrupt_record,
      {f('event_id')} AS event_id, ({f('timestamp')})::DOUBLE AS "timestamp", {f('product_id')} AS product_id"""
    own = (
        f"{f('customer_id')} AS customer_id, ({f('revenue')})::DOUBLE AS revenue, ({f('units_sold')})::BIGINT AS units_sold"
        if topic == "sales"
        else f"{f('warehouse_id')} AS warehouse_id, ({f('quantity_change')})::BIGINT AS quantity_change, {f('event_type')} AS event_type"
    )
    return f'SELECT kafka_key, raw_payload, topic, "partition", "offset", kafka_timestamp, ingested_at, {common}, {own} FROM {bronze}'


def classified(source: str, last_rule: str) -> str:
    return f"""SELECT *, CASE WHEN _corrupt_record IS NOT NULL THEN 'MALFORMED_JSON' WHEN event_id IS NULL THEN 'MISSING_EVENT_ID'
      WHEN product_id IS NULL THEN 'MISSING_PRODUCT_ID' WHEN {last_rule} END AS error_reason FROM {source}"""


CTES["parsed_sales"] = parsed("bronze_sales", "sales")
CTES["parsed_inv"] = parsed("bronze_inv", "inventory")
CTES["class_sales"] = classified("parsed_sales", "revenue IS NULL OR revenue < 0 THEN 'INVALID_REVENUE'")
CTES["class_inv"] = classified("parsed_inv", "warehouse_id IS NULL THEN 'MISSING_WAREHOUSE_ID'")
CTES["silver_sales"] = """
SELECT eid AS event_id, ts AS "timestamp", product_id, customer_id, revenue::DOUBLE AS revenue, units_sold,
       date_trunc('hour', ts) + INTERVAL 1 HOUR AS ingested_at FROM ev WHERE defect > 4 OR (defect = 3 AND revenue >= 0)"""
CTES["silver_inv"] = """
SELECT eid AS event_id, ts AS "timestamp", product_id, warehouse_id, quantity_change, kind AS event_type,
       date_trunc('hour', ts) + INTERVAL 1 HOUR AS ingested_at FROM ev WHERE defect > 4"""
CTES["dedup_sales"] = """
SELECT * FROM silver_sales QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY "timestamp" DESC) = 1"""
CTES["dedup_inv"] = """
SELECT * FROM silver_inv QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY "timestamp" DESC) = 1"""


def sales_mart(source: str) -> str:
    return f"""
SELECT "timestamp"::DATE AS event_date, product_id, {rnd('sum(revenue)', 2)} AS total_revenue,
       sum(units_sold)::BIGINT AS total_units_sold, count(event_id) AS transaction_count,
       {rnd('avg(revenue / nullif(units_sold, 0))', 2)} AS avg_order_value
FROM {source} GROUP BY 1, 2"""


def inventory_mart(source: str) -> str:
    return f"""
SELECT *, {rnd(div('total_picks', 'greatest(current_on_hand, 1)', None), 4)} AS daily_turnover_rate,
       {rnd(div('current_on_hand', 'total_picks / 7.0::DOUBLE', None), 1)} AS days_of_supply,
       CASE WHEN current_on_hand <= 10 THEN 'CRITICAL_STOCKOUT' WHEN current_on_hand <= 50 THEN 'LOW_STOCK_WARNING'
            ELSE 'OPTIMAL' END AS stockout_risk_status
FROM (SELECT "timestamp"::DATE AS snapshot_date, warehouse_id, product_id, sum(quantity_change)::BIGINT AS current_on_hand,
             coalesce(sum(quantity_change) FILTER (event_type = 'RECEIPT'), 0)::BIGINT AS total_receipts,
             coalesce(sum(abs(quantity_change)) FILTER (event_type = 'PICK'), 0)::BIGINT AS total_picks
      FROM {source} GROUP BY 1, 2, 3)"""


CTES["sales_mart"] = sales_mart("dedup_sales")
CTES["inv_mart"] = inventory_mart("dedup_inv")

# ---- star -----------------------------------------------------------------

CTES["dim_product"] = """
SELECT p_partkey AS ProductKey, 'SKU-' || p_partkey AS ProductSKU, p_name AS ProductName, p_brand AS BrandName,
       p_type AS CategoryName, p_retailprice::DECIMAL(10,2) AS UnitListPrice,
       (p_retailprice::DECIMAL(10,2) * 0.6::DECIMAL(2,1))::DECIMAL(10,2) AS UnitStandardCost,
       p_partkey % (SELECT count(*) FROM supplier) AS PrimarySupplierKey FROM part"""
CTES["dim_product_history"] = """
SELECT ProductSKU, ProductName, CategoryName, ProductKey AS NaturalKey,
       CASE WHEN v = 1 THEN DATE '1990-01-01' ELSE DATE '1998-01-01' END AS EffectiveFrom,
       CASE WHEN v = 1 AND ProductKey % 4 = 0 THEN DATE '1998-01-01' ELSE DATE '9999-12-31' END AS EffectiveTo,
       CASE WHEN v = 1 AND ProductKey % 4 = 0 THEN (UnitStandardCost * 0.9::DECIMAL(2,1))::DECIMAL(10,2) ELSE UnitStandardCost END AS UnitStandardCost,
       NOT (v = 1 AND ProductKey % 4 = 0) AS IsCurrent
FROM dim_product JOIN (SELECT 1 AS v UNION ALL SELECT 2) vs ON v = 1 OR ProductKey % 4 = 0"""
CTES["dim_supplier"] = """
SELECT s_suppkey AS SupplierKey, 'SUP-' || s_suppkey AS SupplierCode, s_name AS SupplierName,
       CASE WHEN s_suppkey % 10 = 0 THEN 'Tier 1 Strategic' WHEN s_suppkey % 10 <= 3 THEN 'Tier 2 Preferred' ELSE 'Tier 3 Tactical' END AS SupplierTier,
       (CASE WHEN s_suppkey % 10 = 0 THEN 7 WHEN s_suppkey % 10 <= 3 THEN 21 ELSE 45 END)::BIGINT AS ContractLeadTimeDays,
       (s_suppkey * 13 % 101)::DOUBLE AS VendorRiskScore,
       CASE WHEN n_regionkey >= 2 THEN 'Overseas Inbound' ELSE 'Domestic' END AS RegionZone
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey"""
CTES["dim_warehouse"] = """
SELECT n_nationkey::BIGINT AS WarehouseKey, 'WH-' || n_nationkey AS WarehouseCode, n_name AS WarehouseName,
       n_regionkey::BIGINT AS RegionKey, (1000 * (1 + n_nationkey % 9))::BIGINT AS StorageCapacityPallets FROM nation"""
CTES["dim_region"] = "SELECT r_regionkey::BIGINT AS RegionKey, r_name AS RegionName FROM region"
CTES["dim_channel"] = "SELECT c_custkey AS CustomerChannelKey, c_name AS AccountName, c_mktsegment AS ChannelName FROM customer"
CTES["bridge"] = """
SELECT ProductSKU, ProductKey, PrimarySupplierKey AS SupplierKey, true AS IsPrimarySupplier FROM dim_product
UNION ALL
SELECT ProductSKU, ProductKey, (ProductKey * 7 + 1) % (SELECT count(*) FROM supplier), false FROM dim_product
WHERE ProductKey % 3 <> 0 AND (ProductKey * 7 + 1) % (SELECT count(*) FROM supplier) <> PrimarySupplierKey"""
CTES["scenarios"] = """
SELECT * FROM (VALUES (1, 'SCN-BASE', 'Baseline Plan', 1.00::DOUBLE, 0, 95.0::DOUBLE, 22.0::DOUBLE),
  (2, 'SCN-SURGE10', 'Demand Surge', 1.10::DOUBLE, 0, 95.0::DOUBLE, 22.0::DOUBLE),
  (3, 'SCN-PORT7D', 'Port Disruption', 1.00::DOUBLE, 7, 95.0::DOUBLE, 24.0::DOUBLE),
  (4, 'SCN-SLA98', 'Target SLA 98%', 1.00::DOUBLE, 0, 98.0::DOUBLE, 22.0::DOUBLE),
  (5, 'SCN-STRESS', 'Combined Stress', 1.15::DOUBLE, 5, 98.0::DOUBLE, 22.0::DOUBLE),
  (6, 'SCN-LEAN', 'Lean S&OP', 0.90::DOUBLE, -3, 90.0::DOUBLE, 22.0::DOUBLE))
  s(ScenarioKey, ScenarioCode, ScenarioName, mult, shock, level, rate)"""
CTES["security"] = """
SELECT * FROM (VALUES ('vp@tidewater.example', -1, -1), ('east@tidewater.example', 1, -1), ('multi@tidewater.example', 1, -1),
  ('multi@tidewater.example', 2, -1), ('dc7@tidewater.example', 2, 7), ('oddity@tidewater.example', -1, 5)) u(UserEmail, RegionKey, WarehouseKey)"""

CTES["sales_base"] = """
SELECT l_orderkey, l_linenumber, l_partkey AS ProductKey, l_suppkey, o_custkey AS CustomerChannelKey, s_nationkey::BIGINT AS WarehouseKey,
       o_orderdate::DATE AS OrderDate, o_orderstatus, l_shipdate::DATE AS ShipDate, l_shipdate::DATE + 3 AS DeliveryDate,
       l_quantity::BIGINT AS OrderedQuantity, l_returnflag, l_discount, l_tax,
       CASE WHEN l_returnflag = 'A' THEN l_quantity::BIGINT ELSE 0 END AS CancelledQuantity,
       l_extendedprice::DECIMAL(12,2) AS GrossSalesAmount,
       (l_extendedprice::DECIMAL(12,2) * l_discount::DECIMAL(4,2))::DECIMAL(12,2) AS DiscountAmount
FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN supplier ON l_suppkey = s_suppkey"""
CTES["fact_sales"] = """
SELECT b.*, l_orderkey * 10 + l_linenumber AS SalesLineKey, l_orderkey AS SalesOrderID,
       OrderedQuantity - CancelledQuantity AS ShippedQuantity, (GrossSalesAmount - DiscountAmount)::DECIMAL(12,2) AS NetSalesAmount,
       UnitStandardCost, UnitListPrice, CategoryName, ((OrderedQuantity - CancelledQuantity) * UnitStandardCost)::DECIMAL(12,2) AS CostOfGoodsSold,
       date_diff('day', OrderDate, DeliveryDate) AS OrderLineCycleTimeDays,
       CASE WHEN CancelledQuantity = 0 AND date_diff('day', OrderDate, DeliveryDate) <= 30 THEN 1 ELSE 0 END AS OnTimeInFullFlag
FROM sales_base b LEFT JOIN dim_product USING (ProductKey)"""
CTES["sales_days"] = """
SELECT min(o_orderdate)::DATE AS first_day, max(o_orderdate)::DATE AS last_day,
       date_diff('day', min(o_orderdate)::DATE, max(o_orderdate)::DATE) + 1 AS days FROM orders"""
CTES["calendar_days"] = """
SELECT least((SELECT first_day FROM sales_days), (SELECT min(l_shipdate)::DATE FROM lineitem), (SELECT min(ts)::DATE FROM events)) AS first_day,
       greatest((SELECT last_day FROM sales_days) + 57, (SELECT max(l_shipdate)::DATE + 10 FROM lineitem), (SELECT max(ts)::DATE + 1 FROM events)) AS last_day"""
CTES["po_base"] = """
SELECT l_orderkey * 10 + l_linenumber AS POLineKey, l_orderkey AS PurchaseOrderID, l_suppkey AS SupplierKey, ProductKey,
       WarehouseKey AS ReceivingWarehouseKey, OrderDate AS POCreationDate, OrderedQuantity,
       CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Open In-Transit' ELSE 'Overdue' END AS POStatus,
       CASE WHEN l_suppkey % 10 = 0 THEN 7 WHEN l_suppkey % 10 <= 3 THEN 21 ELSE 45 END AS PromisedLeadTimeDays,
       CASE WHEN o_orderstatus = 'F' THEN (l_orderkey * 7 + l_linenumber * 3) % 13 - CASE WHEN l_suppkey % 10 = 0 THEN 6 WHEN l_suppkey % 10 <= 3 THEN 4 ELSE 1 END END AS LeadTimeVarianceDays,
       CASE WHEN o_orderstatus = 'F' THEN OrderedQuantity - CASE WHEN l_discount >= 0.08::DOUBLE THEN 1 ELSE 0 END ELSE 0 END AS ReceivedQuantity,
       CASE WHEN o_orderstatus = 'F' AND l_tax >= 0.07::DOUBLE THEN 1 ELSE 0 END AS RejectedQuantity,
       (GrossSalesAmount * 0.6::DECIMAL(2,1))::DECIMAL(14,2) AS ExtendedPOAmount
FROM sales_base"""
CTES["fact_po"] = """
SELECT *, PromisedLeadTimeDays + LeadTimeVarianceDays AS ActualLeadTimeDays, POCreationDate + PromisedLeadTimeDays AS PromisedDeliveryDate,
       POCreationDate + (PromisedLeadTimeDays + LeadTimeVarianceDays)::INTEGER AS ActualDockReceiptDate,
       CASE WHEN LeadTimeVarianceDays <= 0 THEN 1 ELSE 0 END AS IsDeliveredOnTimeFlag,
       CASE WHEN POStatus = 'Completed' AND ReceivedQuantity >= OrderedQuantity THEN 1 ELSE 0 END AS IsDeliveredInFullFlag,
       CASE WHEN LeadTimeVarianceDays <= 0 AND POStatus = 'Completed' AND ReceivedQuantity >= OrderedQuantity THEN 1 ELSE 0 END AS IsSupplierOTIFFlag
FROM po_base"""
CTES["returns"] = """
SELECT l_orderkey * 10 + l_linenumber AS ReturnLineKey, l_partkey AS ProductKey, o_custkey AS CustomerChannelKey, o_orderdate::DATE AS OriginalOrderDate,
       l_shipdate::DATE + 10 AS ReturnDate, l_quantity::BIGINT AS ReturnedQuantity, l_quantity::BIGINT * 8 // 10 AS RestockedQuantity,
       l_quantity::BIGINT - l_quantity::BIGINT * 8 // 10 AS ScrappedQuantity
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R'"""
CTES["actual_month"] = """
SELECT date_trunc('month', OrderDate)::DATE AS month, ProductKey, WarehouseKey, sum(OrderedQuantity)::BIGINT AS actual FROM sales_base GROUP BY ALL"""
CTES["fact_forecast"] = """
SELECT *, greatest(0, BaselineStatisticalQuantity + shift) AS ForecastedQuantity,
       greatest(0, BaselineStatisticalQuantity + shift) - BaselineStatisticalQuantity AS PlannerAdjustmentQuantity
FROM (SELECT (month + INTERVAL 1 MONTH)::DATE AS TargetMonth, ProductKey, WarehouseKey, actual AS BaselineStatisticalQuantity,
             (ProductKey + WarehouseKey + month((month + INTERVAL 1 MONTH)::DATE)) % 7 - 3 AS shift FROM actual_month)"""
CTES["aligned"] = """
SELECT f.*, coalesce(a.actual, 0) AS actual FROM fact_forecast f LEFT JOIN actual_month a
  ON a.month = f.TargetMonth AND a.ProductKey = f.ProductKey AND a.WarehouseKey = f.WarehouseKey"""

CTES["moves"] = """
SELECT "timestamp"::DATE AS day, substring(product_id, 5)::BIGINT AS ProductKey, substring(warehouse_id, 4)::BIGINT AS WarehouseKey,
       quantity_change, event_type, substring(event_id, 5)::BIGINT AS MovementKey FROM dedup_inv"""
CTES["flow"] = "SELECT ProductKey, WarehouseKey, day, sum(quantity_change)::BIGINT AS net_flow FROM moves GROUP BY ALL"
CTES["balance"] = """
SELECT ProductKey, WarehouseKey, day, net_flow, prefix - least(0, min(prefix) OVER w) AS balance
FROM (SELECT *, (sum(net_flow) OVER (PARTITION BY ProductKey, WarehouseKey ORDER BY day))::BIGINT AS prefix FROM flow)
WINDOW w AS (PARTITION BY ProductKey, WarehouseKey ORDER BY day ROWS UNBOUNDED PRECEDING)"""
CTES["spine"] = """
SELECT k.ProductKey, k.WarehouseKey, d.SnapshotDate, b.day IS NOT NULL AS moved, b.balance, b.day
FROM (SELECT ProductKey, WarehouseKey, min(day) AS first_day, max(day) AS last_move FROM flow GROUP BY 1, 2) k
JOIN (SELECT unnest(generate_series((SELECT min(ts)::DATE FROM events), (SELECT max(ts)::DATE FROM events) + 2, INTERVAL 1 DAY))::DATE AS SnapshotDate) d
  ON d.SnapshotDate >= k.first_day AND d.SnapshotDate <= greatest(k.last_move, (SELECT max(day) FROM flow))
LEFT JOIN balance b ON b.ProductKey = k.ProductKey AND b.WarehouseKey = k.WarehouseKey AND b.day = d.SnapshotDate"""
CTES["snapshot_base"] = """
SELECT ProductKey, WarehouseKey, SnapshotDate,
       last_value(balance IGNORE NULLS) OVER w AS OnHandQuantity,
       date_diff('day', last_value(day IGNORE NULLS) OVER w, SnapshotDate) AS DaysSinceLastMovement
FROM spine WINDOW w AS (PARTITION BY ProductKey, WarehouseKey ORDER BY SnapshotDate ROWS UNBOUNDED PRECEDING)"""
CTES["snapshot"] = """
SELECT s.*, least(OnHandQuantity, (s.ProductKey + s.WarehouseKey) % 5) AS ReservedQuantity,
       OnHandQuantity - least(OnHandQuantity, (s.ProductKey + s.WarehouseKey) % 5) AS AvailableQuantity,
       UnitStandardCost AS UnitLandedCost, (OnHandQuantity * UnitStandardCost)::DECIMAL(14,2) AS InventoryValuation,
       CategoryName, RegionKey, coalesce(InTransitInboundQuantity, 0) AS InTransitInboundQuantity
FROM snapshot_base s LEFT JOIN dim_product USING (ProductKey) LEFT JOIN dim_warehouse USING (WarehouseKey)
LEFT JOIN open_inbound USING (ProductKey, WarehouseKey)"""
CTES["open_inbound"] = """
SELECT ProductKey, ReceivingWarehouseKey AS WarehouseKey, sum(OrderedQuantity)::BIGINT AS InTransitInboundQuantity, sum(ExtendedPOAmount) AS OpenPOAmount
FROM fact_po WHERE POStatus = 'Open In-Transit' GROUP BY 1, 2"""
CTES["episodes"] = """
SELECT ProductKey, WarehouseKey, min(SnapshotDate) AS StartDate, max(SnapshotDate) AS EndDate, count(*) AS StockoutDurationDays
FROM (SELECT *, SnapshotDate - (row_number() OVER (PARTITION BY ProductKey, WarehouseKey ORDER BY SnapshotDate))::INTEGER AS island
      FROM snapshot WHERE AvailableQuantity <= 0) GROUP BY ProductKey, WarehouseKey, island"""
CTES["picks"] = "SELECT ProductKey, WarehouseKey, day, -sum(quantity_change)::BIGINT AS units FROM moves WHERE event_type = 'PICK' GROUP BY ALL"
CTES["stockout"] = """
SELECT e.*, e.lost AS EstimatedLostDemandUnits, (e.lost * UnitListPrice)::DECIMAL(16,2) AS EstimatedLostRevenueAmount, CategoryName, ProductSKU,
       PrimarySupplierKey, CASE (e.ProductKey + e.WarehouseKey) % 3 WHEN 0 THEN 'Supplier Delayed Inbound' WHEN 1 THEN 'Demand Spike' ELSE 'Record Inaccuracy' END AS StockoutAttributedReason,
       date_diff('day', DATE '1970-01-01', StartDate) * 100000000000000 + e.ProductKey * 100 + e.WarehouseKey AS StockoutEventKey
FROM (SELECT ep.*, (2 * coalesce((SELECT sum(units) FROM picks p WHERE p.ProductKey = ep.ProductKey AND p.WarehouseKey = ep.WarehouseKey
             AND p.day BETWEEN ep.StartDate - 30 AND ep.StartDate - 1), 0)::BIGINT * StockoutDurationDays + 30) // 60 AS lost FROM episodes ep) e
LEFT JOIN dim_product USING (ProductKey)"""
CTES["supplier_monthly"] = f"""
SELECT *, SupplierKey * 1000000 + year(YearMonthDate) * 100 + month(YearMonthDate) AS SupplierMonthlyKey,
       {dkey('YearMonthDate')} AS YearMonthDateKey, strftime(YearMonthDate, '%Y-%m') AS YearMonth,
       {div('OTIFLineCount * 100', 'TotalPOLines')} AS OTIFRatePct, {div('lt_sum', 'lt_n', None)} AS AverageLeadTimeDays,
       {std('lt_n', 'lt_sum', 'lt_sq')} AS LeadTimeStdDevDays,
       {div('TotalReceivedQuantity * 100', 'TotalOrderedQuantity')} AS LineFillRatePct,
       CASE WHEN {div('OTIFLineCount * 100', 'TotalPOLines')} < 15 THEN 'Critical SLA Breach' WHEN {div('OTIFLineCount * 100', 'TotalPOLines')} < 60 THEN 'Moderate Risk' ELSE 'Low Risk' END AS SupplierMonthlyRiskRating
FROM (SELECT SupplierKey, date_trunc('month', POCreationDate)::DATE AS YearMonthDate, count(DISTINCT PurchaseOrderID) AS TotalPOCount,
        count(*) AS TotalPOLines, sum(OrderedQuantity)::BIGINT AS TotalOrderedQuantity, sum(ReceivedQuantity)::BIGINT AS TotalReceivedQuantity,
        sum(RejectedQuantity)::BIGINT AS TotalRejectedQuantity, sum(ExtendedPOAmount)::DOUBLE AS TotalSpendAmount,
        sum(IsDeliveredOnTimeFlag)::BIGINT AS OnTimePOCount, sum(IsDeliveredInFullFlag)::BIGINT AS InFullPOCount,
        sum(IsSupplierOTIFFlag)::BIGINT AS OTIFLineCount, count(*) FILTER (LeadTimeVarianceDays > 0) AS LateDeliveryCount,
        count(ActualLeadTimeDays) AS lt_n, sum(ActualLeadTimeDays) AS lt_sum, sum(ActualLeadTimeDays * ActualLeadTimeDays) AS lt_sq
      FROM fact_po GROUP BY 1, 2)"""


def compose(sql: str) -> str:
    """Prefix the shared expressions the statement uses, directly or through others."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                visit(CTES[name])
                if name not in needed:
                    needed.append(name)

    visit(sql)
    if not needed:
        return sql
    head = ",\n".join(f"{n} AS ({CTES[n].strip()})" for n in needed)
    sql = sql.strip()
    return f"WITH {head},\n{sql[5:]}" if sql.upper().startswith("WITH ") else f"WITH {head}\n{sql}"
