"""Statements for tidewater.plans.measures."""

from .base import CTES, div, rnd


def valuation(key: str) -> str:
    return f"""SELECT {key}, {div('sum(v)', 'count(*)')} AS avg_daily_valuation, max_by(v, SnapshotDate) AS current_valuation, max_by(dead, SnapshotDate) AS dead_stock_valuation
        FROM (SELECT {key}, SnapshotDate, sum(InventoryValuation) AS v, coalesce(sum(InventoryValuation) FILTER (DaysSinceLastMovement > 180), 0) AS dead FROM snapshot GROUP BY 1, 2) GROUP BY 1"""


def turns(key: str) -> str:
    return f"""SELECT *, {div('365', 'turns')} AS dio FROM (SELECT *, {div('annualized_cogs', 'avg_daily_valuation')} AS turns FROM
        (SELECT v.*, total_cogs, {div('coalesce(total_cogs, 0) * 365', '(SELECT days FROM sales_days)')} AS annualized_cogs
         FROM ({valuation(key)}) v LEFT JOIN (SELECT {key}, sum(CostOfGoodsSold) AS total_cogs FROM fact_sales GROUP BY 1) USING ({key})))"""


CTES["turns_product"] = turns("ProductKey")
CTES["turns_category"] = turns("CategoryName")
CTES["turns_site"] = turns("WarehouseKey")
CTES["severe"] = """
SELECT CategoryName, sum(current_valuation) AS severe_excess_valuation FROM turns_product JOIN dim_product USING (ProductKey) WHERE dio > 365 GROUP BY 1"""
CTES["usage"] = f"""
SELECT w.WarehouseKey, WarehouseCode, StorageCapacityPallets, coalesce(oh, 0)::BIGINT AS on_hand, {div('oh', '350')} AS pallets_occupied,
       {div(div('oh', '350'), 'StorageCapacityPallets')} AS utilization, RegionKey
FROM dim_warehouse w LEFT JOIN (SELECT WarehouseKey, max_by(oh, SnapshotDate) AS oh FROM
     (SELECT WarehouseKey, SnapshotDate, sum(OnHandQuantity) AS oh FROM snapshot GROUP BY 1, 2) GROUP BY 1) USING (WarehouseKey)"""
CTES["po_tier"] = "SELECT f.*, SupplierTier, RegionZone, SupplierCode FROM fact_po f LEFT JOIN dim_supplier USING (SupplierKey)"
CTES["errs"] = """
SELECT ProductKey, sum(ForecastedQuantity) AS forecast, sum(BaselineStatisticalQuantity) AS baseline, sum(PlannerAdjustmentQuantity) AS adjustment,
       sum(abs(actual - ForecastedQuantity)) AS abs_error, sum(abs(actual - BaselineStatisticalQuantity)) AS baseline_error FROM aligned GROUP BY 1"""
CTES["fc_category"] = """
SELECT CategoryName, coalesce(sum(forecast), 0)::BIGINT AS forecast, coalesce(sum(baseline), 0)::BIGINT AS baseline, coalesce(sum(adjustment), 0)::BIGINT AS adjustment,
       coalesce(sum(abs_error), 0)::BIGINT AS abs_error, coalesce(sum(baseline_error), 0)::BIGINT AS baseline_error, sum(actual)::BIGINT AS actual, sum(forecast * UnitListPrice)::DOUBLE AS forecast_value
FROM (SELECT ProductKey, sum(OrderedQuantity) AS actual FROM sales_base GROUP BY 1) LEFT JOIN errs USING (ProductKey) LEFT JOIN dim_product USING (ProductKey) GROUP BY 1"""


def po_measures(key: str) -> str:
    avg = lambda c, f="": div(f"sum({c}){f}", f"count({c}){f}", None)
    done = " FILTER (POStatus = 'Completed')"
    return f"""SELECT {key}, sum(ExtendedPOAmount)::DOUBLE AS spend, sum(OrderedQuantity)::BIGINT AS ordered, sum(ReceivedQuantity)::BIGINT AS received,
        sum(RejectedQuantity)::BIGINT AS rejected, count(DISTINCT PurchaseOrderID) AS po_count, count(*) AS line_count, count(*){done} AS completed,
        count(*) FILTER (POStatus = 'Open In-Transit') AS open_lines, count(*) FILTER (POStatus = 'Overdue') AS overdue,
        {avg('PromisedLeadTimeDays')} AS avg_contract_lead_time, {avg('PromisedLeadTimeDays', done)} AS avg_contract_lead_time_completed,
        {avg('ActualLeadTimeDays')} AS avg_actual_lead_time, {avg('LeadTimeVarianceDays')} AS avg_lead_time_variance,
        sum(IsDeliveredOnTimeFlag)::BIGINT AS on_time, sum(IsDeliveredInFullFlag)::BIGINT AS in_full, sum(IsSupplierOTIFFlag)::BIGINT AS otif FROM po_tier GROUP BY 1"""


OTIF = div("otif", "completed")

SQL = {
    "sales_kpis": f"""WITH g AS (SELECT CategoryName, sum(OrderedQuantity)::BIGINT AS ordered, sum(ShippedQuantity)::BIGINT AS shipped, sum(CancelledQuantity)::BIGINT AS cancelled,
            sum(GrossSalesAmount) AS gross, sum(DiscountAmount) AS disc, sum(NetSalesAmount) AS net, sum(CostOfGoodsSold) AS cogs, count(DISTINCT SalesOrderID) AS order_count,
            count(*) AS line_count, sum(OrderLineCycleTimeDays) AS cyc FROM fact_sales GROUP BY 1),
        oh AS (SELECT CategoryName, max_by(q, SnapshotDate)::BIGINT AS on_hand FROM (SELECT CategoryName, SnapshotDate, sum(OnHandQuantity) AS q FROM snapshot GROUP BY 1, 2) GROUP BY 1),
        so AS (SELECT CategoryName, count(*) AS stockout_events FROM stockout GROUP BY 1),
        r AS (SELECT CategoryName, ordered, shipped, cancelled, gross::DOUBLE AS gross_sales, disc::DOUBLE AS discount, net::DOUBLE AS net_sales, cogs::DOUBLE AS cogs,
            (net - g.cogs)::DOUBLE AS gross_profit, {div('net - g.cogs', 'net')} AS gross_margin_pct, {div('disc', 'gross')} AS avg_discount_pct, order_count, line_count,
            {div('cyc', 'line_count')} AS avg_cycle_days, {div('shipped', '(SELECT days FROM sales_days)')} AS daily_demand, coalesce(on_hand, 0) AS on_hand,
            coalesce(stockout_events, 0) AS stockout_events FROM g LEFT JOIN oh USING (CategoryName) LEFT JOIN so USING (CategoryName)),
        c AS (SELECT *, {div('on_hand', 'daily_demand', '9999.0::DOUBLE')} AS forward_days_of_supply FROM r)
        SELECT *, CASE WHEN forward_days_of_supply > 730 THEN 'Freeze Replenishment POs & Rebalance' WHEN forward_days_of_supply > 365 THEN 'Cancel Inbound & Mark Clearance'
            WHEN stockout_events > 0 THEN 'Expedite Emergency PO' ELSE 'Monitor Run Rate' END AS recommended_action FROM c""",
    "inventory_position": f"""WITH d AS (SELECT WarehouseKey, SnapshotDate, sum(OnHandQuantity) AS oh, sum(AvailableQuantity) AS av, sum(ReservedQuantity) AS re, sum(InTransitInboundQuantity) AS ib,
            sum(InventoryValuation) AS v, count(*) AS n, count(*) FILTER (AvailableQuantity <= 0) AS o FROM snapshot GROUP BY 1, 2)
        SELECT WarehouseKey, max(SnapshotDate) AS latest_snapshot_date, max_by(oh, SnapshotDate)::BIGINT AS on_hand, max_by(av, SnapshotDate)::BIGINT AS available,
            max_by(re, SnapshotDate)::BIGINT AS reserved, max_by(ib, SnapshotDate)::BIGINT AS inbound, max_by(v, SnapshotDate)::DOUBLE AS current_valuation,
            coalesce(sum(v) FILTER (SnapshotDate >= DATE '2024-01-08'), 0)::DOUBLE AS summed_valuation,
            {div("sum(v) FILTER (SnapshotDate >= DATE '2024-01-08')", "count(*) FILTER (SnapshotDate >= DATE '2024-01-08')")} AS avg_daily_valuation,
            coalesce(sum(n) FILTER (SnapshotDate >= DATE '2024-01-08'), 0)::BIGINT AS snapshot_records, sum(n)::BIGINT AS total_rows_all_dates,
            coalesce(sum(o) FILTER (SnapshotDate >= DATE '2024-01-08'), 0)::BIGINT AS stockout_records FROM d GROUP BY 1""",
    "inventory_aging": f"""WITH d AS (SELECT CategoryName, SnapshotDate, sum(InventoryValuation) AS total, coalesce(sum(InventoryValuation) FILTER (DaysSinceLastMovement <= 60), 0) AS t1,
            coalesce(sum(InventoryValuation) FILTER (DaysSinceLastMovement > 60 AND DaysSinceLastMovement <= 120), 0) AS t2,
            coalesce(sum(InventoryValuation) FILTER (DaysSinceLastMovement > 120 AND DaysSinceLastMovement <= 180), 0) AS t3,
            coalesce(sum(InventoryValuation) FILTER (DaysSinceLastMovement > 180), 0) AS t4 FROM snapshot GROUP BY 1, 2),
        l AS (SELECT * FROM d QUALIFY SnapshotDate = max(SnapshotDate) OVER (PARTITION BY CategoryName)),
        r AS (SELECT CategoryName, total, 1 AS o, 'Healthy Active' AS t, t1 AS v FROM l UNION ALL SELECT CategoryName, total, 2, 'Slow Moving', t2 FROM l
            UNION ALL SELECT CategoryName, total, 3, 'Stagnant At-Risk', t3 FROM l UNION ALL SELECT CategoryName, total, 4, 'Dead Stock', t4 FROM l)
        SELECT CategoryName, o::BIGINT AS tier_order, t AS aging_tier, v::DOUBLE AS valuation, {div('v', 'total')} AS share FROM r""",
    "inventory_turns": """SELECT CategoryName, total_cogs::DOUBLE AS total_cogs, annualized_cogs, avg_daily_valuation, current_valuation::DOUBLE AS current_valuation, turns, dio,
        coalesce(severe_excess_valuation, 0)::DOUBLE AS severe_excess_valuation FROM turns_category LEFT JOIN severe USING (CategoryName)""",
    "storage_utilization": "SELECT * EXCLUDE (RegionKey) FROM usage",
    "velocity_tiers": """SELECT (CASE WHEN dio > 365 THEN 1 WHEN dio > 180 THEN 2 WHEN dio > 60 THEN 3 WHEN dio >= 14 THEN 4 ELSE 5 END)::BIGINT AS tier_order,
        CASE WHEN dio > 365 THEN 'Severe Excess' WHEN dio > 180 THEN 'Surplus / Slow' WHEN dio > 60 THEN 'Buffer / Seasonal' WHEN dio >= 14 THEN 'Optimal / Fast' ELSE 'Depletion Risk' END AS tier_name,
        sum(current_valuation)::DOUBLE AS capital, count(*) AS sku_count FROM turns_product GROUP BY 1, 2""",
    "warehouse_health": """SELECT WarehouseKey, StorageCapacityPallets, utilization, coalesce(dio, 0.0) AS dio,
        CASE WHEN coalesce(dio, 0.0) > 730 OR utilization > 0.90::DOUBLE THEN 'Severe Excess' WHEN coalesce(dio, 0.0) < 30 OR utilization < 0.35::DOUBLE THEN 'Depletion Risk' ELSE 'Balanced' END AS health_status
        FROM usage LEFT JOIN turns_site USING (WarehouseKey)""",
    "facility_summary": "SELECT RegionKey, count(*) AS facility_count, sum(StorageCapacityPallets)::BIGINT AS capacity_pallets, sum(on_hand)::BIGINT AS on_hand FROM usage GROUP BY 1",
    "service_levels": f"""WITH o AS (SELECT RegionKey, SalesOrderID, count(*) FILTER (OnTimeInFullFlag = 1) AS otif, count(*) FILTER (ShippedQuantity > 0 AND CancelledQuantity = 0) AS ful,
            min(OnTimeInFullFlag) AS worst, sum(OrderedQuantity) AS q, sum(ShippedQuantity) AS s, sum(CancelledQuantity) AS c FROM fact_sales LEFT JOIN dim_warehouse USING (WarehouseKey) GROUP BY 1, 2),
        g AS (SELECT RegionKey, sum(otif)::BIGINT AS otif_lines, sum(ful)::BIGINT AS fulfilled_lines, count(*) FILTER (worst = 1) AS otif_orders, count(*) AS orders, sum(q) AS q, sum(s) AS s, sum(c) AS c FROM o GROUP BY 1),
        n AS (SELECT RegionKey, count(*) AS snaps, count(*) FILTER (AvailableQuantity <= 0) AS outs FROM snapshot GROUP BY 1),
        x AS (SELECT RegionKey, count(*) AS stockout_incidents, sum(StockoutDurationDays)::BIGINT AS stockout_days, sum(EstimatedLostDemandUnits)::BIGINT AS lost_units,
            sum(EstimatedLostRevenueAmount)::DOUBLE AS lost_revenue FROM stockout JOIN dim_warehouse USING (WarehouseKey) GROUP BY 1),
        r AS (SELECT g.RegionKey, otif_lines, fulfilled_lines, {div('otif_lines', 'fulfilled_lines', None)} AS otif_rate, otif_orders, orders, {div('otif_orders', 'orders')} AS order_otif_rate,
            {div('s', 'q')} AS fill_rate, {div('q - s - c', 'q')} AS backorder_rate, {div('outs', 'snaps', None)} AS stockout_rate, stockout_incidents, stockout_days, lost_units, lost_revenue,
            0.85::DOUBLE AS otif_target, 0.002::DOUBLE AS stockout_target FROM g LEFT JOIN n USING (RegionKey) LEFT JOIN x USING (RegionKey))
        SELECT *, CASE WHEN otif_rate < 0.85::DOUBLE THEN 'High' WHEN stockout_rate > 0.001::DOUBLE THEN 'Moderate' ELSE 'Normal' END AS risk_tier FROM r""",
    "stockout_by_reason": """SELECT StockoutAttributedReason, WarehouseKey, count(*) AS incidents, sum(StockoutDurationDays)::BIGINT AS days, sum(EstimatedLostRevenueAmount)::DOUBLE AS lost_revenue
        FROM stockout GROUP BY 1, 2""",
    "stockout_top_events": """SELECT row_number() OVER (ORDER BY EstimatedLostRevenueAmount DESC, StockoutEventKey) AS event_rank, EstimatedLostRevenueAmount::DOUBLE AS lost_revenue, ProductSKU, CategoryName,
        WarehouseCode, StockoutAttributedReason, StockoutDurationDays, concat_ws(' • ', ProductSKU, CategoryName, 'Facility: ' || WarehouseCode,
            'Reason: ' || replace(StockoutAttributedReason, 'Supplier ', ''), StockoutDurationDays || 'd Outage') AS details
        FROM stockout LEFT JOIN dim_warehouse USING (WarehouseKey) QUALIFY event_rank <= 3""",
    "stockout_severity": """SELECT CASE abc_class WHEN 'A' THEN 'Critical Tier A' WHEN 'B' THEN 'Moderate Tier B' ELSE 'Low Tier C' END AS severity_tier, count(*) AS incidents,
        sum(StockoutDurationDays)::BIGINT AS days, sum(EstimatedLostRevenueAmount)::DOUBLE AS lost_revenue FROM stockout LEFT JOIN abc_labels USING (ProductKey) GROUP BY 1""",
    "procurement_kpis": f"""SELECT *, {OTIF} AS otif_rate, {div('on_time', 'completed')} AS on_time_rate, {div('in_full', 'completed')} AS in_full_rate, {div('rejected', 'received')} AS defect_rate,
        1.0::DOUBLE - {div('rejected', 'received')} AS acceptance_rate, 0.85::DOUBLE - {OTIF} AS otif_gap,
        CASE WHEN {OTIF} >= 0.85::DOUBLE THEN 'SLA Met' WHEN {OTIF} >= 0.70::DOUBLE THEN 'Watch Zone' WHEN {OTIF} >= 0.50::DOUBLE THEN 'At Risk' ELSE 'SLA Breach' END AS otif_status
        FROM ({po_measures('SupplierTier')})""",
    "procurement_by_dock_month": f"""SELECT strftime(ActualDockReceiptDate, '%Y-%m') AS dock_month, count(*) AS lines, {div('sum(LeadTimeVarianceDays)', 'count(*)')} AS avg_lead_time_variance
        FROM fact_po WHERE ActualDockReceiptDate IS NOT NULL GROUP BY 1""",
    "late_root_cause": f"""WITH g AS (SELECT CASE WHEN RegionZone = 'Overseas Inbound' AND LeadTimeVarianceDays >= 7 THEN 'Customs & Port Congestion (Overseas)'
            WHEN SupplierTier = 'Tier 3 Tactical' AND LeadTimeVarianceDays BETWEEN 3 AND 5 THEN 'Raw Material Shortage (Tier 3)'
            WHEN LeadTimeVarianceDays BETWEEN 1 AND 2 THEN 'Carrier Capacity & Freight Inefficiency' ELSE 'Other Late Delivery' END AS root_cause,
            count(*) AS late_lines, sum(ExtendedPOAmount)::DOUBLE AS spend FROM po_tier WHERE LeadTimeVarianceDays > 0 GROUP BY 1)
        SELECT *, {div('late_lines', 'sum(late_lines) OVER ()')} AS share FROM g""",
    "supplier_scorecard_summary": f"""WITH p AS (SELECT SupplierKey, count(*) AS n, sum(OTIFRatePct) AS otif, sum(AverageLeadTimeDays) AS lt, count(AverageLeadTimeDays) AS lt_n, sum(LeadTimeStdDevDays) AS sd,
            count(LeadTimeStdDevDays) AS sd_n, sum(LineFillRatePct) AS fill, count(*) FILTER (SupplierMonthlyRiskRating = 'Critical SLA Breach') AS breach FROM supplier_monthly GROUP BY 1),
        g AS (SELECT SupplierTier, count(*) AS active_suppliers, sum(n)::BIGINT AS scorecards, {rnd(div('sum(otif)', 'sum(n)'), 6)} AS avg_otif_pct, {rnd(div('sum(lt)', 'sum(lt_n)', None), 6)} AS avg_lead_time,
            {rnd(div('sum(sd)', 'sum(sd_n)', None), 6)} AS avg_lead_time_std, {rnd(div('sum(fill)', 'sum(n)'), 6)} AS avg_fill_pct, sum(breach)::BIGINT AS critical_breaches,
            CASE WHEN count(*) = 1 THEN max(VendorRiskScore) ELSE sum(VendorRiskScore) / count(*) END AS vendor_risk_score FROM p JOIN dim_supplier USING (SupplierKey) GROUP BY 1)
        SELECT *, {div('critical_breaches', 'scorecards')} AS critical_breach_pct FROM g""",
    "sla_watchlist": f"""WITH g AS (SELECT *, {OTIF} AS otif_rate FROM ({po_measures('SupplierKey')}) JOIN dim_supplier USING (SupplierKey))
        SELECT SupplierCode, SupplierTier, RegionZone, otif_rate, spend, avg_lead_time_variance, CASE WHEN otif_rate < 0.09::DOUBLE AND spend > 150000000 THEN 'Shift 30% Volume'
            WHEN otif_rate < 0.10::DOUBLE AND RegionZone = 'Overseas Inbound' THEN 'Dual-Source Mandate' WHEN otif_rate < 0.10::DOUBLE AND avg_lead_time_variance >= 4.0 THEN 'Audit SLA Breach'
            WHEN otif_rate < 0.10::DOUBLE AND avg_lead_time_variance >= 3.5 THEN 'Freeze New POs' WHEN otif_rate < 0.15::DOUBLE THEN 'Penalty Fee Apply'
            WHEN otif_rate < 0.40::DOUBLE THEN 'Improve Action Plan' ELSE 'Monitor' END AS recommended_action FROM g WHERE otif_rate < 0.15::DOUBLE""",
    "forecast_accuracy": f"""SELECT * EXCLUDE (baseline_error), {div('abs_error', 'actual')} AS wape, CASE WHEN actual > 0 THEN greatest(0.0::DOUBLE, 1.0::DOUBLE - {div('abs_error', 'actual')}) END AS accuracy,
        {div('forecast - actual', 'actual')} AS bias FROM fc_category""",
    "forecast_value_add": f"""SELECT CategoryName, {div('baseline_error', 'actual')} AS baseline_wape, {div('abs_error', 'actual')} AS consensus_wape,
        {div('baseline_error', 'actual')} - {div('abs_error', 'actual')} AS value_add FROM fc_category""",
    "forecast_exceptions": f"""WITH r AS (SELECT ProductKey, forecast::BIGINT AS forecast, actual::BIGINT AS actual, (forecast - actual)::BIGINT AS error FROM
            (SELECT ProductKey, sum(ForecastedQuantity) AS forecast FROM fact_forecast GROUP BY 1) JOIN (SELECT ProductKey, sum(OrderedQuantity) AS actual FROM sales_base GROUP BY 1) USING (ProductKey)),
        e AS ((SELECT 'under-forecast' AS exception, * FROM r WHERE error < 0 ORDER BY abs(error) DESC, ProductKey LIMIT 10)
            UNION ALL (SELECT 'over-forecast', * FROM r WHERE error > 0 ORDER BY abs(error) DESC, ProductKey LIMIT 10))
        SELECT exception, ProductSKU, CategoryName, actual, forecast, error, {div('error', 'actual')} AS error_pct FROM e LEFT JOIN dim_product USING (ProductKey)""",
    "wape_deterioration": f"""WITH m AS (SELECT ProductKey, TargetMonth AS month, {div('sum(abs(actual - ForecastedQuantity))', 'sum(actual)')} AS wape FROM aligned GROUP BY 1, 2 HAVING sum(actual) > 0),
        w AS (SELECT m.*, a.wape AS previous_wape, b.wape AS second_previous_wape FROM m
              JOIN m a ON a.ProductKey = m.ProductKey AND a.month = (m.month - INTERVAL 1 MONTH)::DATE
              JOIN m b ON b.ProductKey = m.ProductKey AND b.month = (m.month - INTERVAL 2 MONTH)::DATE)
        SELECT w.*, revenue::DOUBLE AS revenue FROM w JOIN abc_labels USING (ProductKey) WHERE abc_class = 'A' AND wape > previous_wape AND previous_wape > second_previous_wape""",
    "working_capital": f"""SELECT CategoryName, total_cogs::DOUBLE AS total_cogs, {div('total_cogs', '(SELECT days FROM sales_days)')} AS daily_cogs, annualized_cogs,
        avg_daily_valuation * 0.22::DOUBLE AS annual_carrying_cost, current_valuation::DOUBLE * 0.22::DOUBLE AS spot_carrying_cost, current_valuation::DOUBLE AS capital_in_inventory,
        dead_stock_valuation::DOUBLE AS potential_release, coalesce(severe_excess_valuation, 0)::DOUBLE AS severe_excess_valuation FROM turns_category LEFT JOIN severe USING (CategoryName)""",
    "cash_conversion_cycle": f"""WITH d AS (SELECT SnapshotDate, sum(InventoryValuation) AS v FROM snapshot GROUP BY 1), x AS (SELECT {div('sum(v)', 'count(*)')} AS av, max_by(v, SnapshotDate) AS cv FROM d),
        a AS (SELECT cv, {div('365', div(div('(SELECT sum(CostOfGoodsSold) * 365 FROM fact_sales)', '(SELECT days FROM sales_days)'), 'av'))} AS dio FROM x)
        SELECT dio, dio + 30.0::DOUBLE - 45.0::DOUBLE AS ccc_days, cost_part, rate, cv::DOUBLE * rate AS annual_cost FROM a CROSS JOIN (VALUES ('Cost of Capital', 0.105::DOUBLE),
            ('Storage & Handling', 0.045::DOUBLE), ('Obsolescence & Spoilage', 0.04::DOUBLE), ('Taxes, Insurance & Shrink', 0.03::DOUBLE)) p(cost_part, rate)""",
    "hierarchy_rollup": """SELECT CategoryName, BrandName, sum(net)::DOUBLE AS net_sales, sum(units)::BIGINT AS units, count(*) AS skus, grouping(CategoryName, BrandName)::BIGINT AS level
        FROM (SELECT ProductKey, sum(NetSalesAmount) AS net, sum(OrderedQuantity) AS units FROM fact_sales GROUP BY 1) JOIN dim_product USING (ProductKey) GROUP BY ROLLUP (CategoryName, BrandName)""",
    "calendar_rollup": """SELECT y::BIGINT AS year, q::BIGINT AS quarter, m::BIGINT AS month, sum(net)::DOUBLE AS net_sales FROM
        (SELECT year(OrderDate) AS y, quarter(OrderDate) AS q, month(OrderDate) AS m, NetSalesAmount AS net FROM fact_sales) GROUP BY ROLLUP (y, q, m)""",
    "abc_xyz_matrix": """SELECT coalesce(abc_class, 'All') AS abc_class, coalesce(xyz_class, 'All') AS xyz_class, count(*) AS skus, sum(revenue)::DOUBLE AS revenue, sum(demand)::BIGINT AS units,
        'TIER ' || coalesce(abc_class, '*') || coalesce(xyz_class, '*') AS badge
        FROM (SELECT a.abc_class AS abc_class, x.xyz_class AS xyz_class, revenue, demand FROM abc_labels a JOIN xyz_labels x USING (ProductKey)) GROUP BY CUBE (abc_class, xyz_class)""",
    "aging_brackets": """SELECT CategoryName, CASE WHEN DaysSinceLastMovement <= 30 THEN '0-30' WHEN DaysSinceLastMovement <= 60 THEN '31-60' WHEN DaysSinceLastMovement <= 90 THEN '61-90'
        WHEN DaysSinceLastMovement <= 180 THEN '91-180' ELSE '180+' END AS bracket, count(*) AS positions, sum(OnHandQuantity)::BIGINT AS units, sum(InventoryValuation)::DOUBLE AS valuation
        FROM snapshot WHERE SnapshotDate = (SELECT max(day) FROM flow) GROUP BY 1, 2""",
    "turns_doi_reconcile": "SELECT CategoryName, turns, dio, abs(turns * dio - 365) < 0.001 OR turns = 0 AS reconciles FROM turns_category",
}
