"""Statements for tidewater.plans.semantic."""

from .base import CTES, Z, div, std

CTES["order_calendar"] = """
SELECT unnest(generate_series((SELECT first_day FROM sales_days), (SELECT last_day FROM sales_days), INTERVAL 1 DAY))::DATE AS FullDate"""
CTES["sales_places"] = """
SELECT s.*, RegionKey, ChannelName, year(OrderDate) AS y FROM fact_sales s LEFT JOIN dim_warehouse USING (WarehouseKey) LEFT JOIN dim_channel USING (CustomerChannelKey)"""
CTES["po_places"] = """
SELECT p.*, CategoryName, RegionKey, SupplierTier, RegionZone, year(POCreationDate) AS y FROM fact_po p LEFT JOIN dim_product USING (ProductKey)
LEFT JOIN dim_warehouse ON ReceivingWarehouseKey = WarehouseKey LEFT JOIN dim_supplier USING (SupplierKey)"""
CTES["forecast_places"] = """
SELECT a.*, CategoryName, RegionKey, year(TargetMonth) AS y, abs(actual - ForecastedQuantity) AS err FROM aligned a LEFT JOIN dim_product USING (ProductKey) LEFT JOIN dim_warehouse USING (WarehouseKey)"""
TOTAL_DAYS = "(SELECT days FROM sales_days)"


def per_day(keys: str) -> str:
    """Deviation of the daily shipped units over days that have sales."""
    return f"""SELECT {keys}, {std('count(*)', 'sum(u)', 'sum(u * u)')} AS sd FROM
        (SELECT {keys}, OrderDate, sum(ShippedQuantity)::BIGINT AS u FROM sales_places GROUP BY ALL) GROUP BY ALL"""


def policy(z: str, lead: str = "lead") -> str:
    return f"""floor(({z}) * sqrt(greatest(1.0::DOUBLE, {lead} * coalesce(sd, d * 0.25::DOUBLE) * coalesce(sd, d * 0.25::DOUBLE) + d * d * coalesce(lsd, 2.0::DOUBLE) * coalesce(lsd, 2.0::DOUBLE))) + 0.5::DOUBLE)::BIGINT"""


LEADS = f"avg(ActualLeadTimeDays) AS lead, {std('count(ActualLeadTimeDays)', 'sum(ActualLeadTimeDays)', 'sum(ActualLeadTimeDays * ActualLeadTimeDays)')} AS lsd"

SQL = {
    "semantic_measures": f"""WITH s AS (SELECT RegionKey, CategoryName, sum(NetSalesAmount) AS net, sum(CostOfGoodsSold) AS cogs, sum(ShippedQuantity) AS sh, sum(OrderedQuantity) AS q,
            sum(OnTimeInFullFlag) AS o, count(*) FILTER (ShippedQuantity > 0 AND CancelledQuantity = 0) AS f FROM fact_sales LEFT JOIN dim_warehouse USING (WarehouseKey) GROUP BY 1, 2),
        p AS (SELECT RegionKey, CategoryName, sum(ExtendedPOAmount) AS spend, sum(RejectedQuantity) AS rej, sum(ReceivedQuantity) AS rec, sum(IsSupplierOTIFFlag) AS po, count(*) FILTER (POStatus = 'Completed') AS done
            FROM fact_po LEFT JOIN dim_product USING (ProductKey) LEFT JOIN dim_warehouse ON ReceivingWarehouseKey = WarehouseKey GROUP BY 1, 2),
        x AS (SELECT RegionKey, CategoryName, count(*) AS n, sum(EstimatedLostRevenueAmount) AS r FROM stockout LEFT JOIN dim_warehouse USING (WarehouseKey) GROUP BY 1, 2)
        SELECT RegionKey, CategoryName, net::DOUBLE AS net_sales, {div('cogs', 'net')} AS cogs_pct, {div('sh', 'q')} AS fill_rate, {div('o', 'f', None)} AS otif_rate, spend::DOUBLE AS po_spend,
            {div('rej', 'rec')} AS defect_rate, {div('po', 'done')} AS po_otif_rate, n AS stockout_incidents, r::DOUBLE AS lost_revenue
        FROM s FULL JOIN p USING (RegionKey, CategoryName) FULL JOIN x USING (RegionKey, CategoryName)""",
    "semantic_by_dock_month": f"""SELECT strftime(ActualDockReceiptDate, '%Y-%m') AS MonthYear, SupplierTier, count(*) AS po_lines, sum(ReceivedQuantity)::BIGINT AS po_received_units,
        {div('sum(IsSupplierOTIFFlag)', "count(*) FILTER (POStatus = 'Completed')")} AS po_otif_rate
        FROM fact_po LEFT JOIN dim_supplier USING (SupplierKey) JOIN dim_warehouse ON ReceivingWarehouseKey = WarehouseKey WHERE RegionKey IN (0, 1) GROUP BY 1, 2""",
    "served_returns_view": "SELECT OriginalOrderDate, ReturnDate, ReturnedQuantity, RestockedQuantity, ScrappedQuantity FROM returns",
    "context_stock_by_region_month": f"""WITH s AS (SELECT RegionKey, strftime(SnapshotDate, '%Y-%m') AS MonthYear, SnapshotDate AS d, sum(OnHandQuantity) AS oh, sum(AvailableQuantity) AS av, sum(InventoryValuation) AS v,
            coalesce(sum(InventoryValuation) FILTER (DaysSinceLastMovement > 180), 0) AS dead, coalesce(sum(InventoryValuation) FILTER (DaysSinceLastMovement <= 60), 0) AS fresh,
            count(*) AS n, count(*) FILTER (AvailableQuantity <= 0) AS o FROM snapshot GROUP BY 1, 2, 3),
        g AS (SELECT RegionKey, MonthYear, arg_max(oh, d) AS oh, arg_max(av, d) AS av, arg_max(v, d) AS v, sum(v) AS sv, count(*) AS days, max(d) AS last, sum(n) AS n, sum(o) AS o, arg_max(dead, d) AS dead, arg_max(fresh, d) AS fresh FROM s GROUP BY 1, 2),
        w AS (SELECT RegionKey, count(*) AS f, sum(StorageCapacityPallets) AS c FROM dim_warehouse GROUP BY 1)
        SELECT RegionKey, MonthYear, oh::BIGINT AS on_hand, av::BIGINT AS available, v::DOUBLE AS valuation, sv::DOUBLE / days AS avg_daily_valuation, last AS latest_snapshot, n::BIGINT AS snapshot_records,
            (sum(n) OVER (PARTITION BY RegionKey))::BIGINT AS total_snapshot_rows, o::BIGINT AS stockout_records, dead::DOUBLE AS dead_valuation, fresh::DOUBLE AS healthy_valuation, f AS facilities,
            c::BIGINT AS capacity_pallets, {div('oh::DOUBLE / 350', 'c')} AS utilization FROM g LEFT JOIN w USING (RegionKey)""",
    "context_capital_by_category": f"""WITH p AS (SELECT ProductKey, any_value(CategoryName) AS CategoryName, sum(InventoryValuation) AS sv, count(*) AS days, arg_max(InventoryValuation, SnapshotDate) AS v
              FROM (SELECT ProductKey, CategoryName, SnapshotDate, sum(InventoryValuation) AS InventoryValuation FROM snapshot GROUP BY ALL) GROUP BY 1),
        pc AS (SELECT ProductKey, sum(CostOfGoodsSold) AS c FROM fact_sales GROUP BY 1),
        heavy AS (SELECT CategoryName, sum(v) AS v, count(*) AS n FROM p JOIN pc USING (ProductKey)
              WHERE {div('365', div(f"(c * 365)::DOUBLE / {TOTAL_DAYS}", 'sv::DOUBLE / days'))} > 365 GROUP BY 1),
        k AS (SELECT CategoryName, sum(v) AS sv, count(*) AS days, arg_max(v, d) AS v, arg_max(oh, d) AS oh, arg_max(dead, d) AS dead, arg_max(slow, d) AS slow, arg_max(stag, d) AS stag
              FROM (SELECT CategoryName, SnapshotDate AS d, sum(InventoryValuation) AS v, sum(OnHandQuantity) AS oh, coalesce(sum(InventoryValuation) FILTER (DaysSinceLastMovement > 180), 0) AS dead,
                      coalesce(sum(InventoryValuation) FILTER (DaysSinceLastMovement > 60 AND DaysSinceLastMovement <= 120), 0) AS slow,
                      coalesce(sum(InventoryValuation) FILTER (DaysSinceLastMovement > 120 AND DaysSinceLastMovement <= 180), 0) AS stag FROM snapshot GROUP BY 1, 2) GROUP BY 1),
        c AS (SELECT CategoryName, sum(CostOfGoodsSold) AS c, sum(ShippedQuantity) AS u FROM fact_sales GROUP BY 1),
        d AS (SELECT CategoryName, count(DISTINCT ProductSKU) AS skus FROM dim_product GROUP BY 1),
        j AS (SELECT *, (c * 365)::DOUBLE / {TOTAL_DAYS} AS annual, sv::DOUBLE / days AS a FROM d LEFT JOIN k USING (CategoryName) LEFT JOIN c USING (CategoryName))
        SELECT CategoryName, c::DOUBLE AS cogs, annual AS annualized_cogs, {div('c', TOTAL_DAYS)} AS daily_cogs, {div('annual', 'a')} AS turns, {div('365', div('annual', 'a'))} AS dio,
            a * (22.0::DOUBLE / 100.0::DOUBLE) AS carrying_cost, heavy.v::DOUBLE AS severe_excess, heavy.n AS severe_excess_skus, {div('dead', 'j.v')} AS dead_pct, slow::DOUBLE AS slow_valuation, stag::DOUBLE AS stagnant_valuation,
            {div('oh', div('u', TOTAL_DAYS), '9999.0::DOUBLE')} AS cover_days, skus AS active_skus FROM j LEFT JOIN heavy USING (CategoryName)""",
    "context_sales_by_channel_year": f"""WITH o AS (SELECT ChannelName, y, SalesOrderID, min(OnTimeInFullFlag) AS worst FROM sales_places GROUP BY ALL),
        w AS (SELECT ChannelName, y, count(*) AS orders, count(*) FILTER (worst = 1) AS good FROM o GROUP BY 1, 2),
        k AS (SELECT year(FullDate) AS y, count(*) AS days FROM order_calendar GROUP BY 1),
        g AS (SELECT ChannelName, y, count(*) AS n, sum(NetSalesAmount) AS net, sum(CostOfGoodsSold) AS c, avg(OrderLineCycleTimeDays) AS cyc, sum(OnTimeInFullFlag) AS otif,
              count(*) FILTER (ShippedQuantity > 0 AND CancelledQuantity = 0) AS ful, sum(ShippedQuantity) AS u FROM sales_places GROUP BY 1, 2)
        SELECT ChannelName, y AS YearNumber, orders AS sales_orders, n AS sales_lines, (net - c)::DOUBLE AS gross_profit, {div('net - c', 'net')} AS margin_pct, cyc AS cycle_time_days,
            {div('good', 'orders')} AS order_otif_rate, {div('otif', 'ful', None)} AS otif_rate, {div('u', 'days')} AS daily_demand, {div('u', TOTAL_DAYS)} AS avg_daily_units
        FROM g JOIN w USING (ChannelName, y) JOIN k USING (y)""",
    "context_planning_by_category_region": f"""WITH s AS (SELECT CategoryName, RegionKey, sum(OrderedQuantity) AS q, sum(ShippedQuantity) AS u, sum(OnTimeInFullFlag) AS otif, count(*) FILTER (ShippedQuantity > 0 AND CancelledQuantity = 0) AS ful FROM sales_places GROUP BY 1, 2),
        f AS (SELECT CategoryName, RegionKey, sum(ForecastedQuantity) AS f, sum(err) AS e FROM forecast_places GROUP BY 1, 2),
        l AS (SELECT CategoryName, RegionKey, {LEADS} FROM po_places GROUP BY 1, 2), v AS ({per_day('CategoryName, RegionKey')}),
        o AS (SELECT CategoryName, RegionKey, count(*) FILTER (AvailableQuantity <= 0)::DOUBLE / count(*) AS r FROM snapshot GROUP BY 1, 2),
        j AS (SELECT *, {div('u', TOTAL_DAYS)} AS d, coalesce(lead, 14.0::DOUBLE) AS t FROM s FULL JOIN f USING (CategoryName, RegionKey) FULL JOIN l USING (CategoryName, RegionKey) FULL JOIN v USING (CategoryName, RegionKey) FULL JOIN o USING (CategoryName, RegionKey))
        SELECT CategoryName, RegionKey, f::BIGINT AS forecast_units, e::BIGINT AS forecast_error, {div('e', 'q')} AS wape, CASE WHEN q > 0 THEN greatest(0.0::DOUBLE, 1 - {div('e', 'q')}) END AS forecast_accuracy,
            {div('f - q', 'q')} AS forecast_bias, floor(d * t + 0.5::DOUBLE)::BIGINT AS lead_time_demand, {policy('1.65::DOUBLE', 't')} AS safety_stock, floor(d * t + 0.5::DOUBLE)::BIGINT + {policy('1.65::DOUBLE', 't')} AS reorder_point,
            CASE WHEN {div('otif', 'ful', None)} < 0.85 THEN 'High' WHEN r > 0.001 THEN 'Moderate' ELSE 'Normal' END AS risk_tier FROM j""",
    "context_orders_in_two_regions": f"""WITH s AS (SELECT y, sum(OrderedQuantity) AS q, count(DISTINCT SalesOrderID) AS orders, sum(NetSalesAmount) AS net, sum(CostOfGoodsSold) AS c FROM sales_places WHERE RegionKey IN (1, 3) GROUP BY 1),
        w AS (SELECT y, count(*) FILTER (worst = 1) AS good FROM (SELECT y, SalesOrderID, min(OnTimeInFullFlag) AS worst FROM sales_places WHERE RegionKey IN (1, 3) GROUP BY 1, 2) GROUP BY 1),
        f AS (SELECT y, sum(err) AS e FROM forecast_places WHERE RegionKey IN (1, 3) GROUP BY 1),
        o AS (SELECT year(StartDate) AS y, sum(EstimatedLostRevenueAmount) AS r, max(EstimatedLostRevenueAmount) AS top FROM stockout LEFT JOIN dim_warehouse USING (WarehouseKey) WHERE RegionKey IN (1, 3) GROUP BY 1),
        p AS (SELECT year(SnapshotDate) AS y, count(*) FILTER (AvailableQuantity <= 0)::DOUBLE / count(*) AS r FROM snapshot WHERE RegionKey IN (1, 3) GROUP BY 1)
        SELECT y AS YearNumber, e::BIGINT AS forecast_error, {div('e', 'q')} AS wape, orders AS sales_orders, {div('net - c', 'net')} AS margin_pct, {div('good', 'orders')} AS order_otif_rate, o.r::DOUBLE AS lost_revenue,
            top::DOUBLE AS top_lost_revenue, p.r AS stockout_rate FROM s FULL JOIN w USING (y) FULL JOIN f USING (y) FULL JOIN o USING (y) FULL JOIN p USING (y)""",
    "context_supply_by_tier": f"""WITH p AS (SELECT SupplierTier, count(DISTINCT PurchaseOrderID) AS po, count(*) AS n, count(*) FILTER (POStatus = 'Overdue') AS od, avg(PromisedLeadTimeDays) AS pl, avg(LeadTimeVarianceDays) AS lv, {LEADS} FROM po_places GROUP BY ALL),
        m AS (SELECT SupplierTier, count(DISTINCT SupplierKey) AS a, sum(OTIFRatePct::DECIMAL(28,10))::DOUBLE / count(*) AS r, count(*) FILTER (SupplierMonthlyRiskRating = 'Critical SLA Breach')::DOUBLE / count(*) AS b
              FROM supplier_monthly JOIN dim_supplier USING (SupplierKey) GROUP BY ALL)
        SELECT SupplierTier, po AS po_orders, od AS po_overdue_lines, pl AS contract_lead_time, lead AS actual_lead_time, lsd AS lead_time_deviation, lv AS lead_time_variance, a AS active_suppliers, r AS scorecard_otif, b AS critical_breach_pct FROM p FULL JOIN m USING (SupplierTier)""",
    "context_supply_by_zone_year": f"""WITH p AS (SELECT RegionZone, y, count(DISTINCT PurchaseOrderID) AS po, count(*) AS n, count(*) FILTER (POStatus = 'Overdue') AS od, avg(PromisedLeadTimeDays) AS pl, avg(LeadTimeVarianceDays) AS lv, {LEADS} FROM po_places GROUP BY ALL),
        m AS (SELECT RegionZone, year(YearMonthDate) AS y, count(DISTINCT SupplierKey) AS a, sum(OTIFRatePct::DECIMAL(28,10))::DOUBLE / count(*) AS r, count(*) FILTER (SupplierMonthlyRiskRating = 'Critical SLA Breach')::DOUBLE / count(*) AS b
              FROM supplier_monthly JOIN dim_supplier USING (SupplierKey) GROUP BY ALL)
        SELECT RegionZone, y AS YearNumber, po AS po_orders, n AS po_lines, lead AS actual_lead_time, lsd AS lead_time_deviation, a AS active_suppliers, r AS scorecard_otif, b AS critical_breach_pct FROM p FULL JOIN m USING (RegionZone, y)""",
    "context_outages_by_category_month": """WITH o AS (SELECT CategoryName, strftime(StartDate, '%Y-%m') AS MonthYear, count(*) AS n, sum(StockoutDurationDays) AS d, sum(EstimatedLostRevenueAmount) AS r, max(EstimatedLostRevenueAmount) AS t FROM stockout GROUP BY 1, 2),
        p AS (SELECT CategoryName, strftime(SnapshotDate, '%Y-%m') AS MonthYear, count(*) FILTER (AvailableQuantity <= 0)::DOUBLE / count(*) AS rate FROM snapshot GROUP BY 1, 2)
        SELECT CategoryName, MonthYear, n AS stockout_incidents, d::BIGINT AS stockout_days, r::DOUBLE AS lost_revenue, t::DOUBLE AS top_lost_revenue, rate AS stockout_rate FROM o FULL JOIN p USING (CategoryName, MonthYear)""",
    "context_scenarios_by_region": f"""WITH s AS (SELECT RegionKey, sum(OrderedQuantity) AS q, sum(ShippedQuantity) AS u FROM sales_places GROUP BY 1), l AS (SELECT RegionKey, {LEADS} FROM po_places GROUP BY 1), v AS ({per_day('RegionKey')}),
        k AS (SELECT RegionKey, sum(v)::DOUBLE / count(*) AS a FROM (SELECT RegionKey, SnapshotDate, sum(InventoryValuation) AS v FROM snapshot GROUP BY 1, 2) GROUP BY 1),
        j AS (SELECT *, {div('u', TOTAL_DAYS)} AS d, coalesce(lead, 14.0::DOUBLE) AS t FROM s FULL JOIN l USING (RegionKey) FULL JOIN v USING (RegionKey) FULL JOIN k USING (RegionKey))
        SELECT ScenarioCode, RegionKey, q::DOUBLE * mult AS simulated_demand, floor({div('q', TOTAL_DAYS)} * mult * (t + shock) + 0.5::DOUBLE)::BIGINT AS simulated_lead_time_demand, {policy(Z.format('level'), 't')} AS safety_stock,
            a * (rate / 100.0::DOUBLE) AS carrying_cost FROM j CROSS JOIN scenarios""",
    "context_scenarios": f"""WITH s AS (SELECT sum(OrderedQuantity) AS q, sum(CostOfGoodsSold) AS c FROM fact_sales), l AS (SELECT avg(ActualLeadTimeDays) AS t FROM fact_po),
        k AS (SELECT sum(v)::DOUBLE / count(*) AS a FROM (SELECT SnapshotDate, sum(InventoryValuation) AS v FROM snapshot GROUP BY 1))
        SELECT ScenarioCode, q::DOUBLE * mult AS simulated_demand, floor({div('q', TOTAL_DAYS)} * mult * (t + shock) + 0.5::DOUBLE)::BIGINT AS simulated_lead_time_demand, rate AS carrying_rate,
            {div(f"(c * 365)::DOUBLE / {TOTAL_DAYS}", 'a')} AS turns FROM s CROSS JOIN l CROSS JOIN k CROSS JOIN scenarios WHERE ScenarioCode IN ('SCN-BASE', 'SCN-STRESS')""",
    "served_sales_view": """SELECT SalesOrderID, l_linenumber::BIGINT AS SalesOrderLineNumber, OrderDate, ShipDate, DeliveryDate, OrderedQuantity, CancelledQuantity, ShippedQuantity, UnitStandardCost::DOUBLE AS UnitStandardCost,
        CategoryName, GrossSalesAmount::DOUBLE AS GrossSalesAmount, DiscountAmount::DOUBLE AS DiscountAmount, NetSalesAmount::DOUBLE AS NetSalesAmount, CostOfGoodsSold::DOUBLE AS CostOfGoodsSold, OrderLineCycleTimeDays FROM fact_sales""",
    "served_purchase_view": """SELECT PurchaseOrderID, POStatus, POCreationDate, PromisedDeliveryDate, ActualDockReceiptDate, OrderedQuantity, ReceivedQuantity::BIGINT AS ReceivedQuantity, RejectedQuantity::BIGINT AS RejectedQuantity,
        ExtendedPOAmount::DOUBLE AS ExtendedPOAmount, PromisedLeadTimeDays::BIGINT AS PromisedLeadTimeDays, ActualLeadTimeDays::BIGINT AS ActualLeadTimeDays, LeadTimeVarianceDays::BIGINT AS LeadTimeVarianceDays FROM fact_po""",
    "served_forecast_view": """SELECT (TargetMonth - INTERVAL 1 MONTH)::DATE AS ForecastGeneratedDate, TargetMonth, BaselineStatisticalQuantity, PlannerAdjustmentQuantity::BIGINT AS PlannerAdjustmentQuantity,
        ForecastedQuantity::BIGINT AS ForecastedQuantity, (ForecastedQuantity * UnitListPrice)::DOUBLE AS ForecastValue FROM fact_forecast LEFT JOIN dim_product USING (ProductKey)""",
    "served_movement_view": "SELECT day AS MovementDate, event_type AS MovementType, quantity_change::BIGINT AS MovementQuantity FROM moves",
    "served_snapshot_view": """SELECT SnapshotDate, OnHandQuantity::BIGINT AS OnHandQuantity, ReservedQuantity::BIGINT AS ReservedQuantity, AvailableQuantity::BIGINT AS AvailableQuantity, DaysSinceLastMovement::BIGINT AS DaysSinceLastMovement,
        UnitLandedCost::DOUBLE AS UnitLandedCost, CategoryName, InventoryValuation::DOUBLE AS InventoryValuation, InTransitInboundQuantity::BIGINT AS InTransitInboundQuantity FROM snapshot""",
    "served_stockout_view": """SELECT StartDate, EndDate, StockoutDurationDays, EstimatedLostDemandUnits::BIGINT AS EstimatedLostDemandUnits, EstimatedLostRevenueAmount::DOUBLE AS EstimatedLostRevenueAmount, StockoutAttributedReason FROM stockout""",
    "served_scorecard_view": "SELECT * EXCLUDE (lt_n, lt_sum, lt_sq, SupplierKey, SupplierMonthlyKey, YearMonthDateKey) FROM supplier_monthly",
}


def velocity(group: str, where: str) -> str:
    """Capital and products per tier: (group, c1, n1, ... c5, n5)."""
    bands = ["dio > 365", "dio > 180 AND dio <= 365", "dio > 60 AND dio <= 180", "dio >= 14 AND dio <= 60", "dio < 14"]
    tiers = ", ".join(f"sum(v) FILTER ({b})::DOUBLE AS tier_{k}_capital, nullif(count(v) FILTER ({b}), 0) AS tier_{k}_skus" for k, b in enumerate(bands, 1))
    return f"""SELECT {group}, {tiers} FROM (
        SELECT {group}, v, {div('365', div(f"(c * 365)::DOUBLE / {TOTAL_DAYS}", 'a'))} AS dio
        FROM (SELECT {group}, ProductKey, sum(q)::DOUBLE / count(*) AS a, arg_max(q, d) AS v
              FROM (SELECT {group}, ProductKey, SnapshotDate AS d, sum(InventoryValuation) AS q FROM snapshot WHERE {where} GROUP BY ALL) GROUP BY ALL)
        LEFT JOIN (SELECT {group}, ProductKey, sum(CostOfGoodsSold) AS c FROM sales_places WHERE {where} GROUP BY ALL) USING ({group}, ProductKey)) GROUP BY 1"""


SQL["context_velocity_by_region"] = f"""WITH t AS ({velocity('RegionKey', 'true')}), w AS (SELECT RegionKey, count(*) AS f, sum(StorageCapacityPallets) AS cap FROM dim_warehouse GROUP BY 1),
    k AS (SELECT RegionKey, sum(v)::DOUBLE / count(*) AS a, arg_max(oh, d) AS oh FROM (SELECT RegionKey, SnapshotDate AS d, sum(InventoryValuation) AS v, sum(OnHandQuantity) AS oh FROM snapshot GROUP BY 1, 2) GROUP BY 1),
    c AS (SELECT RegionKey, sum(CostOfGoodsSold) AS c FROM sales_places GROUP BY 1)
    SELECT t.*, f AS facilities, {div(div('oh', '350'), 'cap')} AS utilization, {div(f"(c * 365)::DOUBLE / {TOTAL_DAYS}", 'a')} AS turns
    FROM w LEFT JOIN t USING (RegionKey) LEFT JOIN k USING (RegionKey) LEFT JOIN c USING (RegionKey)"""
SQL["context_velocity_by_region"] = SQL["context_velocity_by_region"].replace("SELECT t.*, f AS", "SELECT w.RegionKey, t.* EXCLUDE (RegionKey), f AS")
SQL["context_velocity_by_category"] = f"""WITH t AS ({velocity('CategoryName', 'RegionKey IN (0, 2)')}), d AS (SELECT CategoryName, count(DISTINCT ProductSKU) AS s FROM dim_product GROUP BY 1),
    k AS (SELECT CategoryName, arg_max(dead, d) AS dead FROM (SELECT CategoryName, SnapshotDate AS d, coalesce(sum(InventoryValuation) FILTER (DaysSinceLastMovement > 180), 0) AS dead
          FROM snapshot WHERE RegionKey IN (0, 2) GROUP BY 1, 2) GROUP BY 1)
    SELECT d.CategoryName, t.* EXCLUDE (CategoryName), s AS active_skus, dead::DOUBLE AS dead_valuation FROM d LEFT JOIN t USING (CategoryName) LEFT JOIN k USING (CategoryName)"""
