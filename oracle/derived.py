"""Statements for tidewater.plans.derived."""

from .base import CTES, div, dkey, std

CTES["abc"] = f"""
SELECT ProductKey, revenue, {div('sum(revenue) OVER (ORDER BY revenue DESC)', 'sum(revenue) OVER ()')} AS cumulative_share
FROM (SELECT ProductKey, sum(NetSalesAmount) AS revenue FROM fact_sales GROUP BY 1)"""
CTES["abc_labels"] = """
SELECT *, CASE WHEN cumulative_share <= 0.75::DOUBLE THEN 'A' WHEN cumulative_share <= 0.95::DOUBLE THEN 'B' ELSE 'C' END AS abc_class FROM abc"""
CTES["xyz"] = f"""
SELECT ProductKey, demand::BIGINT AS demand, {div(std('days', 'demand', 'demand_sq'), div('demand', 'days'), None)} AS cv
FROM (SELECT ProductKey, sum(q) AS demand, sum(q * q) AS demand_sq FROM
        (SELECT ProductKey, OrderDate, sum(OrderedQuantity)::BIGINT AS q FROM sales_base GROUP BY 1, 2) GROUP BY 1) CROSS JOIN sales_days"""
CTES["xyz_labels"] = """
SELECT *, CASE WHEN cv < 0.25::DOUBLE THEN 'X' WHEN cv < 0.75::DOUBLE THEN 'Y' ELSE 'Z' END AS xyz_class FROM xyz"""
CTES["prio"] = """
SELECT o_custkey AS CustomerKey, o_orderdate::DATE AS d, o_orderpriority AS p FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate::DATE ORDER BY o_orderkey DESC) = 1"""


def scd2(source: str) -> str:
    return f"""SELECT CustomerKey, p AS ServicePriority, d AS EffectiveFrom, coalesce(lead(d) OVER w, DATE '9999-12-31') AS EffectiveTo, lead(d) OVER w IS NULL AS IsCurrent
        FROM (SELECT * FROM {source} QUALIFY lag(p) OVER (PARTITION BY CustomerKey ORDER BY d) IS DISTINCT FROM p)
        WINDOW w AS (PARTITION BY CustomerKey ORDER BY d)"""


SQL = {
    "inventory_balance": "SELECT ProductKey, WarehouseKey, day, net_flow, balance::BIGINT AS balance FROM balance",
    "daily_snapshot": """SELECT SnapshotDate, ProductKey, WarehouseKey, OnHandQuantity::BIGINT AS OnHandQuantity, ReservedQuantity::BIGINT AS ReservedQuantity,
        AvailableQuantity::BIGINT AS AvailableQuantity, DaysSinceLastMovement, UnitLandedCost::DOUBLE AS UnitLandedCost, InventoryValuation::DOUBLE AS InventoryValuation,
        (CASE WHEN AvailableQuantity <= 0 THEN 1 ELSE 0 END)::BIGINT AS IsStockoutFlag FROM snapshot""",
    "stockout_episodes": "SELECT ProductKey, WarehouseKey, StartDate, EndDate, StockoutDurationDays FROM episodes",
    "lost_demand": """SELECT StockoutEventKey, ProductKey, WarehouseKey, StartDate, StockoutDurationDays, EstimatedLostDemandUnits::BIGINT AS EstimatedLostDemandUnits,
        EstimatedLostRevenueAmount::DOUBLE AS EstimatedLostRevenueAmount, StockoutAttributedReason FROM stockout""",
    "supplier_scorecard_monthly": "SELECT * EXCLUDE (lt_n, lt_sum, lt_sq) FROM supplier_monthly",
    "abc_class": "SELECT ProductKey, revenue::DOUBLE AS revenue, cumulative_share, abc_class FROM abc_labels",
    "xyz_class": "SELECT * FROM xyz_labels",
    "abc_transition": f"""WITH r AS (SELECT ProductKey, date_trunc('quarter', OrderDate)::DATE AS quarter, sum(NetSalesAmount) AS revenue FROM fact_sales GROUP BY 1, 2),
        s AS (SELECT *, {div('sum(revenue) OVER (PARTITION BY quarter ORDER BY revenue DESC)', 'sum(revenue) OVER (PARTITION BY quarter)')} AS share FROM r),
        c AS (SELECT *, CASE WHEN share <= 0.75::DOUBLE THEN 'A' WHEN share <= 0.95::DOUBLE THEN 'B' ELSE 'C' END AS abc_class FROM s)
        SELECT c.quarter, coalesce(p.abc_class, 'NEW') AS previous_class, c.abc_class, count(*) AS skus, sum(c.revenue)::DOUBLE AS revenue
        FROM c LEFT JOIN c p ON p.ProductKey = c.ProductKey AND p.quarter = (c.quarter - INTERVAL 3 MONTH)::DATE GROUP BY 1, 2, 3""",
    "scd2_build": scd2("prio"),
    "scd2_late_changes": scd2("prio"),
    "scorecard_increments": "SELECT * EXCLUDE (lt_n, lt_sum, lt_sq) FROM supplier_monthly",
    "scd2_apply": f"""WITH dim AS ({scd2("(SELECT * FROM prio WHERE d < DATE '2000-01-01')")}),
        inc AS (SELECT CustomerKey, p FROM prio WHERE d >= DATE '2000-01-01' QUALIFY row_number() OVER (PARTITION BY CustomerKey ORDER BY d DESC) = 1)
        SELECT d.CustomerKey, ServicePriority, EffectiveFrom, CASE WHEN IsCurrent AND i.p IS NOT NULL AND i.p <> ServicePriority THEN DATE '2000-01-01' ELSE EffectiveTo END AS EffectiveTo,
               IsCurrent AND NOT coalesce(i.p <> ServicePriority, false) AS IsCurrent FROM dim d LEFT JOIN inc i USING (CustomerKey)
        UNION ALL SELECT i.CustomerKey, i.p, DATE '2000-01-01', DATE '9999-12-31', true FROM inc i LEFT JOIN (SELECT * FROM dim WHERE IsCurrent) d USING (CustomerKey)
        WHERE d.CustomerKey IS NULL OR d.ServicePriority <> i.p""",
    "dim_date": f"""SELECT {dkey('d')} AS DateKey, d AS FullDate, dayofweek(d)::BIGINT + 1 AS DayOfWeek, dayname(d) AS DayName, day(d)::BIGINT AS DayOfMonth, dayofyear(d)::BIGINT AS DayOfYear,
        weekofyear(d)::BIGINT AS WeekOfYear, month(d)::BIGINT AS MonthNumber, monthname(d) AS MonthName, strftime(d, '%Y-%m') AS MonthYear, quarter(d)::BIGINT AS QuarterNumber,
        'Q' || quarter(d) AS QuarterName, year(d)::BIGINT AS YearNumber, ((month(d) + 5) % 12 + 1)::BIGINT AS FiscalMonthNumber,
        'FQ' || ((month(d) + 5) % 12 // 3 + 1) AS FiscalQuarter, (year(d) + CASE WHEN month(d) >= 7 THEN 1 ELSE 0 END)::BIGINT AS FiscalYear,
        dayofweek(d) BETWEEN 1 AND 5 AS IsWeekday, strftime(d, '%m-%d') IN ('01-01', '07-04', '12-25') AS IsHoliday,
        CASE WHEN month(d) >= 11 THEN 'Peak Holiday' WHEN month(d) IN (8, 9) THEN 'Back-to-School' WHEN month(d) IN (6, 7) THEN 'Summer Low' ELSE 'Normal' END AS SeasonalityPeriod
        FROM (SELECT unnest(generate_series(first_day, last_day, INTERVAL 1 DAY))::DATE AS d FROM calendar_days)""",
    "monthly_trend": f"""WITH d AS (SELECT OrderDate, sum(NetSalesAmount) AS net FROM fact_sales GROUP BY 1),
        t AS (SELECT *, (sum(net) OVER (ORDER BY OrderDate RANGE BETWEEN INTERVAL 29 DAYS PRECEDING AND CURRENT ROW))::DOUBLE / 30.0::DOUBLE AS t30 FROM d),
        m AS (SELECT date_trunc('month', OrderDate)::DATE AS m, sum(net)::DOUBLE AS net_sales, max_by(t30, OrderDate) AS t30 FROM t GROUP BY 1),
        v AS (SELECT date_trunc('month', SnapshotDate)::DATE AS m, sum(v)::DOUBLE / count(*) AS avg_daily_valuation FROM
              (SELECT SnapshotDate, sum(InventoryValuation) AS v FROM snapshot GROUP BY 1) GROUP BY 1),
        b AS (SELECT m, net_sales, t30, avg_daily_valuation, lag(net_sales) OVER (ORDER BY m) AS prev FROM m FULL JOIN v USING (m))
        SELECT strftime(m, '%Y-%m') AS month, net_sales, prev AS previous_net_sales, {div('net_sales - prev', 'prev', None)} AS net_sales_change,
               t30 AS trailing_30d_daily_net, avg_daily_valuation FROM b""",
    "share_of_total": f"""WITH n AS (SELECT 'region' AS level, RegionName AS member, sum(NetSalesAmount) AS net FROM fact_sales JOIN dim_warehouse USING (WarehouseKey) JOIN dim_region USING (RegionKey) GROUP BY 2
        UNION ALL SELECT 'category', CategoryName, sum(NetSalesAmount) FROM fact_sales GROUP BY 2)
        SELECT level, member, net::DOUBLE AS net_sales, {div('net', 'sum(net) OVER (PARTITION BY level)')} AS share FROM n""",
    "trailing90_otif": f"""SELECT *, {div('otif', 'completed')} AS otif_rate, {div('on_time', 'completed')} AS on_time_rate FROM
        (SELECT SupplierKey, count(*) AS lines, count(*) FILTER (POStatus = 'Completed') AS completed, sum(IsDeliveredOnTimeFlag)::BIGINT AS on_time,
                sum(IsDeliveredInFullFlag)::BIGINT AS in_full, sum(IsSupplierOTIFFlag)::BIGINT AS otif, sum(ExtendedPOAmount)::DOUBLE AS spend
         FROM fact_po WHERE POCreationDate > (SELECT last_day FROM sales_days) - 90 GROUP BY 1)""",
    "projected_stockout": f"""WITH b AS (SELECT ProductKey, WarehouseKey, sum(units)::DOUBLE / 30.0::DOUBLE AS burn FROM picks WHERE day > (SELECT max(day) FROM flow) - 30 GROUP BY 1, 2),
        o AS (SELECT ProductKey, ReceivingWarehouseKey AS WarehouseKey, min(PromisedDeliveryDate) AS next_dock_date FROM fact_po WHERE POStatus = 'Open In-Transit' GROUP BY 1, 2),
        j AS (SELECT ProductKey, WarehouseKey, SnapshotDate, OnHandQuantity::BIGINT AS OnHandQuantity, burn, {div('OnHandQuantity', 'burn', None)} AS dos, next_dock_date
              FROM snapshot JOIN b USING (ProductKey, WarehouseKey) LEFT JOIN o USING (ProductKey, WarehouseKey) WHERE SnapshotDate = (SELECT max(day) FROM flow))
        SELECT ProductKey, WarehouseKey, OnHandQuantity, burn AS daily_burn, dos AS days_of_supply, next_dock_date, SnapshotDate + floor(dos)::INTEGER AS projected_stockout_date, dos <= 14 AS within_14_days, coalesce(next_dock_date <= SnapshotDate + floor(dos)::INTEGER, false) AS inbound_in_time FROM j""",
}
