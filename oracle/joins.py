"""Statements for tidewater.plans.joins."""

from .base import div

ALLOWED_WH = """(SELECT DISTINCT u.UserEmail, w.WarehouseKey FROM security u JOIN dim_warehouse w
    ON (u.RegionKey = -1 AND u.WarehouseKey = -1) OR (u.WarehouseKey <> -1 AND u.WarehouseKey = w.WarehouseKey)
       OR (u.RegionKey <> -1 AND u.WarehouseKey = -1 AND u.RegionKey = w.RegionKey))"""

SQL = {
    "star_join": """SELECT RegionName, ChannelName, CategoryName, sum(NetSalesAmount)::DOUBLE AS net_sales, sum(OrderedQuantity)::BIGINT AS ordered_units, count(*) AS lines
        FROM fact_sales LEFT JOIN dim_channel USING (CustomerChannelKey) LEFT JOIN dim_warehouse USING (WarehouseKey) LEFT JOIN dim_region USING (RegionKey) GROUP BY 1, 2, 3""",
    "role_date_join": """SELECT date_role, CASE WHEN d BETWEEN (SELECT first_day FROM calendar_days) AND (SELECT last_day FROM calendar_days) THEN strftime(d, '%Y-%m') END AS MonthYear,
        sum(NetSalesAmount)::DOUBLE AS net_sales, count(*) AS lines
        FROM (SELECT 'order' AS date_role, OrderDate AS d, NetSalesAmount FROM fact_sales UNION ALL SELECT 'ship', ShipDate, NetSalesAmount FROM fact_sales
              UNION ALL SELECT 'delivery', DeliveryDate, NetSalesAmount FROM fact_sales) GROUP BY 1, 2""",
    "scd2_range_join": """SELECT h.CategoryName, h.IsCurrent, sum(ShippedQuantity)::BIGINT AS units, sum(ShippedQuantity * h.UnitStandardCost)::DOUBLE AS cost_at_order_date
        FROM fact_sales s JOIN dim_product_history h ON s.ProductKey = h.NaturalKey AND s.OrderDate >= h.EffectiveFrom AND s.OrderDate < h.EffectiveTo GROUP BY 1, 2""",
    "asof_line_cost": """SELECT h.CategoryName, h.IsCurrent, count(*) AS lines, sum(ShippedQuantity)::BIGINT AS units, sum(ShippedQuantity * h.UnitStandardCost)::DOUBLE AS cost_at_order_date
        FROM fact_sales s ASOF LEFT JOIN (SELECT NaturalKey AS ProductKey, * EXCLUDE (NaturalKey) FROM dim_product_history) h ON s.ProductKey = h.ProductKey AND s.OrderDate >= h.EffectiveFrom GROUP BY 1, 2""",
    "orphan_check": """SELECT k AS ProductKey, count(*) AS lines FROM (SELECT CASE WHEN l_linenumber = 7 AND l_returnflag = 'R' THEN -l_partkey - 1 ELSE l_partkey END AS k FROM lineitem)
        WHERE k NOT IN (SELECT p_partkey FROM part) GROUP BY 1""",
    "row_security": f"""SELECT UserEmail, count(*) AS visible_warehouses, sum(rows)::BIGINT AS sales_rows, sum(net)::DOUBLE AS net_sales
        FROM {ALLOWED_WH} LEFT JOIN (SELECT WarehouseKey, count(*) AS rows, sum(NetSalesAmount) AS net FROM fact_sales GROUP BY 1) USING (WarehouseKey) GROUP BY 1""",
    "secured_sales": f"""SELECT WarehouseKey, count(*) AS rows, sum(OrderedQuantity)::BIGINT AS units FROM fact_sales
        WHERE WarehouseKey IN (SELECT WarehouseKey FROM {ALLOWED_WH} WHERE UserEmail = 'multi@tidewater.example') GROUP BY 1""",
    "region_visibility": """SELECT DISTINCT u.UserEmail, r.RegionKey FROM security u JOIN dim_region r
        ON u.RegionKey = -1 OR u.RegionKey = r.RegionKey OR (u.WarehouseKey <> -1 AND r.RegionKey IN (SELECT RegionKey FROM dim_warehouse w WHERE w.WarehouseKey = u.WarehouseKey))""",
    "scalar_lookup": """SELECT ProductSKU, CategoryName, WarehouseCode, StartDate, StockoutDurationDays FROM stockout LEFT JOIN dim_warehouse USING (WarehouseKey)""",
    "cross_fact_align": """SELECT strftime(month, '%Y-%m') AS month, sum(coalesce(f, 0))::BIGINT AS forecast_units, sum(coalesce(a, 0))::BIGINT AS actual_units,
        sum(abs(coalesce(a, 0) - coalesce(f, 0)))::BIGINT AS absolute_error, count(*) FILTER (a IS NULL) AS forecast_only, count(*) FILTER (f IS NULL) AS actual_only
        FROM (SELECT TargetMonth AS month, ProductKey, WarehouseKey, ForecastedQuantity AS f FROM fact_forecast) FULL JOIN
             (SELECT month, ProductKey, WarehouseKey, actual AS a FROM actual_month) USING (month, ProductKey, WarehouseKey) GROUP BY 1""",
    "scenario_cross_join": """SELECT CategoryName, ScenarioCode, u AS ordered_units, u::DOUBLE * mult AS simulated_demand
        FROM (SELECT CategoryName, sum(OrderedQuantity)::BIGINT AS u FROM fact_sales GROUP BY 1) CROSS JOIN scenarios""",
    "supplier_attribution": f"""SELECT *, {div('tier3_caused', 'supplier_caused')} AS tier3_attribution_pct FROM (
        SELECT count(*) AS supplier_caused, count(*) FILTER (SupplierTier = 'Tier 3 Tactical') AS tier3_caused
        FROM stockout JOIN dim_supplier ON PrimarySupplierKey = SupplierKey WHERE StockoutAttributedReason = 'Supplier Delayed Inbound')""",
    "sourcing_bridge": """SELECT CategoryName, CASE WHEN n = 1 THEN 'Single-Sourced' ELSE 'Multi-Sourced' END AS sourcing, count(*) AS skus
        FROM (SELECT ProductKey, count(DISTINCT SupplierKey) AS n FROM bridge GROUP BY 1) JOIN dim_product USING (ProductKey) GROUP BY 1, 2""",
    "region_rollup": """SELECT RegionName, 'Planner ' || RegionName AS PlannerName, count(*) AS warehouses, sum(StorageCapacityPallets)::BIGINT AS capacity_pallets,
        sum(units)::BIGINT AS ordered_units, sum(net)::DOUBLE AS net_sales
        FROM (SELECT WarehouseKey, sum(OrderedQuantity) AS units, sum(NetSalesAmount) AS net FROM fact_sales GROUP BY 1) JOIN dim_warehouse USING (WarehouseKey) JOIN dim_region USING (RegionKey) GROUP BY 1""",
    "returns_rate": f"""SELECT *, {div('returned', 'shipped')} AS return_rate, {div('restocked', 'returned')} AS restock_share FROM
        (SELECT ChannelName, sum(ShippedQuantity)::BIGINT AS shipped FROM fact_sales JOIN dim_channel USING (CustomerChannelKey) GROUP BY 1) LEFT JOIN
        (SELECT ChannelName, sum(ReturnedQuantity)::BIGINT AS returned, sum(RestockedQuantity)::BIGINT AS restocked, sum(ScrappedQuantity)::BIGINT AS scrapped
         FROM returns JOIN dim_channel USING (CustomerChannelKey) GROUP BY 1) USING (ChannelName)""",
}
