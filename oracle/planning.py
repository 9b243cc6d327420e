"""Statements for tidewater.plans.planning."""

from .base import CTES, Z, div, rnd, std

CTES["repl"] = """
SELECT d.*, lt_n, lt_sum, lt_sq, po_units, po_lines, (SELECT days FROM sales_days) AS days
FROM (SELECT ProductKey, WarehouseKey, sum(q) AS demand, sum(q * q) AS demand_sq FROM
        (SELECT ProductKey, WarehouseKey, OrderDate, sum(ShippedQuantity)::BIGINT AS q FROM fact_sales GROUP BY 1, 2, 3) GROUP BY 1, 2) d
LEFT JOIN (SELECT ProductKey, ReceivingWarehouseKey AS WarehouseKey, count(ActualLeadTimeDays) AS lt_n, sum(ActualLeadTimeDays) AS lt_sum,
        sum(ActualLeadTimeDays * ActualLeadTimeDays) AS lt_sq, sum(OrderedQuantity) AS po_units, count(*) AS po_lines FROM fact_po GROUP BY 1, 2) p USING (ProductKey, WarehouseKey)"""


def king(source: str, z: str = "1.65::DOUBLE", mult: str = "1.0::DOUBLE", shock: str = "0.0::DOUBLE", factor: str = "1.0::DOUBLE") -> str:
    return f"""SELECT *, floor(d * lt + 0.5::DOUBLE)::BIGINT AS lead_time_demand, floor(d * lt + 0.5::DOUBLE)::BIGINT + ss AS rop FROM
        (SELECT *, floor(({z}) * sqrt(greatest(1.0::DOUBLE, lt * sd * sd + d * d * lsd * lsd)) + 0.5::DOUBLE)::BIGINT AS ss FROM
          (SELECT *, {div('demand', 'days')} * ({mult}) AS d, coalesce({std('days', 'demand', 'demand_sq')} * ({mult}), {div('demand', 'days')} * ({mult}) * 0.25::DOUBLE) AS sd,
              coalesce({div('lt_sum', 'lt_n', None)}, 14.0::DOUBLE) + ({shock}) AS lt, coalesce({std('lt_n', 'lt_sum', 'lt_sq')}, 2.0::DOUBLE) * ({factor}) AS lsd,
              floor({div('po_units', 'po_lines * 2')} + 0.5::DOUBLE)::BIGINT AS cycle_stock FROM {source}))"""


CTES["pol"] = king("repl")
CTES["pos"] = """
SELECT ProductKey, WarehouseKey, OnHandQuantity::BIGINT AS oh, ReservedQuantity::BIGINT AS re, AvailableQuantity::BIGINT AS av, InTransitInboundQuantity AS ib,
       InventoryValuation, DaysSinceLastMovement, RegionKey FROM snapshot WHERE SnapshotDate = (SELECT max(day) FROM flow)"""
CTES["exc"] = "SELECT s.*, greatest(0, oh - coalesce(ss + cycle_stock + lead_time_demand, 0)) AS excess_units FROM pos s LEFT JOIN pol p USING (ProductKey, WarehouseKey)"
CTES["known_sites"] = """
SELECT ProductKey, WarehouseKey FROM pos UNION SELECT ProductKey, WarehouseKey FROM pol UNION SELECT ProductKey, WarehouseKey FROM open_inbound"""
CTES["moves_plan"] = """
WITH n AS (SELECT k.ProductKey, RegionKey, k.WarehouseKey, coalesce(av, 0) - coalesce(rop, 0) AS x
       FROM (SELECT ProductKey, WarehouseKey FROM pos UNION SELECT ProductKey, WarehouseKey FROM pol) k JOIN dim_warehouse USING (WarehouseKey)
       LEFT JOIN (SELECT ProductKey, WarehouseKey, av FROM pos) USING (ProductKey, WarehouseKey) LEFT JOIN pol USING (ProductKey, WarehouseKey)),
  e AS (SELECT *, x > 0 AS s, abs(x) AS u, sum(abs(x)) OVER (PARTITION BY ProductKey, RegionKey, x > 0 ORDER BY abs(x) DESC, WarehouseKey ROWS UNBOUNDED PRECEDING) AS hi FROM n WHERE x <> 0)
SELECT a.ProductKey, a.RegionKey, a.WarehouseKey AS origin, b.WarehouseKey AS destination, (least(a.hi, b.hi) - greatest(a.hi - a.u, b.hi - b.u))::BIGINT AS transfer_units
FROM e a JOIN e b ON a.ProductKey = b.ProductKey AND a.RegionKey = b.RegionKey AND a.s AND NOT b.s AND a.hi - a.u < b.hi AND b.hi - b.u < a.hi"""
CTES["cases"] = king("(SELECT r.*, s.*, CategoryName, UnitStandardCost FROM repl r LEFT JOIN dim_product USING (ProductKey) CROSS JOIN scenarios s)", Z.format("level"), "mult", "shock::DOUBLE")
CTES["sims"] = "SELECT ScenarioCode, rate, sum(ss)::BIGINT AS ss_units, sum(rop)::BIGINT AS rop_units, sum(ss * UnitStandardCost) AS ss_value FROM cases GROUP BY 1, 2"
COST = "UnitStandardCost"

SQL = {
    "safety_stock": "SELECT ProductKey, WarehouseKey, d AS avg_daily_demand, sd AS std_daily_demand, lt AS lead_time_days, lsd AS lead_time_std, ss AS safety_stock FROM pol",
    "reorder_point": """SELECT ProductKey, WarehouseKey, lead_time_demand, ss AS safety_stock, rop AS reorder_point, coalesce(oh, 0) AS on_hand,
        CASE WHEN coalesce(oh, 0) >= rop THEN 'Ample Stock Buffer' ELSE 'Reorder Triggered' END AS buffer_status FROM pol LEFT JOIN pos USING (ProductKey, WarehouseKey)""",
    "excess_inventory": f"""SELECT WarehouseKey, count(*) AS positions, count(*) FILTER (excess_units > 0) AS excess_positions, sum(excess_units)::BIGINT AS excess_units,
        sum(excess_units * {COST})::DOUBLE AS excess_value FROM exc LEFT JOIN dim_product USING (ProductKey) GROUP BY 1""",
    "capital_exposure": f"""SELECT CategoryName, dead::DOUBLE AS dead_value, ex::DOUBLE AS excess_value, ib::DOUBLE AS inbound_value, (dead + ex + ib)::DOUBLE AS exposure FROM
        (SELECT CategoryName, coalesce(sum(oh * {COST}) FILTER (DaysSinceLastMovement >= 180), 0) AS dead, coalesce(sum(excess_units * {COST}) FILTER (DaysSinceLastMovement < 180), 0) AS ex,
            coalesce(sum(OpenPOAmount) FILTER (DaysSinceLastMovement >= 180 OR excess_units > 0), 0) AS ib
         FROM (SELECT ProductKey, WarehouseKey, oh, excess_units, DaysSinceLastMovement FROM exc) LEFT JOIN open_inbound USING (ProductKey, WarehouseKey) LEFT JOIN dim_product USING (ProductKey) GROUP BY 1)""",
    "whatif_scenarios": f"""WITH b AS (SELECT * FROM sims WHERE ScenarioCode = 'SCN-BASE')
        SELECT s.ScenarioCode, s.ss_units, s.rop_units, s.ss_value::DOUBLE AS ss_value, (s.ss_value - b.ss_value)::DOUBLE AS ss_value_delta, {div('s.ss_value - b.ss_value', 'b.ss_value')} AS ss_value_delta_pct,
            s.rop_units - b.rop_units AS rop_delta, s.ss_value::DOUBLE * (s.rate / 100.0::DOUBLE) AS carrying_cost,
            s.ss_value::DOUBLE * (s.rate / 100.0::DOUBLE) - b.ss_value::DOUBLE * 0.22::DOUBLE AS carrying_cost_delta FROM sims s CROSS JOIN b""",
    "whatif_category_sensitivity": f"""WITH c AS (SELECT CategoryName, sum(ss * {COST}) FILTER (ScenarioCode = 'SCN-BASE') AS b, sum(ss * {COST}) FILTER (ScenarioCode = 'SCN-STRESS') AS s FROM cases GROUP BY 1)
        SELECT CategoryName, b::DOUBLE AS baseline_value, s::DOUBLE AS simulated_value, (s - b)::DOUBLE AS value_delta, {div('s - b', 'b')} AS delta_pct FROM c""",
    "king_decomposition": f"""WITH t AS (SELECT ScenarioCode, {div('(SELECT sum(ShippedQuantity) FROM fact_sales)', '(SELECT days FROM sales_days)')} * mult AS d,
            coalesce({div('(SELECT sum(ActualLeadTimeDays) FROM fact_po)', '(SELECT count(ActualLeadTimeDays) FROM fact_po)', None)}, 25.8::DOUBLE) + shock AS lt FROM scenarios),
        u AS (SELECT ScenarioCode, d AS daily_demand, lt AS lead_time_days, lt * ((d * 0.45::DOUBLE) * (d * 0.45::DOUBLE)) AS demand_term, (d * d) * 6.25::DOUBLE AS lead_time_term FROM t)
        SELECT *, {div('demand_term', 'demand_term + lead_time_term')} AS demand_share, 1.0::DOUBLE - {div('demand_term', 'demand_term + lead_time_term')} AS lead_time_share FROM u""",
    "whatif_valuation_proxy": f"""WITH v AS (SELECT {div('sum(v)', 'count(*)')} AS av FROM (SELECT SnapshotDate, sum(InventoryValuation) AS v FROM snapshot GROUP BY 1)),
        u AS (SELECT {div('(SELECT av FROM v)', div('(SELECT sum(ShippedQuantity) FROM fact_sales)', '(SELECT days FROM sales_days)'))} AS unit_value)
        SELECT ScenarioCode, ss_units, unit_value, floor(ss_units::DOUBLE * unit_value + 0.5::DOUBLE)::BIGINT AS ss_value_proxy FROM sims CROSS JOIN u""",
    "whatif_sliders": f"""WITH c AS ({king("(SELECT r.*, s.*, UnitStandardCost FROM repl r LEFT JOIN dim_product USING (ProductKey) CROSS JOIN scenarios s)", Z.format("level"), "1.1::DOUBLE", "shock::DOUBLE")})
        SELECT ScenarioCode, sum(ss)::BIGINT AS ss_units, sum(rop)::BIGINT AS rop_units, sum(ss * UnitStandardCost)::DOUBLE AS ss_value,
            sum(ss * UnitStandardCost)::DOUBLE * (24.0::DOUBLE / 100.0::DOUBLE) AS carrying_cost FROM c GROUP BY 1""",
    "stockout_top_skus": """WITH t AS (SELECT ProductKey, sum(NetSalesAmount) AS revenue FROM fact_sales GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 100)
        SELECT ProductKey, revenue::DOUBLE AS revenue, date_trunc('quarter', StartDate)::DATE AS quarter, count(*) AS incidents, sum(StockoutDurationDays)::BIGINT AS days
        FROM t JOIN stockout USING (ProductKey) GROUP BY 1, 2, 3""",
    "xyz_share_by_category": f"""SELECT CategoryName, count(*) AS skus, count(*) FILTER (xyz_class = 'Z') AS z_skus, {rnd('avg(cv)', 6)} AS mean_cv,
        {div("count(*) FILTER (xyz_class = 'Z')", 'count(*)')} AS z_share FROM xyz_labels JOIN dim_product USING (ProductKey) GROUP BY 1""",
    "override_by_segment": f"""WITH p AS (SELECT ProductKey, count(*) FILTER (PlannerAdjustmentQuantity <> 0) AS o, sum(abs(actual - ForecastedQuantity)) AS e, sum(abs(actual - BaselineStatisticalQuantity)) AS b,
            sum(actual) AS a FROM aligned GROUP BY 1),
        g AS (SELECT abc_class || xyz_class AS segment, count(*) AS skus, sum(o)::BIGINT AS overrides, sum(e) AS e, sum(b) AS b, sum(a) AS a FROM p JOIN abc_labels USING (ProductKey) JOIN xyz_labels USING (ProductKey) GROUP BY 1)
        SELECT segment, skus, overrides, 1.0::DOUBLE - {div('e', 'a')} AS accuracy, {div('b', 'a')} - {div('e', 'a')} AS value_add FROM g""",
    "service_policy_by_abc": f"""WITH l AS (SELECT r.*, abc_class, UnitStandardCost, CASE abc_class WHEN 'A' THEN 99.0::DOUBLE WHEN 'B' THEN 95.0::DOUBLE ELSE 90.0::DOUBLE END AS level FROM repl r JOIN abc_labels USING (ProductKey) LEFT JOIN dim_product USING (ProductKey)),
        k AS ({king('l', Z.format('level'))})
        SELECT abc_class, level AS service_level, count(*) AS positions, sum(k.ss)::BIGINT AS ss_units, sum(k.ss * {COST})::DOUBLE AS investment, sum(p.ss)::BIGINT AS flat_ss_units,
            sum(p.ss * {COST})::DOUBLE AS flat_investment FROM k JOIN pol p USING (ProductKey, WarehouseKey) GROUP BY 1, 2""",
    "lt_variance_cut": f"""WITH h AS ({king('repl', factor='0.5::DOUBLE')})
        SELECT CategoryName, sum(p.ss)::BIGINT AS ss_units, sum(h.ss)::BIGINT AS ss_units_after, sum(p.ss - h.ss)::BIGINT AS units_released, sum((p.ss - h.ss) * {COST})::DOUBLE AS capital_released
        FROM h JOIN pol p USING (ProductKey, WarehouseKey) LEFT JOIN dim_product USING (ProductKey) GROUP BY 1""",
    "carrying_rate_sensitivity": f"""WITH v AS (SELECT CategoryName, {div('sum(v)', 'count(*)')} AS a FROM (SELECT CategoryName, SnapshotDate, sum(InventoryValuation) AS v FROM snapshot GROUP BY 1, 2) GROUP BY 1)
        SELECT CategoryName, r AS rate_pct, a * (r::DOUBLE / 100.0::DOUBLE) AS carrying_cost, a * (r::DOUBLE / 100.0::DOUBLE) - a * 0.22::DOUBLE AS delta_to_default
        FROM v CROSS JOIN (SELECT unnest(generate_series(18, 28)) AS r)""",
    "below_rop": """SELECT ProductKey, WarehouseKey, net AS net_available, rop AS reorder_point, rop - net AS deficit_units
        FROM (SELECT ProductKey, WarehouseKey, rop, coalesce(oh, 0) + coalesce(InTransitInboundQuantity, 0) - coalesce(re, 0) AS net
              FROM pol LEFT JOIN pos USING (ProductKey, WarehouseKey) LEFT JOIN open_inbound USING (ProductKey, WarehouseKey)) WHERE net <= rop""",
    "planner_queues": f"""WITH r AS (SELECT k.ProductKey, k.WarehouseKey, coalesce(s.oh, 0) AS oh, coalesce(p.ss, 0) AS ss, coalesce(o.InTransitInboundQuantity, 0) AS i, o.OpenPOAmount,
            {div('coalesce(s.oh, 0)', 'p.d', '9999.0::DOUBLE')} AS cover, coalesce(s.oh, 0) * UnitStandardCost AS v
            FROM known_sites k LEFT JOIN pos s USING (ProductKey, WarehouseKey) LEFT JOIN pol p USING (ProductKey, WarehouseKey) LEFT JOIN open_inbound o USING (ProductKey, WarehouseKey)
            LEFT JOIN dim_product d ON d.ProductKey = k.ProductKey),
        q AS (SELECT *, CASE WHEN oh = 0 AND i > 0 THEN 'Emergency Expedite' WHEN cover > 365 AND i > 0 THEN 'Cancel / Defer Inbound' WHEN oh < ss AND i > 0 THEN 'Inbound ROP Monitoring' ELSE 'No Action' END AS queue FROM r
            UNION ALL SELECT r.*, 'Network Rebalancing' FROM r WHERE EXISTS (SELECT 1 FROM moves_plan m WHERE m.ProductKey = r.ProductKey AND r.WarehouseKey IN (m.origin, m.destination)))
        SELECT queue, count(*) AS positions, sum(oh)::BIGINT AS on_hand, sum(i)::BIGINT AS inbound_units, coalesce(sum(OpenPOAmount), 0)::DOUBLE AS open_po_amount, coalesce(sum(v), 0)::DOUBLE AS valuation FROM q GROUP BY 1""",
    "rebalance_candidates": "SELECT * FROM moves_plan",
    "stockout_open_orders": """WITH l AS (SELECT * FROM fact_sales WHERE OrderDate <= (SELECT max(day) FROM flow) AND (ShipDate > (SELECT max(day) FROM flow) OR CancelledQuantity > 0))
        SELECT p.ProductKey, p.WarehouseKey, any_value(p.oh) AS on_hand, count(DISTINCT SalesOrderID) AS open_orders, count(*) AS open_lines, sum(OrderedQuantity)::BIGINT AS open_units,
            sum(NetSalesAmount)::DOUBLE AS value_at_risk, any_value(coalesce(p.ib, 0))::BIGINT AS inbound_units
        FROM pos p JOIN l USING (ProductKey, WarehouseKey) WHERE p.av <= 0 GROUP BY 1, 2""",
    "overdue_po": """SELECT POLineKey, SupplierKey, ReceivingWarehouseKey, POStatus, PromisedDeliveryDate, OrderedQuantity, ExtendedPOAmount::DOUBLE AS ExtendedPOAmount,
        date_diff('day', PromisedDeliveryDate, (SELECT last_day FROM sales_days)) AS overdue_days FROM fact_po WHERE POStatus <> 'Completed' AND PromisedDeliveryDate < (SELECT last_day FROM sales_days)""",
    "doi_vs_leadtime": f"""SELECT * FROM (SELECT ProductKey, WarehouseKey, CASE WHEN oh > 0 THEN {div('oh', 'd', '9999.0::DOUBLE')} ELSE 0.0::DOUBLE END AS days_of_inventory,
            coalesce(lt, 14.0::DOUBLE) AS lead_time_days, InventoryValuation::DOUBLE AS valuation
          FROM pos LEFT JOIN pol USING (ProductKey, WarehouseKey)) WHERE days_of_inventory > 120 AND lead_time_days < 30""",
    "lead_time_gap": f"""WITH g AS (SELECT SupplierKey, count(ActualLeadTimeDays) AS n, sum(ActualLeadTimeDays) AS s, sum(ActualLeadTimeDays * ActualLeadTimeDays) AS q,
            sum(PromisedLeadTimeDays) FILTER (ActualLeadTimeDays IS NOT NULL) AS p, sum(LeadTimeVarianceDays) AS v FROM fact_po GROUP BY 1),
        r AS (SELECT *, {std('n', 's', 'q')} AS sd FROM g)
        SELECT SupplierKey, n AS receipts, {div('p', 'n', None)} AS contract_days, {div('s', 'n', None)} AS actual_days, {div('v', 'n', None)} AS gap_days, sd AS lead_time_std, coalesce(sd, 0.0) > 5 AS high_variability FROM r""",
    "single_source_spend": """SELECT SupplierTier, CASE WHEN n = 1 THEN 'Single-Sourced' ELSE 'Multi-Sourced' END AS sourcing, sum(ExtendedPOAmount)::DOUBLE AS spend, count(DISTINCT ProductKey) AS skus
        FROM fact_po LEFT JOIN (SELECT ProductKey, count(DISTINCT SupplierKey) AS n FROM bridge GROUP BY 1) USING (ProductKey) LEFT JOIN dim_supplier USING (SupplierKey) GROUP BY 1, 2""",
    "wape_stockout_corr": f"""WITH e AS (SELECT WarehouseKey, {div('sum(abs(actual - ForecastedQuantity))', 'sum(actual)')} AS wape FROM aligned GROUP BY 1),
        s AS (SELECT WarehouseKey, count(*) AS n FROM stockout GROUP BY 1)
        SELECT count(*) AS warehouses, {rnd('corr(wape, coalesce(n, 0)::DOUBLE)', 6)} AS correlation FROM e LEFT JOIN s USING (WarehouseKey)""",
    "wape_stockout_by_category": f"""WITH e AS (SELECT CategoryName, WarehouseKey, {div('sum(abs(actual - ForecastedQuantity))', 'sum(actual)')} AS wape FROM aligned LEFT JOIN dim_product USING (ProductKey) GROUP BY 1, 2),
        s AS (SELECT CategoryName, WarehouseKey, count(*) AS n FROM stockout GROUP BY 1, 2)
        SELECT CategoryName, count(*) AS warehouses, coalesce(sum(n), 0)::BIGINT AS incidents, {rnd('CASE WHEN isfinite(corr(wape, coalesce(n, 0)::DOUBLE)) THEN corr(wape, coalesce(n, 0)::DOUBLE) END', 6)} AS correlation
        FROM e LEFT JOIN s USING (CategoryName, WarehouseKey) GROUP BY 1""",
}
