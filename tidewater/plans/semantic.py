"""Measures of the business, evaluated over any set of dimension attributes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import floor_round, safe_divide, tier, z_score
from ..operators.context import Calc, Each, Leaf, Model, Node, Selected, columns_read, deviation, distinct, either, last, mean, over_days, ratio, rows, stock, total
from ..operators.context import evaluate as evaluate_nodes
from ..operators.replenish import DEFAULT_DEMAND_CV, DEFAULT_LEAD_TIME, DEFAULT_LEAD_TIME_STD
from ..sources.star import DerivedStar, Star
from .measures import CARRYING_RATE, NO_DEMAND, OTIF_TARGET, UNITS_PER_PALLET
from .registry import query

DAYS = "OrderCalendar"

MODEL = Model(
    links={
        "FactSales": {"DimProduct": "ProductKey", "DimWarehouse": "WarehouseKey", "DimCustomerChannel": "CustomerChannelKey"},
        "FactPurchaseOrder": {"DimProduct": "ProductKey", "DimWarehouse": "ReceivingWarehouseKey", "DimSupplier": "SupplierKey"},
        "FactStockout": {"DimProduct": "ProductKey", "DimWarehouse": "WarehouseKey"},
        "FactCustomerReturns": {"DimProduct": "ProductKey", "DimCustomerChannel": "CustomerChannelKey"},
        "FactStockInterval": {"DimProduct": "ProductKey", "DimWarehouse": "WarehouseKey"},
        "FactDemandForecast": {"DimProduct": "ProductKey", "DimWarehouse": "WarehouseKey"},
        "FactSupplierMonthlyPerformance": {"DimSupplier": "SupplierKey"},
        "DimWarehouse": {}, "DimProduct": {},
    },
    keys={"DimProduct": "ProductKey", "DimWarehouse": "WarehouseKey", "DimCustomerChannel": "CustomerChannelKey", "DimSupplier": "SupplierKey", "DimScenario": "ScenarioKey"},
    attributes={
        **dict.fromkeys(["ProductKey", "CategoryName", "BrandName", "ProductSKU"], "DimProduct"),
        **dict.fromkeys(["WarehouseKey", "RegionKey", "WarehouseCode"], "DimWarehouse"),
        **dict.fromkeys(["CustomerChannelKey", "ChannelName"], "DimCustomerChannel"),
        **dict.fromkeys(["SupplierKey", "SupplierTier", "RegionZone"], "DimSupplier"),
        **dict.fromkeys(["ScenarioCode", "DemandMultiplier", "LeadTimeShockDays", "ServiceLevelTargetPct", "AnnualCarryingCostRatePct"], "DimScenario"),
    },
    dates={
        "FactSales": "OrderDate", "FactPurchaseOrder": "POCreationDate", "FactStockout": "StartDate", "FactCustomerReturns": "ReturnDate",
        "FactStockInterval": "FromDate", "FactDemandForecast": "TargetMonth", "FactSupplierMonthlyPerformance": "YearMonthDate", DAYS: "FullDate",
    },
    own={"SalesOrderID": "FactSales"},
)


# Days of inventory above which a product is in a velocity tier, slowest tier first;
# the fourth begins at its bound, the fifth is what is left.
VELOCITY = [365, 180, 60, 14]


class _WithCalendar:
    """A star with the days from the first to the last order as a table of its own."""

    def __init__(self, star: Star):
        self._star = star

    def table(self, name: str, *columns: str) -> DataFrame:
        if name != DAYS:
            return self._star.table(name, *columns)
        ends = self._star.table("FactSales", "OrderDate").agg(F.min("OrderDate").alias("a"), F.max("OrderDate").alias("b"))
        return ends.select(F.explode(F.sequence("a", "b")).alias("FullDate"))

    def carried(self, fact: str) -> set[str]:
        return self._star.carried(fact)


def _when(condition, value=1):
    return F.when(condition, value)


def _number(x):
    return x.cast("double")


def _catalog() -> dict[str, Node]:
    sales, po, out = "FactSales", "FactPurchaseOrder", "FactStockout"
    m: dict[str, Node] = {
        "ordered_units": total(sales, "OrderedQuantity"), "shipped_units": total(sales, "ShippedQuantity"), "cancelled_units": total(sales, "CancelledQuantity"),
        "gross_sales": total(sales, "GrossSalesAmount"), "discounts": total(sales, "DiscountAmount"), "net_sales": total(sales, "NetSalesAmount"),
        "cogs": total(sales, "CostOfGoodsSold"), "sales_lines": rows(sales), "sales_orders": distinct(sales, "SalesOrderID"),
        "cycle_time_days": mean(sales, "OrderLineCycleTimeDays"), "otif_lines": rows(sales, "OnTimeInFullFlag = 1", ("OnTimeInFullFlag",)),
        "fulfilled_lines": rows(sales, "ShippedQuantity > 0 AND CancelledQuantity = 0", ("ShippedQuantity", "CancelledQuantity")),
        "po_spend": total(po, "ExtendedPOAmount"), "po_ordered_units": total(po, "OrderedQuantity"), "po_received_units": total(po, "ReceivedQuantity"),
        "po_rejected_units": total(po, "RejectedQuantity"), "po_lines": rows(po), "po_orders": distinct(po, "PurchaseOrderID"),
        "po_completed_lines": rows(po, "POStatus = 'Completed'", ("POStatus",)), "po_overdue_lines": rows(po, "POStatus = 'Overdue'", ("POStatus",)),
        "po_otif_lines": rows(po, "IsSupplierOTIFFlag = 1", ("IsSupplierOTIFFlag",)), "contract_lead_time": mean(po, "PromisedLeadTimeDays"),
        "actual_lead_time": mean(po, "ActualLeadTimeDays"), "lead_time_deviation": deviation(po, "ActualLeadTimeDays"),
        "lead_time_variance": mean(po, "LeadTimeVarianceDays"),
        "stockout_incidents": rows(out), "stockout_days": total(out, "StockoutDurationDays"), "lost_units": total(out, "EstimatedLostDemandUnits"),
        "lost_revenue": total(out, "EstimatedLostRevenueAmount"), "top_lost_revenue": last(out, "EstimatedLostRevenueAmount"),
        "returned_units": total("FactCustomerReturns", "ReturnedQuantity"),
        "forecast_units": total("FactDemandForecast", "ForecastedQuantity"), "baseline_units": total("FactDemandForecast", "BaselineStatisticalQuantity"),
        "on_hand": stock("OnHandQuantity"), "available": stock("AvailableQuantity"), "reserved": stock("ReservedQuantity"),
        "inbound": stock("InTransitInboundQuantity"), "valuation": stock("InventoryValuation"), "avg_daily_valuation": stock("InventoryValuation", "mean"),
        "snapshot_records": stock(kind="days"), "stockout_records": stock(kind="days", where="AvailableQuantity <= 0", read=("AvailableQuantity",)),
        "latest_snapshot": stock(kind="last day"), "dead_valuation": stock("InventoryValuation", older=180),
        "active_suppliers": distinct("FactSupplierMonthlyPerformance", "SupplierKey"), "scorecard_otif": Leaf("FactSupplierMonthlyPerformance", "mean", "CAST(OTIFRatePct AS DECIMAL(28,10))", ("OTIFRatePct",)),
        "scorecards": rows("FactSupplierMonthlyPerformance"),
        "critical_breaches": rows("FactSupplierMonthlyPerformance", "SupplierMonthlyRiskRating = 'Critical SLA Breach'", ("SupplierMonthlyRiskRating",)),
        "facilities": rows("DimWarehouse"), "capacity_pallets": total("DimWarehouse", "StorageCapacityPallets"), "active_skus": distinct("DimProduct", "ProductSKU"),
        "days": rows(DAYS), "multiplier": Selected("DemandMultiplier", 1.0), "shock_days": Selected("LeadTimeShockDays", 0),
        "service_target": Selected("ServiceLevelTargetPct", 95.0), "carrying_rate": Selected("AnnualCarryingCostRatePct", CARRYING_RATE * 100),
    }
    m["aged_60"], m["aged_120"] = stock("InventoryValuation", older=60), stock("InventoryValuation", older=120)
    m |= {
        "discount_pct": ratio(m["discounts"], m["gross_sales"]), "cogs_pct": ratio(m["cogs"], m["net_sales"]), "gross_profit": m["net_sales"] - m["cogs"],
        "fill_rate": ratio(m["shipped_units"], m["ordered_units"]), "otif_rate": ratio(m["otif_lines"], m["fulfilled_lines"], None),
        "po_otif_rate": ratio(m["po_otif_lines"], m["po_completed_lines"]), "defect_rate": ratio(m["po_rejected_units"], m["po_received_units"]),
        "return_rate": ratio(m["returned_units"], m["shipped_units"]), "critical_breach_pct": ratio(m["critical_breaches"], m["scorecards"]),
        "total_snapshot_rows": m["snapshot_records"].ignoring(), "stockout_rate": ratio(m["stockout_records"], m["snapshot_records"], None),
        "healthy_valuation": m["valuation"] - m["aged_60"], "slow_valuation": m["aged_60"] - m["aged_120"],
        "stagnant_valuation": m["aged_120"] - m["dead_valuation"], "dead_pct": ratio(m["dead_valuation"], m["valuation"]),
        "daily_demand": ratio(m["shipped_units"], m["days"]), "daily_cogs": ratio(m["cogs"], m["days"]),
        "annualized_cogs": Calc(lambda c, d: safe_divide(c * 365, d, None), (m["cogs"], m["days"])),
        "utilization": Calc(lambda u, c: safe_divide(safe_divide(u, F.lit(UNITS_PER_PALLET)), c), (m["on_hand"], m["capacity_pallets"])),
        "avg_daily_units": ratio(m["shipped_units"], m["days"].ignoring()), "simulated_demand": Calc(lambda q, k: _number(q) * _number(k), (m["ordered_units"], m["multiplier"])),
        "carrying_cost": Calc(lambda v, r: v * (_number(r) / 100.0), (m["avg_daily_valuation"], m["carrying_rate"])),
        "order_otif": Each(("SalesOrderID",), Calc(lambda worst: _when(worst == 1).otherwise(0), (Leaf(sales, "min", "OnTimeInFullFlag", ("OnTimeInFullFlag",)),))),
    }
    m["margin_pct"] = ratio(m["gross_profit"], m["net_sales"])
    m["order_otif_rate"] = ratio(m["order_otif"], m["sales_orders"])
    m["cover_days"] = ratio(m["on_hand"], m["daily_demand"], NO_DEMAND)
    m["turns"] = ratio(m["annualized_cogs"], m["avg_daily_valuation"])
    m["dio"] = Calc(lambda t: safe_divide(F.lit(365), t), (m["turns"],))
    heavy = Calc(lambda d: d > 365, (m["dio"],))
    m["severe_excess"] = Each(("ProductKey",), m["valuation"], heavy)
    m["severe_excess_skus"] = Each(("ProductKey",), Calc(lambda v: _when(v.isNotNull()).otherwise(0), (m["valuation"],)), heavy)
    def velocity(d):
        bounds = [d > VELOCITY[0], d > VELOCITY[1], d > VELOCITY[2], d >= VELOCITY[3]]
        return tier(*[(c, str(k)) for k, c in enumerate(bounds, 1)], otherwise="5")

    for number in range(1, 6):
        within = Calc(lambda d, number=number: velocity(d) == str(number), (m["dio"],))
        m[f"tier_{number}_capital"] = Each(("ProductKey",), m["valuation"], within)
        m[f"tier_{number}_skus"] = Each(("ProductKey",), Calc(lambda v: _when(v.isNotNull()), (m["valuation"],)), within)
    m["risk_tier"] = Calc(
        lambda otif, out_rate: tier((otif < OTIF_TARGET, "High"), (out_rate > 0.001, "Moderate"), otherwise="Normal"), (m["otif_rate"], m["stockout_rate"])
    )
    error = Calc(lambda a, f: F.abs(F.coalesce(a, F.lit(0)) - F.coalesce(f, F.lit(0))), (m["ordered_units"], m["forecast_units"]))
    m["forecast_error"] = Each(("MonthYear", "ProductKey", "WarehouseKey"), error, Calc(lambda f: f.isNotNull(), (m["forecast_units"],)))
    m["wape"] = ratio(m["forecast_error"], m["ordered_units"])
    m["forecast_accuracy"] = Calc(lambda q, w: _when(q > 0, F.greatest(F.lit(0.0), 1 - w)), (m["ordered_units"], m["wape"]))
    m["forecast_bias"] = ratio(m["forecast_units"] - m["ordered_units"], m["ordered_units"])
    lead = either(m["actual_lead_time"], DEFAULT_LEAD_TIME)
    spread = Calc(lambda s, d: F.coalesce(s, d * DEFAULT_DEMAND_CV), (over_days(sales, "ShippedQuantity", "deviation"), m["avg_daily_units"]))
    m["lead_time_demand"] = Calc(lambda d, t: floor_round(d * t), (m["avg_daily_units"], lead))
    m["safety_stock"] = Calc(
        lambda level, d, s, t, ts: floor_round(z_score(level) * F.sqrt(F.greatest(F.lit(1.0), t * s * s + d * d * ts * ts))),
        (m["service_target"], m["avg_daily_units"], spread, lead, either(m["lead_time_deviation"], DEFAULT_LEAD_TIME_STD)),
    )
    m["reorder_point"] = m["lead_time_demand"] + m["safety_stock"]
    m["simulated_lead_time_demand"] = Calc(
        lambda q, n, k, t, shock: floor_round(safe_divide(q, n) * _number(k) * (t + shock)), (m["ordered_units"], m["days"], m["multiplier"], lead, m["shock_days"])
    )
    return m


def evaluate(
    star: Star, measures: list[str], group_by: list[str], where: dict[str, list] | None = None, date_roles: dict[str, str] | None = None, store_lines: bool = False
) -> DataFrame:
    """``measures`` by ``group_by`` within ``where`` (attribute -> allowed values). With
    ``store_lines`` what several facts make of the order lines is joined and written once."""
    known = _catalog()
    for m in measures:
        if m not in known:
            raise KeyError(f"unknown measure {m}")
    nodes = {m: known[m] for m in measures}
    if store_lines:
        wanted = columns_read(MODEL, nodes, group_by, where, date_roles)
        of_product = [a for a in dict.fromkeys([*group_by, *(where or {})]) if MODEL.attributes.get(a) == "DimProduct" and a != "ProductKey"]
        star = star.with_stored_lines(wanted, of_product)
    return evaluate_nodes(_WithCalendar(star), MODEL, nodes, group_by, where, date_roles)


@query
def semantic_measures(star: DerivedStar) -> DataFrame:
    return evaluate(
        star,
        ["net_sales", "cogs_pct", "fill_rate", "otif_rate", "po_spend", "defect_rate", "po_otif_rate", "stockout_incidents", "lost_revenue"],
        ["RegionKey", "CategoryName"],
    )


@query
def semantic_by_dock_month(star: DerivedStar) -> DataFrame:
    """The calendar follows the dock receipt instead of the order creation."""
    return evaluate(
        star, ["po_lines", "po_received_units", "po_otif_rate"], ["MonthYear", "SupplierTier"],
        where={"RegionKey": [0, 1]}, date_roles={"FactPurchaseOrder": "ActualDockReceiptDate"},
    )


@query
def context_stock_by_region_month(star: DerivedStar) -> DataFrame:
    """Balances on the last day of each month and region, beside rows that ignore the month."""
    return evaluate(
        star, ["on_hand", "available", "valuation", "avg_daily_valuation", "latest_snapshot", "snapshot_records", "total_snapshot_rows", "stockout_records",
               "dead_valuation", "healthy_valuation", "facilities", "capacity_pallets", "utilization"],
        ["RegionKey", "MonthYear"],
    )


@query
def context_capital_by_category(star: DerivedStar) -> DataFrame:
    """Turns, cover, aging and the products with more than a year of inventory."""
    return evaluate(
        star, ["cogs", "annualized_cogs", "daily_cogs", "turns", "dio", "carrying_cost", "severe_excess", "severe_excess_skus", "dead_pct", "slow_valuation",
               "stagnant_valuation", "cover_days", "active_skus"],
        ["CategoryName"],
    )


@query
def context_sales_by_channel_year(star: DerivedStar) -> DataFrame:
    """Distinct orders, orders whose worst line is on time, means and days of the context."""
    return evaluate(
        star, ["sales_orders", "sales_lines", "gross_profit", "margin_pct", "cycle_time_days", "order_otif_rate", "otif_rate", "daily_demand", "avg_daily_units"],
        ["ChannelName", "YearNumber"],
    )


@query
def context_planning_by_category_region(star: DerivedStar) -> DataFrame:
    """Forecast error per month and site, replenishment from daily deviation, risk by region."""
    return evaluate(
        star, ["forecast_units", "forecast_error", "wape", "forecast_accuracy", "forecast_bias", "lead_time_demand", "safety_stock", "reorder_point", "risk_tier"],
        ["CategoryName", "RegionKey"], store_lines=True,
    )


@query
def context_orders_in_two_regions(star: DerivedStar) -> DataFrame:
    """The same measures by year within a filter that keeps two regions and two suppliers' tiers apart."""
    return evaluate(
        star, ["forecast_error", "wape", "sales_orders", "margin_pct", "order_otif_rate", "lost_revenue", "top_lost_revenue", "stockout_rate"],
        ["YearNumber"], where={"RegionKey": [1, 3]},
    )


@query
def context_supply_by_tier(star: DerivedStar) -> DataFrame:
    return evaluate(
        star, ["po_orders", "po_overdue_lines", "contract_lead_time", "actual_lead_time", "lead_time_deviation", "lead_time_variance", "active_suppliers",
               "scorecard_otif", "critical_breach_pct"],
        ["SupplierTier"],
    )


@query
def context_supply_by_zone_year(star: DerivedStar) -> DataFrame:
    return evaluate(
        star, ["po_orders", "po_lines", "actual_lead_time", "lead_time_deviation", "active_suppliers", "scorecard_otif", "critical_breach_pct"], ["RegionZone", "YearNumber"]
    )


_TIERS = [f"tier_{k}_{what}" for k in range(1, 6) for what in ("capital", "skus")]


@query
def context_velocity_by_region(star: DerivedStar) -> DataFrame:
    """Capital and products per velocity tier, each product judged within the region."""
    return evaluate(star, [*_TIERS, "facilities", "utilization", "turns"], ["RegionKey"])


@query
def context_velocity_by_category(star: DerivedStar) -> DataFrame:
    return evaluate(star, [*_TIERS, "active_skus", "dead_valuation"], ["CategoryName"], where={"RegionKey": [0, 2]})


@query
def context_outages_by_category_month(star: DerivedStar) -> DataFrame:
    return evaluate(star, ["stockout_incidents", "stockout_days", "lost_revenue", "top_lost_revenue", "stockout_rate"], ["CategoryName", "MonthYear"])


@query
def context_scenarios_by_region(star: DerivedStar) -> DataFrame:
    """Each preset of the parameter table beside each region: its one value is selected."""
    return evaluate(star, ["simulated_demand", "simulated_lead_time_demand", "safety_stock", "carrying_cost"], ["ScenarioCode", "RegionKey"])


@query
def context_scenarios(star: DerivedStar) -> DataFrame:
    return evaluate(star, ["simulated_demand", "simulated_lead_time_demand", "carrying_rate", "turns"], ["ScenarioCode"], where={"ScenarioCode": ["SCN-BASE", "SCN-STRESS"]})


HIDDEN_SUFFIXES = ("Key", "Flag")


def served_view(star: Star, fact: str) -> DataFrame:
    """A fact without its technical keys and flags."""
    df = star.table(fact)
    return df.select(*[c for c in df.columns if not c.endswith(HIDDEN_SUFFIXES)])


# query -> fact: what reports may see of each fact
SERVED = {
    "served_sales_view": "FactSales", "served_purchase_view": "FactPurchaseOrder", "served_returns_view": "FactCustomerReturns",
    "served_forecast_view": "FactDemandForecast", "served_movement_view": "FactInventoryMovement", "served_snapshot_view": "FactInventorySnapshot",
    "served_stockout_view": "FactStockout", "served_scorecard_view": "FactSupplierMonthlyPerformance",
}


def _register(name: str, fact: str) -> None:
    def plan(star: DerivedStar) -> DataFrame:
        return served_view(star, fact)

    plan.__name__ = name
    query(plan)


for _name, _fact in SERVED.items():
    _register(_name, _fact)
