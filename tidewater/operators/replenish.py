"""Safety stock and reorder points per SKU and warehouse."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import floor_round, safe_divide, sample_std
from .segments import daily_moments

SITE = ["ProductKey", "WarehouseKey"]

# Fixed values used where history is missing.
DEFAULT_LEAD_TIME, DEFAULT_LEAD_TIME_STD, DEFAULT_DEMAND_CV = 14.0, 2.0, 0.25


def demand_and_lead_time(sales: DataFrame, po: DataFrame, days: Column) -> DataFrame:
    """One row per SKU and warehouse with the sums all policies need.

    Only sums, sums of squares and counts travel; every what-if case is then
    arithmetic on these rows.
    """
    lt = F.col("ActualLeadTimeDays")
    demand = daily_moments(sales, SITE, "ShippedQuantity")
    supply = po.groupBy("ProductKey", F.col("ReceivingWarehouseKey").alias("WarehouseKey")).agg(
        F.count(lt).alias("lt_n"), F.sum(lt).alias("lt_sum"), F.sum(lt * lt).alias("lt_sq"),
        F.sum("OrderedQuantity").alias("po_units"), F.count("*").alias("po_lines"),
    )
    return demand.join(supply, SITE, "left").withColumn("days", days)


def king(z, multiplier=1.0, shock=0.0, lead_time_std_factor=1.0) -> dict[str, Column]:
    """King's formula as named columns over ``demand_and_lead_time`` rows."""

    def lit(x):
        return (F.lit(x) if isinstance(x, (int, float)) else x).cast("double")

    z, multiplier, shock, factor = lit(z), lit(multiplier), lit(shock), lit(lead_time_std_factor)
    d = safe_divide("demand", "days") * multiplier
    d_std = F.coalesce(sample_std("days", "demand", "demand_sq") * multiplier, d * DEFAULT_DEMAND_CV)
    lt = F.coalesce(safe_divide("lt_sum", "lt_n", None), F.lit(DEFAULT_LEAD_TIME)) + shock
    lt_std = F.coalesce(sample_std("lt_n", "lt_sum", "lt_sq"), F.lit(DEFAULT_LEAD_TIME_STD)) * factor
    variance = lt * d_std * d_std + d * d * lt_std * lt_std
    safety = floor_round(z * F.sqrt(F.greatest(F.lit(1.0), variance)))
    lead_demand = floor_round(d * lt)
    return {
        "avg_daily_demand": d, "std_daily_demand": d_std, "lead_time_days": lt, "lead_time_std": lt_std,
        "safety_stock": safety, "lead_time_demand": lead_demand, "reorder_point": lead_demand + safety,
    }


def policy_columns(z: float = 1.65) -> dict[str, Column]:
    # Half a mean purchase line stands for the planned cycle stock.
    return king(z) | {"cycle_stock": floor_round(safe_divide("po_units", F.col("po_lines") * 2))}


def policy(stats: DataFrame, z: float = 1.65) -> DataFrame:
    return stats.select(*SITE, *[c.alias(n) for n, c in policy_columns(z).items()])


def takes_part(imbalance: Column, groups: list[str], node: str) -> Column:
    """Whether ``transfers`` ships from or to a row's node: laid end to end, largest first, its
    stretch begins before the shorter of the two sides of its group ends."""
    units = F.abs(imbalance)
    same = Window.partitionBy(*groups, imbalance > 0)
    before = F.sum(F.when(imbalance != 0, units)).over(same.orderBy(F.desc(units), node).rowsBetween(Window.unboundedPreceding, Window.currentRow)) - units
    whole = Window.partitionBy(*groups)
    surplus, deficit = [F.coalesce(F.sum(F.when(c, units)).over(whole), F.lit(0)) for c in (imbalance > 0, imbalance < 0)]
    return (imbalance != 0) & (before < F.least(surplus, deficit))


def transfers(nodes: DataFrame, groups: list[str], node: str) -> DataFrame:
    """Match surplus to deficit inside each group.

    ``nodes`` has one row per node with a signed ``imbalance``. Both sides are
    laid end to end, largest first; every stretch between two consecutive
    boundaries belongs to one origin and one destination. A group of n nodes
    yields fewer than n transfers, and no pair of nodes is ever formed that
    does not ship.
    """
    side = F.when(F.col("imbalance") > 0, "surplus").otherwise("deficit")
    sized = nodes.where("imbalance <> 0").select(*groups, node, side.alias("side"), F.abs("imbalance").alias("units"))
    stacked = Window.partitionBy(*groups, "side").orderBy(F.desc("units"), node).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = sized.withColumn("end", F.sum("units").over(stacked))
    along = Window.partitionBy(*groups).orderBy("end", "side", node)
    ahead = along.rowsBetween(Window.currentRow, Window.unboundedFollowing)

    def nearest(which):
        return F.first(F.when(F.col("side") == which, F.col(node)), ignorenulls=True).over(ahead)

    cut = ends.select(
        *groups,
        nearest("surplus").alias("origin"),
        nearest("deficit").alias("destination"),
        (F.col("end") - F.coalesce(F.lag("end").over(along), F.lit(0))).alias("transfer_units"),
    )
    return cut.where("transfer_units > 0 AND origin IS NOT NULL AND destination IS NOT NULL")
