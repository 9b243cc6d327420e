"""ABC by cumulative revenue share and XYZ by demand variability."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import safe_divide, sample_std, tier
from ..session import cut_lineage
from .running import running_totals

# Cumulative revenue share of class A, of A and B; variation bounds of X, of Y.
A_SHARE, B_SHARE = 0.75, 0.95
X_CV, Y_CV = 0.25, 0.75


def abc_class(revenue: DataFrame, groups: list[str], slices: int | None = None) -> DataFrame:
    """Rows with ``revenue`` per SKU (and group) -> cumulative share and class.

    SKUs of equal revenue share one class. The revenue per SKU is used twice, so
    it is checkpointed: small next to the lines it was summed from.
    """
    revenue = cut_lineage(revenue)
    totals = running_totals(revenue, groups, "revenue", ["amount"], slices)
    share = safe_divide("run_amount", "all_amount")
    labels = totals.select(
        *groups, "revenue", share.alias("cumulative_share"),
        tier((share <= A_SHARE, "A"), (share <= B_SHARE, "B"), otherwise="C").alias("abc_class"),
    )
    return revenue.drop("amount").join(labels, [*groups, "revenue"])


def revenue_by(sales: DataFrame, keys: list[str]) -> DataFrame:
    return sales.groupBy(*keys).agg(F.sum("NetSalesAmount").alias("revenue")).withColumn("amount", F.col("revenue"))


def daily_moments(sales: DataFrame, keys: list[str], quantity: str) -> DataFrame:
    """Sum and sum of squares of daily demand; days without demand add nothing."""
    daily = sales.groupBy(*keys, "OrderDate").agg(F.sum(quantity).alias("q"))
    q = F.col("q").cast("double")  # squares of a very hot key leave the range of a long
    return daily.groupBy(*keys).agg(F.sum("q").alias("demand"), F.sum(q * q).alias("demand_sq"))


def xyz_class(sales: DataFrame, keys: list[str], days: Column) -> DataFrame:
    """Coefficient of variation of daily ordered units over all ``days`` of the calendar."""
    m = daily_moments(sales, keys, "OrderedQuantity").withColumn("days", days)
    cv = safe_divide(sample_std("days", "demand", "demand_sq"), safe_divide("demand", "days"), None)
    return m.select(
        *keys, "demand", cv.alias("cv"), tier((cv < X_CV, "X"), (cv < Y_CV, "Y"), otherwise="Z").alias("xyz_class")
    )
