"""Facts that follow from other facts: balances, snapshots, outage episodes,
supplier scorecards, versioned dimensions and the calendar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import date_key, safe_divide, sample_std, tier


# -- inventory --------------------------------------------------------------


def inventory_balance(flows: DataFrame, keys: list[str]) -> DataFrame:
    """Daily net flow and a balance that never falls below zero.

    balance(t) = max(0, balance(t-1) + flow(t)) equals the prefix sum lifted by
    its own running minimum, so two window sums over the daily flows suffice.
    The flows are summed per day first, which bounds a window by its days.
    """
    daily = flows.groupBy(*keys, "day").agg(F.sum("quantity_change").alias("net_flow"))
    upto = Window.partitionBy(*keys).orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    s = daily.withColumn("prefix", F.sum("net_flow").over(upto))
    floor = F.least(F.lit(0).cast("long"), F.min("prefix").over(upto))
    return s.withColumn("balance", F.col("prefix") - floor).drop("prefix")


def daily_snapshot(intervals: DataFrame) -> DataFrame:
    """Dense day spine from intervals of unchanged stock: one row per key and day."""
    return intervals.withColumn("SnapshotDate", F.explode(F.sequence("FromDate", "UntilDate")))


def lost_demand(episodes: DataFrame, demand: DataFrame, keys: list[str], days: int = 30) -> DataFrame:
    """Mean daily demand of the ``days`` before the outage times its length.

    Episodes and daily demand share one ordered window per key, so the trailing
    sum is a range frame instead of a range join.
    """
    none_long, none_date = F.lit(None).cast("long"), F.lit(None).cast("date")
    marks = episodes.select(
        *keys, F.col("StartDate").alias("day"), F.lit(0).cast("long").alias("units"),
        "StartDate", "EndDate", "StockoutDurationDays",
    )
    sales = demand.select(
        *keys, "day", "units", none_date.alias("StartDate"), none_date.alias("EndDate"), none_long.alias("StockoutDurationDays")
    )
    number = F.datediff("day", F.lit("1970-01-01").cast("date"))
    trailing = Window.partitionBy(*keys).orderBy("day_number").rangeBetween(-days, -1)
    both = marks.unionByName(sales).withColumn("day_number", number)
    total = F.coalesce(F.sum("units").over(trailing), F.lit(0).cast("long"))
    return (
        both.withColumn("recent", total)
        .where(F.col("StartDate").isNotNull())
        .withColumn(
            "EstimatedLostDemandUnits",
            F.expr(f"(2 * recent * StockoutDurationDays + {days}) div {2 * days}"),
        )
        .select(*keys, "StartDate", "EndDate", "StockoutDurationDays", "EstimatedLostDemandUnits")
    )


# -- supplier scorecard -----------------------------------------------------

SCORECARD_INPUT = [
    "SupplierKey", "POCreationDate", "PurchaseOrderID", "OrderedQuantity", "ReceivedQuantity", "RejectedQuantity",
    "ExtendedPOAmount", "IsDeliveredOnTimeFlag", "IsDeliveredInFullFlag", "IsSupplierOTIFFlag",
    "ActualLeadTimeDays", "LeadTimeVarianceDays",
]

CRITICAL_BREACH, MODERATE_RISK, LOW_RISK = "Critical SLA Breach", "Moderate Risk", "Low Risk"


def order_partials(po: DataFrame) -> DataFrame:
    """What adds up, per supplier, month and order: partials of two sets of lines merge by
    adding, and counting distinct orders is an ordinary second aggregation."""
    lt = F.col("ActualLeadTimeDays")
    month = F.trunc("POCreationDate", "month")
    return po.groupBy("SupplierKey", month.alias("YearMonthDate"), "PurchaseOrderID").agg(
        F.count("*").alias("lines"),
        *[F.sum(c).alias(c) for c in ("OrderedQuantity", "ReceivedQuantity", "RejectedQuantity", "ExtendedPOAmount")],
        F.sum("IsDeliveredOnTimeFlag").alias("on_time"),
        F.sum("IsDeliveredInFullFlag").alias("in_full"),
        F.sum("IsSupplierOTIFFlag").alias("otif"),
        F.count(lt).alias("lt_n"),
        F.sum(lt).alias("lt_sum"),
        F.sum(lt * lt).alias("lt_sq"),
        F.count_if(F.col("LeadTimeVarianceDays") > 0).alias("late"),
    )


def supplier_monthly(po: DataFrame) -> DataFrame:
    """Supplier x month scorecard; the OTIF rate here is over all lines."""
    return scorecard(order_partials(po), merged=True)


def scorecard(partials: DataFrame, merged: bool = False) -> DataFrame:
    """The scorecard from partials; an order may have several unless they are ``merged``."""
    sums = [c for c in partials.columns if c not in ("SupplierKey", "YearMonthDate", "PurchaseOrderID")]
    per_order = partials if merged else partials.groupBy("SupplierKey", "YearMonthDate", "PurchaseOrderID").agg(
        *[F.sum(c).cast(partials.schema[c].dataType).alias(c) for c in sums]
    )
    g = per_order.groupBy("SupplierKey", "YearMonthDate").agg(
        F.count("*").alias("TotalPOCount"),
        F.sum("lines").alias("TotalPOLines"),
        F.sum("OrderedQuantity").alias("TotalOrderedQuantity"),
        F.sum("ReceivedQuantity").alias("TotalReceivedQuantity"),
        F.sum("RejectedQuantity").alias("TotalRejectedQuantity"),
        F.sum("ExtendedPOAmount").alias("TotalSpendAmount"),
        F.sum("on_time").alias("OnTimePOCount"),
        F.sum("in_full").alias("InFullPOCount"),
        F.sum("otif").alias("OTIFLineCount"),
        F.sum("late").alias("LateDeliveryCount"),
        F.sum("lt_n").alias("lt_n"), F.sum("lt_sum").alias("lt_sum"), F.sum("lt_sq").alias("lt_sq"),
    )
    rate = safe_divide(F.col("OTIFLineCount") * 100, "TotalPOLines")
    return g.select(
        (F.col("SupplierKey") * 1000000 + F.year("YearMonthDate") * 100 + F.month("YearMonthDate")).alias("SupplierMonthlyKey"),
        date_key("YearMonthDate").alias("YearMonthDateKey"),
        F.date_format("YearMonthDate", "yyyy-MM").alias("YearMonth"),
        *[c for c in g.columns if not c.startswith("lt_")],
        rate.alias("OTIFRatePct"),
        safe_divide("lt_sum", "lt_n", None).alias("AverageLeadTimeDays"),
        sample_std("lt_n", "lt_sum", "lt_sq").alias("LeadTimeStdDevDays"),
        safe_divide(F.col("TotalReceivedQuantity") * 100, "TotalOrderedQuantity").alias("LineFillRatePct"),
        tier((rate < 15, CRITICAL_BREACH), (rate < 60, MODERATE_RISK), otherwise=LOW_RISK).alias("SupplierMonthlyRiskRating"),
    )


# -- versioned dimensions ---------------------------------------------------


def scd2_build(history: DataFrame, key: str, attributes: list[str], changed_on: str) -> DataFrame:
    """Versions from dated attribute rows: a version starts where a value changes.

    ``history`` must hold one row per key and date (see ``dedup.latest``).
    """
    w = Window.partitionBy(key).orderBy(changed_on)
    state = F.struct(*attributes)
    starts = (
        history.withColumn("_prev", F.lag(state).over(w))
        .where(F.col("_prev").isNull() | ~state.eqNullSafe(F.col("_prev")))
        .drop("_prev")
    )
    end = F.lead(changed_on).over(w)
    return starts.select(
        key, *attributes,
        F.col(changed_on).alias("EffectiveFrom"),
        F.coalesce(end, F.lit("9999-12-31").cast("date")).alias("EffectiveTo"),
        end.isNull().alias("IsCurrent"),
    )


def scd2_apply(dim: DataFrame, incoming: DataFrame, key: str, attributes: list[str], as_of: str) -> DataFrame:
    """Close current versions that changed, add the new ones, keep the rest.

    One outer join on the key decides all three cases; each joined row then
    yields the rows it stands for.
    """
    day, far = F.lit(as_of).cast("date"), F.lit("9999-12-31").cast("date")
    new = incoming.select(F.col(key).alias("_k"), F.struct(*attributes).alias("_new"))
    cur = dim.where("IsCurrent").join(new, F.col(key) == F.col("_k"), "full_outer")
    old_state, new_state = F.struct(*[F.col(a) for a in attributes]), F.col("_new")

    def row(k, state, start, end, current):
        return F.struct(
            k.alias(key), *[state[a].alias(a) for a in attributes],
            start.alias("EffectiveFrom"), end.alias("EffectiveTo"), F.lit(current).alias("IsCurrent"),
        )

    keep = row(F.col(key), old_state, F.col("EffectiveFrom"), F.col("EffectiveTo"), True)
    closed = row(F.col(key), old_state, F.col("EffectiveFrom"), day, False)
    opened = row(F.col("_k"), new_state, day, far, True)
    versions = (
        F.when(F.col(key).isNull(), F.array(opened))
        .when(F.col("_k").isNull() | old_state.eqNullSafe(new_state), F.array(keep))
        .otherwise(F.array(closed, opened))
    )
    current = cur.select(F.inline(versions))
    return dim.where("NOT IsCurrent").select(*current.columns).unionByName(current)


def scd2_versions(observed: DataFrame, key: str, attributes: list[str], changed_on: str) -> DataFrame:
    """Versions as of ``scd2_build``, with ``SeenOn``: the days on which a version was observed.

    A later observation that changes nothing starts no version, but decides where one ends if
    a change dated between the two arrives afterwards, so it is kept.
    """
    w = Window.partitionBy(key).orderBy(changed_on)
    state = F.struct(*attributes)
    differs = F.coalesce(~state.eqNullSafe(F.lag(state).over(w)), F.lit(True))
    run = F.sum(F.col("_new").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    runs = observed.withColumn("_new", differs).withColumn("_run", run).groupBy(key, "_run").agg(
        F.first(state).alias("_state"), F.min(changed_on).alias("EffectiveFrom"), F.sort_array(F.collect_list(changed_on)).alias("SeenOn")
    )
    end = F.lead("EffectiveFrom").over(Window.partitionBy(key).orderBy("EffectiveFrom"))
    return runs.select(
        key, *[F.col(f"_state.{a}").alias(a) for a in attributes], "EffectiveFrom",
        F.coalesce(end, F.lit("9999-12-31").cast("date")).alias("EffectiveTo"), end.isNull().alias("IsCurrent"), "SeenOn",
    )


def scd2_splice(dim: DataFrame, changes: DataFrame, key: str, attributes: list[str], changed_on: str) -> DataFrame:
    """``dim`` (of ``scd2_versions``) after changes of any date, also inside its history.

    Only keys with a change are built anew, from the days on which their versions were seen; a
    change replaces what was observed on its own day. The order in which changes arrive
    does not matter unless two of one day differ.
    """
    keys = changes.select(key).distinct()
    seen = dim.join(keys, key, "left_semi").select(key, *attributes, F.explode("SeenOn").alias(changed_on))
    seen = seen.join(changes.select(key, changed_on), [key, changed_on], "left_anti")
    rebuilt = scd2_versions(seen.unionByName(changes.select(key, *attributes, changed_on)), key, attributes, changed_on)
    return dim.join(keys, key, "left_anti").select(*rebuilt.columns).unionByName(rebuilt)


# -- calendar ---------------------------------------------------------------


def calendar(bounds: DataFrame) -> DataFrame:
    """One row per day between ``first_day`` and ``last_day``; fiscal year from July."""
    d = F.col("FullDate")
    m = F.month(d)
    fiscal_month = (m + 5) % 12 + 1
    fixed_holiday = F.date_format(d, "MM-dd").isin("01-01", "07-04", "12-25")
    days = bounds.select(F.explode(F.sequence("first_day", "last_day")).alias("FullDate"))
    return days.select(
        date_key(d).alias("DateKey"),
        d.alias("FullDate"),
        F.dayofweek(d).alias("DayOfWeek"),
        F.date_format(d, "EEEE").alias("DayName"),
        F.dayofmonth(d).alias("DayOfMonth"),
        F.dayofyear(d).alias("DayOfYear"),
        F.weekofyear(d).alias("WeekOfYear"),
        m.alias("MonthNumber"),
        F.date_format(d, "MMMM").alias("MonthName"),
        F.date_format(d, "yyyy-MM").alias("MonthYear"),
        F.quarter(d).alias("QuarterNumber"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("QuarterName"),
        F.year(d).alias("YearNumber"),
        fiscal_month.alias("FiscalMonthNumber"),
        F.concat(F.lit("FQ"), (F.floor((fiscal_month - 1) / 3) + 1).cast("string")).alias("FiscalQuarter"),
        (F.year(d) + F.when(m >= 7, 1).otherwise(0)).alias("FiscalYear"),
        F.dayofweek(d).between(2, 6).alias("IsWeekday"),
        fixed_holiday.alias("IsHoliday"),
        tier(
            (m >= 11, "Peak Holiday"), (m.isin(8, 9), "Back-to-School"), (m.isin(6, 7), "Summer Low"), otherwise="Normal"
        ).alias("SeasonalityPeriod"),
    )

