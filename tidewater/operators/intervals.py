"""Stock as intervals: one row from a movement to the day before the next one.

A balance that holds for a year is one row here and 365 in the daily snapshot. What the
snapshot answers by rows per day follows from the ends of the intervals: the current
position from those that are still open, outages from adjacent empty ones, averages
over days from lengths, and totals of a group from the days on which something changes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .derived import inventory_balance

FROM, UNTIL = "FromDate", "UntilDate"


def stock_intervals(flows: DataFrame, keys: list[str], last_day: Column) -> DataFrame:
    """(keys, FromDate, UntilDate, OnHandQuantity, IsCurrent); the current one reaches ``last_day``."""
    following = F.lead("day").over(Window.partitionBy(*keys).orderBy("day"))
    held = inventory_balance(flows, keys).withColumn("next", following)
    until = F.coalesce(F.date_sub("next", 1), F.greatest(F.col("day"), last_day))
    return held.select(
        *keys, F.col("day").alias(FROM), until.alias(UNTIL), F.col("balance").alias("OnHandQuantity"), F.col("next").isNull().alias("IsCurrent")
    )


def days(start: str | Column = FROM, end: str | Column = UNTIL) -> Column:
    """Days of an interval, both ends included."""
    return (F.datediff(end, start) + 1).cast("long")


def days_since(first: Column) -> Column:
    """Days of an interval from ``first`` on, 0 if it ends before."""
    return F.greatest(F.lit(0).cast("long"), days(F.greatest(F.col(FROM), first)))


def on_day(intervals: DataFrame, day: Column) -> DataFrame:
    return intervals.where((F.col(FROM) <= day) & (F.col(UNTIL) >= day))


def merged(intervals: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, FromDate, UntilDate): adjacent intervals as one. They must not overlap within a key."""
    order = Window.partitionBy(*keys).orderBy(FROM)
    begins = F.coalesce(F.lag(UNTIL).over(order) < F.date_sub(FROM, 1), F.lit(True))
    run = F.sum(F.col("begins").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        intervals.select(*keys, FROM, UNTIL, begins.alias("begins")).withColumn("run", run)
        .groupBy(*keys, "run").agg(F.min(FROM).alias(FROM), F.max(UNTIL).alias(UNTIL)).drop("run")
    )


def changes(intervals: DataFrame, group: list[str], values: dict[str, Column], late: dict[str, tuple[Column, Column]] | None = None) -> DataFrame:
    """(group, day, n, values): by how much each day changes a group's totals.

    A value is added when its interval begins and taken away the day after it ends. One in
    ``late`` (first day, value) is added on a day of its own, if the interval lasts that long.
    """
    late = late or {}
    names = ["n", *values, *late]
    rows = intervals.select(*group, FROM, UNTIL, F.lit(1).cast("long").alias("n"), *[c.alias(k) for k, c in values.items()],
                            *[c.alias(k) for k, (_, c) in late.items()], *[F.greatest(d, F.col(FROM)).alias(f"_{k}") for k, (d, _) in late.items()])

    lasts = {k: F.col(f"_{k}") <= F.col(UNTIL) for k in late}

    def step(day: Column, parts: dict[str, Column]) -> Column:
        return F.struct(day.alias("day"), *[parts.get(k, F.lit(None)).cast(rows.schema[k].dataType).alias(k) for k in names])

    begin = step(F.col(FROM), {k: F.col(k) for k in ("n", *values)})
    later = [step(F.col(f"_{k}"), {k: F.when(lasts[k], F.col(k))}) for k in late]
    end = step(F.date_add(UNTIL, 1), {k: F.when(lasts[k], -F.col(k)) if k in late else -F.col(k) for k in names})
    steps = [begin, *later, end]
    each = rows.select(*group, F.inline(F.array(*steps)))
    return each.groupBy(*group, "day").agg(*[F.sum(k).alias(k) for k in names])


def rolled(change: DataFrame, group: list[str], names: list[str]) -> DataFrame:
    """The changes of coarser groups."""
    return change.groupBy(*group, "day").agg(*[F.sum(k).alias(k) for k in ["n", *names]])


def totals(change: DataFrame, group: list[str], names: list[str]) -> DataFrame:
    """(group, FromDate, UntilDate, n, values): a group's totals while nothing changes, without
    days on which it has no rows. A window holds the days of one group."""
    order = Window.partitionBy(*group).orderBy("day")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    kept = change.select(
        *group, F.col("day").alias(FROM), F.date_sub(F.lead("day").over(order), 1).alias(UNTIL),
        *[F.coalesce(F.sum(k).over(upto), F.lit(0)).alias(k) for k in ["n", *names]],
    )
    return kept.where("n > 0")


def over_days(value: str, first: Column | None = None) -> Column:
    """Sum of a total over all days, an aggregate; from ``first`` on if given."""
    length = days() if first is None else days_since(first)
    return F.sum(F.col(value) * length.cast("decimal(10,0)"))


def latest(value: str) -> Column:
    """A total on its group's last day, an aggregate."""
    return F.max_by(value, FROM)


def by_month(total: DataFrame) -> DataFrame:
    """Totals cut at the ends of months; ``month`` is the first day."""
    month = F.explode(F.sequence(F.trunc(FROM, "month"), F.trunc(UNTIL, "month"), F.expr("interval 1 month")))
    cut = total.withColumn("month", month)
    return cut.withColumns({FROM: F.greatest(F.col(FROM), F.col("month")), UNTIL: F.least(F.col(UNTIL), F.last_day("month"))})
