"""As-of join whose keys may hold any share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SLICE_DAYS = 32


def as_of(facts: DataFrame, versions: DataFrame, key: str, day: str, start: str, columns: list[str], slice_days: int = SLICE_DAYS) -> DataFrame:
    """Each fact with the ``columns`` of its key's latest version that starts on or before its day;
    null if there is none. ``versions`` holds one row per key and start.

    Facts and versions are merged by key and time slice, so a hot key is spread over its
    slices. The version in force at the end of one slice is carried into the next ones that
    have rows; that takes one row per key and slice.
    """
    number = lambda d: F.floor(F.unix_date(d) / slice_days)
    f = facts.select(F.col(key).alias("_k"), F.col(day).alias("_d"), number(day).alias("_s"), F.struct(*facts.columns).alias("_f"))
    v = versions.select(F.col(key).alias("_k"), F.col(start).alias("_d"), number(start).alias("_s"), F.struct(*columns).alias("_v"))
    nothing = lambda df, name: F.lit(None).cast(df.schema[name].dataType).alias(name)
    ends = v.groupBy("_k", "_s").agg(F.max_by("_v", "_d").alias("_v"))
    slices = f.select("_k", "_s", nothing(v, "_v")).distinct().unionByName(ends).groupBy("_k", "_s").agg(F.first("_v", ignorenulls=True).alias("_v"))
    before = Window.partitionBy("_k").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    carried = slices.select("_k", "_s", nothing(f, "_d"), nothing(f, "_f"), F.last("_v", ignorenulls=True).over(before).alias("_v")).where("_v IS NOT NULL")
    both = f.withColumn("_v", nothing(v, "_v")).unionByName(v.withColumn("_f", nothing(f, "_f"))).unionByName(carried)
    # what was carried comes first, a version before the facts of its day
    upto = Window.partitionBy("_k", "_s").orderBy(F.col("_d").asc_nulls_first(), F.col("_f").isNotNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = both.withColumn("_v", F.last("_v", ignorenulls=True).over(upto)).where("_f IS NOT NULL")
    return found.select("_f.*", *[F.col(f"_v.{c}").alias(c) for c in columns])
