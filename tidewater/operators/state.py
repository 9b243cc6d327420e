"""Mart state that merges: stored partial aggregates, so that late rows touch one month only.

A partial holds per supplier, month and order what adds up (counts, sums, sums of squares), so
distinct orders stay exact. Each increment is stored in a partition of its own below the
months it touches; running it again replaces it. The mart's rows of those months
are then recomputed from the partials of those months alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import file_size, scratch_path
from .derived import order_partials, scorecard
from .storage import _drop, _writer, between_ends

MONTH, INCREMENT = "YearMonthDate", "increment"


def _dynamic(df: DataFrame, path: str, partition_by: list[str]) -> None:
    with file_size(df.sparkSession):
        _writer(df.hint("rebalance", *partition_by), "overwrite", partition_by).option("partitionOverwriteMode", "dynamic").parquet(path)


def add_increment(spark: SparkSession, lines: DataFrame, state: str, mart: str, increment: str) -> None:
    """Adds purchase-order lines to the stored state and refreshes the months they fall into."""
    staged = scratch_path(spark, "increment")
    _writer(order_partials(lines), "overwrite", []).parquet(staged)
    partial = spark.read.parquet(staged)
    _dynamic(partial.withColumn(INCREMENT, F.lit(increment)), state, [MONTH, INCREMENT])
    touched = partial.select(MONTH).distinct()
    stored = spark.read.schema(f"{partial._jdf.schema().toDDL()}, {INCREMENT} string").parquet(state)
    held = between_ends(stored, partial, MONTH).join(touched, MONTH, "left_semi")
    _dynamic(scorecard(held.drop(INCREMENT)), mart, [MONTH])
    _drop(spark, staged)


def merge_increments(spark: SparkSession, state: str) -> int:
    """One increment per month in place of many, for months that have several; says how many."""
    stored = spark.read.option("basePath", state).parquet(state)
    several = stored.groupBy(MONTH).agg(F.count_distinct(INCREMENT).alias("n")).where("n > 1").select(MONTH)
    staged = scratch_path(spark, "merged")
    sums = [c for c in stored.columns if c not in (MONTH, INCREMENT, "SupplierKey", "PurchaseOrderID")]
    rows = stored.join(several, MONTH, "left_semi").groupBy("SupplierKey", MONTH, "PurchaseOrderID").agg(*[F.sum(c).cast(stored.schema[c].dataType).alias(c) for c in sums])
    _writer(rows.withColumn(INCREMENT, F.lit("merged")), "overwrite", [MONTH]).parquet(staged)
    merged = spark.read.parquet(staged)
    months = [r[0] for r in merged.select(MONTH).distinct().collect()]  # one value per month
    from .storage import _rename

    for month in months:
        # the month's directory is swapped as a whole, so its partials never count twice
        place = f"{state}/{MONTH}={month}"
        aside = f"{state}/_aside-{month}"
        _rename(spark, place, aside)
        _writer(merged.where(F.col(MONTH) == F.lit(month)).drop(MONTH), "overwrite", [INCREMENT]).parquet(place)
        _drop(spark, aside)
    _drop(spark, staged)
    return len(months)
