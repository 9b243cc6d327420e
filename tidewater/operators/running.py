"""Running totals and ranks over orderings too large for one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def running_totals(
    df: DataFrame, groups: list[str], order: str, values: list[str], slices: int | None = None
) -> DataFrame:
    """One row per group and distinct ``order`` value, highest first, with for
    each value column ``run_<v>`` (total over order values >= this one) and
    ``all_<v>`` (total of the group), and the same for the row count ``n``.

    Equal order values share one total, so ties are merged before the shuffle
    and cannot overload a task. The merged rows are range-partitioned; each
    slice sums itself and receives the sum of the slices before it. The
    checkpoint fixes which rows are in which slice.
    """
    per_value = df.groupBy(*groups, order).agg(F.count("*").alias("n"), *[F.sum(v).alias(v) for v in values])
    by = [F.col(g) for g in groups] + [F.col(order).desc_nulls_last()]
    ranged = per_value.repartitionByRange(slices, *by) if slices else per_value.repartitionByRange(*by)
    ranged = cut_lineage(ranged.withColumn("_slice", F.spark_partition_id()))
    names = ["n", *values]

    inside = (
        Window.partitionBy("_slice", *groups)
        .orderBy(F.col(order).desc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = ranged.select("*", *[F.sum(v).over(inside).alias(f"_in_{v}") for v in names])

    # One row per slice and group: as small as the number of slices and groups.
    before = Window.partitionBy(*groups).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*groups)
    slice_sums = ranged.groupBy("_slice", *groups).agg(*[F.sum(v).alias(f"_s_{v}") for v in names])
    offsets = slice_sums.select(
        "_slice", *groups,
        *[F.sum(f"_s_{v}").over(before).alias(f"_before_{v}") for v in names],
        *[F.sum(f"_s_{v}").over(whole).alias(f"all_{v}") for v in names],
    )
    joined = local.join(offsets, ["_slice", *groups])
    return joined.select(
        *groups, order, *names,
        *[(F.col(f"_in_{v}") + F.coalesce(f"_before_{v}", F.lit(0))).alias(f"run_{v}") for v in names],
        *[f"all_{v}" for v in names],
    )


def ranked(df: DataFrame, groups: list[str], order: str, name: str, slices: int | None = None) -> DataFrame:
    """``df`` with its rank (ties equal, gaps after ties) by ``order``, highest first."""
    df = cut_lineage(df)
    totals = running_totals(df, groups, order, [], slices)
    ranks = totals.select(*groups, order, (F.col("run_n") - F.col("n") + 1).alias(name))
    return df.join(ranks, [*groups, order])


def previous(df: DataFrame, order: str, columns: list[str], slices: int | None = None) -> DataFrame:
    """``df`` with ``prev_<c>``: the columns of the row before in an order over all rows.

    Rows are range-partitioned; each slice looks back within itself, and its first row gets
    the last row of the slices before it, of which there is one for each slice. ``order`` is unique.
    """
    ranged = df.repartitionByRange(slices, order) if slices else df.repartitionByRange(order)
    ranged = cut_lineage(ranged.withColumn("_slice", F.spark_partition_id()))
    row = F.struct(F.col(order).alias("_o"), *columns)
    inside = Window.partitionBy("_slice").orderBy(order)
    lasts = ranged.groupBy("_slice").agg(F.max(row).alias("last"))
    ends = lasts.agg(F.sort_array(F.collect_list(F.struct("_slice", "last")))).scalar()
    found = ranged.withColumn("_prev", F.lag(row).over(inside)).withColumn("_ends", ends)
    handed = F.try_element_at(F.filter("_ends", lambda e: e["_slice"] < F.col("_slice")), F.lit(-1))["last"]
    found = found.withColumn("_prev", F.coalesce("_prev", handed))
    return found.select(*df.columns, *[F.col(f"_prev.{c}").alias(f"prev_{c}") for c in columns])


def numbered(df: DataFrame, order: list[str], name: str, start=0, slices: int | None = None) -> DataFrame:
    """``df`` with consecutive numbers from ``start`` + 1 in the order of unique columns."""
    ranged = df.repartitionByRange(slices, *order) if slices else df.repartitionByRange(*order)
    ranged = cut_lineage(ranged.withColumn("_slice", F.spark_partition_id()))
    sizes = ranged.groupBy("_slice").agg(F.count("*").alias("n")).agg(F.collect_list(F.struct("_slice", "n"))).scalar()
    before = F.aggregate(F.filter("_sizes", lambda s: s["_slice"] < F.col("_slice")), F.lit(0).cast("long"), lambda a, s: a + s["n"])
    place = F.row_number().over(Window.partitionBy("_slice").orderBy(*order))
    rows = ranged.withColumn("_place", place).withColumn("_sizes", sizes)
    return rows.select(*df.columns, (F.lit(start) + before + F.col("_place")).cast("long").alias(name))
