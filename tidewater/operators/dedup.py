"""Latest-row selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the greatest by ``order``, ties broken by the whole row.

    ``row_number() = 1`` is planned with a group limit before the shuffle, so of
    any number of copies of a hot key each task sends at most one.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    ordering = [F.col(c).desc_nulls_last() for c in order + rest]
    w = Window.partitionBy(*keys).orderBy(*ordering)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def latest_event(silver: DataFrame) -> DataFrame:
    return latest(silver, ["event_id"], ["timestamp"])
