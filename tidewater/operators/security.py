"""Row-level visibility from a user x region x warehouse mapping (-1 = all)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _grants(users: DataFrame, email: str | None) -> DataFrame:
    mail = F.lower("UserEmail")
    u = users.select(mail.alias("UserEmail"), F.col("RegionKey").alias("r"), F.col("WarehouseKey").alias("w"))
    return u if email is None else u.where(F.col("UserEmail") == email.lower())


def allowed_warehouses(users: DataFrame, warehouses: DataFrame, email: str | None = None) -> DataFrame:
    """(user, warehouse) pairs: global needs -1 for both keys; region -1 with a
    warehouse grants that warehouse only."""
    g = _grants(users, email)
    w = warehouses.select("WarehouseKey", "RegionKey")
    direct = g.where("w <> -1").select("UserEmail", F.col("w").alias("WarehouseKey"))
    # Which grants cover a whole region: one row per region named by the mapping.
    regional = g.where("r <> -1 AND w = -1").join(w, F.col("r") == F.col("RegionKey")).select("UserEmail", "WarehouseKey")
    everyone = g.where("r = -1 AND w = -1").select("UserEmail").distinct()
    # A global grant is spelled out per region so that it stays an equi-join.
    regions = w.select("RegionKey").distinct().agg(F.collect_set("RegionKey")).scalar()
    whole = everyone.select("UserEmail", F.explode(regions).alias("r")).join(w, F.col("r") == F.col("RegionKey"))
    known = direct.join(w.select("WarehouseKey"), "WarehouseKey", "left_semi")
    return known.select("UserEmail", "WarehouseKey").unionByName(regional).unionByName(whole.select("UserEmail", "WarehouseKey")).distinct()


def allowed_regions(users: DataFrame, warehouses: DataFrame, regions: DataFrame, email: str | None = None) -> DataFrame:
    """(user, region) pairs: here region -1 alone is global; warehouses bring their region."""
    g = _grants(users, email)
    every = regions.agg(F.collect_set("RegionKey")).scalar()
    direct = g.where("r <> -1").select("UserEmail", F.col("r").alias("RegionKey"))
    through = g.where("w <> -1").join(
        warehouses.select("WarehouseKey", "RegionKey"), F.col("w") == F.col("WarehouseKey")
    ).select("UserEmail", "RegionKey")
    whole = g.where("r = -1").select("UserEmail").distinct().select("UserEmail", F.explode(every).alias("RegionKey"))
    named = direct.unionByName(through).unionByName(whole).distinct()
    return named.join(regions.select("RegionKey"), "RegionKey", "left_semi").select("UserEmail", "RegionKey")


def secure(fact: DataFrame, users: DataFrame, warehouses: DataFrame, email: str, key: str = "WarehouseKey") -> DataFrame:
    """Fact rows of the warehouses a user may see."""
    keys = allowed_warehouses(users, warehouses, email).select(F.col("WarehouseKey").alias("_w"))
    return fact.join(keys, F.col(key) == F.col("_w"), "left_semi")
