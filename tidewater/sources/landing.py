"""Landing-zone helpers: audit columns, source choice, incremental and as-of reads."""

from __future__ import annotations

from datetime import date, datetime, time, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_audit(df: DataFrame, batch_id: str) -> DataFrame:
    """Add the file each row came from, the batch and the load time."""
    return df.select(
        "*",
        F.col("_metadata.file_name").alias("_source_file_name"),
        F.current_timestamp().alias("_ingested_at"),
        F.lit(batch_id).alias("_batch_id"),
    )


def first_usable(candidates: list[tuple[str, DataFrame | None]]) -> tuple[str, DataFrame] | None:
    """First source with rows, else the first that exists, else None."""
    present = [(name, df) for name, df in candidates if df is not None]
    for name, df in present:
        if not df.isEmpty():
            return name, df
    return present[0] if present else None


def table_or_none(spark, name: str) -> DataFrame | None:
    return spark.table(name) if spark.catalog.tableExists(name) else None


def since_lookback(source: DataFrame, stamp: str, newest: date | None, days: int = 3) -> DataFrame:
    """Source rows from ``days`` before the newest date already loaded.

    The stored timestamp is compared with a literal, so the filter reaches the files
    and their row groups. An empty target (None) loads everything.
    """
    if newest is None:
        return source
    first = datetime.combine(newest - timedelta(days=days), time.min).isoformat(" ")
    return source.where(F.col(stamp) >= F.lit(first).cast("timestamp"))


def as_of(df: DataFrame, ingested: str, moment: str) -> DataFrame:
    """State of an append-only table at ``moment``."""
    return df.where(F.col(ingested) <= F.lit(moment).cast("timestamp"))


def normalize(
    df: DataFrame, codes: list[str], texts: list[str], foreign_keys: list[str], required: list[str]
) -> DataFrame:
    """Staging rules: tidy codes and texts, default missing keys, drop unusable rows."""
    changes = {c: F.coalesce(F.nullif(F.upper(F.trim(c)), F.lit("")), F.lit("UNKNOWN")) for c in codes}
    changes |= {c: F.trim(c) for c in texts}
    changes |= {c: F.coalesce(F.col(c).try_cast("long"), F.lit(-1).cast("long")) for c in foreign_keys}
    return df.where(F.expr(" AND ".join(f"`{c}` IS NOT NULL" for c in required))).withColumns(changes)
