"""The batch jobs over a lake directory: gold marts, maintenance, audit.

Layout below ``root``: ``<topic>/raw_events``, ``<topic>/structured_events``,
``<topic>/dlq_events`` and ``marts/<name>``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import marts, parsing, storage
from ..schemas import BRONZE, INVENTORY, SALES
from ..session import configure
from ..sources import landing

SALES_MART, INVENTORY_MART = "marts/fact_sales_summary", "marts/fact_inventory_health"
MARTS = {
    SALES: (SALES_MART, marts.sales_daily_summary, ["event_date", "product_id"], "event_date"),
    INVENTORY: (INVENTORY_MART, marts.inventory_health_daily, ["snapshot_date", "warehouse_id", "product_id"], "snapshot_date"),
}


def choose_source(spark: SparkSession, root: str, topic: str) -> DataFrame | None:
    """Silver if it has rows, else bronze payloads parsed on the fly, else None."""
    found = landing.first_usable(
        [
            ("silver", storage.read_fed(spark, f"{root}/{topic}/structured_events")),
            ("bronze", storage.read_fed(spark, f"{root}/{topic}/raw_events", BRONZE)),
        ]
    )
    if found is None:
        return None
    name, df = found
    if name == "silver":
        return df.drop("transformed_at")
    parsed = parsing.parse_flat(df, topic)
    return parsed.withColumn("timestamp", F.from_unixtime(F.col("timestamp").cast("long")).cast("timestamp"))


def refresh_marts(spark: SparkSession, root: str, lookback_days: int | None = None) -> dict[str, str]:
    """Recompute and upsert both marts; a topic without a source is skipped.

    With ``lookback_days`` only events from that many days before the newest
    date in the mart are read, and the dates they complete are replaced.
    """
    configure(spark)
    report = {}
    for topic, (path, build, keys, day) in MARTS.items():
        source = choose_source(spark, root, topic)
        if source is None:
            report[topic] = "skipped: no source table"
            continue
        if lookback_days is not None and storage.exists(spark, f"{root}/{path}"):
            newest = spark.read.parquet(f"{root}/{path}").agg(F.max(day)).first()[0]
            source = landing.since_lookback(source, "timestamp", newest, lookback_days)
        with storage.exclusive(spark, f"{root}/marts"):
            storage.upsert(spark, f"{root}/{path}", build(source), keys, day)
        report[topic] = "ok"
    return report


FED = ("raw_events", "structured_events", "dlq_events")


def maintain_lake(spark: SparkSession, root: str, target_bytes: int = 256 << 20, checkpoints: dict[str, str] | None = None) -> dict[str, str]:
    """Compact all eight tables; a missing or failing one does not stop the rest.

    ``checkpoints``: topic -> checkpoint of its silver stream, from which it is known which
    batches of the silver table and the quarantine are final. Without it those two keep
    their files.
    """
    tables: dict[str, list[str] | None] = {f"{root}/{topic}/{t}": None for topic in (SALES, INVENTORY) for t in FED}
    tables |= {f"{root}/{path}": [day] for path, _, _, day in MARTS.values()}
    followed = {f"{root}/{topic}/{t}": c for topic, c in (checkpoints or {}).items() for t in FED[1:]}
    with storage.exclusive(spark, f"{root}/marts"):
        return storage.maintain(spark, tables, target_bytes, followed)


def audit(spark: SparkSession, root: str) -> DataFrame:
    """Rows per mart."""
    counts = [
        spark.read.parquet(f"{root}/{path}").agg(F.count("*").alias("total_rows")).select(F.lit(path.split("/")[1]).alias("mart_name"), "total_rows")
        for path, *_ in MARTS.values()
    ]
    return counts[0].unionByName(counts[1])
