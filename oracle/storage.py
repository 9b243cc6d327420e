"""Statements for tidewater.plans.storage."""

from .base import inventory_mart, sales_mart

FIRST = """(SELECT * FROM {0} WHERE ingested_at < TIMESTAMP '2024-01-20'
            QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY "timestamp" DESC) = 1)"""


def merged(first: str, full: str, keys: list[str], day: str) -> str:
    match = " AND ".join(f"n.{k} = f.{k}" for k in keys)
    return f"""WITH fl AS ({first}), nw AS (SELECT * FROM ({full}) WHERE {day} >= DATE '2024-01-18')
        SELECT * FROM nw UNION ALL SELECT * FROM fl f WHERE NOT EXISTS (SELECT 1 FROM nw n WHERE {match})"""


BOTH = """(SELECT topic, "offset", ingested_at FROM bronze_sales UNION ALL SELECT topic, "offset", ingested_at FROM bronze_inv)"""

SQL = {
    "upsert_sales_mart": merged(sales_mart(FIRST.format("silver_sales")), "SELECT * FROM sales_mart", ["event_date", "product_id"], "event_date"),
    "upsert_inventory_mart": merged(
        inventory_mart(FIRST.format("silver_inv")), "SELECT * FROM inv_mart", ["snapshot_date", "warehouse_id", "product_id"], "snapshot_date"
    ),
    "incremental_lookback": " UNION ALL ".join(
        f"""SELECT '{t}' AS topic, "timestamp"::DATE AS event_date, count(*) AS rows FROM {s} WHERE "timestamp"::DATE >= DATE '2024-01-17' GROUP BY ALL"""
        for t, s in (("sales", "silver_sales"), ("inventory", "silver_inv"))
    ),
    "as_of_read": f"""SELECT topic, count(*) AS rows, max("offset") AS last_offset, max(ingested_at) AS last_ingest FROM {BOTH} WHERE ingested_at <= TIMESTAMP '2024-01-15 12:00:00' GROUP BY 1""",
    "compaction": """SELECT topic, error_reason, count(*) AS rows, sum("offset")::BIGINT AS offset_sum
        FROM (SELECT topic, error_reason, "offset" FROM class_sales UNION ALL SELECT topic, error_reason, "offset" FROM class_inv)
        WHERE error_reason IS NOT NULL GROUP BY 1, 2""",
    "offset_audit": """SELECT *, expected - received AS missing, (expected - received)::DOUBLE / expected::DOUBLE AS loss_rate
        FROM (SELECT topic, "partition", min("offset") AS first_offset, max("offset") AS last_offset, count(*) AS received,
                     max("offset") - min("offset") + 1 AS expected
              FROM (SELECT topic, "partition", "offset" FROM bronze_sales UNION ALL SELECT topic, "partition", "offset" FROM bronze_inv) GROUP BY 1, 2)""",
    "offset_rate": """WITH b AS (SELECT topic, "partition", "offset", ingested_at FROM bronze_sales UNION ALL SELECT topic, "partition", "offset", ingested_at FROM bronze_inv),
        p AS (SELECT topic, "partition", max("offset") FILTER (ingested_at <= TIMESTAMP '2024-01-15 12:00:00') + 1 AS a, max("offset") + 1 AS z FROM b
              WHERE ingested_at <= TIMESTAMP '2024-01-15 13:00:00' GROUP BY 1, 2)
        SELECT topic, count(*) AS partitions, sum(z)::BIGINT AS total_offsets, greatest(0.0::DOUBLE, (sum(z) - coalesce(sum(a), 0))::DOUBLE / 3600.0::DOUBLE) AS rows_per_second FROM p GROUP BY 1""",
    "ingest_history": f"""SELECT topic, ingested_at, added AS added_records, (sum(added) OVER (PARTITION BY topic ORDER BY ingested_at))::BIGINT AS total_records
        FROM (SELECT topic, ingested_at, count(*) AS added FROM {BOTH} GROUP BY 1, 2)""",
    "surrogate_keys": """WITH v AS (SELECT ProductSKU, EffectiveFrom, EffectiveFrom < DATE '1998-01-01' AS early FROM dim_product_history)
        SELECT ProductSKU, EffectiveFrom, row_number() OVER (ORDER BY NOT early, ProductSKU, EffectiveFrom) AS ProductKey FROM v""",
}
