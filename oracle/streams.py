"""Statements for tidewater.plans.streams."""

COLS = 'kafka_key, raw_payload, topic, "partition", "offset", kafka_timestamp'
DLQ = 'kafka_key, raw_payload, error_reason, topic, "partition", "offset", kafka_timestamp'

SQL = {
    "stream_bronze": f"SELECT {COLS} FROM bronze_sales UNION ALL SELECT {COLS} FROM bronze_inv",
    "stream_silver": "SELECT * EXCLUDE (ingested_at) FROM silver_sales",
    "stream_silver_inventory": "SELECT * EXCLUDE (ingested_at) FROM silver_inv",
    "stream_dlq": f"""SELECT {DLQ} FROM class_sales WHERE error_reason IS NOT NULL UNION ALL SELECT {DLQ} FROM class_inv WHERE error_reason IS NOT NULL""",
    "stream_restart": "SELECT count(*) AS rows, count(*) AS messages, 0::BIGINT AS repeated FROM bronze_sales",
    "stream_restart_inventory": "SELECT count(*) AS rows, count(*) AS messages, 0::BIGINT AS repeated FROM bronze_inv",
    "stream_compacted": " UNION ALL ".join(
        f"SELECT '{t}' AS topic, '{kind}' AS table_name, count(*) AS rows FROM class_{c}{where}"
        for t, c in (("sales", "sales"), ("inventory", "inv")) for kind, where in (("bronze", ""), ("silver", " WHERE error_reason IS NULL"), ("dlq", " WHERE error_reason IS NOT NULL"))
    ),
    "stream_bounded": """SELECT 'bronze_sales' AS query_name, count(*) AS rows, true AS several_batches FROM bronze_sales
        UNION ALL SELECT 'bronze_inventory', count(*), true FROM bronze_inv""",
}
