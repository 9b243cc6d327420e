"""Statements for tidewater.plans.events."""

from .base import div, inventory_mart, rnd, sales_mart  # noqa: F401

ENV = 'kafka_key, raw_payload, topic, "partition", "offset", kafka_timestamp, ingested_at'
PREVIEW = "CASE WHEN length(raw_payload) > 75 THEN substring(raw_payload, 1, 75) || '...' ELSE raw_payload END"

SQL = {
    "bronze_envelope": f"SELECT {ENV} FROM bronze_sales UNION ALL SELECT {ENV} FROM bronze_inv",
    "json_parse_permissive": """SELECT "partition", "offset", event_id, "timestamp", product_id, customer_id, revenue, units_sold, _corrupt_record FROM parsed_sales""",
    "json_parse_flat": """SELECT event_id, "timestamp", product_id, warehouse_id, quantity_change, event_type FROM parsed_inv""",
    "event_classify": """SELECT topic, "partition", "offset", error_reason FROM class_sales
        UNION ALL SELECT topic, "partition", "offset", error_reason FROM class_inv""",
    "valid_dlq_split": """SELECT topic, CASE WHEN error_reason IS NULL THEN 'silver' ELSE 'quarantine' END AS destination, count(*) AS rows,
        min("offset") AS first_offset, max("offset") AS last_offset
        FROM (SELECT topic, "offset", error_reason FROM class_sales UNION ALL SELECT topic, "offset", error_reason FROM class_inv) GROUP BY 1, 2""",
    "epoch_cast": """SELECT event_id, "timestamp", make_timestamp(round("timestamp" * 1000000)::BIGINT) AS event_time,
        make_timestamp(round("timestamp" * 1000000)::BIGINT)::DATE AS event_date, make_timestamp(floor("timestamp")::BIGINT * 1000000)::DATE AS fallback_date
        FROM parsed_sales WHERE event_id IS NOT NULL""",
    "null_guards": f"""SELECT product_id, net, coalesce(picks, 0) AS picks, greatest(net, 1) AS floored,
        {rnd(div('picks', 'greatest(net, 1)', None), 4)} AS turnover, {div('net', 'picks', '-1.0')} AS cover
        FROM (SELECT product_id, sum(quantity_change)::BIGINT AS net, (sum(abs(quantity_change)) FILTER (event_type = 'PICK'))::BIGINT AS picks
              FROM silver_inv GROUP BY 1)""",
    "payload_preview": f"""SELECT "partition", "offset", error_reason, {PREVIEW} AS preview FROM class_sales WHERE error_reason IS NOT NULL""",
    "staging_normalize": """SELECT c_custkey, trim(c_name) AS c_name, upper(trim(c_mktsegment)) AS c_mktsegment,
        CASE WHEN c_custkey % 11 = 0 THEN -1 ELSE c_nationkey END::BIGINT AS c_nationkey, c_acctbal FROM customer WHERE c_custkey IS NOT NULL""",
    "landing_audit": "SELECT 'lineitem.parquet' AS _source_file_name, 'batch-1' AS _batch_id, count(*) AS rows, count(*) AS stamped_rows FROM lineitem",
    "source_fallback": sales_mart("""(SELECT event_id, product_id, revenue, units_sold, make_timestamp(floor("timestamp")::BIGINT * 1000000) AS "timestamp"
        FROM parsed_sales QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY floor("timestamp") DESC NULLS LAST, product_id DESC NULLS LAST) = 1)"""),
    "source_fallback_inventory": inventory_mart("""(SELECT event_id, product_id, warehouse_id, quantity_change, event_type, make_timestamp(floor("timestamp")::BIGINT * 1000000) AS "timestamp"
        FROM parsed_inv QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY floor("timestamp") DESC NULLS LAST, product_id DESC NULLS LAST) = 1)"""),
    "dedup_latest_event": "SELECT * FROM dedup_sales",
    "dedup_latest_natural_key": """SELECT * FROM silver_sales
        QUALIFY row_number() OVER (PARTITION BY customer_id, product_id ORDER BY ingested_at DESC, "timestamp" DESC, event_id DESC) = 1""",
    "sales_daily_summary": "SELECT * FROM sales_mart",
    "inventory_health_daily": "SELECT * FROM inv_mart",
    "product_sales_topn": f"""SELECT product_id, count(*) AS total_orders, sum(units_sold)::BIGINT AS total_units, {rnd('sum(revenue)', 2)} AS gross_revenue,
        make_timestamp(round(min("timestamp") * 1000000)::BIGINT) AS earliest_order, make_timestamp(round(max("timestamp") * 1000000)::BIGINT) AS latest_order
        FROM parsed_sales GROUP BY 1 ORDER BY gross_revenue DESC NULLS LAST, product_id NULLS FIRST LIMIT 10""",
    "movement_by_type": """SELECT warehouse_id, event_type, count(*) AS movement_events, sum(quantity_change)::BIGINT AS net_stock_delta FROM parsed_inv GROUP BY 1, 2""",
    "sales_mart_latest": "SELECT * FROM sales_mart ORDER BY event_date DESC, total_revenue DESC, product_id LIMIT 20",
    "stockout_alerts": """SELECT * FROM inv_mart WHERE stockout_risk_status IN ('CRITICAL_STOCKOUT', 'LOW_STOCK_WARNING')
        ORDER BY days_of_supply NULLS LAST, snapshot_date, warehouse_id, product_id LIMIT 20""",
    "risk_filter": "SELECT * FROM inv_mart WHERE stockout_risk_status IN ('CRITICAL_STOCKOUT', 'LOW_STOCK_WARNING')",
    "mart_totals": f"""SELECT {rnd('sum(total_revenue)', 2)} AS total_revenue, sum(total_units_sold)::BIGINT AS total_units_sold,
        sum(transaction_count)::BIGINT AS total_transactions FROM sales_mart""",
    "risk_status_counts": """SELECT count(*) AS total_skus, count(*) FILTER (stockout_risk_status = 'CRITICAL_STOCKOUT') AS critical_count,
        count(*) FILTER (stockout_risk_status = 'LOW_STOCK_WARNING') AS warning_count, count(*) FILTER (stockout_risk_status = 'OPTIMAL') AS optimal_count FROM inv_mart""",
    "top_risks": """SELECT snapshot_date, warehouse_id, product_id, current_on_hand, daily_turnover_rate, days_of_supply, stockout_risk_status FROM inv_mart
        ORDER BY CASE stockout_risk_status WHEN 'CRITICAL_STOCKOUT' THEN 1 WHEN 'LOW_STOCK_WARNING' THEN 2 ELSE 3 END, days_of_supply NULLS LAST,
        snapshot_date, warehouse_id, product_id LIMIT 10""",
    "row_counts": """WITH c AS (SELECT 'sales' AS topic, error_reason FROM class_sales UNION ALL SELECT 'inventory', error_reason FROM class_inv),
        t AS (SELECT topic || '.bronze' AS table_name, count(*) AS rows FROM c GROUP BY topic
              UNION ALL SELECT topic || '.silver', count(*) FILTER (error_reason IS NULL) FROM c GROUP BY topic
              UNION ALL SELECT topic || '.quarantine', count(*) FILTER (error_reason IS NOT NULL) FROM c GROUP BY topic)
        SELECT table_name, rows FROM t UNION ALL SELECT 'total', sum(rows)::BIGINT FROM t""",
    "dlq_recent": f"""SELECT kafka_timestamp, topic, "partition", "offset", error_reason, {PREVIEW} AS raw_payload FROM class_sales
        WHERE error_reason IS NOT NULL ORDER BY kafka_timestamp DESC, "partition", "offset" LIMIT 10""",
    "dlq_by_reason": """SELECT topic, error_reason, count(*) AS rows FROM (SELECT topic, error_reason FROM class_sales UNION ALL SELECT topic, error_reason FROM class_inv)
        WHERE error_reason IS NOT NULL GROUP BY 1, 2""",
    "mart_audit": """SELECT 'fact_sales_summary' AS mart_name, count(*) AS total_rows FROM sales_mart
        UNION ALL SELECT 'fact_inventory_health', count(*) FROM inv_mart""",
    "current_stock_view": "SELECT product_id, warehouse_id, sum(quantity_change)::BIGINT AS current_stock FROM silver_inv GROUP BY 1, 2",
    "rank_in_warehouse": """SELECT warehouse_id, product_id, quantity, (quantity * UnitStandardCost)::DOUBLE AS stock_value,
        rank() OVER (PARTITION BY warehouse_id ORDER BY quantity DESC) AS rank_in_warehouse
        FROM (SELECT warehouse_id, product_id, sum(quantity_change)::BIGINT AS quantity FROM dedup_inv GROUP BY 1, 2) LEFT JOIN dim_product ON product_id = ProductSKU""",
    "ingest_rate": """SELECT ingested_at, rows, coalesce(rows::DOUBLE / nullif(epoch(ingested_at) - epoch(lag(ingested_at) OVER (ORDER BY ingested_at)), 0), 0.0) AS rows_per_second
        FROM (SELECT ingested_at, count(*) AS rows FROM (SELECT ingested_at FROM bronze_sales UNION ALL SELECT ingested_at FROM bronze_inv) GROUP BY 1)""",
}
