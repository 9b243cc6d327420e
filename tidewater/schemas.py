"""Declared schemas of the event flow; nothing is inferred."""

from __future__ import annotations

SALES = "sales"
INVENTORY = "inventory"

# The two JSON event contracts.
SALES_EVENT = (
    "event_id string, timestamp double, product_id string, customer_id string, "
    "revenue double, units_sold bigint"
)
INVENTORY_EVENT = (
    "event_id string, timestamp double, product_id string, warehouse_id string, "
    "quantity_change bigint, event_type string"
)
EVENT_SCHEMAS = {SALES: SALES_EVENT, INVENTORY: INVENTORY_EVENT}

# A message as the broker hands it over, before casting.
MESSAGE = (
    "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"
)
BRONZE = (
    "kafka_key string, raw_payload string, topic string, partition int, offset bigint, "
    "kafka_timestamp timestamp, ingested_at timestamp"
)

# The given tables; declared so that a read starts no footer job.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

MART_CODEC = {"compression": "zstd", "parquet.compression.codec.zstd.level": "7"}
