"""Event side: the given ``events`` table re-read as two message topics.

Conventions (all integer arithmetic on ``event_id``, so they can be stated in
SQL too): every tenth event is delivered a second time one hour later with a
changed amount, and five residues of 97 carry a payload defect.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import parsing
from ..schemas import INVENTORY, SALES
from ..session import configure
from .tables import read_table

HOUR_US = 3_600_000_000


def _quoted(name: str, value: Column) -> Column:
    return F.concat(F.lit(f'"{name}": "'), value, F.lit('"'))


def _plain(name: str, value: Column) -> Column:
    return F.concat(F.lit(f'"{name}": '), value)


def _payload(topic: str) -> Column:
    eid = F.col("event_id")
    defect = F.col("defect")
    amount = F.col("value").cast("decimal(12,2)")
    common = [
        F.when(defect != 1, _quoted("event_id", F.concat(F.lit("EVT-"), eid.cast("string")))),
        _plain("timestamp", F.concat(F.expr("cast(epoch_us div 1000000 as string)"), F.lit("."), F.lpad((F.col("epoch_us") % 1000000).cast("string"), 6, "0"))),
        F.when(defect != 2, _quoted("product_id", F.concat(F.lit("SKU-"), F.col("user_id").cast("string")))),
    ]
    if topic == SALES:
        revenue = F.when(defect == 3, -amount).otherwise(amount) + F.col("copy")
        own = [
            _quoted("customer_id", F.concat(F.lit("CUST-"), (eid % 50).cast("string"))),
            _plain("revenue", revenue.cast("decimal(12,2)").cast("string")),
            _plain("units_sold", (eid % 5 + 1).cast("string")),
        ]
    else:
        kind = (
            F.when(F.col("event_type") == "purchase", "PICK")
            .when(F.col("event_type") == "error", "ADJUSTMENT")
            .otherwise("RECEIPT")
        )
        change = (
            F.when(kind == "PICK", -(eid % 50 + 1))
            .when(kind == "RECEIPT", eid % 100 + 1)
            .otherwise(eid % 41 - 20)
        )
        own = [
            F.when(defect != 3, _quoted("warehouse_id", F.concat(F.lit("WH-"), (eid % 10).cast("string")))),
            _plain("quantity_change", change.cast("string")),
            _quoted("event_type", kind),
        ]
    text = F.concat(F.lit("{"), F.concat_ws(", ", *common, *own), F.lit("}"))
    return (
        F.when(defect == 0, F.substring(text, 1, 40))
        .when(defect == 4, F.lit(""))
        .otherwise(text)
    )


def messages(events: DataFrame, topic: str) -> DataFrame:
    """Broker messages of one topic, plus the hour in which they were ingested."""
    eid = F.col("event_id")
    delivered = (
        events.select("event_id", "ts", "user_id", "event_type", "value")
        .withColumn("copy", F.explode(F.when(eid % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
        .withColumn("epoch_us", F.unix_micros(F.col("ts").cast("timestamp")) + F.col("copy").cast("long") * HOUR_US)
        .withColumn("defect", eid % 97)
    )
    broker_time = F.timestamp_micros(F.col("epoch_us"))
    return delivered.select(
        F.concat(F.lit("SKU-"), F.col("user_id").cast("string")).cast("binary").alias("key"),
        _payload(topic).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        (eid % 16).cast("int").alias("partition"),
        (F.floor(eid / 16) * 2 + F.col("copy")).cast("long").alias("offset"),
        broker_time.alias("timestamp"),
        (F.date_trunc("hour", broker_time) + F.expr("interval 1 hour")).alias("ingested_at"),
    )


class EventLake:
    """Bronze, silver and quarantine views over the two topics."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.events = read_table(spark, sf_dir, "events")
        self._classified: dict[str, DataFrame] = {}

    def messages(self, topic: str) -> DataFrame:
        return messages(self.events, topic)

    def bronze(self, topic: str) -> DataFrame:
        return parsing.bronze_envelope(self.messages(topic), F.col("ingested_at"))

    def classified(self, topic: str) -> DataFrame:
        # Built once per query: a plan used twice is also recognised as one exchange.
        if topic not in self._classified:
            self._classified[topic] = parsing.classify(parsing.parse_permissive(self.bronze(topic), topic), topic)
        return self._classified[topic]

    def silver(self, topic: str) -> DataFrame:
        return parsing.valid_rows(self.classified(topic), topic)

    def quarantine(self, topic: str) -> DataFrame:
        return parsing.quarantined_rows(self.classified(topic))

    def silver_sales(self) -> DataFrame:
        return self.silver(SALES)

    def silver_inventory(self) -> DataFrame:
        return self.silver(INVENTORY)
