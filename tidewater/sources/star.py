"""Star-schema tables.

``StarTables`` reads a directory that already holds the star tables as Parquet.
``DerivedStar`` builds the same tables from the given order tables. Every reader
names the columns it wants, so a derived fact joins only the tables those
columns come from; Spark cannot drop a join it cannot prove to be 1:1.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import date_key
from ..operators import derived, intervals
from ..operators.dedup import latest_event
from ..operators.replenish import SITE, demand_and_lead_time
from ..operators.storage import exists, stored_bytes
from ..schemas import MART_CODEC
from ..session import configure, file_size, scratch_path, spread
from .events import EventLake
from .tables import read_table

FAR_FUTURE = "9999-12-31"

# The six what-if presets
# (key, code, name, demand multiplier, lead-time shock, service level %, carrying rate %).
SCENARIOS = [
    (1, "SCN-BASE", "Baseline Plan", "1.00", 0, "95.00", "22.00"),
    (2, "SCN-SURGE10", "Demand Surge", "1.10", 0, "95.00", "22.00"),
    (3, "SCN-PORT7D", "Port Disruption", "1.00", 7, "95.00", "24.00"),
    (4, "SCN-SLA98", "Target SLA 98%", "1.00", 0, "98.00", "22.00"),
    (5, "SCN-STRESS", "Combined Stress", "1.15", 5, "98.00", "22.00"),
    (6, "SCN-LEAN", "Lean S&OP", "0.90", -3, "90.00", "22.00"),
]

# User mapping (email, role, region, warehouse); -1 stands for all.
SECURITY_USERS = [
    ("vp@tidewater.example", "VP of Operations", -1, -1),
    ("east@tidewater.example", "Regional Supply Planner", 1, -1),
    ("multi@tidewater.example", "Regional Supply Planner", 1, -1),
    ("multi@tidewater.example", "Regional Supply Planner", 2, -1),
    ("dc7@tidewater.example", "Warehouse Planner", 2, 7),
    ("oddity@tidewater.example", "Warehouse Planner", -1, 5),
]

# Supplier tier -> contracted lead time in days.
TIER_1, TIER_2, TIER_3 = "Tier 1 Strategic", "Tier 2 Preferred", "Tier 3 Tactical"
CONTRACT_DAYS = {TIER_1: 7, TIER_2: 21, TIER_3: 45}
OVERSEAS, DOMESTIC = "Overseas Inbound", "Domestic"


def scenario_structs() -> Column:
    """The presets as an array literal, to be exploded per row: no join needed."""
    return F.array(
        *[
            F.struct(
                F.lit(k).cast("long").alias("ScenarioKey"),
                F.lit(code).alias("ScenarioCode"),
                F.lit(name).alias("ScenarioName"),
                F.lit(Decimal(mult)).cast("decimal(4,2)").alias("DemandMultiplier"),
                F.lit(shock).cast("long").alias("LeadTimeShockDays"),
                F.lit(Decimal(level)).cast("decimal(5,2)").alias("ServiceLevelTargetPct"),
                F.lit(Decimal(rate)).cast("decimal(5,2)").alias("AnnualCarryingCostRatePct"),
            )
            for k, code, name, mult, shock, level, rate in SCENARIOS
        ]
    )


def supplier_tier(key) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    return F.when(k % 10 == 0, TIER_1).when(k % 10 <= 3, TIER_2).otherwise(TIER_3)


def contract_days(key) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    return F.when(k % 10 == 0, CONTRACT_DAYS[TIER_1]).when(k % 10 <= 3, CONTRACT_DAYS[TIER_2]).otherwise(CONTRACT_DAYS[TIER_3])


def _money(c: Column, precision: int = 12) -> Column:
    return c.cast(f"decimal({precision},2)")


def _dated_key(day: str) -> Column:
    """Integer key of (day, product, warehouse); room for 10^12 products."""
    return F.unix_date(day).cast("long") * 100_000_000_000_000 + F.col("ProductKey") * 100 + F.col("WarehouseKey")


class Star:
    """What the plans need of a star schema, over ``table`` alone."""

    spark: SparkSession

    def table(self, name: str, *columns: str) -> DataFrame:
        raise NotImplementedError

    def carried(self, fact: str) -> set[str]:
        """Dimension attributes that may be asked of a fact itself, without a join by its key."""
        return set()

    def with_stored_lines(self, wanted: dict[str, set[str]], carry: list[str]) -> Star:
        """The same star, for plans that read the order lines several times: fact -> columns, and
        attributes of the product that the lines are to carry. Stored tables are read as they are."""
        return self

    def cogs(self, *keys: str) -> DataFrame:
        """Cost of goods sold by any of ProductKey, WarehouseKey, CategoryName."""
        return self.table("FactSales", *keys, "CostOfGoodsSold").groupBy(*keys).agg(F.sum("CostOfGoodsSold").alias("total_cogs"))

    def order_days(self) -> Column:
        """Calendar days between the first and the last order, as a scalar subquery."""
        d = F.col("OrderDate")
        return self.table("FactSales", "OrderDate").agg(F.datediff(F.max(d), F.min(d)) + 1).scalar()

    def last_order_day(self) -> Column:
        return self.table("FactSales", "OrderDate").agg(F.max("OrderDate")).scalar()

    def last_event_day(self) -> Column:
        return self.table("FactInventorySnapshot", "SnapshotDate").agg(F.max("SnapshotDate")).scalar()

    def position(self, *columns: str) -> DataFrame:
        """Stock per SKU and warehouse on the last event day, from the open intervals."""
        age = {"DaysSinceLastMovement": F.datediff("UntilDate", "LastMovementDate").cast("long")}
        read = [c for c in columns if c not in age]
        if len(read) < len(columns):
            read += ["UntilDate", "LastMovementDate"]
        rows = self.table("FactStockInterval", "IsCurrent", "ProductKey", "WarehouseKey", *read).where("IsCurrent")
        return rows.select("ProductKey", "WarehouseKey", *[age[c].alias(c) if c in age else c for c in columns])

    def movements(self) -> DataFrame:
        """Inventory movements with ``day``, ``quantity_change`` and ``event_type``."""
        m = self.table("FactInventoryMovement", "MovementDate", "ProductKey", "OriginWarehouseKey", "MovementType", "MovementQuantity")
        return m.select(
            F.col("MovementDate").alias("day"), "ProductKey", F.col("OriginWarehouseKey").alias("WarehouseKey"),
            F.col("MovementQuantity").alias("quantity_change"), F.col("MovementType").alias("event_type"),
        )

    def site_sums(self) -> DataFrame:
        """Per SKU and warehouse: what policies need (``demand_and_lead_time``; ``has_policy`` where
        there are sales) and the ``open_inbound`` orders, null where there are none."""
        sales = self.table("FactSales", *SITE, "OrderDate", "ShippedQuantity")
        po = self.table("FactPurchaseOrder", "ProductKey", "ReceivingWarehouseKey", "ActualLeadTimeDays", "OrderedQuantity")
        stats = demand_and_lead_time(sales, po, F.lit(None)).drop("days").withColumn("has_policy", F.lit(True))
        return stats.join(self.open_inbound(), SITE, "full_outer")

    def open_inbound(self) -> DataFrame:
        """Units and spend on purchase-order lines still under way."""
        po = self.table(
            "FactPurchaseOrder", "ProductKey", "ReceivingWarehouseKey", "POStatus", "OrderedQuantity", "ExtendedPOAmount"
        )
        return (
            po.where("POStatus = 'Open In-Transit'")
            .groupBy("ProductKey", F.col("ReceivingWarehouseKey").alias("WarehouseKey"))
            .agg(F.sum("OrderedQuantity").alias("InTransitInboundQuantity"), F.sum("ExtendedPOAmount").alias("OpenPOAmount"))
        )


# Date column each stored fact is partitioned by (by month), and its clustering columns.
STORED_FACTS = {
    "FactSales": ("OrderDate", ["ProductKey", "WarehouseKey"]),
    "FactPurchaseOrder": ("POCreationDate", ["SupplierKey", "ProductKey"]),
    "FactCustomerReturns": ("ReturnDate", ["ProductKey"]),
    "FactDemandForecast": ("TargetMonth", ["ProductKey", "WarehouseKey"]),
    "FactInventoryMovement": ("MovementDate", ["ProductKey", "OriginWarehouseKey"]),
    "FactInventorySnapshot": ("SnapshotDate", ["ProductKey", "WarehouseKey"]),
    "FactStockInterval": ("FromDate", ["ProductKey", "WarehouseKey"]),
    "FactStockout": ("StartDate", ["ProductKey", "WarehouseKey"]),
    "FactSupplierMonthlyPerformance": ("YearMonthDate", ["SupplierKey"]),
}


class StarTables(Star):
    """Star tables stored as Parquet, one directory per table name."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = configure(spark), path
        spread(spark, max(stored_bytes(spark, f"{path}/{fact}") for fact in STORED_FACTS))

    def table(self, name: str, *columns: str) -> DataFrame:
        if name == "FactStockInterval" and not exists(self.spark, f"{self.path}/{name}"):
            df = self._days_as_intervals()
        else:
            df = self.spark.read.parquet(f"{self.path}/{name}")
        if name in STORED_FACTS:
            df = df.drop(MONTH)
        if not columns:
            return df
        # An attribute asked of a fact comes from the dimension its key points to.
        missing = [c for c in columns if c not in df.columns]
        channel = [c for c in missing if c == "ChannelName"]
        for dim, key, lookup in (
            ("DimProduct", "ProductKey", [c for c in missing if c not in channel]),
            ("DimCustomerChannel", "CustomerChannelKey", channel),
        ):
            if lookup:
                df = df.join(self.table(dim, key, *lookup), key, "left")
        return df.select(*columns)


    def _days_as_intervals(self) -> DataFrame:
        """A stored snapshot without intervals: each row is an interval of one day."""
        day = F.col("SnapshotDate")
        snap = self.spark.read.parquet(f"{self.path}/FactInventorySnapshot")
        return snap.withColumns(
            {
                "FromDate": day, "UntilDate": day, "LastMovementDate": F.date_sub(day, F.col("DaysSinceLastMovement").cast("int")),
                "IsCurrent": day == self.last_event_day(),
            }
        )


MONTH = "_month"


def materialize(star: Star, path: str, tables: list[str]) -> StarTables:
    """Store star tables once so that queries read them instead of deriving them.

    Facts are partitioned by month and sorted by their clustering columns inside
    each file, which gives partition pruning by date and row-group skipping by
    key. The rebalance splits heavy months and merges light ones.
    """
    for name in tables:
        df = star.table(name)
        if name in STORED_FACTS:
            day, cluster = STORED_FACTS[name]
            df = df.withColumn(MONTH, F.date_format(day, "yyyy-MM")).hint("rebalance", MONTH)
            writer = df.sortWithinPartitions(MONTH, *cluster).write.partitionBy(MONTH)
        else:
            writer = df.write
        with file_size(star.spark):
            writer.mode("overwrite").options(**MART_CODEC).parquet(f"{path}/{name}")
    return StarTables(star.spark, path)


class DerivedStar(Star):
    """Star tables expressed over region, nation, customer, supplier, part,
    orders, lineitem and events."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = configure(spark), sf_dir
        self.lake = EventLake(spark, sf_dir)
        spread(spark, max(stored_bytes(spark, f"{sf_dir}/{t}.parquet") for t in ("lineitem", "events")))
        self._plans: dict[str, DataFrame] = {}
        self._stored: DataFrame | None = None
        self._stored_as: dict[str, dict[str, str]] = {}  # fact -> column -> its name in the stored lines
        self._carried: list[str] = []
        self._builders: dict[str, Callable[..., DataFrame]] = {
            "DimDate": self._dim_date,
            "DimProduct": self._dim_product,
            "DimProductHistory": self._dim_product_history,
            "DimSupplier": self._dim_supplier,
            "DimWarehouse": self._dim_warehouse,
            "DimRegion": self._dim_region,
            "DimCustomerChannel": self._dim_channel,
            "DimEmployeePlanner": self._dim_planner,
            "DimScenario": self._dim_scenario,
            "BridgeProductSupplier": self._bridge,
            "FactSales": self._fact_sales,
            "FactPurchaseOrder": self._fact_po,
            "FactCustomerReturns": self._fact_returns,
            "FactDemandForecast": self._fact_forecast,
            "FactInventoryMovement": self._fact_movement,
            "FactStockInterval": self._fact_interval,
            "FactInventorySnapshot": self._fact_snapshot,
            "FactStockout": self._fact_stockout,
            "FactSupplierMonthlyPerformance": self._fact_supplier_monthly,
            "SecurityUser": self._security_user,
        }

    def raw(self, name: str) -> DataFrame:
        return self._shared(name, lambda: read_table(self.spark, self.sf_dir, name))

    def _shared(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """Plans several tables start from are built once per instance."""
        if name not in self._plans:
            self._plans[name] = build()
        return self._plans[name]

    def table(self, name: str, *columns: str) -> DataFrame:
        df = self._from_stored(name, columns) if name in self._stored_as else None
        if df is None:
            df = self._builders[name](set(columns))
            lacking = [c for c in columns if c not in df.columns and c in self.carried(name)]
            if lacking:
                product = self._dim_product(set()).select("ProductKey", *lacking)
                df = self._builders[name]({*columns, "ProductKey"}).join(product, "ProductKey", "left")
        return df.select(*columns) if columns else df

    _CARRIERS = ("FactSales", "FactPurchaseOrder", "FactDemandForecast")

    def carried(self, fact: str) -> set[str]:
        return set(self._carried) if fact in self._CARRIERS else set()

    def with_stored_lines(self, wanted: dict[str, set[str]], carry: list[str]) -> DerivedStar:
        """Sales, purchase orders and forecasts come from the same lines: these are joined with their orders,
        suppliers and products once and written with the columns that are wanted of either fact."""
        other = DerivedStar(self.spark, self.sf_dir)
        columns = {"FactSales": self._sales_columns(), "FactPurchaseOrder": self._po_columns()}
        asked = {f: set(wanted.get(f, ())) for f in columns}
        if "FactDemandForecast" in wanted:
            asked["FactSales"] |= set(self._FORECAST_INPUT)
        asked["FactSales"] |= {"OrderDate", "ProductKey"}  # the calendar goes from the first to the last order
        made, names = {}, {f: {} for f in columns}
        for f, made_by in columns.items():
            for c in sorted(asked[f] & set(made_by) - {"UnitStandardCost", "CategoryName", "CostOfGoodsSold"}):
                column = made_by[c]()
                names[f][c] = made.setdefault(str(column._jc), (f"c{len(made)}", column))[0]  # the same in both facts: stored once
        rows = self._lines(set(), set(), True).select(*[column.alias(n) for n, column in made.values()])
        if carry:
            key = names["FactSales"]["ProductKey"]
            rows = rows.join(self._dim_product(set()).select(F.col("ProductKey").alias(key), *carry), key, "left")
        path = scratch_path(self.spark, "lines")
        rows.write.option("compression", "zstd").parquet(path)
        other._stored, other._stored_as, other._carried = self.spark.read.schema(rows.schema).parquet(path), names, list(carry)
        return other

    def _from_stored(self, fact: str, columns: tuple[str, ...]) -> DataFrame | None:
        """A fact of the stored lines, if they have all that is asked for. What needs no order keeps
        lines that have none, so it is read from the lines themselves."""
        names = self._stored_as[fact] | {a: a for a in self._carried}
        of_order = {"FactSales": self._SALES_ORDER_COLUMNS, "FactPurchaseOrder": self._PO_ORDER_COLUMNS}[fact]
        if not set(columns) & of_order or not set(columns) <= set(names):
            return None
        return self._stored.select(*[F.col(names[c]).alias(c) for c in columns])

    # -- dimensions ---------------------------------------------------------

    def _dim_date(self, want) -> DataFrame:
        """Every day any fact can point to: orders with the longest lead time and its
        variance, shipments with deliveries and returns, events with redeliveries."""
        ordered, shipped, event = F.to_date("o_orderdate"), F.to_date("l_shipdate"), F.to_date("ts")
        spans = [
            self.raw("orders").agg(F.min(ordered).alias("a"), F.date_add(F.max(ordered), max(CONTRACT_DAYS.values()) + 12).alias("b")),
            self.raw("lineitem").agg(F.min(shipped).alias("a"), F.date_add(F.max(shipped), 10).alias("b")),
            self.lake.events.agg(F.min(event).alias("a"), F.date_add(F.max(event), 1).alias("b")),
        ]
        every = spans[0].unionByName(spans[1]).unionByName(spans[2])
        return derived.calendar(every.agg(F.min("a").alias("first_day"), F.max("b").alias("last_day")))

    def _dim_product(self, want) -> DataFrame:
        return self._shared("products", self._products)

    def _products(self) -> DataFrame:
        supplier_count = self.raw("supplier").agg(F.count("*")).scalar()
        price = _money(F.col("p_retailprice"), 10)
        return self.raw("part").select(
            F.col("p_partkey").alias("ProductKey"),
            F.concat(F.lit("SKU-"), F.col("p_partkey").cast("string")).alias("ProductSKU"),
            F.col("p_name").alias("ProductName"),
            F.col("p_brand").alias("BrandName"),
            F.col("p_type").alias("CategoryName"),
            price.alias("UnitListPrice"),
            _money(price * F.lit(Decimal("0.6")), 10).alias("UnitStandardCost"),
            (F.col("p_partkey") % supplier_count).alias("PrimarySupplierKey"),
        )

    def _dim_product_history(self, want) -> DataFrame:
        """Versioned products: every fourth SKU was 10 % cheaper to make before 1998."""
        p = self._dim_product(want)
        cost = F.col("UnitStandardCost")
        cut = F.lit("1998-01-01").cast("date")

        def version(start, end, c, current):
            return F.struct(
                start.alias("EffectiveFrom"), end.alias("EffectiveTo"), c.alias("VersionCost"), F.lit(current).alias("IsCurrent")
            )

        open_end, beginning = F.lit(FAR_FUTURE).cast("date"), F.lit("1990-01-01").cast("date")
        versions = F.when(
            F.col("ProductKey") % 4 == 0,
            F.array(
                version(beginning, cut, _money(cost * F.lit(Decimal("0.9")), 10), False),
                version(cut, open_end, cost, True),
            ),
        ).otherwise(F.array(version(beginning, open_end, cost, True)))
        return p.withColumn("v", F.explode(versions)).select(
            "ProductSKU", "ProductName", "CategoryName", F.col("ProductKey").alias("NaturalKey"),
            F.col("v.EffectiveFrom").alias("EffectiveFrom"), F.col("v.EffectiveTo").alias("EffectiveTo"),
            F.col("v.VersionCost").alias("UnitStandardCost"), F.col("v.IsCurrent").alias("IsCurrent"),
        )

    def _dim_supplier(self, want) -> DataFrame:
        s = self.raw("supplier")
        df = s.select(
            F.col("s_suppkey").alias("SupplierKey"),
            F.concat(F.lit("SUP-"), F.col("s_suppkey").cast("string")).alias("SupplierCode"),
            F.col("s_name").alias("SupplierName"),
            supplier_tier("s_suppkey").alias("SupplierTier"),
            contract_days("s_suppkey").cast("long").alias("ContractLeadTimeDays"),
            (F.col("s_suppkey") * 13 % 101).cast("double").alias("VendorRiskScore"),
            F.col("s_nationkey").alias("n_nationkey"),
        )
        if not want or "RegionZone" in want:
            n = self.raw("nation").select("n_nationkey", "n_regionkey")
            df = df.join(n, "n_nationkey", "left").withColumn(
                "RegionZone", F.when(F.col("n_regionkey") >= 2, OVERSEAS).otherwise(DOMESTIC)
            ).drop("n_regionkey")
        return df.drop("n_nationkey")

    def _dim_warehouse(self, want) -> DataFrame:
        k = F.col("n_nationkey")
        return self.raw("nation").select(
            k.cast("long").alias("WarehouseKey"),
            F.concat(F.lit("WH-"), k.cast("string")).alias("WarehouseCode"),
            F.col("n_name").alias("WarehouseName"),
            F.col("n_regionkey").cast("long").alias("RegionKey"),
            ((k % 9 + 1) * 1000).cast("long").alias("StorageCapacityPallets"),
        )

    def _dim_region(self, want) -> DataFrame:
        return self.raw("region").select(
            F.col("r_regionkey").cast("long").alias("RegionKey"), F.col("r_name").alias("RegionName")
        )

    def _dim_channel(self, want) -> DataFrame:
        return self.raw("customer").select(
            F.col("c_custkey").alias("CustomerChannelKey"),
            F.col("c_name").alias("AccountName"),
            F.col("c_mktsegment").alias("ChannelName"),
        )

    def _dim_planner(self, want) -> DataFrame:
        r = F.col("r_regionkey")
        return self.raw("region").select(
            (r + 1).cast("long").alias("PlannerKey"),
            F.concat(F.lit("Planner "), F.col("r_name")).alias("PlannerName"),
            r.cast("long").alias("RegionKey"),
        )

    def _dim_scenario(self, want) -> DataFrame:
        return self.spark.range(1).select(F.inline(scenario_structs()))

    def _security_user(self, want) -> DataFrame:
        rows = F.array(
            *[
                F.struct(
                    F.lit(i).cast("long").alias("SecurityUserKey"),
                    F.lit(email).alias("UserEmail"),
                    F.lit(role).alias("Role"),
                    F.lit(region).cast("long").alias("RegionKey"),
                    F.lit(wh).cast("long").alias("WarehouseKey"),
                )
                for i, (email, role, region, wh) in enumerate(SECURITY_USERS, 1)
            ]
        )
        return self.spark.range(1).select(F.inline(rows))

    def _bridge(self, want) -> DataFrame:
        """Authorised sourcing: the primary supplier, and a second one for two of three SKUs."""
        p = self._dim_product(want)
        n = self.raw("supplier").agg(F.count("*")).scalar()
        second = (F.col("ProductKey") * 7 + 1) % n
        first = F.col("PrimarySupplierKey")
        pair = F.when((F.col("ProductKey") % 3 != 0) & (second != first), F.array(first, second)).otherwise(F.array(first))
        return p.select(
            "ProductSKU", "ProductKey", F.posexplode(pair).alias("pos", "SupplierKey")
        ).select("ProductSKU", "ProductKey", "SupplierKey", (F.col("pos") == 0).alias("IsPrimarySupplier"))

    # -- facts from order lines ---------------------------------------------

    def _lines(self, want: set[str], order_columns: set[str], fact_needs_all: bool) -> DataFrame:
        qty, gross = F.col("l_quantity").cast("long"), _money(F.col("l_extendedprice"))
        discount = _money(gross * F.col("l_discount").cast("decimal(4,2)"))
        # What a line itself decides is worked out before it travels: whole numbers, flags and
        # days are shorter in a shuffle than doubles, text and timestamps.
        li = self.raw("lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", qty.alias("l_units"), gross.alias("l_gross"), discount.alias("l_reduction"),
            _money(gross - discount).alias("l_net"), (F.col("l_returnflag") == "A").alias("l_cancelled"), (F.col("l_returnflag") == "R").alias("l_returned"),
            (F.col("l_discount") >= 0.08).alias("l_short"), (F.col("l_tax") >= 0.07).alias("l_rejected"), F.to_date("l_shipdate").alias("l_ship"),
        )
        if fact_needs_all or want & order_columns:
            o = self.raw("orders").select(
                F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderstatus", F.to_date("o_orderdate").alias("o_date")
            )
            if "ChannelName" in want:
                # The account is looked up per order, before there is a row per line.
                c = self.raw("customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("ChannelName"))
                o = o.join(c, "o_custkey", "left")
            li = li.join(o, "l_orderkey")
        if fact_needs_all or want & {"WarehouseKey", "ReceivingWarehouseKey"}:
            s = self.raw("supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
            li = li.join(s, "l_suppkey", "left")
        return li

    _SALES_ORDER_COLUMNS = {"OrderDate", "OrderDateKey", "CustomerChannelKey", "ChannelName", "OrderLineCycleTimeDays", "OnTimeInFullFlag"}

    def _fact_sales(self, want) -> DataFrame:
        everything = not want
        df = self._lines(want, self._SALES_ORDER_COLUMNS, everything)
        of_product = {"UnitStandardCost", "CostOfGoodsSold", "CategoryName"}
        if everything or want & of_product:
            product = self._dim_product(want).select(F.col("ProductKey").alias("l_partkey"), "UnitStandardCost", "CategoryName")
            df = df.join(product, "l_partkey", "left")
        columns = self._sales_columns()
        if "ChannelName" in want:
            columns["ChannelName"] = lambda: F.col("ChannelName")
        return df.select(*[columns[c]().alias(c) for c in columns if everything or c in want])

    @staticmethod
    def _sales_columns() -> dict[str, Callable[[], Column]]:
        qty, ship = F.col("l_units"), F.col("l_ship")
        cancelled = F.when(F.col("l_cancelled"), qty).otherwise(F.lit(0).cast("long"))
        shipped = qty - cancelled
        delivery = F.date_add(ship, 3)
        return {
            "SalesLineKey": lambda: F.col("l_orderkey") * 10 + F.col("l_linenumber"),
            "SalesOrderID": lambda: F.col("l_orderkey"),
            "SalesOrderLineNumber": lambda: F.col("l_linenumber").cast("long"),
            "OrderDate": lambda: F.col("o_date"),
            "OrderDateKey": lambda: date_key("o_date"),
            "ShipDate": lambda: ship,
            "ShipDateKey": lambda: date_key(ship),
            "DeliveryDate": lambda: delivery,
            "DeliveryDateKey": lambda: date_key(delivery),
            "ProductKey": lambda: F.col("l_partkey"),
            "CustomerChannelKey": lambda: F.col("o_custkey"),
            "WarehouseKey": lambda: F.coalesce(F.col("s_nationkey").cast("long"), F.lit(-1).cast("long")),
            "OrderedQuantity": lambda: qty,
            "CancelledQuantity": lambda: cancelled,
            "ShippedQuantity": lambda: shipped,
            "UnitStandardCost": lambda: F.col("UnitStandardCost"),
            "CategoryName": lambda: F.col("CategoryName"),
            "GrossSalesAmount": lambda: F.col("l_gross"),
            "DiscountAmount": lambda: F.col("l_reduction"),
            "NetSalesAmount": lambda: F.col("l_net"),
            "CostOfGoodsSold": lambda: _money(shipped.cast("decimal(10,0)") * F.col("UnitStandardCost")),
            "OrderLineCycleTimeDays": lambda: F.datediff(delivery, "o_date").cast("long"),
            "OnTimeInFullFlag": lambda: F.when((cancelled == 0) & (F.datediff(delivery, "o_date") <= 30), 1).otherwise(0),
        }

    def cogs(self, *keys: str) -> DataFrame:
        """Cost of goods sold by any of ProductKey, WarehouseKey, CategoryName.

        Units are summed per product before the cost is looked up, so the join
        sees one row per product (and warehouse) instead of every line.
        """
        fact_keys = ["ProductKey", *[k for k in keys if k == "WarehouseKey"]]
        units = self.table("FactSales", *fact_keys, "ShippedQuantity").groupBy(*fact_keys).agg(F.sum("ShippedQuantity").alias("units"))
        product = self.table("DimProduct", "ProductKey", "UnitStandardCost", "CategoryName")
        priced = units.join(product, "ProductKey", "left")
        return priced.groupBy(*keys).agg(
            F.sum(F.col("units").cast("decimal(18,0)") * F.col("UnitStandardCost")).alias("total_cogs")
        )

    _PO_ORDER_COLUMNS = {
        "POStatus", "POCreationDate", "POCreationDateKey", "PromisedDeliveryDate", "ActualDockReceiptDate",
        "ActualDockReceiptDateKey", "ReceivedQuantity", "RejectedQuantity", "ActualLeadTimeDays",
        "LeadTimeVarianceDays", "IsDeliveredOnTimeFlag", "IsDeliveredInFullFlag", "IsSupplierOTIFFlag",
    }

    def _fact_po(self, want) -> DataFrame:
        everything = not want
        df = self._lines(want, self._PO_ORDER_COLUMNS, everything)
        columns = self._po_columns()
        return df.select(*[columns[c]().alias(c) for c in columns if everything or c in want])

    @staticmethod
    def _po_columns() -> dict[str, Callable[[], Column]]:
        qty = F.col("l_units")
        done = F.col("o_orderstatus") == "F"
        promised = contract_days("l_suppkey").cast("long")
        # Better tiers deliver earlier against their promise.
        early = F.when(F.col("l_suppkey") % 10 == 0, 6).when(F.col("l_suppkey") % 10 <= 3, 4).otherwise(1)
        variance = ((F.col("l_orderkey") * 7 + F.col("l_linenumber") * 3) % 13 - early).cast("long")
        received = F.when(done, qty - F.when(F.col("l_short"), 1).otherwise(0)).otherwise(F.lit(0).cast("long"))
        on_time = F.when(done & (variance <= 0), 1).otherwise(0)
        in_full = F.when(done & (received >= qty), 1).otherwise(0)
        dock = F.when(done, F.date_add("o_date", (promised + variance).cast("int")))
        return {
            "POLineKey": lambda: F.col("l_orderkey") * 10 + F.col("l_linenumber"),
            "PurchaseOrderID": lambda: F.col("l_orderkey"),
            "SupplierKey": lambda: F.col("l_suppkey"),
            "ProductKey": lambda: F.col("l_partkey"),
            "ReceivingWarehouseKey": lambda: F.coalesce(F.col("s_nationkey").cast("long"), F.lit(-1).cast("long")),
            "POStatus": lambda: F.when(done, "Completed").when(F.col("o_orderstatus") == "O", "Open In-Transit").otherwise("Overdue"),
            "POCreationDate": lambda: F.col("o_date"),
            "POCreationDateKey": lambda: date_key("o_date"),
            "PromisedDeliveryDate": lambda: F.date_add("o_date", promised.cast("int")),
            "ActualDockReceiptDate": lambda: dock,
            "ActualDockReceiptDateKey": lambda: date_key(dock),
            "OrderedQuantity": lambda: qty,
            "ReceivedQuantity": lambda: received,
            "RejectedQuantity": lambda: F.when(done & F.col("l_rejected"), 1).otherwise(0).cast("long"),
            "ExtendedPOAmount": lambda: _money(F.col("l_gross") * F.lit(Decimal("0.6")), 14),
            "PromisedLeadTimeDays": lambda: promised,
            "ActualLeadTimeDays": lambda: F.when(done, promised + variance),
            "LeadTimeVarianceDays": lambda: F.when(done, variance),
            "IsDeliveredOnTimeFlag": lambda: on_time,
            "IsDeliveredInFullFlag": lambda: in_full,
            "IsSupplierOTIFFlag": lambda: on_time * in_full,
        }

    def site_sums(self) -> DataFrame:
        """Sales and purchase lines are the same lines here, so they are read and joined once."""
        df = self._lines({"WarehouseKey"}, set(), True)
        sales, po = self._sales_columns(), self._po_columns()
        opened = po["POStatus"]() == "Open In-Transit"
        lead = po["ActualLeadTimeDays"]()
        line = {
            "demand": sales["ShippedQuantity"](), "lt_n": F.when(lead.isNotNull(), 1).otherwise(0).cast("long"), "lt_sum": lead, "lt_sq": lead * lead,
            "po_units": po["OrderedQuantity"](), "po_lines": F.lit(1).cast("long"), "open_lines": F.when(opened, 1).otherwise(0).cast("long"),
            "InTransitInboundQuantity": F.when(opened, po["OrderedQuantity"]()), "OpenPOAmount": F.when(opened, po["ExtendedPOAmount"]()),
        }
        rows = df.select(*[sales[c]().alias(c) for c in (*SITE, "OrderDate")], *[c.alias(n) for n, c in line.items()])
        daily = rows.groupBy(*SITE, "OrderDate").agg(*[F.sum(n).alias(n) for n in line])
        q = F.col("demand").cast("double")
        g = daily.groupBy(*SITE).agg(*[F.sum(n).alias(n) for n in line], F.sum(q * q).alias("demand_sq"))
        g = g.withColumn("OpenPOAmount", F.col("OpenPOAmount").cast("decimal(24,2)"))
        # a null key matches no other one, so what meets in one row is then apart: sales and open orders
        supply, inbound = ["lt_n", "lt_sum", "lt_sq", "po_units", "po_lines"], ["InTransitInboundQuantity", "OpenPOAmount"]
        has_open, names = F.col("open_lines") > 0, ["demand", "demand_sq", *supply, *inbound]

        def part(kept: list[str], policy: bool) -> Column:
            values = [(F.col(n) if n in kept else F.lit(None).cast(g.schema[n].dataType)).alias(n) for n in names]
            return F.struct(*values, F.when(F.lit(policy), True).alias("has_policy"))

        apart = F.when(has_open, F.array(part(["demand", "demand_sq"], True), part(inbound, False))).otherwise(F.array(part(["demand", "demand_sq"], True)))
        return g.select(*SITE, F.inline(F.when(F.col("ProductKey").isNull(), apart).otherwise(F.array(part(names, True)))))

    def _fact_returns(self, want) -> DataFrame:
        needs = {"OrderDate"} if not want or want & {"OriginalOrderDate", "CustomerChannelKey"} else set()
        df = self._lines(needs, {"OrderDate"}, False).where("l_returned")
        qty = F.col("l_units")
        restocked = F.floor(qty * 8 / 10).cast("long")
        out = df.select("*", qty.alias("ReturnedQuantity"), restocked.alias("RestockedQuantity"), (qty - restocked).alias("ScrappedQuantity"))
        out = out.withColumns(
            {
                "ReturnLineKey": F.col("l_orderkey") * 10 + F.col("l_linenumber"),
                "ProductKey": F.col("l_partkey"),
                "ReturnDate": F.date_add("l_ship", 10),
            }
        )
        if needs:
            out = out.withColumns({"OriginalOrderDate": F.col("o_date"), "CustomerChannelKey": F.col("o_custkey")})
        return out.select(*[c for c in out.columns if c[0].isupper()])

    _FORECAST_INPUT = ("OrderDate", "ProductKey", "WarehouseKey", "OrderedQuantity")

    def _fact_forecast(self, want) -> DataFrame:
        """Baseline: last month's ordered units; planners shift it by a few units."""
        carried = [a for a in self._carried if a in want]
        actual = (
            self.table("FactSales", *self._FORECAST_INPUT, *carried)
            .groupBy(F.trunc("OrderDate", "month").alias("m"), "ProductKey", "WarehouseKey", *carried)
            .agg(F.sum("OrderedQuantity").alias("BaselineStatisticalQuantity"))
        )
        base = F.col("BaselineStatisticalQuantity")
        month = F.add_months("m", 1)
        shift = (F.col("ProductKey") + F.col("WarehouseKey") + F.month(month)) % 7 - 3
        planned = F.greatest(F.lit(0).cast("long"), base + shift)
        df = actual.select(
            (F.col("ProductKey") * 100 + F.col("WarehouseKey")).alias("_pw"),
            F.col("m").alias("ForecastGeneratedDate"),
            month.alias("TargetMonth"), "ProductKey", "WarehouseKey", base,
            (planned - base).alias("PlannerAdjustmentQuantity"), planned.alias("ForecastedQuantity"), *carried,
        ).withColumn("ForecastKey", F.col("_pw") * 1000000 + F.year("TargetMonth") * 100 + F.month("TargetMonth")).drop("_pw")
        if not want or "ForecastValue" in want:
            price = self._dim_product(want).select("ProductKey", "UnitListPrice")
            df = df.join(price, "ProductKey", "left").withColumn(
                "ForecastValue", _money(F.col("ForecastedQuantity").cast("decimal(18,0)") * F.col("UnitListPrice"), 24)
            ).drop("UnitListPrice")
        return df

    def _fact_supplier_monthly(self, want) -> DataFrame:
        po = self.table("FactPurchaseOrder", *derived.SCORECARD_INPUT)
        return derived.supplier_monthly(po)

    # -- facts from events --------------------------------------------------

    def movements(self) -> DataFrame:
        """Deduplicated inventory events with integer keys."""
        return self._shared("movements", self._movements)

    def _movements(self) -> DataFrame:
        e = latest_event(self.lake.silver_inventory().drop("ingested_at"))
        return e.select(
            "event_id",
            F.to_date("timestamp").alias("day"),
            F.substring_index("product_id", "-", -1).cast("long").alias("ProductKey"),
            F.substring_index("warehouse_id", "-", -1).cast("long").alias("WarehouseKey"),
            "quantity_change",
            "event_type",
        )

    def _fact_movement(self, want) -> DataFrame:
        return self.movements().select(
            F.substring_index("event_id", "-", -1).cast("long").alias("MovementKey"),
            F.col("day").alias("MovementDate"), date_key("day").alias("MovementDateKey"), "ProductKey",
            F.col("WarehouseKey").alias("OriginWarehouseKey"),
            F.col("event_type").alias("MovementType"), F.col("quantity_change").alias("MovementQuantity"),
        )

    def order_days(self) -> Column:
        """Calendar days between the first and the last order, as a scalar subquery."""
        d = F.to_date("o_orderdate")
        return self.raw("orders").agg(F.datediff(F.max(d), F.min(d)) + 1).scalar()

    def last_order_day(self) -> Column:
        return self.raw("orders").agg(F.max(F.to_date("o_orderdate"))).scalar()

    def last_event_day(self) -> Column:
        """Last day with a movement, as a scalar subquery: the snapshot's last day for every site."""
        return self.movements().agg(F.max("day")).scalar()

    def _fact_interval(self, want) -> DataFrame:
        """Stock from each movement to the next; ``InventoryValuation`` is that of one day."""
        everything = not want
        on_hand = F.col("OnHandQuantity")
        df = self._shared("intervals", self._intervals)
        if everything or want & {"UnitLandedCost", "InventoryValuation", "CategoryName"}:
            product = self._dim_product(want).select(
                "ProductKey", F.col("UnitStandardCost").alias("UnitLandedCost"), "CategoryName"
            )
            df = df.join(product, "ProductKey", "left").withColumn(
                "InventoryValuation", _money(on_hand.cast("decimal(18,0)") * F.col("UnitLandedCost"), 24)
            )
        if everything or "InTransitInboundQuantity" in want:
            inbound = self.open_inbound()
            df = df.join(inbound.drop("OpenPOAmount"), ["ProductKey", "WarehouseKey"], "left").withColumn(
                "InTransitInboundQuantity", F.coalesce("InTransitInboundQuantity", F.lit(0).cast("long"))
            )
        return df

    def _intervals(self) -> DataFrame:
        df = intervals.stock_intervals(self.movements(), ["ProductKey", "WarehouseKey"], self.last_event_day())
        on_hand = F.col("OnHandQuantity")
        reserved = F.least(on_hand, (F.col("ProductKey") + F.col("WarehouseKey")) % 5)
        return df.select(
            "*", F.col("FromDate").alias("LastMovementDate"),
            reserved.alias("ReservedQuantity"), (on_hand - reserved).alias("AvailableQuantity"),
            F.when(on_hand - reserved <= 0, 1).otherwise(0).alias("IsStockoutFlag"),
        )

    def _fact_snapshot(self, want) -> DataFrame:
        rows = derived.daily_snapshot(self._fact_interval(want))
        idle = F.datediff("SnapshotDate", "LastMovementDate").cast("long")
        return rows.withColumns(
            {
                "DaysSinceLastMovement": idle, "SnapshotKey": _dated_key("SnapshotDate"), "SnapshotDateKey": date_key("SnapshotDate"),
                "IsDeadStockFlag": F.when(idle >= 180, 1).otherwise(0),
            }
        ).drop("FromDate", "UntilDate", "LastMovementDate", "IsCurrent")

    def _fact_stockout(self, want) -> DataFrame:
        everything = not want
        keys = ["ProductKey", "WarehouseKey"]
        empty = self.table("FactStockInterval", "FromDate", "UntilDate", *keys, "AvailableQuantity").where("AvailableQuantity <= 0")
        df = intervals.merged(empty, keys).select(
            *keys, F.col("FromDate").alias("StartDate"), F.col("UntilDate").alias("EndDate"), intervals.days().alias("StockoutDurationDays")
        )
        lost = {"EstimatedLostDemandUnits", "EstimatedLostRevenueAmount"}
        if everything or want & lost:
            picks = (
                self.movements().where("event_type = 'PICK'")
                .groupBy(*keys, "day").agg(F.sum(-F.col("quantity_change")).alias("units"))
            )
            df = derived.lost_demand(df, picks, keys)
        if everything or "EstimatedLostRevenueAmount" in want:
            price = self._dim_product(want).select("ProductKey", "UnitListPrice")
            df = df.join(price, "ProductKey", "left").withColumn(
                "EstimatedLostRevenueAmount",
                _money(F.col("EstimatedLostDemandUnits").cast("decimal(18,0)") * F.col("UnitListPrice"), 24),
            ).drop("UnitListPrice")
        cause = (F.col("ProductKey") + F.col("WarehouseKey")) % 3
        return df.withColumns(
            {
                "StockoutEventKey": _dated_key("StartDate"),
                "StockoutAttributedReason": F.when(cause == 0, "Supplier Delayed Inbound")
                .when(cause == 1, "Demand Spike")
                .otherwise("Record Inaccuracy"),
            }
        )

