"""Worked examples and edge cases on tiny frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewater.functions import safe_divide, sample_std, stable_round, z_score
from tidewater.operators import intervals, dedup, derived, marts, parsing, quality, security
from tidewater.operators.replenish import king
from tidewater.schemas import BRONZE, INVENTORY, SALES

SILVER_SALES = "event_id string, timestamp timestamp, product_id string, customer_id string, revenue double, units_sold bigint, ingested_at timestamp"
T0 = dt.datetime(2024, 1, 5, 10)


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_dedup_tie_is_deterministic(spark):
    rows = [("e", T0, "p", "c", 5.0, 1, T0), ("e", T0, "p", "c", 9.0, 1, T0)]
    for order in (rows, rows[::-1]):
        assert one(dedup.latest_event(spark.createDataFrame(order, SILVER_SALES))).revenue == 9.0


def test_dedup_limits_copies_before_the_shuffle(spark):
    df = dedup.latest_event(spark.createDataFrame([("e", T0, "p", "c", 5.0, 1, T0)], SILVER_SALES))
    plan = df._jdf.queryExecution().sparkPlan().toString()
    assert "WindowGroupLimit" in plan


def test_order_value_ignores_zero_units(spark):
    rows = [("a", T0, "p", "c", 10.0, 2, T0), ("b", T0, "p", "c", 7.0, 0, T0)]
    r = one(marts.sales_daily_summary(spark.createDataFrame(rows, SILVER_SALES)))
    assert (r.total_revenue, r.total_units_sold, r.transaction_count, r.avg_order_value) == (17.0, 2, 2, 5.0)


def test_health_mart_without_picks(spark):
    schema = "event_id string, timestamp timestamp, product_id string, warehouse_id string, quantity_change bigint, event_type string, ingested_at timestamp"
    r = one(marts.inventory_health_daily(spark.createDataFrame([("a", T0, "p", "w", 51, "RECEIPT", T0)], schema)))
    assert r.days_of_supply is None and r.daily_turnover_rate == 0.0 and r.stockout_risk_status == "OPTIMAL"


GOOD = '{"event_id": "e", "timestamp": 1.5, "product_id": "p", "customer_id": "c", "revenue": 2.0, "units_sold": 1}'


@pytest.mark.parametrize(
    "payload, reason",
    [
        (GOOD, None),
        (GOOD + " trailing", None),
        (GOOD.replace("2.0", '"x"'), "MALFORMED_JSON"),
        (GOOD[:40], "MALFORMED_JSON"),
        ("", "MISSING_EVENT_ID"),
        (None, "MISSING_EVENT_ID"),
        (GOOD.replace('"event_id": "e", ', ""), "MISSING_EVENT_ID"),
        (GOOD.replace('"product_id": "p", ', ""), "MISSING_PRODUCT_ID"),
        (GOOD.replace("2.0", "-2.0"), "INVALID_REVENUE"),
        (GOOD.replace('"revenue": 2.0, ', ""), "INVALID_REVENUE"),
    ],
)
def test_sales_rules(spark, payload, reason):
    bronze = spark.createDataFrame([("k", payload, "sales", 0, 1, T0, T0)], BRONZE)
    classified = parsing.classify(parsing.parse_permissive(bronze, SALES), SALES)
    assert one(classified).error_reason == reason
    valid = parsing.valid_rows(classified, SALES).count()
    assert (valid, parsing.quarantined_rows(classified).count()) == ((1, 0) if reason is None else (0, 1))


def test_inventory_needs_a_warehouse(spark):
    text = '{"event_id": "e", "timestamp": 1.5, "product_id": "p", "quantity_change": 1, "event_type": "PICK"}'
    bronze = spark.createDataFrame([("k", text, "inventory", 0, 1, T0, T0)], BRONZE)
    assert one(parsing.classify(parsing.parse_permissive(bronze, INVENTORY), INVENTORY)).error_reason == "MISSING_WAREHOUSE_ID"


def test_preview(spark):
    df = spark.createDataFrame([("x" * 76,), ("y" * 75,), (None,)], "p string").select(parsing.payload_preview("p").alias("v"))
    assert [r.v for r in df.collect()] == ["x" * 75 + "...", "y" * 75, ""]


def empty_spans(spark, spans):
    rows = [(1, 1, dt.date(2024, 10, a), dt.date(2024, 10, b)) for a, b in spans]
    return spark.createDataFrame(rows, "ProductKey bigint, WarehouseKey bigint, FromDate date, UntilDate date")


def outages(spark, spans):
    runs = intervals.merged(empty_spans(spark, spans), ["ProductKey", "WarehouseKey"])
    return runs.select("ProductKey", "WarehouseKey", F.col("FromDate").alias("StartDate"), F.col("UntilDate").alias("EndDate"), intervals.days().alias("StockoutDurationDays"))


def test_adjacent_empty_spans_are_one_outage(spark):
    r = one(outages(spark, [(3, 3), (4, 6), (7, 7)]))
    assert (r.StartDate, r.EndDate, r.StockoutDurationDays) == (dt.date(2024, 10, 3), dt.date(2024, 10, 7), 5)
    assert sorted(r.StockoutDurationDays for r in outages(spark, [(3, 4), (6, 9)]).collect()) == [2, 4]


def test_lost_demand_uses_the_days_before_only(spark):
    keys = ["ProductKey", "WarehouseKey"]
    episode = outages(spark, [(3, 3), (4, 4)])
    day = lambda d: dt.date(2024, 10, 3) + dt.timedelta(d)
    demand = spark.createDataFrame(
        [(1, 1, day(-30), 60), (1, 1, day(-31), 1000), (1, 1, day(-1), 30), (1, 1, day(0), 1000)],
        "ProductKey bigint, WarehouseKey bigint, day date, units bigint",
    )
    assert one(derived.lost_demand(episode, demand, keys)).EstimatedLostDemandUnits == 6  # 90 / 30 * 2


def test_king_worked_example(spark):
    row = spark.createDataFrame([(2.0, 200.0, 20625.0, 2.0, 28.0, 401.0)], "days double, demand double, demand_sq double, lt_n double, lt_sum double, lt_sq double")
    r = one(row.select(*[c.alias(n) for n, c in king(2.054).items()]))
    assert r.safety_stock == 645
    assert (r.std_daily_demand, r.lead_time_std) == (25.0, 3.0)


def test_king_fallbacks(spark):
    row = spark.createDataFrame([(1, 10, 100, 0, None, None)], "days int, demand int, demand_sq int, lt_n int, lt_sum int, lt_sq int")
    r = one(row.select(*[c.alias(n) for n, c in king(1.65).items()]))
    assert (r.lead_time_days, r.lead_time_std, r.std_daily_demand) == (14.0, 2.0, 2.5)


def test_zero_denominators(spark):
    df = spark.range(1).select(
        safe_divide(F.lit(1), F.lit(0)).alias("a"), safe_divide(F.lit(1), F.lit(0), 9999.0).alias("b"),
        safe_divide(F.lit(None).cast("int"), F.lit(2), None).alias("c"), sample_std(F.lit(1), F.lit(3), F.lit(9)).alias("d"),
    )
    assert tuple(one(df)) == (0.0, 9999.0, None, None)


def test_rounding_is_stable_on_ties(spark):
    df = spark.createDataFrame([(12.345,), (12.344999999999999,), (12.345000000000002,)], "x double")
    assert {r.v for r in df.select(stable_round("x", 2).alias("v")).collect()} == {12.35}


def test_z_table(spark):
    df = spark.createDataFrame([(99.0,), (98.0,), (95.0,), (90.0,), (50.0,)], "l double").select(z_score("l").alias("z"))
    assert [r.z for r in df.collect()] == [2.33, 2.05, 1.65, 1.28, 1.65]


def history(spark, rows):
    return spark.createDataFrame([(k, a, dt.date(2024, 1, d)) for k, a, d in rows], "k string, a string, d date")


def test_scd2_versions_and_boundaries(spark):
    dim = derived.scd2_build(history(spark, [("x", "1", 1), ("x", "1", 2), ("x", "2", 5), ("x", "1", 9)]), "k", ["a"], "d")
    got = {(r.a, r.EffectiveFrom.day, r.EffectiveTo.day if r.EffectiveTo.year < 9999 else None, r.IsCurrent) for r in dim.collect()}
    assert got == {("1", 1, 5, False), ("2", 5, 9, False), ("1", 9, None, True)}
    # a sale on EffectiveFrom belongs to the new version, one on EffectiveTo does not
    hit = dim.where("DATE'2024-01-05' >= EffectiveFrom AND DATE'2024-01-05' < EffectiveTo")
    assert one(hit).a == "2"


def test_scd2_null_value_is_a_version(spark):
    dim = derived.scd2_build(history(spark, [("x", None, 1), ("x", None, 2), ("x", "1", 3)]), "k", ["a"], "d")
    assert dim.count() == 2


def test_scd2_apply_keeps_closes_and_opens(spark):
    dim = derived.scd2_build(history(spark, [("same", "1", 1), ("changed", "1", 1), ("absent", "1", 1)]), "k", ["a"], "d")
    new = spark.createDataFrame([("same", "1"), ("changed", "2"), ("new", "3")], "k string, a string")
    rows = {(r.k, r.a, r.IsCurrent) for r in derived.scd2_apply(dim, new, "k", ["a"], "2024-02-01").collect()}
    assert rows == {("same", "1", True), ("changed", "1", False), ("changed", "2", True), ("absent", "1", True), ("new", "3", True)}


USERS = [("Boss@x", -1, -1), ("east@x", 1, -1), ("two@x", 1, -1), ("two@x", 2, -1), ("dc@x", 2, 7), ("odd@x", -1, 5)]


@pytest.fixture(scope="module")
def sites(spark):
    warehouses = spark.createDataFrame([(5, 1), (6, 1), (7, 2), (8, 3)], "WarehouseKey bigint, RegionKey bigint")
    regions = spark.createDataFrame([(1,), (2,), (3,)], "RegionKey bigint")
    users = spark.createDataFrame(USERS, "UserEmail string, RegionKey bigint, WarehouseKey bigint")
    return users, warehouses, regions


@pytest.mark.parametrize(
    "email, warehouses, regions",
    [
        ("BOSS@x", {5, 6, 7, 8}, {1, 2, 3}), ("east@x", {5, 6}, {1}), ("two@x", {5, 6, 7}, {1, 2}), ("dc@x", {7}, {2}),
        ("odd@x", {5}, {1, 2, 3}), ("nobody@x", set(), set()),
    ],
)
def test_visibility(sites, email, warehouses, regions):
    users, wh, reg = sites
    assert {r.WarehouseKey for r in security.allowed_warehouses(users, wh, email).collect()} == warehouses
    assert {r.RegionKey for r in security.allowed_regions(users, wh, reg, email).collect()} == regions
    assert {r.WarehouseKey for r in security.secure(wh, users, wh, email).collect()} == warehouses


def test_null_foreign_key_is_an_orphan(spark):
    fact = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k bigint")
    dim = spark.createDataFrame([(1,)], "pk bigint")
    r = one(quality.foreign_keys("f", fact, {"k": (dim, "pk")}))
    assert (r.failures, r.total, r.status) == (2, 3, "FAILED")


def test_duplicate_keys_count_extra_copies(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,)], "k bigint")
    r = one(quality.unique_keys({"t": (df, "k")}))
    assert (r.failures, r.total) == (2, 4)


def test_checks_pass_on_no_rows(spark):
    r = one(quality.rules("g", "t", spark.createDataFrame([], "x int"), {"bad": F.col("x") < 0}))
    assert (r.failures, r.total, r.status) == (0, 0, "PASSED")


def test_schema_gate_names_the_gaps(spark):
    df = spark.createDataFrame([(1, "x")], "a bigint, b string")
    assert quality.schema_gaps(df, {"a": "bigint", "b": "date", "c": "int"}) == ["b: expected date, found string", "c: expected int, found nothing"]


def test_hot_key_reaches_the_shuffle_reduced(spark):
    """A third of the rows on one SKU: every task still sends one row per SKU and day."""
    from tidewater.operators.segments import daily_moments

    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 10).cast("int"))
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500)
    sales = spark.range(30000).select(key.alias("ProductKey"), day.alias("OrderDate"), F.lit(2).cast("long").alias("q"))
    got = {r.ProductKey: (r.demand, r.demand_sq) for r in daily_moments(sales, ["ProductKey"], "q").collect()}
    rows = [(0 if i % 3 == 0 else i % 500, i % 10) for i in range(30000)]
    per_day = {}
    for k, d in rows:
        per_day[k, d] = per_day.get((k, d), 0) + 2
    for k, (demand, squares) in got.items():
        days = [v for (kk, _), v in per_day.items() if kk == k]
        assert (demand, squares) == (sum(days), sum(v * v for v in days))
    plan = daily_moments(sales, ["ProductKey"], "q")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_sum") >= 2
