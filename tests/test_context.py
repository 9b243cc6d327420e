"""Measures in a filter context: how each class of leaf behaves under grouping and filters."""

import pytest

from tidewater.plans import semantic
from tidewater.sources.star import DerivedStar


@pytest.fixture(scope="module")
def star(spark, small):
    return DerivedStar(spark, small)


def values(star, measures, group_by, **more):
    return {tuple(r[a] for a in group_by): r.asDict() for r in semantic.evaluate(star, measures, group_by, **more).collect()}


def test_additive_leaves_add_up_and_distinct_ones_do_not(star):
    names = ["net_sales", "sales_lines", "sales_orders", "po_spend", "stockout_incidents"]
    whole = values(star, names, [])[()]
    for group in (["RegionKey"], ["CategoryName", "YearNumber"]):
        parts = values(star, names, group).values()
        for name in ("net_sales", "sales_lines", "po_spend", "stockout_incidents"):
            assert sum(p[name] or 0 for p in parts) == whole[name]
        assert sum(p["sales_orders"] or 0 for p in parts) > whole["sales_orders"]


def test_a_filter_picks_the_group_it_names(star):
    names = ["net_sales", "sales_orders", "cycle_time_days", "valuation", "avg_daily_valuation", "order_otif", "forecast_error", "safety_stock"]
    by_region = values(star, names, ["RegionKey"])
    for region in (0, 3):
        alone = values(star, names, [], where={"RegionKey": [region]})[()]
        assert alone == {n: by_region[(region,)][n] for n in names}


def test_stock_is_the_last_day_of_the_context_and_not_a_sum_of_days(star):
    whole = values(star, ["on_hand", "latest_snapshot", "snapshot_records", "avg_daily_valuation"], [])[()]
    assert whole["on_hand"] == star.position("OnHandQuantity").groupBy().sum("OnHandQuantity").first()[0]
    months = values(star, ["on_hand", "latest_snapshot", "snapshot_records", "total_snapshot_rows"], ["MonthYear"])
    last = months[max(months)]
    assert (last["on_hand"], last["latest_snapshot"]) == (whole["on_hand"], whole["latest_snapshot"])
    assert sum(m["snapshot_records"] for m in months.values()) == whole["snapshot_records"]
    assert {m["total_snapshot_rows"] for m in months.values()} == {whole["snapshot_records"]}


def test_attributes_without_a_path_do_not_filter(star):
    rows = values(star, ["po_spend", "net_sales", "facilities"], ["SupplierTier"])
    total = values(star, ["net_sales", "facilities"], [])[()]
    assert {(r["net_sales"], r["facilities"]) for r in rows.values()} == {(total["net_sales"], total["facilities"])}
    with pytest.raises(ValueError):
        semantic.evaluate(star, ["net_sales"], ["SupplierTier"])
    with pytest.raises(KeyError):
        semantic.evaluate(star, ["no such measure"], [])


def test_selected_value_and_default(star):
    presets = values(star, ["carrying_rate", "multiplier", "ordered_units", "simulated_demand"], ["ScenarioCode"])
    assert len(presets) == 6 and float(presets[("SCN-STRESS",)]["multiplier"]) == 1.15
    many = values(star, ["carrying_rate", "multiplier", "ordered_units"], [])[()]
    assert (many["carrying_rate"], many["multiplier"]) == (22.0, 1.0)
    one = values(star, ["carrying_rate", "ordered_units"], [], where={"ScenarioCode": ["SCN-PORT7D"]})[()]
    assert float(one["carrying_rate"]) == 24.0


def test_leaves_of_one_fact_and_context_share_an_aggregation(star):
    plan = semantic.evaluate(star, ["net_sales", "cogs", "sales_orders", "cycle_time_days", "otif_rate"], ["ChannelName"])
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("lineitem.parquet") + text.count("l_extendedprice") > 0
    assert text.count("Relation [l_orderkey") == 1
