"""Measures over stored lines: the lines are joined once, and the values are those of the facts."""

import os

import pytest
from pyspark.sql import functions as F

from tidewater.plans import semantic
from tidewater.plans.registry import all_queries
from tidewater.sources.star import DerivedStar

MEASURES = ["forecast_units", "forecast_error", "wape", "forecast_bias", "lead_time_demand", "safety_stock", "risk_tier", "ordered_units", "po_lines", "returned_units"]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def odd(spark, small, tmp_path_factory):
    """Lines without a product, a supplier or an order, orders without lines, products without a category."""
    path = tmp_path_factory.mktemp("odd")
    for name in os.listdir(small):
        if name not in ("lineitem.parquet", "orders.parquet", "part.parquet"):
            os.symlink(f"{small}/{name}", path / name)
    key, number = F.col("l_orderkey"), F.col("l_linenumber")
    lines = spark.read.parquet(f"{small}/lineitem.parquet")
    lines = lines.withColumns({
        "l_partkey": F.when(number != 3, F.when(key % 11 == 0, F.col("l_partkey") + 10**9).otherwise(F.col("l_partkey"))),
        "l_suppkey": F.when(number != 2, F.col("l_suppkey")), "l_orderkey": F.when(key % 7 == 0, key + 10**9).otherwise(key),
    })
    lines.write.parquet(f"{path}/lineitem.parquet")
    spark.read.parquet(f"{small}/orders.parquet").where("o_orderkey % 5 != 0").write.parquet(f"{path}/orders.parquet")
    part = spark.read.parquet(f"{small}/part.parquet")
    part.withColumn("p_type", F.when(F.col("p_partkey") % 9 != 0, F.col("p_type"))).write.parquet(f"{path}/part.parquet")
    return str(path)


def test_planning_reads_and_joins_the_lines_once(spark, small):
    plan = all_queries()["context_planning_by_category_region"](spark, small)._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey#" not in plan


def test_a_group_with_keys_is_summed_with_one_shuffle_of_its_rows(spark, small):
    """Rows of both facts are stacked before they are summed; attributes of the keys follow behind."""
    star = DerivedStar(spark, small)
    df = semantic.evaluate(star, ["ordered_units", "forecast_units"], ["RegionKey", "MonthYear", "ProductKey", "WarehouseKey"], store_lines=True)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert sum("Aggregate [" in line for line in plan.splitlines()) == 2  # the forecast from its lines, and both by group


@pytest.mark.parametrize("group_by, where", [
    (["CategoryName", "RegionKey"], None), (["CategoryName", "RegionKey", "YearNumber"], {"CategoryName": ["A", "ECONOMY"], "RegionKey": [0, 1]}),
    (["ProductKey", "CategoryName", "BrandName"], None), (["MonthYear", "WarehouseKey", "RegionKey"], {"RegionKey": [2]}), ([], None),
])
def test_stored_lines_give_the_values_of_the_facts(spark, odd, group_by, where):
    if where and "CategoryName" in where:
        where = where | {"CategoryName": [r[0] for r in spark.read.parquet(f"{odd}/part.parquet").select("p_type").distinct().where("p_type IS NOT NULL").sort("p_type").limit(2).collect()]}
    once, apart = (rows(semantic.evaluate(DerivedStar(spark, odd), MEASURES, group_by, where, store_lines=stored)) for stored in (True, False))
    assert once == apart and once


def test_columns_without_an_order_keep_lines_that_have_none(spark, odd):
    star = DerivedStar(spark, odd)
    stored = star.with_stored_lines({"FactSales": {"WarehouseKey", "OrderedQuantity"}, "FactPurchaseOrder": {"OrderedQuantity", "POStatus"}}, ["CategoryName"])
    for fact, columns in (("FactSales", ["ProductKey", "OrderedQuantity"]), ("FactSales", ["ProductKey", "OrderedQuantity", "OrderDate"]), ("FactPurchaseOrder", ["OrderedQuantity"]),
                          ("FactPurchaseOrder", ["OrderedQuantity", "POStatus"])):
        assert rows(stored.table(fact, *columns)) == rows(star.table(fact, *columns))
    assert stored.table("FactPurchaseOrder", "CategoryName", "OrderedQuantity").count() == star.table("FactPurchaseOrder").select("OrderedQuantity").count() + (
        star.table("FactPurchaseOrder", "OrderedQuantity").count() - star.table("FactPurchaseOrder", "OrderedQuantity", "POStatus").count())
