"""Planner queues read the order lines once; lines travel in short columns."""

import os
import random
import re

from pyspark.sql import functions as F

from tidewater.operators.replenish import takes_part, transfers
from tidewater.plans import planning, semantic
from tidewater.sources.star import DerivedStar, Star


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_planner_queues_reads_the_lines_once(spark, small):
    plan = planning.planner_queues(DerivedStar(spark, small))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_orderkey#") and sum("Relation [" in line and "l_orderkey#" in line for line in plan.splitlines()) == 1


def test_nodes_that_take_part_are_the_ends_of_transfers(spark):
    rng = random.Random(5)
    nodes = [(g, n, rng.choice([-3, -2, -1, 0, 0, 1, 2, 5])) for g in range(60) for n in range(rng.randint(1, 9))]
    df = spark.createDataFrame(nodes, "g long, n long, imbalance long")
    ends = {(r.g, n) for r in transfers(df, ["g"], "n").collect() for n in (r.origin, r.destination)}
    flagged = df.withColumn("moves", takes_part(F.col("imbalance"), ["g"], "n")).where("moves")
    assert ends and {(r.g, r.n) for r in flagged.collect()} == ends


def test_sums_of_one_pass_are_those_of_both_facts_with_null_keys(spark, small, tmp_path):
    for name in os.listdir(small):
        os.symlink(f"{small}/{name}", tmp_path / name)
    os.unlink(tmp_path / "lineitem.parquet")
    lines = spark.read.parquet(f"{small}/lineitem.parquet")
    lines = lines.withColumn("l_partkey", F.when(F.col("l_linenumber") != 3, F.col("l_partkey"))).withColumn("l_suppkey", F.when(F.col("l_linenumber") != 2, F.col("l_suppkey")))
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    star = DerivedStar(spark, str(tmp_path))
    expected = Star.site_sums(star)
    got = rows(star.site_sums().select(*expected.columns))
    assert got == rows(expected) and any(r[0] is None for r in got)


def test_lines_travel_as_whole_numbers_flags_and_days(spark, small):
    plan = semantic.semantic_measures(DerivedStar(spark, small))._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Project [" in line and "l_orderkey#" in line and "l_partkey#" in line]
    assert joins and not any(re.search(r"[\[ ](l_extendedprice|l_returnflag|l_shipdate|l_discount)#\d+[,\]]", line) for line in joins)
