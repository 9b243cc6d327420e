"""Operators that take their input in parts, against one pass over all of it."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from compare import canonical
from pyspark.sql import functions as F

from tidewater.operators import derived, keys, quality, state
from tidewater.operators.asof import as_of
from tidewater.operators.running import numbered, previous
from tidewater.plans import derived as derived_plans
from tidewater.session import finish, scratch_path
from tidewater.sources.star import DerivedStar

START = dt.date(2024, 1, 1)


def same(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    assert canonical([tuple(r) for r in a.collect()], a.columns) == canonical([tuple(r) for r in b.select(*a.columns).collect()], a.columns)


@pytest.mark.parametrize("seed", range(3))
def test_changes_in_any_order_give_the_same_versions(spark, seed):
    rnd = random.Random(seed)
    rows = [(k, rnd.choice(["a", "b", None]), START + dt.timedelta(d)) for k in range(12) for d in rnd.sample(range(30), rnd.randint(1, 9))]
    schema = "k int, v string, d date"
    whole = derived.scd2_build(spark.createDataFrame(rows, schema), "k", ["v"], "d")
    rnd.shuffle(rows)
    cuts = sorted(rnd.sample(range(1, len(rows)), 3))
    dim = None
    for part in (rows[: cuts[0]], rows[cuts[0] : cuts[1]], rows[cuts[1] : cuts[2]], rows[cuts[2] :]):
        change = spark.createDataFrame(part, schema)
        dim = derived.scd2_versions(change, "k", ["v"], "d") if dim is None else derived.scd2_splice(dim, change, "k", ["v"], "d")
        dim = spark.createDataFrame(dim.collect(), dim.schema)
    assert all(r.SeenOn[0] == r.EffectiveFrom for r in dim.collect())
    same(dim.drop("SeenOn"), whole)


def test_a_change_replaces_what_was_seen_on_its_day(spark):
    schema = "k int, v string, d date"
    dim = derived.scd2_versions(spark.createDataFrame([(1, "a", START), (1, "b", START + dt.timedelta(5))], schema), "k", ["v"], "d")
    dim = derived.scd2_splice(dim, spark.createDataFrame([(1, "a", START + dt.timedelta(5)), (2, "x", START)], schema), "k", ["v"], "d")
    assert sorted((r.k, r.v, r.EffectiveFrom, r.IsCurrent) for r in dim.collect()) == [(1, "a", START, True), (2, "x", START, True)]


def order_lines(seed):
    rnd = random.Random(seed)
    for n in range(400):
        ordered = rnd.randint(1, 30)
        lead = rnd.choice([None, rnd.randint(1, 40)])
        yield (
            rnd.randrange(4), START + dt.timedelta(rnd.randrange(100)), rnd.randrange(60), ordered, rnd.randint(0, ordered), 0, float(ordered),
            rnd.randint(0, 1), rnd.randint(0, 1), rnd.randint(0, 1), lead, None if lead is None else lead - 10,
        )


def test_scorecard_from_increments_equals_that_of_all_lines(spark):
    kinds = ["bigint", "date", "bigint", "bigint", "bigint", "bigint", "double", "int", "int", "int", "bigint", "bigint"]
    schema = ", ".join(f"{c} {t}" for c, t in zip(derived.SCORECARD_INPUT, kinds))
    rows = list(order_lines(5))
    lines = spark.createDataFrame(rows, schema).withColumn("ExtendedPOAmount", F.col("ExtendedPOAmount").cast("decimal(14,2)"))
    parts = lines.withColumn("part", F.pmod(F.xxhash64("PurchaseOrderID", "OrderedQuantity", "POCreationDate"), F.lit(3)))
    base = scratch_path(spark, "inc")
    place, mart = f"{base}/state", f"{base}/mart"
    for k in (0, 1, 2, 1):  # the second increment runs twice
        state.add_increment(spark, parts.where(F.col("part") == k).drop("part"), place, mart, f"load {k}")
    whole = derived.supplier_monthly(lines)
    same(whole, spark.read.parquet(mart))
    # a late line rewrites the files of its month only
    files = {r.f: r.m for r in spark.read.parquet(mart).select(F.col("_metadata.file_path").alias("f"), "YearMonthDate", F.col("_metadata.file_modification_time").alias("m")).distinct().collect()}
    late = spark.createDataFrame([rows[0]], schema).withColumns({"ExtendedPOAmount": F.col("ExtendedPOAmount").cast("decimal(14,2)"), "POCreationDate": F.lit(START + dt.timedelta(40))})
    state.add_increment(spark, late, place, mart, "late")
    now = {r.f: r.m for r in spark.read.parquet(mart).select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_modification_time").alias("m")).distinct().collect()}
    assert {f for f in files if "2024-02" not in f} == {f for f in now if f in files} and all(now[f] == files[f] for f in files if f in now)
    same(derived.supplier_monthly(lines.unionByName(late)), spark.read.parquet(mart))
    assert state.merge_increments(spark, place) == 4
    state.add_increment(spark, late.withColumn("PurchaseOrderID", F.lit(999).cast("long")), place, mart, "later")
    same(derived.supplier_monthly(lines.unionByName(late).unionByName(late.withColumn("PurchaseOrderID", F.lit(999).cast("long")))), spark.read.parquet(mart))


def test_keys_stay_and_never_collide(spark):
    path = scratch_path(spark, "keys")
    frame = lambda names: spark.createDataFrame([(n,) for n in names], "name string")
    first = {r.name: r.key for r in keys.assign(spark, path, frame(["b", "d", None, "b"]), ["name"], "key", "one").collect()}
    assert first == {None: 1, "b": 2, "d": 3}
    for _ in range(2):
        then = {r.name: r.key for r in keys.assign(spark, path, frame(["c", "a", "d", None] + [f"z{k}" for k in range(50)]), ["name"], "key", "two").collect()}
        assert {n: then[n] for n in first} == first and sorted(then.values()) == list(range(1, 56))
        assert (then["a"], then["c"]) == (4, 5)


@pytest.mark.parametrize("slices", [1, 4])
def test_rows_before_and_numbers_over_slices(spark, slices):
    rnd = random.Random(slices)
    values = sorted(rnd.sample(range(1000), 40))
    df = spark.createDataFrame([(v, v * 2) for v in values], "o int, x int").repartition(3)
    found = {r.o: (r.prev_x, r.prev_o) for r in previous(df, "o", ["x", "o"], slices).collect()}
    assert found == {v: (values[k - 1] * 2, values[k - 1]) if k else (None, None) for k, v in enumerate(values)}
    assert {r.o: r.n for r in numbered(df, ["o"], "n", 7, slices).collect()} == {v: k + 8 for k, v in enumerate(values)}


def test_as_of_join_with_a_key_that_holds_most_rows(spark):
    rnd = random.Random(2)
    day = lambda d: START + dt.timedelta(d)
    versions = [(k, day(d), f"{k}-{d}") for k in range(3) for d in sorted(rnd.sample(range(-50, 400), 6))] + [(9, day(3), "nine")]
    facts = [(n, 0 if n % 4 else rnd.randrange(5), day(rnd.randrange(-60, 420))) for n in range(600)]
    out = as_of(spark.createDataFrame(facts, "n int, k int, d date"), spark.createDataFrame(versions, "k int, since date, v string"), "k", "d", "since", ["v", "since"])
    got = {r.n: (r.v, r.since) for r in out.collect()}
    assert len(got) == 600
    for n, k, d in facts:
        before = [(since, v) for key, since, v in versions if key == k and since <= d]
        assert got[n] == (max(before)[1], max(before)[0]) if before else got[n] == (None, None)


def test_rules_are_counted_by_the_job_that_writes(spark):
    path = scratch_path(spark, "rules")
    df = spark.range(100).select("id", (F.col("id") % 7).alias("x"))
    found = quality.written_with_rules(df, path, {"a": {"odd": F.col("id") % 2 == 1}, "b": {"zero of small": (F.col("id") < 10, F.col("x") == 0), "null": F.col("x").isNull()}}, "t")
    rows = {r.check_name: (r.check_group, r.failures, r.total, r.status) for r in found.collect()}
    assert rows == {"t: odd": ("a", 50, 100, "FAILED"), "t: zero of small": ("b", 2, 10, "FAILED"), "t: null": ("b", 0, 100, "PASSED")}
    assert spark.read.parquet(path).count() == 100


def test_the_lines_of_all_deliveries_are_derived_once(spark, small, monkeypatch):
    plans, add = [], state.add_increment

    def spied(spark, lines, *rest):
        plans.append(lines._jdf.queryExecution().optimizedPlan().toString())
        add(spark, lines, *rest)

    monkeypatch.setattr(state, "add_increment", spied)
    star = DerivedStar(spark, small)
    same(finish(derived_plans.scorecard_increments(star)).drop("YearMonthDate"), finish(star.table("FactSupplierMonthlyPerformance")).drop("YearMonthDate"))
    assert len(plans) == 4 and not any("Join" in p for p in plans)
