"""Distributed operators against plain recomputation on random input."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidewater.operators import derived, intervals, segments, storage
from tidewater.operators.replenish import transfers
from tidewater.operators.running import ranked, running_totals
from tidewater.session import scratch_path


@pytest.mark.parametrize("seed", [1, 2])
def test_balance_equals_the_recurrence(spark, seed):
    rng = random.Random(seed)
    start = dt.date(2024, 1, 1)
    flows = {(k, d): rng.randint(-20, 15) for k in range(20) for d in range(40) if rng.random() < 0.6}
    rows = [(k, start + dt.timedelta(d), q) for (k, d), q in flows.items()]
    df = spark.createDataFrame(rows, "k int, day date, quantity_change bigint")
    got = {(r.k, (r.day - start).days): r.balance for r in derived.inventory_balance(df, ["k"]).collect()}
    stock = defaultdict(int)
    for (k, d), q in sorted(flows.items()):
        stock[k] = max(0, stock[k] + q)
        assert got[k, d] == stock[k]

    last = start + dt.timedelta(45)
    held_since = intervals.stock_intervals(df, ["k"], F.lit(last).cast("date"))
    snap = derived.daily_snapshot(held_since).collect()
    held = {(r.k, (r.SnapshotDate - start).days): (r.OnHandQuantity, (r.SnapshotDate - r.FromDate).days) for r in snap}
    assert {r.k for r in held_since.where("IsCurrent").collect()} == set(range(20))
    for k in range(20):
        days = sorted(d for kk, d in flows if kk == k)
        assert [d for kk, d in sorted(held) if kk == k] == list(range(days[0], 46))
        for d in range(days[0], 46):
            moved = max(x for x in days if x <= d)
            assert held[k, d] == (got[k, moved], d - moved)


@pytest.mark.parametrize("seed", [3, 4])
def test_interval_totals_equal_those_of_days(spark, seed):
    """Totals, averages, late values and months of random intervals with gaps, against a row per day."""
    rng, start = random.Random(seed), dt.date(2023, 12, 20)
    rows, daily = [], defaultdict(lambda: [0, 0, 0])
    for k in range(25):
        at = rng.randint(0, 30)
        while at < 80:
            end, v, g = at + rng.randint(0, 12), rng.randint(0, 9), "ab"[k % 2]
            rows.append((g, k, start + dt.timedelta(at), start + dt.timedelta(end), v))
            for d in range(at, end + 1):
                cell = daily[g, d]
                cell[0], cell[1] = cell[0] + 1, cell[1] + v
                cell[2] += v if d - at >= 5 else 0
            at = end + 1 + rng.choice([0, 0, 0, 25])
    df = spark.createDataFrame(rows, "g string, k int, FromDate date, UntilDate date, v bigint").withColumn("v", F.col("v").cast("decimal(20,2)"))
    change = intervals.changes(df, ["g", "k"], {"v": F.col("v")}, {"old": (F.date_add("FromDate", 5), F.col("v"))})
    total = intervals.totals(intervals.rolled(change, ["g"], ["v", "old"]), ["g"], ["v", "old"])
    got = {(r.g, (r.FromDate - start).days + i): [r.n, int(r.v), int(r.old)] for r in total.collect() for i in range((r.UntilDate - r.FromDate).days + 1)}
    assert got == dict(daily)
    since = start + dt.timedelta(40)
    found = total.groupBy("g").agg(
        intervals.over_days("v").alias("all"), intervals.over_days("v", F.lit(since)).alias("since"), F.sum(intervals.days()).alias("days"), intervals.latest("v").alias("now")
    )
    for r in found.collect():
        mine = {d: c for (g, d), c in daily.items() if g == r.g}
        assert (r.all, r.since, r.days, r.now) == (sum(c[1] for c in mine.values()), sum(c[1] for d, c in mine.items() if d >= 40), len(mine), mine[max(mine)][1])
    months = intervals.by_month(total).groupBy("g", "month").agg(F.sum(intervals.days()).alias("n"), intervals.over_days("v").alias("v"))
    for r in months.collect():
        mine = [c for (g, d), c in daily.items() if g == r.g and (start + dt.timedelta(d)).replace(day=1) == r.month]
        assert (r.n, r.v) == (len(mine), sum(c[1] for c in mine))


@pytest.mark.parametrize("slices", [1, 3, 7])
def test_running_totals_over_slices(spark, slices):
    rng = random.Random(slices)
    rows = [(rng.choice("ab"), rng.randint(0, 12), rng.randint(1, 9)) for _ in range(300)]
    df = spark.createDataFrame(rows, "g string, o int, v bigint")
    for r in running_totals(df, ["g"], "o", ["v"], slices).collect():
        above = [v for g, o, v in rows if g == r.g and o >= r.o]
        assert (r.run_v, r.run_n) == (sum(above), len(above))
        assert r.all_v == sum(v for g, _, v in rows if g == r.g)


def test_ranked_matches_sql_rank(spark):
    rows = [("w", i, i % 4) for i in range(12)]
    df = spark.createDataFrame(rows, "g string, id int, o int")
    got = {r.id: r.rk for r in ranked(df, ["g"], "o", "rk", 3).collect()}
    assert got == {i: 1 + sum(1 for _, _, o in rows if o > i % 4) for i in range(12)}


def test_abc_ties_share_a_class(spark):
    rows = [(i, 10) for i in range(10)]
    df = spark.createDataFrame(rows, "ProductKey int, revenue int").withColumn("amount", F.col("revenue"))
    assert {r.abc_class for r in segments.abc_class(df, [], 4).collect()} == {"C"}


def test_transfers_conserve_units_and_stay_linear(spark):
    rng = random.Random(5)
    rows = [(g, n, rng.randint(-50, 50)) for g in range(30) for n in range(rng.randint(1, 12))]
    df = spark.createDataFrame(rows, "g int, n int, imbalance bigint")
    got = transfers(df, ["g"], "n").collect()
    for g in range(30):
        have = {n: x for gg, n, x in rows if gg == g}
        mine = [r for r in got if r.g == g]
        up, down = sum(x for x in have.values() if x > 0), -sum(x for x in have.values() if x < 0)
        assert sum(r.transfer_units for r in mine) == min(up, down)
        assert len(mine) < max(2, len(have))
        out, into = defaultdict(int), defaultdict(int)
        for r in mine:
            out[r.origin] += r.transfer_units
            into[r.destination] += r.transfer_units
        assert all(v <= have[n] for n, v in out.items()) and all(v <= -have[n] for n, v in into.items())


MART = "d date, k string, v bigint"


def mart(spark, rows):
    return spark.createDataFrame([(dt.date(2024, 1, d), k, v) for d, k, v in rows], MART)


def contents(spark, path):
    return sorted((r.d.day, r.k, r.v) for r in spark.read.parquet(path).collect())


def test_upsert_replaces_inserts_keeps_and_repeats(spark):
    path = scratch_path(spark, "t")
    storage.create_mart(mart(spark, [(1, "a", 1), (1, "b", 2), (2, "a", 3)]), path, ["d"])
    change = mart(spark, [(1, "a", 10), (3, "c", 30)])
    want = [(1, "a", 10), (1, "b", 2), (2, "a", 3), (3, "c", 30)]
    for _ in range(2):
        storage.upsert(spark, path, change, ["d", "k"], "d")
        assert contents(spark, path) == want


def test_upsert_creates_a_missing_table(spark):
    path = scratch_path(spark, "t")
    storage.upsert(spark, path, mart(spark, [(1, "a", 1)]), ["d", "k"], "d")
    assert contents(spark, path) == [(1, "a", 1)]


def test_upsert_rewrites_touched_partitions_only(spark):
    path = scratch_path(spark, "t")
    storage.create_mart(mart(spark, [(1, "a", 1), (2, "a", 2)]), path, ["d"])
    files = lambda d: {r.f for r in spark.read.parquet(path).where(f"d = '2024-01-0{d}'").select(F.col("_metadata.file_path").alias("f")).collect()}
    before = files(1), files(2)
    storage.upsert(spark, path, mart(spark, [(2, "a", 5)]), ["d", "k"], "d")
    assert files(1) == before[0] and files(2) != before[1]


def test_upsert_reads_only_the_span_of_its_source(spark):
    path = scratch_path(spark, "t")
    storage.create_mart(mart(spark, [(d, "a", 1) for d in (1, 2, 3)]), path, ["d"])
    part = storage.between_ends(spark.read.parquet(path), mart(spark, [(2, "a", 5)]), "d")
    plan = part._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") :].split("]")[0]
    assert ">=" in filters and "<=" in filters
    assert part.count() == 1


def test_lookback_reaches_the_files(spark):
    import datetime

    from tidewater.sources import landing

    path = scratch_path(spark, "t")
    spark.sql("SELECT timestamp_seconds(86400 * id) AS timestamp, id FROM range(40)").write.parquet(path)
    new = landing.since_lookback(spark.read.parquet(path), "timestamp", datetime.date(1970, 1, 31), 3)
    assert sorted(r.id for r in new.collect()) == list(range(27, 40))
    assert "GreaterThanOrEqual(timestamp" in new._jdf.queryExecution().executedPlan().toString()
    assert landing.since_lookback(spark.read.parquet(path), "timestamp", None).count() == 40


def test_compaction_keeps_rows_and_reduces_files(spark):
    path = scratch_path(spark, "t")
    df = spark.range(1000).select((F.col("id") % 2).alias("p"), "id")
    df.repartition(20).write.partitionBy("p").parquet(path)
    done = storage.compact(spark, path, ["p"])
    assert done == {"partitions": 2, "files_before": 40, "files_after": 2}
    assert storage.compact(spark, path, ["p"]) == {"partitions": 0, "files_before": 0, "files_after": 0}
    assert spark.read.parquet(path).agg(F.sum("id")).first()[0] == sum(range(1000))


def test_compaction_keeps_rows_added_to_open_partitions(spark):
    path = scratch_path(spark, "t")
    df = spark.range(1000).select((F.col("id") % 2).alias("p"), "id")
    df.repartition(20).write.partitionBy("p").parquet(path)
    df.where("p = 1").write.mode("append").partitionBy("p").parquet(path)
    done = storage.compact(spark, path, ["p"], closed=F.col("p") == 0)
    assert done["partitions"] == 1 and spark.read.parquet(path).count() == 1500


def test_maintenance_goes_on_after_a_failure(spark):
    path = scratch_path(spark, "t")
    spark.range(10).write.parquet(path)
    report = storage.maintain(spark, {scratch_path(spark, "absent"): [], path: []})
    assert [v.split(":")[0] for v in report.values()] == ["failed", "ok"]


def test_offset_gap_is_reported(spark):
    df = spark.createDataFrame([("t", 0, o) for o in (1, 2, 5)], "topic string, partition int, offset bigint")
    r = storage.offset_audit(df).first()
    assert (r.expected, r.missing, r.loss_rate) == (5, 2, 0.4)
