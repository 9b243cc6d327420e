"""Data-quality checks; every check is one row (group, name, failures, total, status)."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def _rows(df: DataFrame, group: str) -> DataFrame:
    failures = F.coalesce("failures", F.lit(0)).cast("long")
    return df.select(
        F.lit(group).alias("check_group"), "check_name", failures.alias("failures"),
        F.coalesce("total", F.lit(0)).cast("long").alias("total"),
        F.when(failures == 0, "PASSED").otherwise("FAILED").alias("status"),
    )


def union(checks: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def unique_keys(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Extra copies of a key. Copies are counted per key before the shuffle, so
    a key repeated in a third of the table costs no more than any other."""

    def one(name: str, df: DataFrame, key: str) -> DataFrame:
        per_key = df.groupBy(key).agg(F.count("*").alias("n"))
        return per_key.agg(F.sum(F.col("n") - 1).alias("failures"), F.sum("n").alias("total")).withColumn(
            "check_name", F.lit(f"{name}.{key}")
        )

    return _rows(union([one(n, df, k) for n, (df, k) in tables.items()]), "primary key")


def foreign_keys(name: str, fact: DataFrame, references: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Distinct key values without a dimension row, all keys of a fact in one scan."""
    value = lambda k: F.col(k).cast("long")
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("fk"), value(k).alias("v")) for k in references]))
    used = fact.select(pairs.alias("p")).groupBy("p.fk", "p.v").agg(F.count("*").alias("rows"))
    known = union(
        [d.select(F.lit(k).alias("fk"), F.col(pk).cast("long").alias("v"), F.lit(1).alias("hit")) for k, (d, pk) in references.items()]
    )
    joined = used.join(known, ["fk", "v"], "left")
    g = joined.groupBy("fk").agg(F.count_if(F.col("hit").isNull()).alias("failures"), F.count("*").alias("total"))
    return _rows(g.withColumn("check_name", F.concat(F.lit(f"{name}."), F.col("fk"))), "foreign key")


def rules(group: str, name: str, df: DataFrame, broken: dict[str, Column]) -> DataFrame:
    """Rows matching each condition, all conditions in one scan; NULL is not a failure."""
    labels = list(broken)
    counted = df.agg(F.count("*").alias("total"), *[F.count_if(broken[c]).alias(f"f{i}") for i, c in enumerate(labels)])
    listed = F.array(*[F.struct(F.lit(f"{name}: {c}").alias("check_name"), F.col(f"f{i}").alias("failures")) for i, c in enumerate(labels)])
    return _rows(counted.select("total", F.inline(listed)), group)


def summary(checks: DataFrame) -> DataFrame:
    return checks.agg(
        F.count("*").alias("checks"), F.count_if(F.col("status") == "PASSED").alias("passed"),
        F.count_if(F.col("status") == "FAILED").alias("failed"), F.sum("failures").alias("failing_rows"),
    ).select(
        "*", (F.col("passed").cast("double") / F.col("checks").cast("double")).alias("pass_rate"),
        (F.lit(100.0) * F.col("passed").cast("double") / F.col("checks").cast("double")).alias("dq_index"),
    )


def first_failed_gate(gates: list[tuple[str, Callable[[], DataFrame]]]) -> str | None:
    """Run check groups in order and stop at the first with a failure."""
    for name, checks in gates:
        if not checks().where("status = 'FAILED'").isEmpty():
            return name
    return None


def schema_gaps(df: DataFrame, expected: dict[str, str]) -> list[str]:
    """Columns missing or of another type; the first gate, before any rows are read."""
    have = dict(df.dtypes)
    return [f"{c}: expected {t}, found {have.get(c, 'nothing')}" for c, t in expected.items() if have.get(c) != t]


def written_with_rules(df: DataFrame, path: str, groups: dict[str, dict[str, Column]], name: str) -> DataFrame:
    """Writes ``df`` and counts, in the same pass, the rows that break each rule; returns the
    checks. ``groups``: check group -> rule -> condition; a rule ``(where, condition)`` counts
    only rows that satisfy ``where``. The counts are a handful of numbers per task."""
    listed = [(g, label, c if isinstance(c, tuple) else (F.lit(True), c)) for g, rules_ in groups.items() for label, c in rules_.items()]
    seen = Observation(f"rules of {name}")
    counts = [F.count_if(where & broken).alias(f"f{i}") for i, (_, _, (where, broken)) in enumerate(listed)]
    totals = [F.count_if(where).alias(f"t{i}") for i, (_, _, (where, _)) in enumerate(listed)]
    df.observe(seen, *counts, *totals).write.mode("overwrite").parquet(path)
    found = seen.get
    rows = [(g, f"{name}: {label}", found[f"f{i}"], found[f"t{i}"]) for i, (g, label, _) in enumerate(listed)]
    checks = df.sparkSession.createDataFrame(rows, "check_group string, check_name string, failures long, total long")
    return checks.withColumn("status", F.when(F.col("failures") == 0, "PASSED").otherwise("FAILED"))
