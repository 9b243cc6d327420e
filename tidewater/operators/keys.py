"""Surrogate keys kept in a stored map from business keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .running import numbered
from .storage import _children, _drop, _rename, _same, _writer, exists
from ..session import scratch_path


def known_keys(spark: SparkSession, path: str) -> DataFrame | None:
    return spark.read.parquet(*[f"{path}/{n}" for n in _children(spark, path) if n.startswith("load-")]) if exists(spark, path) else None


def assign(spark: SparkSession, path: str, rows: DataFrame, business: list[str], name: str, load: str) -> DataFrame:
    """The map (business, key) after giving numbers to the business keys of ``rows`` it lacks.

    Known keys keep their number; new ones follow the highest one in order of the business
    key, so no two are equal. The numbers of a load are published by one rename: a load that
    runs again finds its keys known and adds none.
    """
    known = known_keys(spark, path)
    new = rows.select(*business).distinct()
    start = 0
    if known is not None:
        start = known.agg(F.coalesce(F.max(name), F.lit(0))).first()[0]
        new = new.join(known, _same(new, known, business), "left_anti")
    staged = scratch_path(spark, "keys")
    _writer(numbered(new, business, name, start), "overwrite", []).parquet(staged)
    if not _rename(spark, staged, f"{path}/load-{load}"):
        _drop(spark, staged)
    return known_keys(spark, path)
