"""Names of all queries; each subject module adds its own."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import finish
from ..sources.star import DerivedStar

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(plan: Callable[[DerivedStar], DataFrame]) -> Callable[[DerivedStar], DataFrame]:
    """Register ``plan`` under its own name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return finish(plan(DerivedStar(spark, sf_dir)))

    run.__name__ = plan.__name__
    REGISTRY[plan.__name__] = run
    return plan


def all_queries() -> dict[str, Query]:
    from . import derived, events, joins, measures, planning, quality, semantic, storage, streams  # noqa: F401

    return dict(REGISTRY)
