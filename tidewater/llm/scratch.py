"""Tables written between the steps of an operator, in the shared folder of the cluster."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: it cuts lineage, and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def merged_tasks(df: DataFrame) -> DataFrame:
    """``df`` with fewer and larger tasks, for few columns and far fewer rows than there are documents:
    a task, a Python call and a file for each shuffle partition would cost more than the rows."""
    tasks = max(2 * df.sparkSession.sparkContext.defaultParallelism, shuffle_partitions(df) // 8)
    return df.coalesce(tasks)


def written_small(df: DataFrame, name: str) -> DataFrame:
    return written(merged_tasks(df), name)


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def on_workers(spark: SparkSession) -> SparkSession:
    """Lets Python workers that begin elsewhere import this package from where it lies.
    On a cluster it has to lie there on every executor, or come by ``--py-files``."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = [p for p in spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([*paths, root])
    return spark
