"""Session helpers: the few settings results depend on, and shared scratch space."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Packed order lines take 40 times their bytes in the sorts and hash tables of a task, so a task gets
# less than Spark's 64 MB of a shuffle and 128 MB of a file. Smaller values of the session stay.
SHUFFLE_SIZE, SPLIT_SIZE = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes"
TASK_BYTES = {SHUFFLE_SIZE: 8 << 20, SPLIT_SIZE: 32 << 20}
FILE_SIZE = "tidewater.fileBytes"  # what the session had for SHUFFLE_SIZE: the size of rebalanced files
CORES_FIRST = "spark.sql.adaptive.coalescePartitions.parallelismFirst"
PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
MOST_PARTITIONS = 10_000  # more blocks than tasks can fetch well; beyond it partitions grow, none is left out


def configure(spark: SparkSession) -> SparkSession:
    """Event dates are UTC dates, so the session zone must be UTC; and what a task takes is bounded."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    for key, most in TASK_BYTES.items():
        if size_in_bytes(spark.conf.get(key)) > most:
            if key == SHUFFLE_SIZE:
                spark.conf.set(FILE_SIZE, spark.conf.get(key))
            spark.conf.set(key, str(most))
    return spark


def size_in_bytes(text: str) -> int:
    """A size as Spark writes it: ``64MB``, ``8m``, ``67108864b`` or a plain number of bytes."""
    number, unit = re.fullmatch(r"\s*(\d+)\s*([kmgtp]?)i?b?\s*", text.lower()).groups()
    return int(number) << (10 * " kmgtp".index(unit or " "))


def spread(spark: SparkSession, read_bytes: int) -> None:
    """As many shuffle partitions as an input of ``read_bytes`` needs for tasks of the same size; AQE
    merges those that turn out small. Never fewer than the session has."""
    least = int(spark.conf.get(PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = min(MOST_PARTITIONS, -(-2 * read_bytes // TASK_BYTES[SHUFFLE_SIZE]))  # lines are shuffled at twice their file's bytes
    if wanted > least:
        spark.conf.set(PARTITIONS, str(wanted))


@contextmanager
def file_size(spark: SparkSession, few: bool = False) -> Iterator[None]:
    """Within, rebalanced files have the size that the session gave them, not that of a task's share;
    with ``few`` there is no smaller file only to keep every core writing."""
    saved = {k: spark.conf.get(k) for k in (SHUFFLE_SIZE, CORES_FIRST)}
    spark.conf.set(SHUFFLE_SIZE, spark.conf.get(FILE_SIZE, saved[SHUFFLE_SIZE]))
    if few:
        spark.conf.set(CORES_FIRST, "false")
    try:
        yield
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach. A temporary one stands in where none is set and
    driver and executors are one process; on a cluster that is an error."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark._jsc.sc().getCheckpointDir()
    if configured is None and current.isDefined():
        configured = current.get()
    if configured is None:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="tidewater-")
    if not current.isDefined():
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unused path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives executor loss and fixes partition contents."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def finish(df: DataFrame) -> DataFrame:
    """Serving types: DOUBLE for money, BIGINT for integers, zone-free timestamps."""
    out = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("long")
        elif isinstance(field.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        out.append(c.alias(field.name))
    return df.select(*out)
