"""What one task takes of a shuffle or file does not grow with the input."""

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidewater import session
from tidewater.operators import storage
from tidewater.sources.star import DerivedStar
from tidewater.streaming import jobs


@pytest.fixture
def fresh(spark):
    """A session with Spark's own sizes; the context is shared."""
    other = spark.newSession()
    other.conf.set(session.SHUFFLE_SIZE, "64MB")
    other.conf.set(session.SPLIT_SIZE, "128MB")
    other.conf.set("spark.sql.shuffle.partitions", "40")
    return other


def partitions(df):
    return df.select(F.spark_partition_id().alias("p")).distinct().count()


def test_a_shuffle_is_cut_into_small_tasks(fresh, small):
    fresh.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    DerivedStar(fresh, small)
    rows = fresh.range(0, 600_000, 1, 4).groupBy("id").agg(F.max(F.sha2(F.col("id").cast("string"), 256)).alias("h"))
    assert partitions(rows) >= 3  # about 30 MB, one task of the 64 MB size


def test_files_are_cut_into_small_tasks(fresh, small):
    DerivedStar(fresh, small)
    assert session.size_in_bytes(fresh.conf.get(session.SPLIT_SIZE)) == 32 << 20


def test_smaller_sizes_of_the_session_stay(fresh):
    fresh.conf.set(session.SHUFFLE_SIZE, "1m")
    fresh.conf.set(session.SPLIT_SIZE, "16m")
    session.configure(fresh)
    assert (fresh.conf.get(session.SHUFFLE_SIZE), fresh.conf.get(session.SPLIT_SIZE)) == ("1m", "16m")


def test_partitions_grow_with_the_input_and_never_shrink(fresh):
    session.spread(fresh, 1 << 20)
    assert fresh.conf.get(session.PARTITIONS, None) is None
    session.spread(fresh, 1 << 30)
    assert fresh.conf.get(session.PARTITIONS) == "256"
    session.spread(fresh, 1 << 40)
    assert fresh.conf.get(session.PARTITIONS) == "10000"
    session.spread(fresh, 1 << 20)
    assert fresh.conf.get(session.PARTITIONS) == "10000"


def test_rebalanced_files_keep_their_size(fresh, tmp_path):
    """Tables are not written as files of a task's share."""
    fresh.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    session.configure(fresh)
    rows = fresh.range(0, 400_000, 1, 4).select("id", F.sha2(F.col("id").cast("string"), 256).alias("h"))
    storage.append(rows, f"{tmp_path}/t")
    assert len(fresh.read.parquet(f"{tmp_path}/t").inputFiles()) == 1
    assert fresh.conf.get(session.SHUFFLE_SIZE) == str(8 << 20)


@pytest.mark.parametrize("text,size", [("64MB", 64 << 20), ("8m", 8 << 20), ("16k", 16 << 10), ("67108864b", 1 << 26), ("1024", 1024), ("2g", 2 << 30)])
def test_sizes_are_read_as_spark_writes_them(text, size):
    assert session.size_in_bytes(text) == size


def test_a_file_of_a_stream_is_read_by_several_tasks(spark, small, tmp_path):
    """One row group a file means one working task a batch, however many cores there are."""
    rows = spark.range(0, 200_000, 1, 1).select(F.sha2(F.col("id").cast("string"), 512).alias("h"))
    assert storage.write_batch(rows, f"{tmp_path}/t", 0)
    (file,) = spark.read.parquet(f"{tmp_path}/t").inputFiles()
    assert pq.ParquetFile(file.removeprefix("file://")).metadata.num_row_groups > 2


def test_a_parallel_batch_becomes_few_files(spark, tmp_path):
    message = "cast(cast(id as string) as binary) key, cast(cast(id as string) as binary) value, 't' topic, cast(id % 16 as int) partition, id offset, timestamp'2024-01-01' timestamp"
    spark.range(0, 4000, 1, 1).selectExpr(*message.split(", ")).write.option("parquet.block.size", "4096").parquet(f"{tmp_path}/in")
    parts = spark.conf.get(session.SPLIT_SIZE), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set(session.SPLIT_SIZE, "8k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        source = jobs.file_source(spark, f"{tmp_path}/in")
        jobs.bronze_ingest(source, f"{tmp_path}/out", f"{tmp_path}/chk", "few_files", once=True, few_files=True).awaitTermination()
    finally:
        spark.conf.set(session.SPLIT_SIZE, parts[0])
        spark.conf.set("spark.sql.files.openCostInBytes", parts[1])
    out = spark.read.parquet(f"{tmp_path}/out")
    assert out.count() == 4000 and len(out.inputFiles()) == 1
