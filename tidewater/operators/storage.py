"""Parquet table maintenance: keyed upsert, compaction, layout and footprint."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import MART_CODEC
from ..session import CORES_FIRST, SHUFFLE_SIZE, file_size, scratch_path


# Files that a stream reads one at a time: several row groups each, so that several tasks read one file.
ROW_GROUPS = {"parquet.block.size": str(4 << 20)}


def _writer(df: DataFrame, mode: str, partition_by: list[str]):
    w = df.write.mode(mode).options(**MART_CODEC)
    return w.partitionBy(*partition_by) if partition_by else w


def create_mart(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Partitioned mart. The rebalance hint lets AQE split a heavy date over
    several files and merge light ones, so neither one task nor many small
    files result."""
    with file_size(df.sparkSession):
        _writer(df.hint("rebalance", *partition_by), "overwrite", partition_by).parquet(path)


def append(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    keys = partition_by or []
    with file_size(df.sparkSession):
        _writer(df.hint("rebalance", *keys), "append", keys).parquet(path)


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a file or of all files below a folder; 0 if there is none."""
    fs, p = _fs(spark, path)
    return fs.getContentSummary(p).getLength() if fs.exists(p) else 0


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One small file of text, in whichever store ``path`` names."""
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def _drop(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


LOCK_WAIT_S, LOCK_STALE_S = 600, 6 * 3600


@contextmanager
def exclusive(spark: SparkSession, root: str, wait_s: float = LOCK_WAIT_S, stale_s: float = LOCK_STALE_S) -> Iterator[None]:
    """One writer of the tables below ``root`` at a time: the holder of a lock file, which is
    created only where none is. One left by a job that died is taken over after ``stale_s``."""
    path = f"{root.rstrip('/')}/_lock"
    fs, p = _fs(spark, path)
    deadline = time.monotonic() + wait_s
    while True:
        try:
            fs.create(p, False).close()
            break
        except Exception as e:
            if not fs.exists(p):
                if "FileAlreadyExists" not in str(e):
                    raise
                continue
            if time.time() - fs.getFileStatus(p).getModificationTime() / 1000 > stale_s:
                fs.delete(p, False)
            elif time.monotonic() > deadline:
                raise TimeoutError(f"{path} is held by another writer") from e
            else:
                time.sleep(0.2)
    try:
        yield
    finally:
        fs.delete(p, False)


def between_ends(target: DataFrame, source: DataFrame, partition: str) -> DataFrame:
    """``target`` from the first to the last partition value of ``source``, as literals, so
    that only those directories are listed and read; with the null partition if the source touches it."""
    low, high, blank = source.agg(F.min(partition), F.max(partition), F.count_if(F.col(partition).isNull())).first()
    if low is None:
        return target.where(F.col(partition).isNull()) if blank else target.where(F.lit(False))
    inside = F.col(partition).between(F.lit(low), F.lit(high))
    return target.where(inside | F.col(partition).isNull() if blank else inside)


def _same(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    """Equal in all columns, nulls included."""
    return reduce(and_, [left[c].eqNullSafe(right[c]) for c in columns])


def upsert(spark: SparkSession, path: str, source: DataFrame, keys: list[str], partition: str) -> None:
    """Insert or replace rows by key; only partitions the source touches are rewritten. A null
    is a partition and a key value like any other.

    The source is written once to the shared folder, so the touched partitions
    and the new rows come from the same data even if an executor is lost. The
    rewrite is staged by the writer and swapped in at commit.
    """
    staged = scratch_path(spark, "upsert")
    _writer(source, "overwrite", []).parquet(staged)
    source = spark.read.parquet(staged)
    if exists(spark, path):
        touched, new = source.select(partition).distinct(), source.select(*keys).distinct()
        target = between_ends(spark.read.schema(source.schema).parquet(path), source, partition)
        kept = target.join(touched, _same(target, touched, [partition]), "left_semi")
        kept = kept.join(new, _same(kept, new, keys), "left_anti")
        merged = kept.select(*source.columns).unionByName(source)
        with file_size(spark):
            _writer(merged.hint("rebalance", partition), "overwrite", [partition]).option(
                "partitionOverwriteMode", "dynamic"
            ).parquet(path)
    else:
        create_mart(source, path, [partition])
    _drop(spark, staged)


@contextmanager
def _files_of(spark: SparkSession, target_bytes: int) -> Iterator[None]:
    """Within, AQE merges and splits rebalanced rows to about ``target_bytes``, also where that leaves
    cores without a file."""
    saved = {k: spark.conf.get(k) for k in (SHUFFLE_SIZE, CORES_FIRST)}
    spark.conf.set(SHUFFLE_SIZE, str(target_bytes))
    spark.conf.set(CORES_FIRST, "false")
    try:
        yield
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)


def _rewrite(df: DataFrame, path: str, partition_by: list[str], target_bytes: int) -> None:
    """Write files of about ``target_bytes``."""
    with _files_of(df.sparkSession, target_bytes):
        _writer(df.hint("rebalance", *partition_by), "overwrite", partition_by).option("partitionOverwriteMode", "dynamic").parquet(path)


def compact(
    spark: SparkSession, path: str, partition_by: list[str], target_bytes: int = 256 << 20, closed: Column | None = None
) -> dict[str, int]:
    """Rewrite partitions of many small files into files of about ``target_bytes``.

    Only partitions that satisfy ``closed`` are touched, and of those only the ones with
    at least two files below half the target. Each is replaced as a whole when the writer
    commits (dynamic overwrite), so a run that fails leaves the table as it was and a
    repeated run finds the same rows. No other writer may add to a partition meanwhile:
    ``exclusive`` keeps writers apart, ``closed`` keeps the open partitions of one that appends out. A table without
    partitions is left alone.
    """
    table = spark.read.parquet(path)
    if not partition_by:
        return {"partitions": 0, "files_before": 0, "files_after": 0}
    if closed is not None:
        table = table.where(closed)
    m = F.col("_metadata")
    files = table.select(*partition_by, m["file_path"].alias("file"), m["file_size"].alias("bytes")).distinct()
    small = files.groupBy(*partition_by).agg(F.count("*").alias("files"), F.count_if(F.col("bytes") < target_bytes // 2).alias("small"))
    todo = small.where("small > 1").select(*partition_by, "files")
    staged = scratch_path(spark, "compacted")
    _writer(todo, "overwrite", []).parquet(staged)
    todo = spark.read.parquet(staged)
    partitions, before = todo.agg(F.count("*"), F.coalesce(F.sum("files"), F.lit(0))).first()
    after = 0
    if partitions:
        same = [table[c].eqNullSafe(todo[c]) for c in partition_by]
        rows = table.join(todo, reduce(and_, same), "left_semi")
        _rewrite(rows, path, partition_by, target_bytes)
        now = spark.read.parquet(path)
        same = [now[c].eqNullSafe(todo[c]) for c in partition_by]
        after = now.join(todo, reduce(and_, same), "left_semi").select(F.col("_metadata.file_path")).distinct().count()
    _drop(spark, staged)
    return {"partitions": partitions, "files_before": before, "files_after": after}


# -- tables fed by a stream: one directory per micro-batch --------------------
#
# Beside a table ``t`` lies ``t_closed`` with what no stream reads any more: ``open``, into which
# the following stream moves the files it has read, ``closing-x``, which is being compacted, and
# ``merged-x``, its result. Once ``merged-x`` is there, ``closing-x`` no longer counts.


def closed_dir(path: str) -> str:
    return f"{path.rstrip('/')}_closed"


def _children(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def _rename(spark: SparkSession, old: str, new: str) -> bool:
    fs, p = _fs(spark, old)
    target = spark._jvm.org.apache.hadoop.fs.Path(new)
    fs.mkdirs(target.getParent())
    return not fs.exists(target) and fs.rename(p, target)


def write_batch(rows: DataFrame, path: str, batch_id: int, few_files: bool = False) -> bool:
    """Publishes a micro-batch as a whole, once: it is written under a hidden name and then
    renamed. A batch that runs again after it was published adds nothing, so a stream
    that follows the table meets each row in one file only. Says whether it published."""
    final = f"{path}/batch_id={batch_id}"
    if exists(rows.sparkSession, final):
        return False
    staged = f"{path}/_staged-{batch_id}-{uuid.uuid4().hex}"
    with file_size(rows.sparkSession, few=few_files):
        _writer(rows, "overwrite", []).options(**ROW_GROUPS).parquet(staged)
    published = _rename(rows.sparkSession, staged, final)
    if not published:
        _drop(rows.sparkSession, staged)
    return published


def _parts(spark: SparkSession, path: str) -> list[str]:
    """Directories that make up a stream-fed table."""
    closed = closed_dir(path)
    names = _children(spark, closed)
    done = {n.removeprefix("merged-") for n in names if n.startswith("merged-")}
    kept = [n for n in names if n == "open" or n.startswith("merged-") or (n.startswith("closing-") and n.removeprefix("closing-") not in done)]
    return [path] * exists(spark, path) + [f"{closed}/{n}" for n in kept]


def read_fed(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """All rows of a stream-fed table, archived and compacted ones included; None if there are none."""
    parts = [p for p in _parts(spark, path) if any(not n.startswith(("_", ".")) for n in _children(spark, p))]
    if not parts:
        return None
    reader = spark.read.option("recursiveFileLookup", "true")
    return (reader.schema(schema) if schema else reader).parquet(*parts)


def committed_batches(spark: SparkSession, checkpoint: str) -> int:
    """Batches below this number are committed by their stream and never run again."""
    ids = [int(n) for n in _children(spark, f"{checkpoint}/commits") if n.isdigit()]
    return max(ids, default=0)


def close_batches(spark: SparkSession, path: str, below: int) -> int:
    """Moves the batches of a table that no stream follows to its closed files."""
    found = [n for n in _children(spark, path) if n.startswith("batch_id=") and int(n[9:]) < below]
    return sum(_rename(spark, f"{path}/{n}", f"{closed_dir(path)}/open/{n}") for n in found)


def compact_closed(spark: SparkSession, path: str, target_bytes: int = 256 << 20) -> dict[str, int]:
    """Rewrites the closed files of a stream-fed table into files of about ``target_bytes``.

    The set to rewrite is fixed by renaming ``open``, so files that a stream closes meanwhile
    wait for the next run. The result appears by one rename; a run that stopped before it
    is taken up again, and one that stopped behind it only deletes what it replaced.
    """
    closed = closed_dir(path)
    if any(not n.startswith(("_", ".")) for n in _children(spark, f"{closed}/open")):
        _rename(spark, f"{closed}/open", f"{closed}/closing-{uuid.uuid4().hex}")
    names = _children(spark, closed)
    report = {"files_before": 0, "files_after": 0}
    for name in [n for n in names if n.startswith("closing-")]:
        done = f"{closed}/merged-{name.removeprefix('closing-')}"
        if not exists(spark, done):
            rows = spark.read.option("recursiveFileLookup", "true").parquet(f"{closed}/{name}")
            staged = f"{closed}/_staged-{uuid.uuid4().hex}"
            _rewrite(rows, staged, [], target_bytes)
            report["files_before"] += rows.select(F.col("_metadata.file_path")).distinct().count()
            report["files_after"] += sum(n.endswith(".parquet") for n in _children(spark, staged))
            _rename(spark, staged, done)
        _drop(spark, f"{closed}/{name}")
    return report


TABLES_AT_ONCE = 4


def maintain(
    spark: SparkSession, tables: dict[str, list[str] | None], target_bytes: int = 256 << 20, followed: dict[str, str] | None = None
) -> dict[str, str]:
    """Compact several tables: path -> partition columns, None for a stream-fed one.

    Of a stream-fed table only closed files are rewritten: those that the stream behind it
    has read and moved away or, for a table that no stream follows, the batches that are
    committed by the checkpoint of the stream that writes it (``followed``: path -> checkpoint).
    One failure does not stop the rest. Files of the wanted size are few, so several tables are
    rewritten at once; the sizes of the session are set around all of them.
    """

    def one(table: tuple[str, list[str] | None]) -> tuple[str, str]:
        path, partition_by = table
        try:
            if partition_by is None:
                rows = read_fed(spark, path)
                if rows is None:
                    raise FileNotFoundError(path)
                if followed and path in followed:
                    close_batches(spark, path, committed_batches(spark, followed[path]))
                done = compact_closed(spark, path, target_bytes)
            else:
                done = compact(spark, path, partition_by, target_bytes)
            return path, "ok: " + ", ".join(f"{k} {v}" for k, v in done.items())
        except Exception as e:
            return path, f"failed: {e}"

    with _files_of(spark, target_bytes), ThreadPoolExecutor(TABLES_AT_ONCE) as pool:
        return dict(pool.map(one, tables.items()))


def file_layout(df: DataFrame) -> DataFrame:
    """Rows and bytes of every file behind a Parquet frame."""
    m = F.col("_metadata")
    return df.groupBy(m["file_name"].alias("file_name"), m["file_size"].alias("file_size_bytes")).agg(
        F.count("*").alias("record_count")
    )


def layout_summary(df: DataFrame) -> DataFrame:
    return file_layout(df).agg(
        F.count("*").alias("file_count"),
        F.sum("record_count").alias("total_records"),
        F.sum("file_size_bytes").alias("total_bytes"),
        (F.sum("file_size_bytes") / F.count("*")).alias("avg_file_bytes"),
    )


def storage_footprint(bronze: DataFrame) -> DataFrame:
    """Stored bytes against the bytes of the raw JSON text."""
    m = F.col("_metadata")
    per_file = bronze.groupBy(m["file_path"].alias("file"), m["file_size"].alias("bytes")).agg(
        F.count("*").alias("n"), F.sum(F.octet_length("raw_payload")).alias("json_bytes")
    )
    total = per_file.agg(F.sum("n").alias("rows"), F.sum("bytes").alias("parquet_bytes"), F.sum("json_bytes").alias("json_bytes"))
    return total.select(
        "*",
        F.try_divide(F.col("parquet_bytes").cast("double"), F.col("rows").cast("double")).alias("parquet_bytes_per_row"),
        (F.lit(1.0) - F.try_divide(F.col("parquet_bytes").cast("double"), F.col("json_bytes").cast("double"))).alias("reduction"),
    )


def offset_audit(bronze: DataFrame) -> DataFrame:
    """Messages missing between the lowest and highest offset of each partition."""
    g = bronze.groupBy("topic", "partition").agg(
        F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"), F.count("*").alias("received")
    )
    expected = F.col("last_offset") - F.col("first_offset") + 1
    return g.select(
        "*", expected.alias("expected"), (expected - F.col("received")).alias("missing"),
        ((expected - F.col("received")).cast("double") / expected.cast("double")).alias("loss_rate"),
    )


def offset_rate(earlier: DataFrame, later: DataFrame, seconds: int) -> DataFrame:
    """Messages per second by topic between two readings of a bronze table."""

    def total(df: DataFrame, name: str) -> DataFrame:
        ends = df.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("end"))
        return ends.groupBy("topic").agg(F.sum("end").alias(name), F.count("*").alias(f"{name}_partitions"))

    both = total(later, "later").join(total(earlier, "earlier"), "topic", "left")
    grown = F.col("later") - F.coalesce("earlier", F.lit(0))
    return both.select(
        "topic", F.col("later_partitions").alias("partitions"), F.col("later").alias("total_offsets"),
        F.greatest(F.lit(0.0), grown.cast("double") / F.lit(float(seconds))).alias("rows_per_second"),
    )
