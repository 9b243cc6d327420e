"""Streams over larger tables give every core something to write."""

from tidewater.plans import streams
from tidewater.plans.registry import all_queries
from tidewater.sources.star import DerivedStar


def test_files_of_a_batch_follow_the_table_up_to_the_cores(spark, small, monkeypatch):
    star, cores = DerivedStar(spark, small), spark.sparkContext.defaultParallelism
    assert streams.files_a_batch(star) == 1
    monkeypatch.setattr(streams.storage, "stored_bytes", lambda *_: 1 << 40)
    assert streams.files_a_batch(star) == cores


def test_the_topic_has_a_file_for_every_core_and_the_same_rows(spark, small, monkeypatch):
    want = sorted(map(tuple, all_queries()["stream_compacted"](spark, small).collect()))
    given = []
    real = streams.publish
    monkeypatch.setattr(streams, "files_a_batch", lambda star: 3)
    monkeypatch.setattr(streams, "publish", lambda star, t, path, *a, **k: (real(star, t, path, *a, **k), given.append(len(spark.read.parquet(path).inputFiles()))))
    assert sorted(map(tuple, all_queries()["stream_compacted"](spark, small).collect())) == want
    assert given == [12, 24, 12, 24]
