"""stream_compacted maintains its tables while the silver stream lags and again behind it."""

import threading

import pytest

from tidewater import session
from tidewater.plans import streams
from tidewater.plans.registry import all_queries
from tidewater.session import scratch_path


def rows(spark, path):
    found = streams.storage.read_fed(spark, path)
    return 0 if found is None else found.count()


def test_maintenance_runs_while_silver_lags_and_again_behind_it(spark, small, monkeypatch):
    seen, real = [], streams.storage.maintain

    def maintain(spark, tables, *args, **more):
        behind = {}
        for path in tables:
            base, _, table = path.rpartition("/")
            topic = table.split("_", 1)[1]
            behind[topic] = rows(spark, f"{base}/bronze_{topic}") - rows(spark, f"{base}/silver_{topic}") - rows(spark, f"{base}/dlq_{topic}")
        report = real(spark, tables, *args, **more)
        seen.append((behind, {path.rpartition("/")[2]: said for path, said in report.items()}))
        return report

    monkeypatch.setattr(streams.storage, "maintain", maintain)
    all_queries()["stream_compacted"](spark, small).collect()
    lagging = [(behind, report) for behind, report in seen if any(behind.values())]
    assert {t for behind, _ in lagging for t, n in behind.items() if n > 0} == set(streams.TOPICS)
    assert seen[-1][0] == dict.fromkeys(streams.TOPICS, 0) and len(seen[-1][1]) == 6
    for _, report in seen:  # small files become one of the wanted size, whatever the number of cores
        for said in report.values():
            assert said.startswith("ok") and int(said.split("files_before ")[1].split(",")[0]) > 1 and said.endswith("files_after 1"), seen


def test_a_table_that_maintenance_fails_on_is_an_error(spark, small, monkeypatch):
    def broken(*args):
        raise OSError("no space left")

    monkeypatch.setattr(streams.storage, "_rewrite", broken)
    with pytest.raises(RuntimeError, match="no space left"):
        all_queries()["stream_compacted"](spark, small)


def test_tables_are_rewritten_at_once_and_the_sizes_of_the_session_come_back(spark, monkeypatch):
    paths = [scratch_path(spark, "fed") for _ in range(3)]
    for path in paths:
        for i in range(3):
            streams.storage.write_batch(spark.range(i * 10, i * 10 + 10).repartition(2), path, i)
        streams.storage.close_batches(spark, path, 3)
    sizes = {k: spark.conf.get(k) for k in (session.SHUFFLE_SIZE, session.CORES_FIRST)}
    together, real = threading.Barrier(3, timeout=60), streams.storage._rewrite

    def rewrite(*args):
        together.wait()  # breaks unless all three are in here
        real(*args)

    monkeypatch.setattr(streams.storage, "_rewrite", rewrite)
    report = streams.storage.maintain(spark, dict.fromkeys(paths))
    assert all(said.startswith("ok") and said.endswith("files_after 1") for said in report.values()) and list(report) == paths, report
    assert {k: spark.conf.get(k) for k in sizes} == sizes
    assert [rows(spark, path) for path in paths] == [30] * 3
