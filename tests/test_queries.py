"""Every registered query against its DuckDB statement on the smallest tables."""

import pytest
from compare import compare

import __spark_entry__ as entry
import oracle
from tidewater.plans.registry import all_queries

QUERIES, STATEMENTS = all_queries(), oracle.statements()
ROWS_ONLY = sorted(set(QUERIES) - set(STATEMENTS))


def test_every_statement_has_a_query():
    assert set(STATEMENTS) <= set(QUERIES)


def test_rows_only_queries_are_the_known_ones():
    assert ROWS_ONLY == [
        "file_layout", "file_layout_summary", "storage_footprint", "stream_backpressure", "stream_metrics", "surrogate_keys",
    ]


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_matches_statement(name, spark, con, small):
    notes = compare(QUERIES[name](spark, small), con, STATEMENTS[name])
    assert [n for n in notes if not n.startswith("note")] == []


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_returns_rows(name, spark, small):
    assert QUERIES[name](spark, small).count() > 0


def test_entry_lists_every_query():
    assert set(QUERIES) <= set(entry.queries()) and set(STATEMENTS) <= set(entry.oracle_sql())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "event_date" and df.count() > 0
