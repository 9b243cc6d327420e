"""Run registered queries next to their DuckDB statements and compare the rows.

    python tests/compare.py [name ...]      (COMPARE_SF, default 0.01)
"""

from __future__ import annotations

import datetime
import math
import os
import sys
import time
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def normal(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else (0.0 if v == 0 else v)
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=lambda r: tuple((x is None, str(x)) for x in r))


def close(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)
    return a == b


def compare(df, con, sql: str) -> list[str]:
    """Differences between the Spark frame and the statement; empty if none."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    types = {d[0]: str(d[1]) for d in cur.description}
    want = canonical(cur.fetchall(), names)
    if sorted(names) != sorted(df.columns):
        return [f"columns differ: spark {sorted(df.columns)} sql {sorted(names)}"]
    notes = []
    for f in df.schema.fields:
        kind = KINDS.get(f.dataType.simpleString(), f.dataType.simpleString())
        if kind != types[f.name]:
            notes.append(f"type {f.name}: spark {kind} sql {types[f.name]}")
    got = canonical([tuple(r) for r in df.collect()], df.columns)
    if len(got) != len(want):
        notes.append(f"rows: spark {len(got)} sql {len(want)}")
    cols = sorted(names)
    bad, inexact = 0, 0
    for g, w in zip(got, want):
        if g != w:
            if all(close(x, y) for x, y in zip(g, w)):
                inexact += 1
                continue
            bad += 1
            if bad <= 3:
                notes.append("differs: " + "; ".join(f"{c}: {x!r} | {y!r}" for c, x, y in zip(cols, g, w) if not close(x, y)))
    if bad:
        notes.append(f"{bad} rows differ")
    if inexact:
        notes.append(f"{inexact} rows equal only within 1e-9")
    if not want:
        notes.append("note: empty result")
    return notes


def spark_session(cores: str = "8"):
    from pyspark.sql import SparkSession

    return (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def main() -> int:
    import __spark_entry__ as entry

    sf_dir = f"/root/testdata/sf{os.environ.get('COMPARE_SF', '0.01')}"
    spark = spark_session()
    spark.sparkContext.setLogLevel("ERROR")
    queries, oracle = entry.queries(), entry.oracle_sql()
    con, failed = duck(sf_dir), 0
    for name in sys.argv[1:] or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracle:
                notes = compare(df, con, oracle[name])
            else:
                notes = [f"note: rows only, {df.count()} rows"]
        except Exception as e:  # report and go on with the next query
            notes = [f"ERROR {type(e).__name__}: {str(e)[:1500]}"]
        problems = [n for n in notes if not n.startswith("note")]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - start:.1f}s {' / '.join(notes)}", flush=True)
    print(f"{failed} failing")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
