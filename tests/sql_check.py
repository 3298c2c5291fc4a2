"""Compare queries with their SQL: ``python tests/sql_check.py SF_DIR [name ...]``."""

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def canonical(frame: pd.DataFrame) -> list:
    frame = frame[sorted(frame.columns)].astype(object)
    rows = frame.where(frame.notna(), None).values.tolist()
    return sorted(
        (tuple(round(float(v), 6) if isinstance(v, (int, float)) else v for v in row) for row in rows), key=repr
    )


def compare(spark, sf_dir: str, name: str) -> str | None:
    """None when equal, else what differs."""
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    expected = con.execute(entry.oracle_sql()[name]).df()
    got = entry.queries()[name](spark, sf_dir).toPandas()
    if sorted(got.columns) != sorted(expected.columns):
        return f"columns {sorted(got.columns)} != {sorted(expected.columns)}"
    left, right = canonical(got), canonical(expected)
    if left == right:
        return None
    extra, lost = [r for r in left if r not in set(right)][:3], [r for r in right if r not in set(left)][:3]
    return f"{len(left)} rows, {len(right)} expected; extra {extra}; missing {lost}"


if __name__ == "__main__":
    from rosterlink.session import local_session

    session = local_session(8)
    session.sparkContext.setLogLevel("ERROR")
    for key in sys.argv[2:] or list(entry.oracle_sql()):
        start = time.time()
        try:
            outcome = compare(session, sys.argv[1], key)
        except Exception as error:
            outcome = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"CHECK {key:24s} {time.time() - start:6.1f}s {outcome or 'equal'}", flush=True)
