"""Run registered queries against their SQL in DuckDB and report differences.

    python tools/check_oracle.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from recordloom.session import local_session  # noqa: E402
from recordloom.suite import QUERIES  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def normalise(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float):
        return f"{value:.9g}"
    if isinstance(value, bool):
        return str(value)
    return str(value)


def canonical_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple("\0" if (v := normalise(r[i])) is None else v for i in order) for r in rows)


def compare(spark_df, con, sql: str) -> str | None:
    got_columns = spark_df.columns
    got = canonical_rows(got_columns, [tuple(r) for r in spark_df.collect()])
    cursor = con.execute(sql)
    want_columns = [d[0] for d in cursor.description]
    want = canonical_rows(want_columns, cursor.fetchall())
    if sorted(got_columns) != sorted(want_columns):
        return f"columns differ: {sorted(got_columns)} / {sorted(want_columns)}"
    if got != want:
        missing = [r for r in want if r not in set(got)][:3]
        extra = [r for r in got if r not in set(want)][:3]
        return f"{len(got)} rows, expected {len(want)}; missing {missing}; extra {extra}"
    return None


def main() -> int:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = args or list(QUERIES)
    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failures = 0
    for name in names:
        q, start = QUERIES[name], time.time()
        try:
            if q.sql is None:
                problem, n = None, q.run(spark, sf_dir).count()
            else:
                problem, n = compare(q.run(spark, sf_dir), con, q.sql), None
        except Exception as e:  # report and go on with the next query
            problem, n = f"{type(e).__name__}: {str(e)[:700]}", None
        failures += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {problem or ('' if n is None else f'{n} rows, no sql')}", flush=True)
    print(f"{len(names) - failures}/{len(names)} match")
    return 1 if failures else 0


if __name__ == "__main__":
    sys.exit(main())
