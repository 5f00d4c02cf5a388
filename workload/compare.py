"""Compare registered queries with their SQL twins in DuckDB: ``python -m workload.compare [names]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        if Path(f"{sf_dir}/{t}.parquet").exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    if hasattr(v, "normalize") and not isinstance(v, (int, str)):
        return round(float(v), 6)
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def oracle_rows(con, sql):
    cur = con.execute(sql)
    return rows_of([d[0] for d in cur.description], cur.fetchall())


def difference(df, con, sql) -> str | None:
    """None when equal, else a short description."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    if sorted(names) != sorted(df.columns):
        return f"columns differ: spark-only {set(df.columns) - set(names)}, sql-only {set(names) - set(df.columns)}"
    want = rows_of(names, cur.fetchall())
    got = spark_rows(df)
    if got == want:
        return None
    have, expected = set(got), set(want)
    only = [r for r in got if r not in expected][:3]
    other = [r for r in want if r not in have][:3]
    return f"rows {len(got)} vs {len(want)}\n  columns {sorted(names)}\n  spark {only}\n  sql   {other}"


def main() -> int:
    from millwright.session import local_session
    from workload.registry import ALL

    args = [a for a in sys.argv[1:] if not a.startswith("/")]
    sf_dir = next((a for a in sys.argv[1:] if a.startswith("/")), "/root/testdata/sf0.01")
    spark, con, bad = local_session(), connect(sf_dir), 0
    for name, (query, sql) in ALL.items():
        if args and name not in args:
            continue
        t = time.time()
        df = query(spark, sf_dir)
        msg = f"rows={df.count()} (no SQL)" if sql is None else difference(df, con, sql)
        ok = msg is None or sql is None
        bad += not ok
        print(f"{'ok ' if ok else 'BAD'} {name} {time.time() - t:.1f}s {msg or ''}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
