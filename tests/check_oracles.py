"""Run queries against their SQL counterparts: `python tests/check_oracles.py SF_DIR [name ...]`."""

from __future__ import annotations

import math
import sys
import time
from datetime import date, datetime
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def _plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, date):
        return v.isoformat()
    if isinstance(v, (bool, int, str)):
        return v
    return float(v)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, sf_dir: str, query, sql: str) -> str | None:
    """None where both give the same rows, else what differs."""
    df = query(spark, sf_dir)
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    ours, theirs = rows_of(df.columns, df.collect()), rows_of(names, res.fetchall())
    if not theirs:
        return "no rows"
    if ours != theirs:
        only, other = set(ours) - set(theirs), set(theirs) - set(ours)
        return (
            f"{len(ours)} / {len(theirs)} rows; {len(only)} ours only {sorted(only, key=repr)[:3]}; "
            f"{len(other)} SQL only {sorted(other, key=repr)[:3]}"
        )
    return None


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from tidebar.session import build_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = build_session(
        master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("OFF")
    con, failed, sqls = connect(sf_dir), 0, oracle_sql()
    for name, query in queries().items():
        if name not in sqls or names and name not in names:
            continue
        began = time.time()
        try:
            problem = compare(spark, con, sf_dir, query, sqls[name])
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        failed += problem is not None
        print(f"{name}: {'ok' if problem is None else problem} ({time.time() - began:.1f}s)")
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main())
