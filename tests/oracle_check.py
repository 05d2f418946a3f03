"""Run registered queries and their SQL oracles side by side and compare the rows.

    python tests/oracle_check.py [folder of the tables] [name prefix ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from __spark_entry__ import oracle_sql, queries  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, (float, decimal.Decimal)):
        return "nan" if math.isnan(v) else round(float(v), 6)
    if isinstance(v, int):
        return float(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return str(v)


def normalized(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, sf_dir: str, name: str) -> str | None:
    """None if both sides agree, else what differs."""
    df = queries()[name](spark, sf_dir)
    mine = normalized(df.columns, df.collect())
    sql = oracle_sql().get(name)
    if sql is None:
        return None
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    theirs = normalized(cols, cur.fetchall())
    if sorted(df.columns) != sorted(cols):
        return f"columns {sorted(df.columns)} against {sorted(cols)}"
    if len(mine) != len(theirs):
        return f"{len(mine)} rows against {len(theirs)}"
    for a, b in zip(mine, theirs):
        if a != b:
            return f"{a} against {b}"
    return None if mine else "no rows"


def main() -> int:
    from crawldelta.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:]) or ("",)
    spark = local_session(8, 8)
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in queries():
        if not name.startswith(prefixes):
            continue
        t = time.time()
        try:
            problem = compare(spark, con, sf_dir, name)
        except Exception as e:  # shown per query, so that the others still run
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {time.time() - t:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{bad} of {len(queries())} differ")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
