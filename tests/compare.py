"""Order-insensitive comparison of a Spark result with a DuckDB result.

Mirrors the correctness gate: same row count, same column names, and the
same multiset of rows after normalising values to text.
"""

from __future__ import annotations

import datetime as _dt
import decimal
import hashlib
import math

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f") if v == v.to_integral() else format(v.normalize(), "f")
    if isinstance(v, _dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, _dt.date):
        return v.isoformat()
    if isinstance(v, bool):
        return str(v).lower()
    return str(v)


def digest(rows: list[tuple], columns: list[str]) -> tuple[int, list[str], str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return len(lines), sorted(columns), hashlib.sha1("\n".join(lines).encode()).hexdigest()


def duckdb_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark_df, con, sql: str) -> dict:
    s_rows = [tuple(r) for r in spark_df.collect()]
    s = digest(s_rows, spark_df.columns)
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    d = digest(cur.fetchall(), cols)
    return {"rows": (s[0], d[0]), "columns_match": s[1] == d[1], "match": s == d,
            "spark_cols": s[1], "oracle_cols": d[1]}
