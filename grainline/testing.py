"""Compare a Spark result with a DuckDB oracle statement (tests and tools only)."""

from __future__ import annotations

import datetime as _dt
import decimal
import math

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir.rstrip('/')}/{t}.parquet')")
    return con


def _canon(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (_dt.datetime, _dt.date)):
        return v.isoformat()
    if hasattr(v, "item"):          # numpy scalar
        return _canon(v.item())
    return v


def rows_of_spark(df):
    cols = sorted(df.columns)
    return cols, [tuple(_canon(r[c]) for c in cols) for r in df.select(*cols).collect()]


def rows_of_duck(con, text):
    rel = con.sql(text)
    cols = list(rel.columns)
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], [tuple(_canon(r[i]) for i in order) for r in rel.fetchall()]


def _key(row):
    return tuple((x is None, str(type(x).__name__), str(x)) for x in row)


def compare(df, con, text) -> tuple[bool, str]:
    s_cols, s_rows = rows_of_spark(df)
    d_cols, d_rows = rows_of_duck(con, text)
    if s_cols != d_cols:
        return False, f"columns differ: spark={s_cols} duck={d_cols}"
    if len(s_rows) != len(d_rows):
        return False, f"row counts differ: spark={len(s_rows)} duck={len(d_rows)}"
    a, b = sorted(s_rows, key=_key), sorted(d_rows, key=_key)
    for x, y in zip(a, b):
        if x != y:
            return False, f"first differing row: spark={x} duck={y}"
    return True, f"{len(s_rows)} rows equal"


def duck_types(con, text) -> dict[str, str]:
    rel = con.sql(text)
    return dict(zip(rel.columns, [str(t) for t in rel.types]))
