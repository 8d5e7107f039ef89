"""Compare a Spark result with DuckDB running the oracle SQL."""

from __future__ import annotations

import math

import duckdb

from panelkit.plans.tables import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{v:.9g}"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return str([norm(x) for x in v])
    return "None" if v is None else str(v)


def compare(sdf, con, sql: str) -> str | None:
    """None when equal (columns by name, rows as a multiset), else a message."""
    scols = sorted(sdf.columns)
    srows = sorted(tuple(norm(r[c]) for c in scols) for r in (x.asDict() for x in sdf.collect()))
    res = con.execute(sql)
    ocols = [d[0] for d in res.description]
    if sorted(ocols) != scols:
        return f"columns differ: {scols} vs {sorted(ocols)}"
    orows = sorted(tuple(norm(dict(zip(ocols, r))[c]) for c in scols) for r in res.fetchall())
    if srows != orows:
        extra = sorted(set(srows) - set(orows))[:3]
        missing = sorted(set(orows) - set(srows))[:3]
        return f"rows differ ({len(srows)} vs {len(orows)}): spark-only {extra} duck-only {missing}"
    return None
