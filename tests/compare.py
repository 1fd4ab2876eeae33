"""Spark rows against DuckDB rows, as multisets, with columns sorted by name."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime, timezone
from decimal import Decimal
from pathlib import Path

import duckdb


def plain(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, Decimal):
        return float(f"{float(v):.9g}")
    if isinstance(v, datetime):
        return (v.astimezone(timezone.utc).replace(tzinfo=None) if v.tzinfo else v).isoformat()
    if isinstance(v, date):
        return v.isoformat()
    if isinstance(v, dict):
        return tuple((k, plain(x)) for k, x in v.items())
    if hasattr(v, "asDict"):
        return tuple((k, plain(x)) for k, x in v.asDict().items())
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def oracle(folder: str):
    c = duckdb.connect()
    for p in sorted(Path(folder).glob("*.parquet")):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return c


def differences(df, sql: str, folder: str) -> str:
    """Empty if the rows are equal."""
    cur = oracle(folder).execute(sql)
    names = [d[0] for d in cur.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    order = sorted(names)
    theirs = Counter(tuple(plain(dict(zip(names, r, strict=True))[n]) for n in order) for r in cur.fetchall())
    ours = Counter(tuple(plain(r[n]) for n in order) for r in df.collect())
    if ours == theirs:
        return ""
    a, b = ours - theirs, theirs - ours
    return f"{sum(ours.values())} rows, {sum(theirs.values())} expected; only ours {sum(a.values())}: {list(a)[:3]}; only theirs {sum(b.values())}: {list(b)[:3]}"
