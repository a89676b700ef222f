"""Compare a Spark result with a DuckDB result as bags of rows."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else (int(value) if value.is_integer() else round(value, 9))
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return value


def bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(plain(row[i]) for i in order) for row in rows)


def differences(frame, con, sql):
    """None when equal, else a description."""
    names, ours = bag(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = con.execute(sql)
    other_names, theirs = bag([d[0] for d in cursor.description], cursor.fetchall())
    if names != other_names:
        return f"columns {sorted(set(names) ^ set(other_names))}"
    if ours == theirs:
        return None
    extra, missing = list((ours - theirs).items())[:3], list((theirs - ours).items())[:3]
    detail = ""
    if extra and missing:
        a, b = extra[0][0], missing[0][0]
        detail = str([(n, x, y) for n, x, y in zip(names, a, b) if x != y])[:600]
    return (f"{sum(ours.values())} rows against {sum(theirs.values())}; {sum((ours - theirs).values())} only here, "
            f"{sum((theirs - ours).values())} only there; {detail} extra={extra[:1]} missing={missing[:1]}")[:3000]
