"""Run a registered query and its oracle text side by side."""

from __future__ import annotations

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return v + 0.0
    if hasattr(v, "asDict"):
        return tuple(sorted((k, _plain(x)) for k, x in v.asDict().items()))
    return v


def _sortable(row):
    return tuple((x is None, str(type(x).__name__) if not isinstance(x, (int, float)) else "num", x if not isinstance(x, (type(None),)) else 0) for x in row)


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted((tuple(_plain(r[n]) for n in names) for r in df.collect()), key=_sortable)


def duck_rows(con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = sorted((tuple(_plain(r[i]) for i in order) for r in cur.fetchall()), key=_sortable)
    return [names[i] for i in order], rows, {names[i]: str(cur.description[i][1]) for i in range(len(names))}


def compare(df, con, sql):
    """None when equal, else a short text."""
    n1, r1 = spark_rows(df)
    n2, r2, types = duck_rows(con, sql)
    if n1 != n2:
        return f"columns {n1} vs {n2}"
    wide = [n for n, t in types.items() if "HUGEINT" in t or "DECIMAL" in t or "INT128" in t]
    if wide:
        return f"oracle column types to cast: {wide}"
    if len(r1) != len(r2):
        return f"rows {len(r1)} vs {len(r2)}; first {r1[:2]} vs {r2[:2]}"
    bad = [(a, b) for a, b in zip(r1, r2) if a != b]
    if bad:
        return f"{len(bad)} of {len(r1)} rows differ, first {bad[0]}"
    if not r1:
        return "both empty"
    return None
