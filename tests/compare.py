"""Row-by-row comparison of a query with its SQL counterpart."""

from __future__ import annotations

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _key(row):
    return tuple((v is not None, str(type(v)), v) if not isinstance(v, float) else (True, "float", repr(v)) for v in row)


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    cols = sorted(df.columns)
    got = [tuple(r) for r in df.select(*[f"`{c}`" for c in cols]).collect()]
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    raw = rel.fetchall()
    if sorted(names) != cols:
        return f"columns {cols} vs {sorted(names)}"
    at = [names.index(c) for c in cols]
    want = [tuple(r[i] for i in at) for r in raw]
    if len(got) != len(want):
        return f"{len(got)} rows vs {len(want)}; extra {list(set(got) - set(want))[:2]}, missing {list(set(want) - set(got))[:2]}"
    g, w = sorted(map(_key, got)), sorted(map(_key, want))
    if g == w:
        return None
    bad = [(a, b) for a, b in zip(g, w) if a != b]
    diff = [(c, x[-1], y[-1]) for c, x, y in zip(cols, *bad[0]) if x != y]
    return f"{len(bad)} of {len(g)} rows differ, first: {diff} in {[x[-1] for x in bad[0][0]]}"
