"""Compare a registered query with its SQL on the same Parquet tables."""

from __future__ import annotations

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def _kind(value):
    return "num" if isinstance(value, (int, float)) and not isinstance(value, bool) else type(
        value).__name__


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    return value


def _sorted(rows):
    return sorted(([_cell(v) for v in r] for r in rows), key=lambda r: [
        (v is None, str(type(v)) if not isinstance(v, (int, float)) else "n", v) for v in
        (x if x is not None else 0 for x in r)])


def differences(df, con, sql) -> str | None:
    """None when both agree, else what differs first."""
    cols = sorted(df.columns)
    got = _sorted([tuple(r) for r in df.select(*cols).collect()])
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    if sorted(names) != cols:
        return f"columns {cols} against {sorted(names)}"
    order = [names.index(c) for c in cols]
    want = _sorted([[r[i] for i in order] for r in cur.fetchall()])
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"{dict(zip(cols, g))} against {dict(zip(cols, w))}"
        if [_kind(v) for v in g] != [_kind(v) for v in w]:
            return f"types {[type(v) for v in g]} against {[type(v) for v in w]}"
    return None
