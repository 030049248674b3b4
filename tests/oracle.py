"""Compare a Spark result with DuckDB's answer to the query's SQL."""

from __future__ import annotations

import datetime
import decimal
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _kind(t: str) -> str:
    t = t.lower()
    if t.startswith("decimal"):
        return "decimal"
    for kind, names in {
        "int": ("int", "bigint", "smallint", "integer", "hugeint", "tinyint", "ubigint"),
        "text": ("string", "varchar"),
        "float": ("double", "float"),
    }.items():
        if t in names:
            return kind
    return t


def _value(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_value(x) for x in v)
    return v


def compare(df, con, sql: str) -> list[str]:
    """Differences between the two results; empty when they agree."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    kinds = {d[0]: _kind(str(d[1])) for d in cur.description}
    rows = cur.fetchall()
    problems = []
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(set(df.columns) ^ set(names))}"]
    mine = {n: _kind(t) for n, t in df.dtypes}
    problems += [f"type of {n}: {mine[n]} / {kinds[n]}" for n in names if mine[n] != kinds[n]]
    order = sorted(names)
    here = Counter(tuple(_value(r[n]) for n in order) for r in df.collect())
    at = [names.index(n) for n in order]
    there = Counter(tuple(_value(r[i]) for i in at) for r in rows)
    if here != there:
        extra, lacking = here - there, there - here
        problems.append(f"rows {sum(here.values())} / {sum(there.values())}; columns {order}")
        problems += [f"  spark only: {r}" for r in list(extra)[:3]] + [f"  sql only:   {r}" for r in list(lacking)[:3]]
    return problems
