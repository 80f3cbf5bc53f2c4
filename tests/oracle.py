"""Run a query in Spark and its SQL in DuckDB and compare whole results."""

from __future__ import annotations

import math
import os
import time

import duckdb

VIEWS = ("region nation customer supplier part orders lineitem events documents embeddings "
         "pages benchmark labels conversations").split()

TYPES = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
    "date": "DATE", "boolean": "BOOLEAN", "float": "FLOAT", "timestamp_ntz": "TIMESTAMP",
}


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in VIEWS:
        path = f"{sf}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(out, key=repr)


def compare(spark, con, fn, sql: str, sf: str) -> dict:
    started = time.time()
    df = fn(spark, sf)
    rows = [tuple(r) for r in df.collect()]
    spent = time.time() - started
    rel = con.execute(sql)
    desc = rel.description
    theirs = rel.fetchall()
    a, b = _rows(df.columns, rows), _rows([d[0] for d in desc], theirs)
    ours_types = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())
                  for f in df.schema.fields}
    their_types = {d[0]: str(d[1]) for d in desc}
    return {
        "rows": (len(a), len(b)),
        "names": sorted(df.columns) == sorted(d[0] for d in desc),
        "types": {k: (v, their_types.get(k)) for k, v in ours_types.items()
                  if v != their_types.get(k)},
        "equal": a == b,
        "diff": [(x, y) for x, y in zip(a, b) if x != y][:3],
        "seconds": round(spent, 2),
    }
