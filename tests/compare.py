"""Compare a Spark result with DuckDB on the same parquet files."""

from __future__ import annotations

import datetime as dt
import glob
import math
import os
from collections import Counter
from decimal import Decimal

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, Decimal):
        v = float(v) if v % 1 else int(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return 0.0 if v == 0 else v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, dict):
        return tuple(sorted((k, plain(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return plain(v.asDict())
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


KINDS = {"integer": "int", "bigint": "int", "long": "int", "int": "int", "hugeint": "int", "double": "float",
         "float": "float", "varchar": "string", "string": "string", "date": "date", "timestamp": "timestamp",
         "timestamp_ntz": "timestamp", "boolean": "bool"}


def differences(df, con, sql: str) -> list[str]:
    """Empty when names, kinds of types, and the multiset of rows agree."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    kinds = [KINDS.get(str(d[1]).lower(), str(d[1]).lower()) for d in cur.description]
    want_rows = cur.fetchall()
    cols = sorted(names)
    if sorted(df.columns) != cols:
        return [f"columns {sorted(df.columns)} != {cols}"]
    out = []
    spark_kinds = {f.name: KINDS.get(f.dataType.typeName(), f.dataType.typeName()) for f in df.schema}
    for n, k in zip(names, kinds):
        if spark_kinds[n] != k:
            out.append(f"type of {n}: {spark_kinds[n]} != {k}")
    at = [names.index(c) for c in cols]
    want = Counter(tuple(plain(row[i]) for i in at) for row in want_rows)
    got = Counter(tuple(plain(row[c]) for c in cols) for row in df.collect())
    if got != want:
        more, less = list((got - want).items()), list((want - got).items())
        out.append(f"rows {sum(got.values())} vs {sum(want.values())}; {len(more)} only in Spark, e.g. "
                   f"{sorted(map(str, more))[:2]}; {len(less)} only in SQL, e.g. {sorted(map(str, less))[:2]}")
    if not want:
        out.append("the check has no rows")
    return out
