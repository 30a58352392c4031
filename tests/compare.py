"""Comparison of a Spark result with its SQL twin, shared by the tests and tools/oracle_check.py."""

from __future__ import annotations

import collections
import datetime as dt
import decimal
import math
import os

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
FAMILY = {"int": "int32", "integer": "int32", "bigint": "int64", "smallint": "int16", "tinyint": "int8",
          "double": "float64", "float": "float32", "string": "str", "varchar": "str", "date": "date", "boolean": "bool"}


def views(con, sf: str) -> None:
    for t in TABLES:
        path = os.path.join(sf, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"create view {t} as select * from read_parquet('{path}')")


def family(t: str) -> str:
    t = t.lower()
    if t.startswith("decimal"):
        return "decimal"
    return "ts" if t.startswith("timestamp") else FAMILY.get(t, t)


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, bytearray):
        return bytes(v)
    return v


def differences(sdf, rel) -> list[str]:
    """What differs between a Spark DataFrame and a DuckDB relation; empty if they agree."""
    scols, dcols = list(sdf.columns), list(rel.columns)
    if sorted(scols) != sorted(dcols):
        return [f"columns spark={scols} duck={dcols}"]
    order = sorted(scols)
    stypes = {f.name: family(f.dataType.simpleString()) for f in sdf.schema.fields}
    dtypes = {c: family(str(t)) for c, t in zip(rel.columns, rel.types)}
    out = [f"types {d}"] if (d := {c: (stypes[c], dtypes[c]) for c in order if stypes[c] != dtypes[c]}) else []
    si, di = [scols.index(c) for c in order], [dcols.index(c) for c in order]
    sc = collections.Counter(tuple(norm(r[i]) for i in si) for r in sdf.collect())
    dc = collections.Counter(tuple(norm(r[i]) for i in di) for r in rel.fetchall())
    if sum(sc.values()) != sum(dc.values()):
        out.append(f"rowcount spark={sum(sc.values())} duck={sum(dc.values())}")
    if sc != dc:
        out.append(f"values differ (cols {order}): {sum((sc - dc).values())} spark-only e.g. {list((sc - dc).elements())[:3]}; "
                   f"duck-only e.g. {list((dc - sc).elements())[:3]}")
    return out
