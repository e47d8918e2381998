"""Compare a Spark query with its DuckDB oracle (the driver's check, locally)."""

from __future__ import annotations

import math
import os

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v + 0.0  # exact, like the driver's value hash (only -0.0 -> 0.0)
    if hasattr(v, "isoformat"):
        try:
            return pd.Timestamp(v).isoformat()
        except Exception:
            return str(v)
    try:
        import numpy as np
        if isinstance(v, np.generic):
            return _norm(v.item())
    except Exception:
        pass
    return v


def rows_of(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(v) for v in rec))
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


# Spark simpleString -> DuckDB type name, for the schema part of the check.
SPARK_TO_DUCK = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE",
    "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT",
}


def schema_diff(spark_df, con, sql: str) -> list[str]:
    duck_types = {r[0]: r[1] for r in con.execute(f"describe ({sql})").fetchall()}
    out = []
    for f in spark_df.schema.fields:
        want = SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
        if duck_types.get(f.name) != want:
            out.append(f"{f.name}: spark {f.dataType.simpleString()} vs duck {duck_types.get(f.name)}")
    return out


def compare(spark_df, con, sql: str):
    """Return (ok, message)."""
    types = schema_diff(spark_df, con, sql)
    if types:
        return False, "types differ: " + "; ".join(types)
    s = spark_df.toPandas()
    d = con.execute(sql).fetchdf()
    if sorted(s.columns) != sorted(d.columns):
        return False, f"columns differ: spark={sorted(s.columns)} duck={sorted(d.columns)}"
    if len(s) != len(d):
        return False, f"row count spark={len(s)} duck={len(d)}"
    rs, rd = rows_of(s), rows_of(d)
    for i, (a, b) in enumerate(zip(rs, rd)):
        if a != b:
            return False, f"row {i} differs:\n spark={a}\n duck ={b}"
    return True, f"{len(s)} rows equal"
