"""Side-by-side check of a registered query against its DuckDB oracle.

Mirrors the driver's gate: row count, schema (names and type families) and an
order-insensitive hash of the values with columns sorted by name.
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]

_SPARK_TO_DUCK = {
    "LongType": "BIGINT", "IntegerType": "INTEGER", "ShortType": "SMALLINT", "ByteType": "TINYINT",
    "DoubleType": "DOUBLE", "FloatType": "FLOAT", "StringType": "VARCHAR", "BooleanType": "BOOLEAN",
    "DateType": "DATE", "TimestampNTZType": "TIMESTAMP", "TimestampType": "TIMESTAMP WITH TIME ZONE",
    "BinaryType": "BLOB",
}


def spark_type_name(t) -> str:
    from pyspark.sql import types as T
    if isinstance(t, T.ArrayType):
        return spark_type_name(t.elementType) + "[]"
    if isinstance(t, T.StructType):
        return "STRUCT(" + ", ".join(f"{f.name} {spark_type_name(f.dataType)}" for f in t.fields) + ")"
    if isinstance(t, T.DecimalType):
        return f"DECIMAL({t.precision},{t.scale})"
    return _SPARK_TO_DUCK.get(type(t).__name__, type(t).__name__)


def duck_con(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}") if v != 0 else 0.0
    if isinstance(v, decimal.Decimal):
        return _norm(float(v))
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    return v


def rows_hash(cols: list[str], rows) -> tuple[int, str]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    keys = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    h = hashlib.sha256("\n".join(keys).encode()).hexdigest()
    return len(keys), h


def compare(spark, name: str, fn, sql: str | None, sf_dir: str, con=None) -> dict:
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_types = {f.name: spark_type_name(f.dataType) for f in df.schema.fields}
    s_rows = [tuple(r) for r in df.collect()]
    out = {"query": name, "spark_rows": len(s_rows)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    con = con or duck_con(sf_dir)
    cur = con.execute(sql)
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    d_types = {c[0]: str(c[1]) for c in cur.description}
    out["oracle_rows"] = len(d_rows)
    out["names_match"] = sorted(s_cols) == sorted(d_cols)
    out["types"] = {c: (s_types.get(c), d_types.get(c)) for c in sorted(set(s_cols) | set(d_cols))
                    if s_types.get(c) != d_types.get(c)}
    n1, h1 = rows_hash(s_cols, s_rows)
    n2, h2 = rows_hash(d_cols, d_rows)
    out["hash_match"] = h1 == h2
    out["status"] = "ok" if (out["names_match"] and not out["types"] and h1 == h2 and n1 == n2) else "FAIL"
    if h1 != h2:
        order_s = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
        order_d = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
        a = {repr(tuple(_norm(r[i]) for i in order_s)) for r in s_rows}
        b = {repr(tuple(_norm(r[i]) for i in order_d)) for r in d_rows}
        out["only_spark"] = sorted(a - b)[:3]
        out["only_oracle"] = sorted(b - a)[:3]
    return out
