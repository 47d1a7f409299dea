"""Side-by-side check of a Spark query against its DuckDB oracle SQL.

Both results are normalised the same way: columns sorted by name, numbers rounded
to 6 decimals, dates and times as ISO text, rows compared as a multiset.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
from collections import Counter

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    try:
        import pandas as pd
        if v is pd.NaT or v is pd.NA:
            return None
        if isinstance(v, pd.Timestamp):
            v = v.to_pydatetime()
    except ImportError:  # pragma: no cover
        pass
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        v = v.item()
    if isinstance(v, bool):
        return v
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return None
        r = round(v, 6)
        return int(r) if r.is_integer() else r
    if isinstance(v, int):
        return v
    if isinstance(v, dt.datetime):
        if v.time() == dt.time(0):
            return v.date().isoformat()
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def rows_of(pdf) -> tuple[list[str], Counter]:
    cols = sorted(pdf.columns)
    out = Counter()
    for rec in pdf[cols].itertuples(index=False, name=None):
        out[tuple(_norm(v) for v in rec)] += 1
    return cols, out


SPARK_TYPES = {"LongType": "i64", "IntegerType": "i32", "ShortType": "i16", "ByteType": "i8", "DoubleType": "f64",
               "FloatType": "f32", "StringType": "str", "BooleanType": "bool", "DateType": "date",
               "TimestampNTZType": "ts", "TimestampType": "tstz"}
DUCK_TYPES = {"BIGINT": "i64", "INTEGER": "i32", "SMALLINT": "i16", "TINYINT": "i8", "DOUBLE": "f64", "FLOAT": "f32",
              "VARCHAR": "str", "BOOLEAN": "bool", "DATE": "date", "TIMESTAMP": "ts"}


def type_differences(spark_df, sql: str, con) -> dict:
    """Columns whose type category differs between the Spark result and the SQL twin."""
    sp = {f.name: SPARK_TYPES.get(type(f.dataType).__name__, str(f.dataType)) for f in spark_df.schema.fields}
    rel = con.sql(sql)
    du = {c: DUCK_TYPES.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
    return {c: (sp.get(c), du.get(c)) for c in set(sp) | set(du) if sp.get(c) != du.get(c)}


def compare(spark_df, sql: str, con) -> dict:
    types = type_differences(spark_df, sql, con)
    sp = spark_df.toPandas()
    ora = con.execute(sql).df()
    c1, r1 = rows_of(sp)
    c2, r2 = rows_of(ora)
    res = {"rows_spark": len(sp), "rows_oracle": len(ora), "cols_match": c1 == c2,
           "values_match": c1 == c2 and r1 == r2, "types_match": not types}
    if types:
        res["type_differences"] = types
    if not res["values_match"]:
        res["cols_spark"], res["cols_oracle"] = c1, c2
        res["only_spark"] = list((r1 - r2).items())[:5]
        res["only_oracle"] = list((r2 - r1).items())[:5]
    return res
