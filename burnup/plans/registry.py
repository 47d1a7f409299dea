"""Named queries: each takes (spark, sf_dir) and returns a DataFrame; most have an
oracle twin in DuckDB SQL over the same parquet tables.

Output columns are flat and typed so both engines agree: ids as bigint, measures
summed as exact decimals and returned as double, dates as date, text as text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from burnup.plans.oracle_views import with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None, ctes: tuple = ()):
    """Register a Spark query under ``name`` and, when given, its oracle SQL."""
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_views(sql, *ctes)
        return fn
    return deco


def as_doubles(df: DataFrame) -> DataFrame:
    """Decimal measures leave as double (exact decimal sum, one final conversion)."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name)
                       if isinstance(f.dataType, DecimalType) else F.col(f.name)
                       for f in df.schema.fields])


def load_all() -> tuple[dict, dict]:
    """Import every module that registers queries; returns (queries, oracle SQL)."""
    from burnup.plans import (queries_effort, queries_entries, queries_landing,  # noqa: F401
                              queries_mapping, queries_more, queries_quality, queries_sprints)
    return QUERIES, ORACLE
