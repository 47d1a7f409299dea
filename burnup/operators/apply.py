"""Table changes as pure DataFrame functions (section 2.9 of the survey).

Plain Parquet tables take no UPDATE/DELETE/MERGE, so each change is a function
``target -> new target`` and the caller writes a new version. One pattern covers
almost all of them: reduce the source to one row per key (so the result does not
depend on which of several source rows a database would pick), left join, then
``when(matched & guard, new).otherwise(old)``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_MATCH = "__matched"


def _cols(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def one_row_per_key(df: DataFrame, keys, order_by: Sequence[str | Column],
                    pick: str = "min") -> DataFrame:
    """Keep one row per key: the one with the smallest (or largest) ``order_by``.

    Done as an aggregate (``min_by``/``max_by`` of a struct), so a hot key is
    combined map-side instead of being sorted inside one task.
    """
    keys = _cols(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(keys)
    order = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order_by])
    chooser = F.min_by if pick == "min" else F.max_by
    picked = chooser(F.struct(*[F.col(c) for c in rest]), order).alias("__row")
    return df.groupBy(*keys).agg(picked).select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest])


def update_from(target: DataFrame, source: DataFrame, keys, assignments: Mapping[str, Column | str],
                guard: Column | None = None, source_keys=None) -> DataFrame:
    """``UPDATE target SET col = expr FROM source WHERE keys match AND guard``.

    ``source`` must hold at most one row per key (see :func:`one_row_per_key`);
    ``source_keys`` name its key columns when they differ from ``keys``.
    ``assignments`` maps target columns to a source column name or to a Column
    (for example a literal). ``guard`` is evaluated on the *old* target row.
    Unmatched rows keep their values.
    """
    keys = _cols(keys)
    source_keys = _cols(source_keys) if source_keys is not None else keys
    src_cols = [c for c in source.columns if c not in source_keys]
    src = source.select(
        *[F.col(sk).alias(f"__k{i}") for i, sk in enumerate(source_keys)],
        *[F.col(c).alias(f"src__{c}") for c in src_cols],
        F.lit(True).alias(_MATCH))
    cond = [target[k] == src[f"__k{i}"] for i, k in enumerate(keys)]
    joined = target.join(src, cond, "left")
    hit = F.coalesce(F.col(_MATCH), F.lit(False))
    if guard is not None:
        hit = hit & F.coalesce(guard, F.lit(False))
    new_values = {}
    for col, expr in assignments.items():
        value = F.col(f"src__{expr}") if isinstance(expr, str) else expr
        new_values[col] = F.when(hit, value).otherwise(F.col(col)).cast(target.schema[col].dataType)
    return joined.select(*[new_values[c].alias(c) if c in new_values else target[c] for c in target.columns])


def set_where(target: DataFrame, cond: Column, assignments: Mapping[str, Column]) -> DataFrame:
    """``UPDATE target SET ... WHERE cond`` without a source table."""
    hit = F.coalesce(cond, F.lit(False))
    return target.withColumns({
        c: F.when(hit, v).otherwise(F.col(c)).cast(target.schema[c].dataType)
        for c, v in assignments.items()})


def flag_matching(target: DataFrame, keys_df: DataFrame, keys, flag_col: str,
                  value: bool, guard: Column | None = None, key_cols=None) -> DataFrame:
    """Set ``flag_col = value`` where the target key occurs in ``keys_df`` (IN / EXISTS)."""
    keys = _cols(keys)
    key_cols = _cols(key_cols) if key_cols is not None else keys
    marks = keys_df.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(key_cols)]).distinct() \
        .withColumn(_MATCH, F.lit(True))
    cond = [target[k] == marks[f"__k{i}"] for i, k in enumerate(keys)]
    hit = F.coalesce(F.col(_MATCH), F.lit(False))
    if guard is not None:
        hit = hit & F.coalesce(guard, F.lit(False))
    joined = target.join(marks, cond, "left")
    return joined.select(*[F.when(hit, F.lit(value)).otherwise(target[c]).alias(c) if c == flag_col
                           else target[c] for c in target.columns])


def insert_if_absent(target: DataFrame, rows: DataFrame, keys) -> DataFrame:
    """``INSERT ... SELECT ... UNION SELECT ... WHERE NOT EXISTS (key in target)``.

    The candidate rows are de-duplicated first (UNION, not UNION ALL), then anti
    joined on the key, then appended. Applying it twice equals applying it once.
    """
    keys = _cols(keys)
    new = rows.distinct().join(target.select(*keys), keys, "left_anti")
    return target.unionByName(new, allowMissingColumns=True)


def delete_matching(target: DataFrame, keys_df: DataFrame, keys, key_cols=None) -> DataFrame:
    """``DELETE FROM target WHERE key IN (select ...)`` as an anti join."""
    keys = _cols(keys)
    key_cols = _cols(key_cols) if key_cols is not None else keys
    k = keys_df.select(*[F.col(c).alias(t) for c, t in zip(key_cols, keys)])
    return target.join(k, keys, "left_anti")
