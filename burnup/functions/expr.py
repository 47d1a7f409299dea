"""Column expressions shared by the operators (all JVM-side, codegen friendly)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

__all__ = [
    "flag_unset", "flag_set", "json_path", "json_text", "json_decimal", "json_timestamp",
    "last_path_segment", "pg_to_char", "id_list_to_array", "weekdays_between",
    "holidays_between", "working_days_between", "holiday_array", "null_token",
    "round_to_bigint", "contains_ci", "like_any_ci", "squeeze_lower", "lit_ts",
    "lit_date", "register_sql_functions", "POINTS_TYPE", "HOURS_TYPE",
]

# Story points and hours are exact decimals; sums never go through doubles.
POINTS_TYPE = "decimal(30,6)"
HOURS_TYPE = "decimal(18,2)"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lit_ts(value) -> Column:
    """A timestamp literal without zone (the warehouse times carry none). Built from text,
    so neither the Python process zone nor the session zone can shift it."""
    if isinstance(value, (_dt.datetime, _dt.date)):
        value = value.isoformat(sep=" ") if isinstance(value, _dt.datetime) else value.isoformat()
    return F.lit(value).cast("timestamp_ntz")


def lit_date(value) -> Column:
    if isinstance(value, _dt.datetime):
        value = value.date()
    if isinstance(value, _dt.date):
        value = value.isoformat()
    return F.lit(value).cast("date")


# a three-valued flag where NULL means "not yet". Written as IS NULL OR = false
# because that form is pushed into the Parquet scan; coalesce(flag, false) is not.
def flag_unset(c) -> Column:
    c = _c(c)
    return c.isNull() | (c == F.lit(False))


def flag_set(c) -> Column:
    """coalesce(flag, false) = true; NULL compares to NULL and drops out of a filter."""
    return F.coalesce(_c(c) == F.lit(True), F.lit(False))


# One JSON path into a text document.
def json_path(*keys: str) -> str:
    return "$." + ".".join(keys)


def json_text(c, *keys: str) -> Column:
    """``doc -> 'a' ->> 'b'``: text of the field, NULL for JSON null, missing or malformed."""
    return F.get_json_object(_c(c), json_path(*keys))


def json_decimal(c, *keys: str, dtype: str = POINTS_TYPE) -> Column:
    return json_text(c, *keys).try_cast(dtype)


def json_timestamp(c, *keys: str) -> Column:
    """Text cast to a zone-less timestamp; a zone suffix in the text is ignored the
    way a cast to ``timestamp`` without zone ignores it."""
    return json_text(c, *keys).try_cast("timestamp_ntz")


# Last segment of a path, trimmed (``trim(reverse(split_part(reverse(s),'/',1)))``).
def last_path_segment(c) -> Column:
    return F.trim(F.substring_index(_c(c), "/", -1))


# to_char formats used by the pipeline, as Spark datetime patterns.
# The two text layouts the service expects.
_PG_FORMATS = {"YYYY/MM/DD": "yyyy/MM/dd", "YYYYMMDD": "yyyyMMdd", "YYYY-MM-DD": "yyyy-MM-dd"}


def pg_to_char(c, pg_format: str) -> Column:
    return F.date_format(_c(c), _PG_FORMATS[pg_format])


# E12: '2448, 2506' -> array<bigint>
def id_list_to_array(c) -> Column:
    return F.transform(F.split(_c(c), ","), lambda x: F.trim(x).cast("bigint"))


# Monday-to-Friday days in [a, b], both ends included; 0 when a > b; O(1) per row.
def weekdays_between(a, b) -> Column:
    a, b = F.to_date(_c(a)), F.to_date(_c(b))
    n = F.datediff(b, a) + 1
    full = F.floor(n / 7).cast("int")
    rem = (n % 7).cast("int")
    d0 = F.weekday(a)  # 0 = Monday ... 6 = Sunday
    head = F.greatest(F.lit(0), F.least(d0 + rem - 1, F.lit(4)) - d0 + 1)
    tail = F.greatest(F.lit(0), d0 + rem - 7)
    return F.when(n <= 0, F.lit(0)).otherwise(full * 5 + head + tail).cast("int")


def holiday_array(holidays: DataFrame, date_col: str = "holiday_date",
                  mandatory_col: str | None = "is_mandatory_holiday") -> Column:
    """Mandatory holiday dates as one array, evaluated once as a scalar subquery.

    A holiday calendar has at most one row per day, so the array is bounded by the
    calendar span; it is broadcast as a value instead of joining every row.
    """
    h = holidays
    if mandatory_col:
        h = h.where(F.col(mandatory_col) == F.lit(True))
    return h.select(F.array_sort(F.collect_set(F.to_date(date_col)))).scalar()


# E16 helper: mandatory holidays on weekdays inside [a, b].
def holidays_between(a, b, holidays: Column) -> Column:
    a, b = F.to_date(_c(a)), F.to_date(_c(b))
    return F.size(F.filter(holidays, lambda h: (h >= a) & (h <= b) & (F.weekday(h) < 5)))


def working_days_between(a, b, holidays: Column) -> Column:
    """E15 minus mandatory weekday holidays in the range (NULL in, NULL out)."""
    wd = weekdays_between(a, b)
    return F.when(wd.isNull(), F.lit(None)).otherwise(
        F.greatest(F.lit(0), wd - holidays_between(a, b, holidays))).cast("int")


# The text 'None' and the empty text both load as NULL.
def null_token(c) -> Column:
    c = _c(c)
    return F.when(c.isin("None", ""), F.lit(None).cast("string")).otherwise(c)


# Text that is safe inside quoted literals: no quotes of either kind, backslashes doubled.
def without_quotes(c) -> Column:
    return F.replace(F.translate(_c(c), "'\"", ""), F.lit("\\"), F.lit("\\\\"))


# Numeric -> bigint rounds in the warehouse; Spark's cast would truncate.
def round_to_bigint(c) -> Column:
    return F.round(_c(c)).cast("bigint")


# substring tests, case-insensitive; NULL input gives false like CASE ... ELSE false.
def contains_ci(c, needle: str) -> Column:
    return F.coalesce(F.lower(_c(c)).contains(needle.lower()), F.lit(False))


def like_any_ci(c, needles: list[str]) -> Column:
    out = F.lit(False)
    for n in needles:
        out = out | contains_ci(c, n)
    return out


def squeeze_lower(c, blank_as: str = "") -> Column:
    """lower(replace(trim(s), ' ', blank_as))"""
    return F.lower(F.replace(F.trim(_c(c)), F.lit(" "), F.lit(blank_as)))


def register_sql_functions(spark: SparkSession, holidays_view: str | None = None) -> None:
    """V3: the two working-day functions as SQL functions for ``spark.sql`` users."""
    n, first = "(datediff(b, a) + 1)", "weekday(a)"
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION weekdays_sql(a DATE, b DATE) RETURNS INT "
        f"RETURN CASE WHEN {n} <= 0 THEN 0 ELSE CAST({n} DIV 7 * 5 "
        f"+ greatest(0, least({first} + {n} % 7 - 1, 4) - {first} + 1) + greatest(0, {first} + {n} % 7 - 7) AS INT) END")
    if holidays_view:
        # the calendar as one array (a row per day at most), so no join with it
        spark.sql(
            "CREATE OR REPLACE TEMPORARY FUNCTION weekdays_holiday_sql(a DATE, b DATE) RETURNS INT "
            "RETURN CASE WHEN a > b THEN 0 ELSE weekdays_sql(a, b) - size(array_intersect(sequence(a, b), "
            f"(SELECT collect_set(to_date(holiday_date)) FROM {holidays_view} WHERE is_mandatory_holiday = true "
            "AND weekday(to_date(holiday_date)) < 5))) END")
