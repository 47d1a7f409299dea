"""Data quality rules (Q1, Q2) and the run ledger (L1)."""

from __future__ import annotations

import re

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from burnup.functions.expr import lit_ts

# The two result states. The default project name of the rule table is ours.
STATUS_OK, STATUS_FAIL = "Success", "Fail"
DEFAULT_PROJECT = "effort"


def rule_result(spark: SparkSession, name: str, sql: str, expected: int) -> tuple[str | None, bool, str | None]:
    """One rule: (found text, passed, failure) of the first cell of ``sql`` in the rule's own order.

    Only that cell leaves the cluster. No rows count as 0; a NULL cell, a fraction or a
    text is compared as it is, so none of them passes for a whole number. A rule that
    can't run fails alone, with the reason.
    """
    try:
        df = spark.sql(sql)
        row = df.toDF(*[f"c{i}" for i in range(len(df.columns))]).select("c0").limit(1).first()
    except PySparkException as e:
        return None, False, f"check '{name}' could not run: {str(e).splitlines()[0]}"
    return judged(name, 0 if row is None else row["c0"], expected)


def judged(name: str, cell, expected: int) -> tuple[str | None, bool, str | None]:
    """(found text, passed, failure) of a rule's cell."""
    passed = not isinstance(cell, str) and cell == expected
    found = None if cell is None else str(cell)
    return found, passed, None if passed else f"check '{name}' failed: expected {expected}, found {found}"


#: A rule that counts the rows of one table, with or without a condition on them.
ONE_TABLE = re.compile(r"\s*SELECT\s+count\(\*\)\s+FROM\s+([\w.]+)(?:\s+(?:AS\s+)?(?!WHERE\b)(\w+))?(?:\s+WHERE\s+(.+?))?\s*;?\s*", re.I | re.S)
#: What a condition may not hold to be counted beside others: it would ask another table or change the rows.
NOT_SHARED = re.compile(r"\b(select|group|having|order|limit|union|except|intersect|join|over)\b|;|--|/\*", re.I)


def shared_rules(rules: list[tuple[str, str]]) -> dict[str, list[tuple[str, str, str]]]:
    """Table -> (name, alias, condition) of the (name, sql) rules that can be counted in one pass over it."""
    out: dict[str, list[tuple[str, str, str]]] = {}
    for name, sql in rules:
        m = ONE_TABLE.fullmatch(sql)
        if m and not NOT_SHARED.search(m[3] or ""):
            out.setdefault(m[1].lower(), []).append((name, m[2] or m[1].split(".")[-1], m[3] or "TRUE"))
    return out


def shared_counts(spark: SparkSession, rules: list[tuple[str, str]]) -> dict[str, int]:
    """Rule -> count, a job for each table: all its rules are sums of one aggregation. Rules
    that can't run together with the others are left out, to be run alone."""
    found: dict[str, int] = {}
    for table, own in shared_rules(rules).items():
        for alias in sorted({a for _, a, _ in own}):
            some = [(n, c) for n, a, c in own if a == alias]
            try:
                cells = spark.table(table).alias(alias).agg(*[F.count_if(F.expr(f"({c})")).alias(f"c{i}") for i, (_, c) in enumerate(some)]).first()
            except PySparkException:
                continue
            found.update({n: cells[i] for i, (n, _) in enumerate(some)})
    return found


def sanity_suite(spark: SparkSession, rules: DataFrame, as_of, task_id: int,
                 project: str = DEFAULT_PROJECT) -> DataFrame:
    """Q1 + Q2: run every rule of ``project`` and report Success / Fail with a message.

    ``rules`` has columns (query, name, expected_value, project_name). The rule table
    is small by nature (one row per hand-written check). Rules that count rows of one table
    share a pass over it, so they are a job a table; every other rule, and all rules of a table where one of them
    can't run, are a job each, so one rule's failure doesn't end the others. Jobs run when this is called.
    """
    todo = rules.where(F.col("project_name") == F.lit(project)) \
        .select("query", "name", "expected_value").orderBy("name").collect()
    # keyed by place: two rules may have one name
    counted = shared_counts(spark, [(str(i), r["query"]) for i, r in enumerate(todo)])
    out = []
    for i, r in enumerate(todo):
        expected = int(r["expected_value"])
        if (n := counted.get(str(i))) is not None:
            found, passed, message = judged(r["name"], n, expected)
        else:
            found, passed, message = rule_result(spark, r["name"], r["query"], expected)
        out.append((r["name"], expected, found, STATUS_OK if passed else STATUS_FAIL, message, task_id, project))
    cols = "condition string, expected_value bigint, actual_value string, status string, message string, " \
           "task_id bigint, project_name string"
    return spark.createDataFrame(out, cols).select(
        "condition", "expected_value", "actual_value", "status", "message", lit_ts(as_of).alias("created_date"),
        "task_id", "project_name")


def run_ledger_fold(events: DataFrame) -> DataFrame:
    """L1: append-only run events folded to one row per sub task, with its main task's state.

    ``events`` has (task_id, main_task_id, kind, ts, message) with kind in start / end /
    error for a sub task and main_start / main_end for a main task. A sub task's end may
    be written again: its last terminal event gives its end and status (an error at the
    same time wins). A main task's end is written once: its first terminal event - an
    error of any of its sub tasks, or its own end - decides, and later ones change
    nothing, so a run that failed stays failed. Both are in progress until then.
    """
    return join_ledger(sub_task_fold(events), main_task_fold(events))


def sub_task_fold(events: DataFrame) -> DataFrame:
    """A row per sub task; no aggregate depends on the order of its events."""
    kind, ts = F.col("kind"), F.col("ts")
    term = kind.isin("end", "error")
    failed = F.when(kind == "error", F.lit("FAILED")).otherwise(F.lit("SUCCESS"))
    return events.where(kind.isin("start", "end", "error")).groupBy("task_id", "main_task_id").agg(
        F.min(F.when(kind == "start", ts)).alias("start_date"),
        F.max(F.when(term, ts)).alias("end_date"),
        F.coalesce(F.max_by(failed, F.when(term, F.struct(ts, (kind == "error").alias("e")))),
                   F.lit("IN-PROGRESS")).alias("status"),
        F.count(F.when(kind == "error", F.lit(1))).alias("error_count"))


def main_task_fold(events: DataFrame) -> DataFrame:
    """A row per main task: its start, and its first terminal event."""
    kind, ts = F.col("kind"), F.col("ts")
    first_end = F.min(F.when(kind.isin("error", "main_end"), F.struct(ts.alias("ts"), (kind == "main_end").alias("ok"))))
    return events.groupBy("main_task_id").agg(
        F.min(F.when(kind == "main_start", ts)).alias("main_start_date"), first_end.alias("__end"))


def join_ledger(sub: DataFrame, main: DataFrame) -> DataFrame:
    main = main.select("main_task_id", "main_start_date", F.col("__end.ts").alias("main_end_date"),
                       F.when(F.col("__end").isNull(), F.lit("IN-PROGRESS")).when(F.col("__end.ok"), F.lit("SUCCESS"))
                       .otherwise(F.lit("FAILED")).alias("main_status"))
    return sub.join(main, "main_task_id").select(
        "task_id", "main_task_id", "start_date", "end_date", "status", "error_count",
        "main_start_date", "main_end_date", "main_status")
