"""Registered quality and ledger queries (Q1, Q2, L1)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from burnup.operators import quality as qa
from burnup.plans import domain as d
from burnup.plans.registry import ORACLE, query
from burnup.session import scratch_path
from burnup.streaming.ledger import read_ledger, start_ledger_stream

# The rule table of the scenario (fixed values): name, query, expected first cell.
RULES = [
    ("sprints without team", "SELECT count(*) FROM sprint_summary s WHERE NOT EXISTS "
     "(SELECT 1 FROM team_dim t WHERE t.team_dim_id = s.team_dim_id)", 0),
    ("members without resource", "SELECT count(*) FROM user_team_map u WHERE NOT EXISTS "
     "(SELECT 1 FROM resource_dim r WHERE r.resource_dim_id = u.user_dim_id)", 0),
    ("issues outside any sprint", "SELECT count(*) FROM sprint_issues i WHERE NOT EXISTS "
     "(SELECT 1 FROM sprint_summary s WHERE s.sprint_number = i.sprint_number AND s.team_dim_id = i.team_dim_id)", 0),
    ("entries without date key", "SELECT count(*) FROM timesheet_entries e WHERE NOT EXISTS "
     "(SELECT 1 FROM date_dimension x WHERE x.dt = e.entrydate)", 0),
    ("entries with negative hours", "SELECT count(*) FROM timesheet_entries WHERE entryhours < 0", 0),
    ("resources without type", "SELECT count(*) FROM resource_dim WHERE type IS NULL", 0),
    ("reportable teams", "SELECT count(*) FROM team_dim WHERE is_reportable = TRUE", 16),
    ("no rows at all", "SELECT team_dim_id FROM team_dim WHERE team_dim_id < 0", 0),
]
TASK_ID = 1


def _sanity_sql() -> str:
    """Every rule as one row with its first cell, or 0 for no rows."""
    found = " UNION ALL ".join(
        f"SELECT '{name}' AS condition, {exp}::BIGINT AS expected_value, "
        f"(SELECT CASE WHEN count(*) = 0 THEN 0 ELSE first(cell) END FROM (SELECT * FROM ({sql}) LIMIT 1) q(cell)) AS cell"
        for name, sql, exp in RULES)
    return f"""
WITH found AS ({found})
SELECT condition, expected_value, CAST(cell AS VARCHAR) AS actual_value,
       if(cell IS NOT DISTINCT FROM expected_value, 'Success', 'Fail') AS status,
       if(cell IS DISTINCT FROM expected_value,
          printf('check ''%s'' failed: expected %d, found %d', condition, expected_value, cell), NULL) AS message,
       TIMESTAMP '2024-01-24 12:00:00' AS created_date, CAST({TASK_ID} AS BIGINT) AS task_id, 'effort' AS project_name
FROM found"""


@query("sanity_suite", _sanity_sql())
def sanity_suite(spark, sf_dir):
    t = d.Tables(spark, sf_dir)
    views = {"sprint_summary": d.sprint_summary(t), "team_dim": d.team_dim(t), "user_team_map": d.user_team_map(t),
             "resource_dim": d.resource_dim(t), "sprint_issues": d.sprint_issues(t),
             "timesheet_entries": d.timesheet_entries(t), "date_dimension": d.date_dimension(t)}
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    rules = spark.createDataFrame([(sql, name, exp, "effort") for name, sql, exp in RULES],
                                  "query string, name string, expected_value bigint, project_name string")
    return qa.sanity_suite(spark, rules, d.AS_OF, TASK_ID)


# Scenario: what each event type says about a run (fixed values).
EVENT_KINDS = {"signup": "main_start", "view": "start", "click": "end", "error": "error", "purchase": "main_end"}


def run_events(t: d.Tables):
    """Run events of the scenario: user = sub task, user mod 10 = main task; every event counts."""
    kind = F.col("event_type")
    for name, meaning in EVENT_KINDS.items():
        kind = F.when(F.col("event_type") == name, F.lit(meaning)).otherwise(kind)
    return t.events.select(F.col("user_id").alias("task_id"), (F.col("user_id") % 10).alias("main_task_id"),
                           kind.alias("kind"), "ts", F.col("props").alias("message"))


@query("run_ledger_fold", """
WITH ev AS (
  SELECT user_id, user_id % 10 AS run, event_type AS what, ts FROM events),
final AS (
  SELECT DISTINCT ON (user_id) user_id, ts, what FROM ev WHERE what IN ('click', 'error')
  ORDER BY user_id, ts DESC, what = 'error' DESC),
stop AS (
  SELECT DISTINCT ON (run) run, ts, what FROM ev WHERE what IN ('error', 'purchase')
  ORDER BY run, ts, what = 'purchase'),
seen AS (SELECT run, min(ts) AS ts FROM ev WHERE what = 'signup' GROUP BY run)
SELECT e.user_id AS task_id, e.run AS main_task_id, min(e.ts) FILTER (e.what = 'view') AS start_date,
       any_value(f.ts) AS end_date,
       coalesce(any_value(if(f.what = 'error', 'FAILED', 'SUCCESS')) FILTER (f.what IS NOT NULL), 'IN-PROGRESS') AS status,
       count(*) FILTER (e.what = 'error') AS error_count,
       any_value(n.ts) AS main_start_date, any_value(s.ts) AS main_end_date,
       coalesce(any_value(if(s.what = 'error', 'FAILED', 'SUCCESS')) FILTER (s.what IS NOT NULL), 'IN-PROGRESS') AS main_status
FROM ev e LEFT JOIN final f ON f.user_id = e.user_id LEFT JOIN stop s ON s.run = e.run LEFT JOIN seen n ON n.run = e.run
WHERE e.what IN ('view', 'click', 'error')
GROUP BY e.user_id, e.run""")
def run_ledger_fold(spark, sf_dir):
    return qa.run_ledger_fold(run_events(d.Tables(spark, sf_dir)))


@query("run_ledger_stream", ORACLE["run_ledger_fold"])
def run_ledger_stream(spark, sf_dir):
    """L1 as a running fold over files in which the events lie in no order of time."""
    base = scratch_path(spark, f"ledger-{uuid.uuid4().hex}")
    events = run_events(d.Tables(spark, sf_dir)).select("task_id", "main_task_id", "kind", "ts", "message")
    events.repartition(3, F.xxhash64("ts")).write.parquet(f"{base}/events")
    for q in start_ledger_stream(spark, f"{base}/events", events.schema, f"{base}/ledger", files_per_batch=1):
        q.awaitTermination()
    return read_ledger(spark, f"{base}/ledger")
