"""Registered sprint-metric queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from burnup.functions.expr import holiday_array
from burnup.operators import sprints as sp
from burnup.plans import domain as d
from burnup.plans.registry import as_doubles, query

PENDING = "coalesce(is_metrics_updated, FALSE) = FALSE"
POINTS = "TRY_CAST(json_extract_string(ticket_details, '$.fields.customfield_10411') AS DECIMAL(30,6))"
AS_OF = "TIMESTAMP '2024-01-24 12:00:00'"

# The rules of SURVEY 2 stated over two small views: the sprints still open, and an issue's facts.
OPEN_CTE = ("open_sprint", f"""
SELECT sprint_number, team_dim_id, sprint_start_date AS begins, sprint_complete_date AS ends
FROM sprint_summary WHERE {PENDING}""")
ISSUE_CTE = ("issue_fact", f"""
SELECT sprint_number, team_dim_id, {POINTS} AS pts, doc_done IS NOT NULL AS has_done,
       coalesce(TRY_CAST(doc_done AS TIMESTAMP), {AS_OF}) AS done_at,
       status_on_sprint_closure IS NOT NULL AND status_on_sprint_closure <> 'Open' AS left_open_state
FROM (SELECT *, json_extract_string(ticket_details, '$.fields.resolutiondate') AS doc_done FROM sprint_issues)
WHERE is_active""")
SCORED_CTE = ("scored", """
SELECT f.sprint_number, f.team_dim_id, f.pts, f.has_done AND f.done_at BETWEEN o.begins AND o.ends AS within,
       f.left_open_state AND f.done_at >= o.begins AS finished
FROM open_sprint o JOIN issue_fact f USING (sprint_number, team_dim_id)""")
BASE = (OPEN_CTE, ISSUE_CTE, SCORED_CTE)


def _t(spark, sf_dir):
    return d.Tables(spark, sf_dir)


@query("pending_sprints", "SELECT sprint_number, team_dim_id FROM open_sprint GROUP BY ALL", ctes=(OPEN_CTE,))
def pending_sprints(spark, sf_dir):
    return sp.pending_sprints(d.sprint_summary(_t(spark, sf_dir)))


# A1 counts an issue when its sprint's number is open, whatever the team.
EST_CTE = ("est", """
SELECT sprint_number, team_dim_id, sum(pts) AS points
FROM issue_fact SEMI JOIN open_sprint USING (sprint_number) GROUP BY ALL""")


@query("sprint_estimated_points", "SELECT sprint_number, team_dim_id, points::DOUBLE AS estimated_points FROM est",
       ctes=(OPEN_CTE, ISSUE_CTE, EST_CTE))
def sprint_estimated_points(spark, sf_dir):
    t = _t(spark, sf_dir)
    return as_doubles(sp.estimated_points(d.sprint_issues(t), d.sprint_summary(t)))


def _points_where(flag: str) -> str:
    """Points of the flagged issues per sprint; sprints without one don't appear."""
    return f"SELECT sprint_number, team_dim_id, sum(pts) FILTER ({flag}) AS points FROM scored GROUP BY ALL HAVING bool_or({flag})"


WITHIN_CTE, FINISHED_CTE = ("within_points", _points_where("within")), ("finished_points", _points_where("finished"))


@query("sprint_actual_completed_points", "SELECT sprint_number, team_dim_id, points::DOUBLE AS completed_points FROM within_points",
       ctes=(*BASE, WITHIN_CTE))
def sprint_actual_completed_points(spark, sf_dir):
    t = _t(spark, sf_dir)
    return as_doubles(sp.actual_completed_points(d.sprint_issues(t), d.sprint_summary(t), d.AS_OF))


@query("sprint_completed_points", "SELECT sprint_number, team_dim_id, points::DOUBLE AS completed_points FROM finished_points",
       ctes=(*BASE, FINISHED_CTE))
def sprint_completed_points(spark, sf_dir):
    t = _t(spark, sf_dir)
    return as_doubles(sp.completed_points(d.sprint_issues(t), d.sprint_summary(t), d.AS_OF))


# A4: members who joined before the start and stayed past the completion, both strictly.
SIZE_CTE = ("team_size", f"""
SELECT * FROM (
  SELECT o.team_dim_id, o.sprint_number,
         (SELECT count(*) FROM user_team_map w WHERE w.team_dim_id = o.team_dim_id AND w.team_entry_date < o.begins
            AND (w.team_exit_date > o.ends OR (w.team_exit_date IS NULL AND o.ends < {AS_OF}))) AS no_of_devs
  FROM open_sprint o)
WHERE no_of_devs > 0""")


@query("sprint_team_size", "SELECT * FROM team_size", ctes=(OPEN_CTE, SIZE_CTE))
def sprint_team_size(spark, sf_dir):
    t = _t(spark, sf_dir)
    return sp.team_size(d.sprint_summary(t), d.user_team_map(t), d.AS_OF)


# Each sprint beside the one before it in the order of all sprints.
W1_CTE = ("w1", """
WITH line AS (SELECT sprint_number, team_dim_id, sprint_start_date::DATE AS first_day, sprint_complete_date::DATE AS last_day,
                     row_number() OVER (ORDER BY team_dim_id, sprint_number, sprint_start_date) AS place FROM sprint_summary)
SELECT now.sprint_number, now.team_dim_id, now.first_day + (before.last_day IS NOT DISTINCT FROM now.first_day)::INTEGER AS actual_start_date
FROM line now LEFT JOIN line before ON before.place + 1 = now.place""")


@query("actual_sprint_start", """
SELECT s.sprint_number, s.team_dim_id, coalesce(s.actual_sprint_start_date, w1.actual_start_date)
       AS actual_sprint_start_date
FROM sprint_summary s JOIN w1 ON s.sprint_number = w1.sprint_number AND s.team_dim_id = w1.team_dim_id""",
       ctes=(W1_CTE,))
def actual_sprint_start(spark, sf_dir):
    t = _t(spark, sf_dir)
    return sp.set_actual_start(d.sprint_summary(t)).select(
        "sprint_number", "team_dim_id", "actual_sprint_start_date")


# E15 / E16 in SQL: weekdays of the inclusive range, minus mandatory weekday holidays.
def _days_sql(a: str, b: str) -> tuple[str, str]:
    total = (f"len(list_filter(generate_series(CAST({a} AS DATE), CAST({b} AS DATE), INTERVAL 1 DAY), "
             f"lambda x: isodow(x) < 6))")
    hol = (f"(SELECT count(DISTINCT CAST(holiday_date AS DATE)) FROM holiday_dim WHERE is_mandatory_holiday "
           f"AND CAST(holiday_date AS DATE) BETWEEN CAST({a} AS DATE) AND CAST({b} AS DATE) "
           f"AND isodow(CAST(holiday_date AS DATE)) < 6)")
    return total, f"({total} - {hol})"


_TOTAL, _ACTUAL = _days_sql("a.actual_sprint_start_date", "a.sprint_complete_date")

SPRINT_DAYS_CTE = ("u5", """
SELECT s.* REPLACE (coalesce(s.actual_sprint_start_date, w1.actual_start_date) AS actual_sprint_start_date)
FROM sprint_summary s JOIN w1 ON s.sprint_number = w1.sprint_number AND s.team_dim_id = w1.team_dim_id""")


@query("sprint_days", f"""
SELECT a.sprint_number, a.team_dim_id,
       CASE WHEN {PENDING} THEN CAST({_TOTAL} AS INTEGER) ELSE a.total_sprint_days END AS total_sprint_days,
       CASE WHEN {PENDING} THEN CAST({_ACTUAL} AS INTEGER) ELSE a.actual_sprint_days END AS actual_sprint_days
FROM u5 a""", ctes=(W1_CTE, SPRINT_DAYS_CTE))
def sprint_days(spark, sf_dir):
    t = _t(spark, sf_dir)
    s = sp.sprint_days(sp.set_actual_start(d.sprint_summary(t)), holiday_array(d.holiday_dim(t)))
    return s.select("sprint_number", "team_dim_id", "total_sprint_days", "actual_sprint_days")


def _metrics_ctes():
    """C1 in SQL: all measures of a sprint side by side, then laid over the sprint table."""
    measure = ("measure", """
SELECT sprint_number, team_dim_id,
       max(v) FILTER (m = 'est') AS est, bool_or(m = 'est') AS has_est, max(v) FILTER (m = 'within') AS inside,
       bool_or(m = 'within') AS has_inside, max(v) FILTER (m = 'finished') AS done, bool_or(m = 'finished') AS has_done,
       max(v) FILTER (m = 'size') AS devs
FROM (SELECT sprint_number, team_dim_id, 'est' AS m, points AS v FROM est
      UNION ALL SELECT sprint_number, team_dim_id, 'within', points FROM within_points
      UNION ALL SELECT sprint_number, team_dim_id, 'finished', points FROM finished_points
      UNION ALL SELECT sprint_number, team_dim_id, 'size', no_of_devs FROM team_size)
GROUP BY ALL""")
    laid = ("laid", """
SELECT s.* REPLACE (
  if(coalesce(x.has_est, FALSE), x.est::DECIMAL(18,2), s.estimated_points) AS estimated_points,
  if(coalesce(x.has_inside, FALSE), x.inside::DECIMAL(18,2), s.actual_completed_points) AS actual_completed_points,
  if(coalesce(x.has_done, FALSE), x.done::DECIMAL(18,2), s.completed_points) AS completed_points,
  coalesce(x.devs::BIGINT, s.number_of_devs) AS number_of_devs,
  coalesce(s.actual_sprint_start_date, w1.actual_start_date) AS actual_sprint_start_date)
FROM sprint_summary s JOIN w1 USING (sprint_number, team_dim_id) LEFT JOIN measure x USING (sprint_number, team_dim_id)""")
    metrics = ("metrics", f"""
SELECT a.* REPLACE (
  if({PENDING}, {_TOTAL}::INTEGER, a.total_sprint_days) AS total_sprint_days,
  if({PENDING}, {_ACTUAL}::INTEGER, a.actual_sprint_days) AS actual_sprint_days)
FROM laid a""")
    return (*BASE, EST_CTE, WITHIN_CTE, FINISHED_CTE, SIZE_CTE, W1_CTE, measure, laid, metrics)


METRIC_COLS = ("sprint_number, team_dim_id, CAST(estimated_points AS DOUBLE) AS estimated_points, "
               "CAST(actual_completed_points AS DOUBLE) AS actual_completed_points, "
               "CAST(completed_points AS DOUBLE) AS completed_points, number_of_devs, "
               "actual_sprint_start_date, total_sprint_days, actual_sprint_days, is_metrics_updated")


def session_memo(fn):
    """Share a derived plan per session and folder (an immutable DataFrame; no data is
    cached), so several registered queries do not rebuild the same pipeline prefix."""
    def wrapped(spark, sf_dir):
        plans, key = d.plans_of(spark), (sf_dir, fn)
        if key not in plans:
            plans[key] = fn(spark, sf_dir)
        return plans[key]
    wrapped.__name__, wrapped.__doc__ = fn.__name__, fn.__doc__
    return wrapped


@session_memo
def metrics_frame(spark, sf_dir):
    t = _t(spark, sf_dir)
    return sp.sprint_metrics(d.sprint_summary(t), d.sprint_issues(t), d.user_team_map(t),
                             holiday_array(d.holiday_dim(t)), d.AS_OF)


@query("sprint_metrics", f"SELECT {METRIC_COLS} FROM metrics", ctes=_metrics_ctes())
def sprint_metrics(spark, sf_dir):
    return as_doubles(metrics_frame(spark, sf_dir).select(
        "sprint_number", "team_dim_id", "estimated_points", "actual_completed_points",
        "completed_points", "number_of_devs", "actual_sprint_start_date", "total_sprint_days",
        "actual_sprint_days", "is_metrics_updated"))


@query("close_sprints", """
SELECT sprint_number, team_dim_id,
       CASE WHEN is_metrics_updated IS NULL OR is_metrics_updated = FALSE THEN TRUE
            ELSE is_metrics_updated END AS is_metrics_updated
FROM metrics""", ctes=_metrics_ctes())
def close_sprints(spark, sf_dir):
    return sp.close_sprints(metrics_frame(spark, sf_dir)).select(
        "sprint_number", "team_dim_id", "is_metrics_updated")
