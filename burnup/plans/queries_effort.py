"""Registered effort queries: C2, C3, A12, A13, A5, A6, C4, N4, U22, U23, U24/C6, C5."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from burnup.functions.expr import holiday_array, lit_ts
from burnup.operators import effort as ef
from burnup.operators import nesting as ns
from burnup.operators import sprints as sp
from burnup.plans import domain as d
from burnup.plans.queries_sprints import POINTS, _metrics_ctes, metrics_frame, session_memo
from burnup.plans.registry import query
from burnup.session import cut_lineage, scratch_path
from burnup.streaming import push_retry as pr

AS_OF = "TIMESTAMP '2024-01-24 12:00:00'"
PENDING_M = "(m.is_metrics_updated IS NULL OR m.is_metrics_updated = FALSE)"

FACT_CTES = (
    *_metrics_ctes(),
    ("feat", f"""
SELECT i.team_dim_id, i.sprint_number, i.portfolio_dim_id, i.pv_project_dim_id, i.task_ppm_id, i.is_maintenance,
       coalesce(sum({POINTS}), 0) AS fpts
FROM sprint_issues i JOIN metrics m ON i.team_dim_id = m.team_dim_id AND i.sprint_number = m.sprint_number
WHERE i.is_active = TRUE AND i.portfolio_dim_id IS NOT NULL AND {PENDING_M}
GROUP BY 1, 2, 3, 4, 5, 6"""),
    ("tot", "SELECT team_dim_id, sprint_number, sum(fpts) AS total, count(*) AS nfeat FROM feat GROUP BY 1, 2"),
    ("fact", """
SELECT f.team_dim_id, f.sprint_number, f.portfolio_dim_id, f.pv_project_dim_id, f.task_ppm_id, f.is_maintenance,
       (CAST(8 AS DOUBLE) * CAST(m.actual_sprint_days AS DOUBLE)) *
       (CASE WHEN t.total > 0 THEN CAST(f.fpts AS DOUBLE) / CAST(t.total AS DOUBLE)
             ELSE CAST(1 AS DOUBLE) / CAST(t.nfeat AS DOUBLE) END) AS time_spent
FROM feat f JOIN tot t ON f.team_dim_id = t.team_dim_id AND f.sprint_number = t.sprint_number
JOIN metrics m ON f.team_dim_id = m.team_dim_id AND f.sprint_number = m.sprint_number"""),
    ("closed", """
SELECT * REPLACE (CASE WHEN is_metrics_updated IS NULL OR is_metrics_updated = FALSE THEN TRUE
                  ELSE is_metrics_updated END AS is_metrics_updated) FROM metrics"""),
)

A6_WHERE = ("(a.is_timesheet_populated IS NULL OR a.is_timesheet_populated = FALSE) "
            "AND a.is_metrics_updated = TRUE AND a.sprint_end_date > DATE '2020-05-14' "
            "AND a.sprint_end_date <= DATE '2024-01-24'")

PLAN_CTES = (
    *FACT_CTES,
    ("alist", f"SELECT DISTINCT sprint_number FROM closed a WHERE {A6_WHERE}"),
    ("mem", f"""
SELECT ps.team_dim_id, ps.sprint_number, ps.sprint_name, ps.actual_sprint_start_date, ps.sprint_complete_date,
       ps.actual_sprint_days, u.user_dim_id
FROM closed ps JOIN user_team_map u ON ps.team_dim_id = u.team_dim_id
 AND u.team_entry_date < ps.sprint_start_date AND coalesce(u.team_exit_date, {AS_OF}) > ps.sprint_complete_date
WHERE ps.sprint_number IN (SELECT sprint_number FROM alist)"""),
    ("mdays", """
SELECT * FROM (
  SELECT mem.*, CAST(unnest(generate_series(CAST(actual_sprint_start_date AS TIMESTAMP),
                CAST(CAST(sprint_complete_date AS DATE) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date_of_sprint
  FROM mem)
WHERE isodow(date_of_sprint) < 6
  AND date_of_sprint NOT IN (SELECT CAST(holiday_date AS DATE) FROM holiday_dim WHERE is_mandatory_holiday)"""),
    ("plan", """
SELECT r.resource_ppm_id, d.date_of_sprint,
       f.time_spent / CAST(d.actual_sprint_days AS DOUBLE) AS per_day_time_spent,
       TRY_CAST(p.project_ppm_id AS BIGINT) AS project_ppm_id, f.task_ppm_id, r.primary_role_id AS resource_role_id,
       t.team_name, d.sprint_name, d.team_dim_id, d.sprint_number, f.portfolio_dim_id
FROM mdays d JOIN fact f ON f.team_dim_id = d.team_dim_id AND f.sprint_number = d.sprint_number
JOIN resource_dim r ON r.resource_dim_id = d.user_dim_id
JOIN team_dim t ON t.team_dim_id = d.team_dim_id
LEFT JOIN projects_dim p ON p.pv_project_dim_id = f.pv_project_dim_id"""),
)

POP_CTES = (
    *PLAN_CTES,
    # A5: the first qualifying sprint that one of a resource's memberships spans, ends included
    ("due_user", f"""
SELECT r.resource_ppm_id, min(c.sprint_start_date) AS first_start
FROM resource_dim r, closed c
WHERE {A6_WHERE.replace('a.', 'c.')}
  AND EXISTS (SELECT 1 FROM user_team_map w WHERE w.user_dim_id = r.resource_dim_id AND w.team_dim_id = c.team_dim_id
              AND w.team_entry_date <= c.sprint_start_date AND ifnull(w.team_exit_date, {AS_OF}) >= c.sprint_end_date)
GROUP BY r.resource_ppm_id"""),
    ("wanted", """
SELECT t.* FROM timesheet_data t SEMI JOIN due_user u ON u.resource_ppm_id = t.userId
WHERE t.endDate >= (SELECT min(first_start)::DATE FROM due_user)"""),
    ("header", "SELECT timesheetId, userId, startDate, endDate FROM wanted GROUP BY ALL"),
    ("due", """
SELECT h.timesheetId, p.resource_ppm_id AS userId, p.project_ppm_id, p.task_ppm_id, p.date_of_sprint AS entryDate,
       p.resource_role_id, p.per_day_time_spent
FROM header h, plan p WHERE p.resource_ppm_id = h.userId AND p.date_of_sprint >= h.startDate AND p.date_of_sprint <= h.endDate"""),
    ("booked", """
SELECT timesheetId, userId, project_ppm_id, task_ppm_id, entryDate, entryId FROM wanted
WHERE entryId IS NOT NULL AND entryDate >= startDate AND entryDate <= endDate"""),
    # C4: what is booked already keeps its id, all else is new
    ("pop", """
SELECT 0 AS companyId, 1 AS entryTypeId, timesheetId, userId, project_ppm_id AS level1Id, task_ppm_id AS level2Id,
       strftime(entryDate, '%Y/%m/%d') AS entryDate, entryId, resource_role_id AS level3Id, per_day_time_spent AS entryHours
FROM (SELECT d.*, b.entryId FROM due d JOIN booked b USING (timesheetId, userId, project_ppm_id, task_ppm_id, entryDate)
      UNION ALL
      SELECT d.*, 0 FROM due d ANTI JOIN booked b USING (timesheetId, userId, project_ppm_id, task_ppm_id, entryDate))"""),
)


def _t(spark, sf_dir):
    return d.Tables(spark, sf_dir)


@session_memo
def _metrics(spark, sf_dir):
    """C1 result and C2 fact (the sprint table is still open)."""
    t = _t(spark, sf_dir)
    s1 = metrics_frame(spark, sf_dir)
    return t, s1, ef.feature_time_spent(s1, d.sprint_issues(t))


@session_memo
def _closed(spark, sf_dir):
    """... plus the closed sprint table (U7) and the A6 sprint numbers."""
    t, s1, fact = _metrics(spark, sf_dir)
    s2 = sp.close_sprints(s1)
    return t, s1, fact, s2, ef.timesheet_sprint_numbers(s2, d.AS_OF)


@session_memo
def _frames(spark, sf_dir):
    """... plus the C3 plan."""
    t, s1, fact, s2, numbers = _closed(spark, sf_dir)
    plan = ef.timesheet_plan(s2, numbers, fact, d.user_team_map(t), d.resource_dim(t), d.team_dim(t),
                             d.projects_dim(t), holiday_array(d.holiday_dim(t)), d.AS_OF)
    return t, s1, fact, s2, numbers, plan


def _population(spark, sf_dir):
    t, s1, fact, s2, numbers, plan = _frames(spark, sf_dir)
    users = ef.timesheet_users(s2, d.user_team_map(t), d.resource_dim(t), d.AS_OF)
    data = ef.requested_timesheets(d.generator_timesheet_rows(t), users)
    return t, ef.timesheet_population(plan, data)


FACT_COLS = ["team_dim_id", "sprint_number", "portfolio_dim_id", "pv_project_dim_id", "task_ppm_id",
             "is_maintenance", "time_spent"]


@query("feature_time_spent", f"SELECT {', '.join(FACT_COLS)} FROM fact", ctes=FACT_CTES)
def feature_time_spent(spark, sf_dir):
    return _metrics(spark, sf_dir)[2].select(*FACT_COLS)


@query("timesheet_plan", "SELECT * FROM plan", ctes=PLAN_CTES)
def timesheet_plan(spark, sf_dir):
    return _frames(spark, sf_dir)[5]


@query("team_daily_hours_check", """
SELECT f.team_dim_id, f.sprint_number,
       CAST(CAST(sum(time_spent) / CAST(ss.actual_sprint_days AS DOUBLE) AS DECIMAL(10,0)) AS BIGINT) AS hr
FROM fact f JOIN metrics ss ON f.sprint_number = ss.sprint_number AND f.team_dim_id = ss.team_dim_id
WHERE portfolio_dim_id IS NOT NULL
GROUP BY f.team_dim_id, f.sprint_number, ss.actual_sprint_days""", ctes=FACT_CTES)
def team_daily_hours_check(spark, sf_dir):
    t, s1, fact = _metrics(spark, sf_dir)
    return ef.team_daily_hours_check(fact, s1)


@query("team_hours_vs_capacity_check", """
SELECT p.team_dim_id, p.sprint_number, p.team_name, p.sprint_name,
       CAST(CAST(p.hr AS DECIMAL(10,0)) AS BIGINT) AS planned_hr, CAST(CAST(c.hr AS DECIMAL(10,0)) AS BIGINT) AS capacity_hr
FROM (SELECT team_dim_id, sprint_number, team_name, sprint_name, sum(per_day_time_spent) AS hr FROM plan
      GROUP BY 1, 2, 3, 4) p
JOIN (SELECT f.team_dim_id, f.sprint_number, sum(time_spent) * number_of_devs AS hr
      FROM fact f JOIN metrics ss ON f.sprint_number = ss.sprint_number AND f.team_dim_id = ss.team_dim_id
      WHERE portfolio_dim_id IS NOT NULL GROUP BY f.team_dim_id, f.sprint_number, ss.number_of_devs) c
  ON p.team_dim_id = c.team_dim_id AND p.sprint_number = c.sprint_number""", ctes=PLAN_CTES)
def team_hours_vs_capacity_check(spark, sf_dir):
    t, s1, fact, s2, numbers, plan = _frames(spark, sf_dir)
    return ef.team_hours_vs_capacity_check(plan, fact, s1)


@query("timesheet_user_list", """
SELECT CAST(floor(resource_ppm_id / 1000) AS BIGINT) AS user_batch,
       string_agg(CAST(resource_ppm_id AS VARCHAR), ', ' ORDER BY resource_ppm_id) AS user_list,
       (SELECT strftime(min(first_start), '%Y/%m/%d') FROM due_user) AS min
FROM due_user GROUP BY floor(resource_ppm_id / 1000)""", ctes=POP_CTES)
def timesheet_user_list(spark, sf_dir):
    t, s1, fact, s2, numbers = _closed(spark, sf_dir)
    return ef.timesheet_user_list(s2, d.user_team_map(t), d.resource_dim(t), d.AS_OF)


@query("timesheet_sprint_list", """
SELECT CAST(floor(sprint_number / 1000) AS BIGINT) AS sprint_batch,
       string_agg(CAST(sprint_number AS VARCHAR), ', ' ORDER BY sprint_number) AS sprint_number
FROM alist GROUP BY floor(sprint_number / 1000)""", ctes=PLAN_CTES)
def timesheet_sprint_list(spark, sf_dir):
    return ef.timesheet_sprint_list(_closed(spark, sf_dir)[3], d.AS_OF)


@query("timesheet_population", "SELECT * FROM pop", ctes=POP_CTES)
def timesheet_population(spark, sf_dir):
    return _population(spark, sf_dir)[1]


def payload_records(payload):
    """Every record of every payload list, with its place in the list."""
    e = payload.select("userId", "chunk", F.posexplode("entriesProject").alias("place", "r"))
    return e.select("userId", "chunk", "place", "r.*")


# The list of a chunk is sorted by the records' fields, NULLs first.
RECORDS_SQL = """
SELECT userId, entryDate AS chunk,
       CAST(row_number() OVER (PARTITION BY timesheetId, userId, entryDate ORDER BY level1Id NULLS FIRST, level2Id NULLS FIRST,
            entryId NULLS FIRST, level3Id NULLS FIRST, entryHours NULLS FIRST) - 1 AS INTEGER) AS place,
       companyId, entryTypeId, timesheetId, level1Id, level2Id, entryDate, entryId, level3Id, entryHours
FROM pop"""


@query("timesheet_payload", RECORDS_SQL, ctes=POP_CTES)
def timesheet_payload(spark, sf_dir):
    return payload_records(ns.timesheet_payload(_population(spark, sf_dir)[1]))


@query("payload_json", """
SELECT timesheetId, userId, entryDate AS chunk, count(*) AS n_entries, sum(level2Id)::BIGINT AS level2_sum, min(entryId) AS first_entry
FROM pop GROUP BY timesheetId, userId, entryDate""", ctes=POP_CTES)
def payload_json(spark, sf_dir):
    """N5, read back from its JSON text."""
    sent = ns.payload_json(ns.timesheet_payload(_population(spark, sf_dir)[1]))
    back = F.from_json("payload", "timesheetId bigint, userId bigint, entriesProject array<struct<level2Id:bigint,entryId:bigint>>")
    e = sent.select("chunk", back.alias("p"))
    total = F.aggregate("p.entriesProject", F.lit(0).cast("bigint"), lambda x, y: x + F.coalesce(y["level2Id"], F.lit(0)))
    return e.select("p.timesheetId", "p.userId", "chunk", F.size("p.entriesProject").cast("bigint").alias("n_entries"),
                    total.alias("level2_sum"), F.array_min(F.transform("p.entriesProject", lambda x: x["entryId"])).alias("first_entry"))


@query("payload_service_names", """
SELECT companyId, entryTypeId, timesheetId, userId, level1Id, level2Id, entryDate, entryId, level3Id, entryHours FROM pop""",
       ctes=POP_CTES)
def payload_service_names(spark, sf_dir):
    """Rows as a database returns them, names in lower case, renamed for the service."""
    rows = _population(spark, sf_dir)[1]
    return ns.to_service_names(rows.toDF(*[c.lower() for c in rows.columns]))


@query("mark_populated", """
SELECT sprint_number, team_dim_id,
       CASE WHEN sprint_number IN (SELECT sprint_number FROM alist) THEN TRUE ELSE is_timesheet_populated END
         AS is_timesheet_populated
FROM closed""", ctes=PLAN_CTES)
def mark_populated(spark, sf_dir):
    t, s1, fact, s2, numbers = _closed(spark, sf_dir)
    return ef.mark_populated(s2, numbers).select("sprint_number", "team_dim_id", "is_timesheet_populated")


DL_CTES = (
    *POP_CTES,
    ("dl1", f"""
SELECT * FROM dead_letter_seed
UNION ALL
SELECT companyId, entryTypeId, timesheetId, userId, level1Id, level2Id, CAST(strptime(entryDate, '%Y/%m/%d') AS DATE),
       entryId, level3Id, coalesce(entryHours, 0), {AS_OF}
FROM pop p WHERE p.timesheetId % 11 = 0
  AND NOT EXISTS (SELECT 1 FROM dead_letter_seed s WHERE s.timesheetId = p.timesheetId AND s.userId = p.userId)"""),
)
DL_COLS = ", ".join(ef.DEAD_LETTER_COLS)


def _dead_letter_inputs(spark, sf_dir):
    """The pushed rows are a written table (as in the generation chain C5): the payload,
    the acknowledgements and the dead letter all read them."""
    t, rows = _population(spark, sf_dir)
    return t, cut_lineage(rows, "rows"), d.dead_letter_seed(t)


@query("dead_letter_append", f"SELECT {DL_COLS} FROM dl1", ctes=DL_CTES)
def dead_letter_append(spark, sf_dir):
    t, rows, seed = _dead_letter_inputs(spark, sf_dir)
    acks = d.push_acknowledgements(ns.timesheet_payload(rows))
    return ef.dead_letter_append(seed, rows, acks, d.AS_OF)


@query("apply_push_result", f"SELECT {DL_COLS} FROM dl1 WHERE timesheetId % 11 = 0", ctes=DL_CTES)
def apply_push_result(spark, sf_dir):
    t, rows, seed = _dead_letter_inputs(spark, sf_dir)
    return ef.apply_push_result(seed, rows, d.push_acknowledgements, d.AS_OF)


@query("push_retry_stream", f"SELECT {DL_COLS} FROM dl1 WHERE timesheetId % 11 = 0", ctes=DL_CTES)
def push_retry_stream(spark, sf_dir):
    """C6/U24 as a stream: the answers to the push and to the retry of the dead letter, folded by chunk."""
    t, rows, seed = _dead_letter_inputs(spark, sf_dir)
    first = d.push_acknowledgements(ns.timesheet_payload(rows))
    dl = cut_lineage(ef.dead_letter_append(seed, rows, first, d.AS_OF), "dead_letter")
    second = d.push_acknowledgements(ns.timesheet_payload(ef.dead_letter_rows(dl)))
    base = scratch_path(spark, f"push-{uuid.uuid4().hex}")
    for attempt, acks in enumerate((first, second)):
        at = lit_ts(d.AS_OF + dt.timedelta(minutes=10 * attempt)).cast("timestamp")
        acks.select(*ef.CHUNK_KEYS, F.lit(attempt).alias("attempt"), "ok", at.alias("answered_at")).write.mode("append").parquet(f"{base}/answers")
    pr.start_retry_stream(spark, f"{base}/answers", f"{base}/events", f"{base}/progress").awaitTermination()
    return pr.clear_accepted(dl, spark.read.schema(pr.EVENTS).parquet(f"{base}/events"))


def _generated(spark, sf_dir):
    t = _t(spark, sf_dir)
    return t, ef.generate_timesheets(
        d.sprint_summary(t), d.sprint_issues(t), d.user_team_map(t), d.resource_dim(t), d.team_dim(t),
        d.projects_dim(t), d.generator_timesheet_rows(t), holiday_array(d.holiday_dim(t)),
        d.push_acknowledgements, d.AS_OF)


@query("generate_timesheets", f"SELECT r.*, timesheetId % 11 <> 0 AS ok FROM ({RECORDS_SQL}) r", ctes=POP_CTES)
def generate_timesheets(spark, sf_dir):
    """The records sent, with the service's answer for their chunk."""
    out = _generated(spark, sf_dir)[1]
    return payload_records(out["payload"]).join(out["acks"].select("timesheetId", "userId", "chunk", "ok").hint("merge"),
                                                ["timesheetId", "userId", "chunk"])


@query("generate_timesheets_sprints", """
SELECT sprint_number, team_dim_id, is_metrics_updated,
       sprint_number IN (FROM alist) AND EXISTS (FROM due_user) OR is_timesheet_populated AS is_timesheet_populated
FROM closed""", ctes=POP_CTES)
def generate_timesheets_sprints(spark, sf_dir):
    """C5's sprint table after U22."""
    return _generated(spark, sf_dir)[1]["sprints"].select("sprint_number", "team_dim_id", "is_metrics_updated", "is_timesheet_populated")


@query("generate_timesheets_dead_letter", f"SELECT {DL_COLS} FROM dl1 WHERE timesheetId % 11 = 0", ctes=DL_CTES)
def generate_timesheets_dead_letter(spark, sf_dir):
    """C5's dead letter after push and retry."""
    t, out = _generated(spark, sf_dir)
    return ef.apply_push_result(d.dead_letter_seed(t), out["rows"], d.push_acknowledgements, d.AS_OF, out["payload"])


@query("draft_population", """
SELECT strftime(p.date_of_sprint, '%Y/%m/%d') AS date_of_sprint, p.resource_ppm_id, p.per_day_time_spent, p.project_ppm_id,
       p.task_ppm_id, p.resource_role_id, x.timesheetId, x.entryId AS entryid, strftime(x.entryDate, '%Y/%m/%d') AS entrydate
FROM plan p JOIN (
  SELECT timesheetId, userId, entryId, entryDate, entryDate AS from_day, entryDate AS to_day FROM wanted WHERE entryId IS NOT NULL
  UNION ALL
  SELECT timesheetId, userId, NULL, NULL, startDate, endDate FROM header
  WHERE timesheetId NOT IN (SELECT timesheetId FROM wanted WHERE entryId IS NOT NULL)) x
  ON x.userId = p.resource_ppm_id AND x.from_day <= p.date_of_sprint AND p.date_of_sprint <= x.to_day""", ctes=POP_CTES)
def draft_population(spark, sf_dir):
    t, s1, fact, s2, numbers, plan = _frames(spark, sf_dir)
    users = ef.timesheet_users(s2, d.user_team_map(t), d.resource_dim(t), d.AS_OF)
    return ef.draft_timesheet_population(plan, ef.requested_timesheets(d.generator_timesheet_rows(t), users))


def _all_sprints_plan(spark, sf_dir):
    t, s1, fact, s2, numbers = _closed(spark, sf_dir)
    return s2, ef.timesheet_plan(s2, None, fact, d.user_team_map(t), d.resource_dim(t), d.team_dim(t), d.projects_dim(t),
                                 holiday_array(d.holiday_dim(t)), d.AS_OF)


@query("sprint_entries_lateral", "SELECT sprint_number AS due_sprint, plan.* FROM plan", ctes=PLAN_CTES)
def sprint_entries_lateral(spark, sf_dir):
    """V4 in SQL, called for each sprint number that is due."""
    s2, plan = _all_sprints_plan(spark, sf_dir)
    ef.register_timesheet_functions(plan)
    ef.timesheet_sprint_numbers(s2, d.AS_OF).createOrReplaceTempView("due_sprints")
    return spark.sql("SELECT s.sprint_number AS due_sprint, e.* FROM due_sprints s JOIN LATERAL sprint_entries(s.sprint_number) e")


@query("timesheet_entries_listed", "SELECT * FROM plan", ctes=PLAN_CTES)
def timesheet_entries_listed(spark, sf_dir):
    """V4 in SQL, called with the text list of all numbers that are due."""
    s2, plan = _all_sprints_plan(spark, sf_dir)
    ef.register_timesheet_functions(plan)
    ef.timesheet_sprint_list(s2, d.AS_OF).createOrReplaceTempView("due_sprint_lists")
    return spark.sql("SELECT * FROM timesheet_entries((SELECT listagg(sprint_number, ', ') FROM due_sprint_lists))")


# A header of over a hundred years for each user that has one, over all planned days.
@query("long_header_population", """
SELECT p.resource_ppm_id, p.date_of_sprint, p.task_ppm_id, p.project_ppm_id, p.team_dim_id, p.sprint_number, p.portfolio_dim_id, h.timesheetId
FROM plan p JOIN (SELECT userId, min(timesheetId) AS timesheetId, min(startDate) - INTERVAL 50 YEAR AS a, max(endDate) + INTERVAL 50 YEAR AS b
                  FROM timesheet_data GROUP BY userId) h ON h.userId = p.resource_ppm_id AND p.date_of_sprint BETWEEN h.a AND h.b""", ctes=POP_CTES)
def long_header_population(spark, sf_dir):
    """J10 over ranges of any length."""
    from burnup.operators.intervals import days_in_ranges
    t, s1, fact, s2, numbers, plan = _frames(spark, sf_dir)
    years = F.make_ym_interval(F.lit(50))
    h = d.generator_timesheet_rows(t).groupBy("userId").agg(F.min("timesheetId").alias("timesheetId"), (F.min("startDate") - years).alias("a"),
                                                            (F.max("endDate") + years).alias("b"))
    out = days_in_ranges(plan, h, [("resource_ppm_id", "userId")], "date_of_sprint", "a", "b")
    return out.select("resource_ppm_id", "date_of_sprint", "task_ppm_id", "project_ppm_id", "team_dim_id", "sprint_number", "portfolio_dim_id", "timesheetId")
