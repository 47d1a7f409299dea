"""The domain tables of :mod:`burnup.plans.domain`, stated again in DuckDB SQL.

The oracle twin of each query inlines the views it needs as CTEs. The text is
written independently of the Spark code from the same derivation rules, so that a
mistake in one of them shows up as a mismatch.
"""

from __future__ import annotations

import re

AS_OF = "TIMESTAMP '2024-01-24 12:00:00'"
AS_OF_DATE = "DATE '2024-01-24'"
FLOOR = "DATE '2020-05-14'"

VIEWS: dict[str, str] = {
    "team_dim": """
SELECT CAST(n_nationkey AS BIGINT) AS team_dim_id,
       CASE WHEN n_nationkey = 0 THEN 'Artex'
            WHEN n_nationkey % 5 = 0 THEN 'Artex ' || n_name ELSE n_name END AS team_name,
       TRUE AS is_active, CAST(n_regionkey AS INTEGER) AS jira_rapid_view_id,
       n_nationkey % 3 <> 0 AS is_reportable
FROM nation""",
    "resource_dim": """
SELECT c_custkey AS resource_dim_id, c_custkey + 100000 AS resource_ppm_id,
       c_name AS resource_first_name,
       CASE c_mktsegment WHEN 'AUTOMOBILE' THEN NULL WHEN 'BUILDING' THEN 'Contractor'
            WHEN 'FURNITURE' THEN 'Sr Consultant' ELSE 'Employee' END AS type,
       CASE WHEN c_custkey % 10 = 0 THEN FALSE END AS is_consultant,
       CAST(c_nationkey % 4 + 1 AS BIGINT) AS primary_role_id
FROM customer""",
    "user_team_map": """
SELECT c_custkey AS user_dim_id, CAST(c_nationkey AS BIGINT) AS team_dim_id,
       CAST(DATE '2023-12-20' + CAST(c_custkey % 20 AS INTEGER) AS TIMESTAMP) AS team_entry_date,
       CASE WHEN c_custkey % 4 = 0
            THEN CAST(DATE '2023-12-20' + CAST(c_custkey % 20 + 15 AS INTEGER) AS TIMESTAMP) END
            AS team_exit_date,
       c_custkey % 7 <> 0 AS is_active
FROM customer""",
    "sprint_summary": """
SELECT CAST(w AS BIGINT) AS sprint_number, team_dim_id, 'Sprint ' || CAST(w AS VARCHAR) AS sprint_name,
       st AS sprint_start_date, st + INTERVAL 4 DAY AS sprint_end_date,
       st + CAST(CASE WHEN team_dim_id % 2 = 0 THEN 5 ELSE 4 END AS INTEGER) * INTERVAL 1 DAY
          + INTERVAL 8 HOUR AS sprint_complete_date,
       CASE WHEN (team_dim_id + w) % 7 = 0 THEN CAST(st AS DATE) END AS actual_sprint_start_date,
       CAST(NULL AS DECIMAL(18,2)) AS estimated_points,
       CAST(NULL AS DECIMAL(18,2)) AS actual_completed_points,
       CAST(NULL AS DECIMAL(18,2)) AS completed_points,
       CAST(NULL AS BIGINT) AS number_of_devs, CAST(NULL AS INTEGER) AS total_sprint_days,
       CAST(NULL AS INTEGER) AS actual_sprint_days,
       CASE (team_dim_id + w) % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END AS is_metrics_updated,
       CASE WHEN (team_dim_id + w) % 4 = 0 THEN TRUE END AS is_timesheet_populated
FROM (SELECT team_dim_id, w,
             TIMESTAMP '2024-01-01 09:00:00' + CAST((w - 1) * 5 AS INTEGER) * INTERVAL 1 DAY AS st
      FROM (SELECT CAST(n_nationkey AS BIGINT) AS team_dim_id, unnest(generate_series(1, 6)) AS w
            FROM nation))""",
    "sprint_issues": """
SELECT event_id AS issue_id, CAST((day(ts) - 1) // 5 + 1 AS BIGINT) AS sprint_number,
       CAST(c_nationkey AS BIGINT) AS team_dim_id,
       '{"fields": {"customfield_10411": ' ||
         CASE WHEN event_id % 11 = 0 THEN 'null'
              WHEN event_id % 2 = 1 THEN json_extract_string(props, '$.k') || '.5'
              ELSE json_extract_string(props, '$.k') END ||
         CASE WHEN event_type = 'error' THEN ''
              ELSE ', "resolutiondate": "' || strftime(ts + INTERVAL 2 DAY, '%Y-%m-%d %H:%M:%S') || '"' END
         || '}}' AS ticket_details,
       event_id % 10 <> 0 AS is_active,
       CASE event_type WHEN 'view' THEN 'Open' WHEN 'error' THEN NULL ELSE 'Done' END
         AS status_on_sprint_closure,
       event_id % 150 AS epic_dim_id, event_id % 10 AS project_dim_id,
       CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id % 5 + 1 END AS portfolio_dim_id,
       CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id % 5 END AS pv_project_dim_id,
       CAST(NULL AS BOOLEAN) AS is_maintenance, event_id % 3 + 1 AS task_ppm_id
FROM events JOIN customer ON user_id = c_custkey""",
    "portfolio_dim": """
SELECT CAST(r_regionkey + 1 AS BIGINT) AS portfolio_dim_id,
       CAST(r_regionkey + 500 AS VARCHAR) AS portfolio_ppm_id, r_name AS portfolio_name
FROM region""",
    "jira_project_dim": """
SELECT s_suppkey AS project_dim_id,
       CASE WHEN s_suppkey % 2 = 0 THEN 'Team ' || r_name || ' Care' ELSE s_name END AS project_name
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "projects_dim": """
SELECT p_partkey AS pv_project_dim_id, CAST(p_partkey + 7000 AS VARCHAR) AS project_ppm_id,
       p_name || CASE WHEN p_size % 7 = 0 THEN ' (Ongoing)' ELSE '' END AS pv_project_name,
       CASE WHEN p_partkey % 3 = 0 THEN 'A' || CAST(p_partkey AS VARCHAR) END AS pv_aha_id,
       CASE WHEN p_type = 'ECONOMY' THEN 'Services' ELSE p_type END AS category,
       CASE WHEN p_size > 45 THEN NULL ELSE p_partkey % 5 + 1 END AS portfolio_dim_id,
       CASE WHEN p_size % 13 = 0 THEN TRUE WHEN p_size % 11 = 0 THEN FALSE END AS is_maintenance_project
FROM part""",
    "epic_dim": """
SELECT p_partkey AS epic_dim_id,
       CASE WHEN p_partkey % 2 = 0 THEN 'https://tracker.example.com/features/A' || CAST(p_partkey AS VARCHAR) || ' '
            ELSE 'A' || CAST(p_partkey AS VARCHAR) END AS aha_reference
FROM part""",
    "project_tasks": """
SELECT s_suppkey AS task_dim_id, CAST(s_suppkey AS VARCHAR) AS task_ppm_id,
       s_suppkey * 7 % 200 AS pv_project_dim_id, s_suppkey % 9 <> 0 AS is_time_reportable
FROM supplier""",
    "holiday_dim": """
SELECT * FROM (VALUES
  (TIMESTAMP '2024-01-01 00:00:00', 'New Years Day', 'US', 'US', TRUE),
  (TIMESTAMP '2024-01-13 00:00:00', 'Company Day', 'US', 'US', TRUE),
  (TIMESTAMP '2024-01-15 00:00:00', 'Martin Luther King Day', 'US', 'US', TRUE),
  (TIMESTAMP '2024-01-16 00:00:00', 'Optional Day', 'US', 'US', FALSE))
  AS h(holiday_date, holiday_name, holiday_country, holiday_state, is_mandatory_holiday)""",
    "li": """
SELECT l.*, o_custkey, o_orderdate,
       CAST(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 99 ELSE 2 END AS BIGINT) AS etype,
       DATE '2023-12-01' + CAST(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) % 61 AS INTEGER)
         AS edate
FROM lineitem l JOIN orders ON l_orderkey = o_orderkey""",
    "entry_cols": """
SELECT l_orderkey AS timesheetid, CAST(0 AS BIGINT) AS companyid, edate AS entrydate,
       CAST(l_quantity AS DECIMAL(18,2)) AS entryhours, l_orderkey * 10 + l_linenumber AS entryid,
       etype AS entrytypeid, CAST(NULL AS VARCHAR) AS externalid,
       CAST(l_partkey % 100 AS DECIMAL(18,2)) AS internalrate,
       CAST(l_suppkey % 100 AS DECIMAL(18,2)) AS billablerate,
       l_linestatus = 'F' AS isbillable, l_returnflag <> 'R' AS isproductive,
       CASE etype WHEN 1 THEN l_partkey + 7000 WHEN 99 THEN l_partkey % 5 + 500 ELSE l_partkey END AS level1id,
       l_suppkey AS level2id, CAST(l_linenumber AS BIGINT) AS level3id, CAST(NULL AS BIGINT) AS locationid,
       CAST(NULL AS VARCHAR) AS notes,
       CASE WHEN l_linestatus = 'F' THEN 'Fully Approved' WHEN l_orderkey % 5 = 0 THEN NULL ELSE 'Open' END AS state,
       o_custkey + 100000 AS userid,
       o_orderdate, o_custkey, l_linenumber, l_shipdate
FROM li""",
    "timesheet_entries": """
SELECT timesheetid, companyid, entrydate, entryhours, entryid, entrytypeid, externalid, internalrate,
       billablerate, isbillable, isproductive, level1id, level2id, level3id, locationid, notes, state,
       userid, o_orderdate AS date_created, TRUE AS is_active,
       CASE WHEN l_linenumber = 2 THEN NULL ELSE o_custkey END AS resource_dim_id,
       CAST(NULL AS BIGINT) AS team_dim_id, CAST(NULL AS BIGINT) AS project_dim_id,
       CASE WHEN l_linenumber = 1 THEN CAST(0 AS BIGINT) END AS portfolio_dim_id,
       CAST(NULL AS BIGINT) AS task_dim_id, CAST(NULL AS BIGINT) AS date_dim_id
FROM entry_cols""",
    "import_batch": """
SELECT 2 * timesheetid AS timesheetid, companyid, entrydate, entryhours,
       CASE WHEN level3id <> 7 THEN entryid END AS entryid, entrytypeid, externalid,
       internalrate, billablerate, isbillable, isproductive, level1id, level2id, level3id, locationid,
       notes, state, userid
FROM entry_cols""",
    "date_dimension": """
SELECT CAST(strftime(dt, '%Y%m%d') AS BIGINT) AS sk_date, dt
FROM (SELECT DISTINCT edate AS dt FROM li)""",
    "generator_headers": """
SELECT c_custkey * 10 + w AS timesheetId, c_custkey + 100000 AS userId,
       DATE '2024-01-01' + CAST(w * 7 AS INTEGER) AS startDate,
       DATE '2024-01-01' + CAST(w * 7 + 6 AS INTEGER) AS endDate
FROM (SELECT c_custkey, unnest(generate_series(0, 3)) AS w FROM customer)""",
    "generator_existing_entries": """
SELECT user_id + 100000 AS userId, CAST(ts AS DATE) AS entryDate,
       event_id % 5 + 7000 AS project_ppm_id, event_id % 3 + 1 AS task_ppm_id,
       min(event_id) AS entryId, CAST(count(*) AS DECIMAL(18,2)) AS entryHours
FROM events GROUP BY 1, 2, 3, 4""",
    "timesheet_data": """
SELECT h.timesheetId, h.userId, h.startDate, h.endDate, e.entryId, e.entryDate, e.entryHours,
       e.project_ppm_id, e.task_ppm_id
FROM generator_headers h LEFT JOIN generator_existing_entries e
  ON h.userId = e.userId AND e.entryDate BETWEEN h.startDate AND h.endDate""",
    "dead_letter_seed": """
SELECT 0 AS companyId, 1 AS entryTypeId, 10 * s_suppkey + s_suppkey % 4 AS timesheetId, s_suppkey + 100000 AS userId,
       (s_suppkey + 100000) % 200 + 7000 AS level1Id, CAST(1 AS BIGINT) AS level2Id,
       DATE '2024-01-01' + CAST(7 * (s_suppkey % 4) AS INTEGER) AS entryDate, CAST(0 AS BIGINT) AS entryId,
       CAST(1 AS BIGINT) AS level3Id, CAST(1 AS DOUBLE) AS entryHours,
       TIMESTAMP '2024-01-17 00:00:00' AS created_date
FROM supplier""",
    "refresh_log": """
SELECT CAST(n_nationkey AS BIGINT) AS team_dim_id, DATE '2024-01-05' AS from_date, DATE '2024-01-20' AS to_date,
       n_nationkey = 12 AS is_timesheet_refreshed
FROM nation
UNION ALL
SELECT CAST(n_nationkey AS BIGINT), DATE '2024-01-10', DATE '2024-01-12', n_nationkey = 12
FROM nation WHERE n_nationkey = 0""",
}

# Views used by other views.
DEPENDS = {
    "entry_cols": ["li"],
    "timesheet_entries": ["entry_cols"],
    "import_batch": ["entry_cols"],
    "date_dimension": ["li"],
    "timesheet_data": ["generator_headers", "generator_existing_entries"],
}


def with_views(sql: str, *extra: tuple[str, str]) -> str:
    """Prefix ``sql`` with the CTEs it names (views first, then ``extra`` CTEs in order).

    ``extra`` holds query-specific CTEs as (name, body) pairs that may use the views.
    """
    names: list[str] = []
    text = sql + " ".join(body for _, body in extra)

    def need(name: str):
        for dep in DEPENDS.get(name, []):
            need(dep)
        if name not in names:
            names.append(name)

    for name in VIEWS:
        if re.search(rf"\b{name}\b", text):
            need(name)
    ctes = [f"{n} AS ({VIEWS[n]})" for n in names] + [f"{n} AS ({b})" for n, b in extra]
    if not ctes:
        return sql
    body = sql.lstrip()
    if body[:5].upper() == "WITH ":
        return "WITH " + ",\n".join(ctes) + ",\n" + body[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + sql
