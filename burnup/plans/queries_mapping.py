"""Registered mapping / clean-up queries."""

from __future__ import annotations

from burnup.operators import mapping as mp
from burnup.plans import domain as d
from burnup.plans.registry import query

U8_SQL = """SELECT * REPLACE (CASE WHEN is_maintenance_project IS NULL OR is_maintenance_project = FALSE
    THEN coalesce(lower(pv_project_name) LIKE '%(ongoing)%', FALSE) ELSE is_maintenance_project END
    AS is_maintenance_project) FROM projects_dim"""


def _t(spark, sf_dir):
    return d.Tables(spark, sf_dir)


@query("maintenance_projects", "SELECT pv_project_dim_id, is_maintenance_project FROM p8",
       ctes=(("p8", U8_SQL),))
def maintenance_projects(spark, sf_dir):
    return mp.maintenance_projects(d.projects_dim(_t(spark, sf_dir))).select(
        "pv_project_dim_id", "is_maintenance_project")


@query("time_reportable", """
SELECT task_dim_id, CASE WHEN is_time_reportable = TRUE AND pv_project_dim_id IN
    (SELECT pv_project_dim_id FROM projects_dim WHERE category = 'Services') THEN FALSE
    ELSE is_time_reportable END AS is_time_reportable
FROM project_tasks""")
def time_reportable(spark, sf_dir):
    t = _t(spark, sf_dir)
    return mp.time_reportable(d.project_tasks(t), d.projects_dim(t)).select(
        "task_dim_id", "is_time_reportable")


def _laid_over(issues: str, found: str, key: str, maintenance: str) -> str:
    """Issues without a portfolio take what was found for their key."""
    hit = "i.is_active AND i.portfolio_dim_id IS NULL AND f.pv IS NOT NULL"
    return f"""
SELECT i.* REPLACE (if({hit}, f.pf, i.portfolio_dim_id) AS portfolio_dim_id, if({hit}, f.pv, i.pv_project_dim_id) AS pv_project_dim_id,
                    if({hit}, {maintenance}, i.is_maintenance) AS is_maintenance)
FROM {issues} i LEFT JOIN {found} f USING ({key})"""


def _u16_ctes(projects: str):
    """An epic's references are its whole reference and the last part of that path."""
    reference = ("epic_reference", """
SELECT epic_dim_id, unnest([aha_reference, trim(string_split(aha_reference, '/')[-1])]) AS ref FROM epic_dim""")
    found = ("epic_project", f"""
SELECT DISTINCT ON (epic_dim_id) epic_dim_id, p.pv_project_dim_id AS pv, f.portfolio_dim_id AS pf
FROM {projects} p JOIN epic_reference ON ref = pv_aha_id LEFT JOIN portfolio_dim f USING (portfolio_dim_id)
ORDER BY epic_dim_id, p.pv_project_dim_id""")
    return reference, found, ("u16", _laid_over("sprint_issues", "epic_project", "epic_dim_id", "FALSE"))


ISSUE_COLS = "issue_id, portfolio_dim_id, pv_project_dim_id, is_maintenance"


@query("issue_portfolio_by_epic", f"SELECT {ISSUE_COLS} FROM u16", ctes=_u16_ctes("projects_dim"))
def issue_portfolio_by_epic(spark, sf_dir):
    t = _t(spark, sf_dir)
    return mp.issue_portfolio_by_epic(d.sprint_issues(t), d.epic_dim(t), d.projects_dim(t),
                                      d.portfolio_dim(t)).select(*ISSUE_COLS.split(", "))


U17_CTES = (
    ("p8", U8_SQL),
    *_u16_ctes("p8"),
    ("name_project", """
SELECT DISTINCT ON (j.project_dim_id) j.project_dim_id, p.pv_project_dim_id AS pv, f.portfolio_dim_id AS pf
FROM portfolio_dim f JOIN p8 p USING (portfolio_dim_id), jira_project_dim j
WHERE p.is_maintenance_project AND lower(p.category) <> 'services'
  AND replace(trim(j.project_name), ' ', '') ILIKE concat('%', replace(trim(f.portfolio_name), ' ', '%'), '%')
ORDER BY j.project_dim_id, p.pv_project_dim_id"""),
    ("u17", _laid_over("u16", "name_project", "project_dim_id", "TRUE")),
)


@query("issue_portfolio_by_name", f"SELECT {ISSUE_COLS} FROM u17", ctes=U17_CTES)
def issue_portfolio_by_name(spark, sf_dir):
    t = _t(spark, sf_dir)
    projects = mp.maintenance_projects(d.projects_dim(t))
    issues = mp.issue_portfolio_by_epic(d.sprint_issues(t), d.epic_dim(t), projects, d.portfolio_dim(t))
    return mp.issue_portfolio_by_name(issues, d.jira_project_dim(t), projects, d.portfolio_dim(t)) \
        .select(*ISSUE_COLS.split(", "))


@query("consultant_flag", """
SELECT resource_dim_id, CASE WHEN is_consultant IS NULL
    THEN coalesce(lower(type) LIKE '%contractor%' OR lower(type) LIKE '%consultant%', FALSE)
    ELSE is_consultant END AS is_consultant
FROM resource_dim""")
def consultant_flag(spark, sf_dir):
    return mp.consultant_flag(d.resource_dim(_t(spark, sf_dir))).select("resource_dim_id", "is_consultant")


@query("remove_system_users", """
FROM user_team_map m ANTI JOIN (SELECT resource_dim_id FROM resource_dim WHERE type IS NULL) x ON x.resource_dim_id = m.user_dim_id
SELECT m.*""")
def remove_system_users(spark, sf_dir):
    t = _t(spark, sf_dir)
    return mp.remove_system_users(d.user_team_map(t), d.resource_dim(t))


@query("team_patches", """
SELECT team_dim_id, team_name,
       CASE WHEN team_name NOT LIKE '%Artex%' THEN FALSE ELSE is_active END AS is_active,
       CASE WHEN team_name = 'Artex' THEN 83 ELSE jira_rapid_view_id END AS jira_rapid_view_id
FROM team_dim""")
def team_patches(spark, sf_dir):
    return mp.team_patches(d.team_dim(_t(spark, sf_dir))).select(
        "team_dim_id", "team_name", "is_active", "jira_rapid_view_id")
