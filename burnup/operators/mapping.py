"""Dimension clean-up and mapping: U8, U9, U16-U20 (with joins J7, J8, J15) and C9."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burnup.functions.expr import contains_ci, last_path_segment, like_any_ci, squeeze_lower
from burnup.operators.apply import delete_matching, flag_matching, insert_if_absent, set_where, update_from


def maintenance_projects(projects: DataFrame) -> DataFrame:
    """U8: ``is_maintenance_project`` = name contains '(ongoing)' (any case), for rows
    where the flag is NULL or false."""
    f = F.col("is_maintenance_project")
    return set_where(projects, f.isNull() | (f == F.lit(False)),
                     {"is_maintenance_project": contains_ci("pv_project_name", "(ongoing)")})


def time_reportable(tasks: DataFrame, projects: DataFrame) -> DataFrame:
    """Tasks of projects whose category is exactly 'Services' stop being reportable."""
    services = projects.where(F.col("category") == F.lit("Services")).select("pv_project_dim_id")
    return flag_matching(tasks, services, "pv_project_dim_id", "is_time_reportable", False,
                         guard=F.col("is_time_reportable") == F.lit(True))


def _projects_with_portfolio(projects: DataFrame, portfolios: DataFrame) -> DataFrame:
    """projects LEFT JOIN portfolio: the portfolio id is the *portfolio table's* one."""
    pd_ = portfolios.select(F.col("portfolio_dim_id").alias("__pf"), "portfolio_name")
    return projects.join(pd_, projects["portfolio_dim_id"] == pd_["__pf"], "left") \
        .select("pv_project_dim_id", "pv_aha_id", "pv_project_name", "category",
                "is_maintenance_project", F.col("__pf").alias("pf_portfolio_dim_id"), "portfolio_name")


def epic_project_candidates(epics: DataFrame, projects: DataFrame, portfolios: DataFrame) -> DataFrame:
    """Epic -> project where last path segment of the reference = aha id OR the whole
    reference = aha id. The OR is turned into an equi join on the distinct pair of
    keys (an OR condition would force a nested-loop join); one row per epic,
    the smallest project id wins when several match."""
    keys = epics.select("epic_dim_id", F.explode(F.array_distinct(F.array(
        last_path_segment("aha_reference"), F.col("aha_reference")))).alias("__aha"))
    pp = _projects_with_portfolio(projects, portfolios).where(F.col("pv_aha_id").isNotNull())
    # Both sides grow; by their files' sizes Spark would broadcast one through the driver.
    j = keys.join(pp.hint("merge"), keys["__aha"] == pp["pv_aha_id"])
    return j.groupBy("epic_dim_id").agg(F.min_by(
        F.struct("pv_project_dim_id", "pf_portfolio_dim_id"), "pv_project_dim_id").alias("__p")) \
        .select("epic_dim_id", F.col("__p.pv_project_dim_id").alias("pv_project_dim_id"),
                F.col("__p.pf_portfolio_dim_id").alias("portfolio_dim_id"))


def issue_portfolio_by_epic(issues: DataFrame, epics: DataFrame, projects: DataFrame,
                            portfolios: DataFrame) -> DataFrame:
    """U16: active issues without portfolio take portfolio and project of their epic's
    project, and ``is_maintenance = false``."""
    cand = epic_project_candidates(epics, projects, portfolios)
    guard = (F.col("is_active") == F.lit(True)) & F.col("portfolio_dim_id").isNull()
    return update_from(issues, cand, "epic_dim_id", {
        "portfolio_dim_id": "portfolio_dim_id", "pv_project_dim_id": "pv_project_dim_id",
        "is_maintenance": F.lit(False)}, guard=guard)


def like_pattern_matches(names: DataFrame, name_col: str, patterns: DataFrame,
                         pattern_col: str) -> DataFrame:
    """Pairs (names row, patterns row) with ``name LIKE pattern`` - without a nested loop.

    Every pattern is blocked on its longest literal piece (text between ``%`` and
    ``_``): a name can only match if it contains that piece. Names are cut into their
    substrings of exactly the lengths that occur as piece lengths, and those are equi
    joined to the pieces; the LIKE test then runs on the candidates only. Patterns
    without any literal piece match on length alone and are joined on a length bound.
    The result is exact: the blocking only removes pairs that cannot match.
    """
    pieces = F.split(F.col(pattern_col), "[%_]")
    longest = F.array_sort(F.transform(pieces, lambda x: F.struct((-F.length(x)).alias("l"), x.alias("p"))))
    pat = patterns.withColumn("__key", longest[0]["p"]).withColumn("__klen", F.length("__key"))
    lit_pat = pat.where(F.col("__klen") > 0)
    wild_pat = pat.where(F.coalesce(F.col("__klen"), F.lit(0)) == 0) \
        .where(F.col(pattern_col).isNotNull())

    nm = names.withColumn("__nlen", F.length(name_col))
    lengths = lit_pat.select(F.col("__klen").alias("__L")).distinct()
    nl = nm.select("*", F.explode(F.sequence(F.lit(1), F.greatest(F.col("__nlen"), F.lit(1)))).alias("__L")) \
        .where(F.col("__L") <= F.col("__nlen")) \
        .join(lengths, "__L", "left_semi")
    subs = nl.select("*", F.explode(F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.col("__nlen") - F.col("__L") + 1),
        lambda i: F.substring(F.col(name_col), i, F.col("__L"))))).alias("__sub"))
    cand = subs.join(lit_pat, (subs["__L"] == lit_pat["__klen"]) & (subs["__sub"] == lit_pat["__key"]))
    cand = cand.drop("__L", "__sub", "__key", "__klen", "__nlen")
    # Wildcard-only patterns ('%', '_%_' ...): fixed minimum (and with no '%' exact)
    # length. Their number is bounded by the longest pattern, so the join key is length.
    w = wild_pat.select("*", F.length(F.replace(F.col(pattern_col), F.lit("%"), F.lit(""))).alias("__min"),
                        F.col(pattern_col).contains("%").alias("__open"))
    wl = nm.select("*", F.explode(F.sequence(F.lit(0), F.col("__nlen"))).alias("__m"))
    wc = wl.join(w, wl["__m"] == w["__min"]).where(F.col("__open") | (F.col("__nlen") == F.col("__min"))) \
        .drop("__m", "__min", "__open", "__key", "__klen", "__nlen")
    out = cand.unionByName(wc)
    return out.where(F.expr(f"`{name_col}` LIKE `{pattern_col}`"))


def name_project_candidates(jira_projects: DataFrame, projects: DataFrame, portfolios: DataFrame) -> DataFrame:
    """Jira project -> maintenance project (non-services) whose *portfolio name*, blanks
    as '%', occurs in the squeezed Jira project name. One row per Jira project; the
    smallest project id wins: first of each pattern, then of each name, so no name meets
    all projects of a portfolio."""
    pp = _projects_with_portfolio(projects, portfolios) \
        .where((F.lower("category") != F.lit("services")) & (F.col("is_maintenance_project") == F.lit(True)))
    pp = pp.withColumn("__pattern", F.concat(F.lit("%"), squeeze_lower("portfolio_name", "%"), F.lit("%")))
    first = F.min_by(F.struct("pv_project_dim_id", "pf_portfolio_dim_id"), "pv_project_dim_id").alias("__p")
    patterns = pp.groupBy("__pattern").agg(first).select("__pattern", "__p.*")
    names = jira_projects.select(squeeze_lower("project_name").alias("__name")).distinct()
    matched = like_pattern_matches(names, "__name", patterns, "__pattern").groupBy("__name").agg(first)
    jp = jira_projects.select("project_dim_id", squeeze_lower("project_name").alias("__name"))
    return jp.join(matched.hint("merge"), "__name").groupBy("project_dim_id").agg(F.min_by("__p", "__p.pv_project_dim_id").alias("__p")) \
        .select("project_dim_id", F.col("__p.pv_project_dim_id").alias("pv_project_dim_id"),
                F.col("__p.pf_portfolio_dim_id").alias("portfolio_dim_id"))


def issue_portfolio_by_name(issues: DataFrame, jira_projects: DataFrame, projects: DataFrame,
                            portfolios: DataFrame) -> DataFrame:
    """U17 (after U16): active issues still without portfolio take it from a maintenance
    project matched by name, with ``is_maintenance = true``."""
    cand = name_project_candidates(jira_projects, projects, portfolios)
    guard = (F.col("is_active") == F.lit(True)) & F.col("portfolio_dim_id").isNull()
    return update_from(issues, cand, "project_dim_id", {
        "portfolio_dim_id": "portfolio_dim_id", "pv_project_dim_id": "pv_project_dim_id",
        "is_maintenance": F.lit(True)}, guard=guard)


def consultant_flag(resources: DataFrame) -> DataFrame:
    """Where unset, consultant = type contains 'contractor' or 'consultant'."""
    return set_where(resources, F.col("is_consultant").isNull(),
                     {"is_consultant": like_any_ci("type", ["contractor", "consultant"])})


def remove_system_users(members: DataFrame, resources: DataFrame) -> DataFrame:
    """Drop memberships of users whose resource has no type."""
    bad = resources.where(F.col("type").isNull()).select(F.col("resource_dim_id").alias("user_dim_id"))
    return delete_matching(members, bad, "user_dim_id")


# Hand-made patches (fixed values).
TEAM_NAME_KEEP_ACTIVE = "%Artex%"
TEAM_RAPID_VIEW = ("Artex", 83)
PROJECT_AHA_PATCHES = [
    ("Periop Surgical History (Dev Partner)", "200"),
    ("SOC2 Compliance", "216"),
    ("IPL Editor Tool", "1"),
]


def team_patches(teams: DataFrame) -> DataFrame:
    """U20 (teams): inactive unless the name contains 'Artex'; rapid view id of 'Artex'."""
    t = set_where(teams, ~F.col("team_name").like(TEAM_NAME_KEEP_ACTIVE), {"is_active": F.lit(False)})
    name, view = TEAM_RAPID_VIEW
    return set_where(t, F.col("team_name") == F.lit(name), {"jira_rapid_view_id": F.lit(view)})


def project_patches(projects: DataFrame) -> DataFrame:
    """U20 (projects): fixed aha ids by project name, only where still NULL."""
    out = projects
    for name, aha in PROJECT_AHA_PATCHES:
        out = set_where(out, (F.col("pv_project_name") == F.lit(name)) & F.col("pv_aha_id").isNull(),
                        {"pv_aha_id": F.lit(aha)})
    return out


def dim_cleanup(tables: dict[str, DataFrame], holiday_seed: DataFrame | None = None) -> dict[str, DataFrame]:
    """U20/S10 -> U8 -> U9 -> U16, U17 -> U18 -> U19, in this order.

    ``tables`` holds team_dim, projects_dim, project_tasks, portfolio_dim, epic_dim,
    jira_project_dim, sprint_issues, resource_dim, user_team_map (and holiday_dim
    when ``holiday_seed`` is given). Returns the changed tables.
    """
    out = dict(tables)
    out["team_dim"] = team_patches(out["team_dim"])
    projects = project_patches(out["projects_dim"])
    if holiday_seed is not None:
        out["holiday_dim"] = insert_if_absent(out["holiday_dim"], holiday_seed, "holiday_date")
    projects = maintenance_projects(projects)
    out["projects_dim"] = projects
    out["project_tasks"] = time_reportable(out["project_tasks"], projects)
    issues = issue_portfolio_by_epic(out["sprint_issues"], out["epic_dim"], projects, out["portfolio_dim"])
    out["sprint_issues"] = issue_portfolio_by_name(issues, out["jira_project_dim"], projects,
                                                   out["portfolio_dim"])
    out["resource_dim"] = consultant_flag(out["resource_dim"])
    out["user_team_map"] = remove_system_users(out["user_team_map"], out["resource_dim"])
    return out

