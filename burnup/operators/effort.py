"""Effort side: C2 time spent per feature, C3 planned hours, the invariants A12/A13,
user and sprint lists A5/A6, C4 population, payloads, dead letter (U22-U24, C6), C5."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from burnup.functions.expr import flag_set, flag_unset, json_decimal, lit_date, lit_ts, pg_to_char
from burnup.operators.apply import flag_matching, one_row_per_key
from burnup.operators.intervals import days_in_ranges
from burnup.operators.nesting import CHUNK_FIELD, bounded_listagg, explode_project_entries, timesheet_payload
from burnup.operators.sprints import members_covering
from burnup.session import cut_lineage

# Joins of two tables that both grow are hinted as sort-merge joins: by the size of a compressed file Spark takes
# a million resources for small enough to broadcast, and a broadcast passes through the driver.

# The hours of a developer day the warehouse tests assert, and the
# earliest sprint end the generator looks at.
HOURS_PER_DAY = 8
SPRINT_END_FLOOR = dt.date(2020, 5, 14)

FEATURE_KEYS = ["team_dim_id", "sprint_number", "portfolio_dim_id", "pv_project_dim_id", "task_ppm_id",
                "is_maintenance"]


def feature_time_spent(sprints: DataFrame, issues: DataFrame, hours_per_day: int = HOURS_PER_DAY) -> DataFrame:
    """C2 [INFERRED contract]: hours per developer per feature for every pending sprint.

    A feature is (portfolio, project, task, maintenance flag) of the active issues that
    have a portfolio. Its weight is its story points over all such points of the
    (team, sprint); ``time_spent = hours_per_day * actual_sprint_days * weight``, with an
    equal split when the sprint has no points. ``sprints`` is the table after C1.
    """
    pend = sprints.where(flag_unset("is_metrics_updated")).select(
        "team_dim_id", "sprint_number", "actual_sprint_days")
    pts = json_decimal("ticket_details", "fields", "customfield_10411")
    feats = (issues.where((F.col("is_active") == F.lit(True)) & F.col("portfolio_dim_id").isNotNull())
             .join(pend.select("team_dim_id", "sprint_number"), ["team_dim_id", "sprint_number"], "left_semi")
             .groupBy(*FEATURE_KEYS).agg(F.coalesce(F.sum(pts), F.lit(0)).alias("fpts")))
    # Totals per sprint over the (few) features of that sprint: a window on the already
    # aggregated features, so the issue aggregation runs once.
    w = Window.partitionBy("team_dim_id", "sprint_number")
    feats = feats.withColumn("__total", F.sum("fpts").over(w)).withColumn("__nfeat", F.count(F.lit(1)).over(w))
    j = feats.join(pend, ["team_dim_id", "sprint_number"])
    weight = F.when(F.col("__total") > 0, F.col("fpts").cast("double") / F.col("__total").cast("double")) \
        .otherwise(F.lit(1.0) / F.col("__nfeat").cast("double"))
    spent = (F.lit(float(hours_per_day)) * F.col("actual_sprint_days").cast("double")) * weight
    return j.select(*FEATURE_KEYS, spent.alias("time_spent"))


def timesheet_sprint_rows(sprints: DataFrame, as_of, floor: dt.date = SPRINT_END_FLOOR) -> DataFrame:
    """Sprints that are closed (metrics done), not yet populated, and ended by ``as_of``."""
    as_of_date = as_of.date() if isinstance(as_of, dt.datetime) else as_of
    return sprints.where(flag_unset("is_timesheet_populated") & flag_set("is_metrics_updated")
                         & (F.col("sprint_end_date") > lit_date(floor).cast("timestamp_ntz"))
                         & (F.col("sprint_end_date") <= lit_date(as_of_date).cast("timestamp_ntz")))


def timesheet_sprint_numbers(sprints: DataFrame, as_of) -> DataFrame:
    """A6 as rows: the distinct sprint numbers to generate timesheets for."""
    return timesheet_sprint_rows(sprints, as_of).select("sprint_number").distinct()


def timesheet_sprint_list(sprints: DataFrame, as_of) -> DataFrame:
    """The sprint numbers as text lists (in batches)."""
    return bounded_listagg(timesheet_sprint_numbers(sprints, as_of), [], "sprint_number", "sprint_number",
                           batch_col="sprint_batch")


def timesheet_users(sprints: DataFrame, members: DataFrame, resources: DataFrame, as_of) -> DataFrame:
    """A5 as rows: per resource the earliest start of a qualifying sprint it fully covers
    (non-strict containment against the sprint *end* date, J5)."""
    a = timesheet_sprint_rows(sprints, as_of)
    j = members_covering(a, members, as_of, strict=False, end_col="sprint_end_date")
    r = resources.select("resource_dim_id", "resource_ppm_id")
    j = j.join(r.hint("merge"), F.col("user_dim_id") == F.col("resource_dim_id"))
    return j.groupBy("resource_ppm_id").agg(F.min("sprint_start_date").alias("sprint_start_date"))


def timesheet_user_list(sprints, members, resources, as_of) -> DataFrame:
    """A5: user id lists (in batches) and the overall earliest start as YYYY/MM/DD."""
    users = timesheet_users(sprints, members, resources, as_of)
    first = users.select(F.min("sprint_start_date")).scalar()
    g = bounded_listagg(users, [], "resource_ppm_id", "user_list", batch_col="user_batch")
    return g.select("user_batch", "user_list", pg_to_char(first, "YYYY/MM/DD").alias("min"))


def working_days(start: Column, end: Column, holidays: Column) -> Column:
    """Array of the weekdays in [start, end] that are not mandatory holidays."""
    return F.filter(day_range(F.to_date(start), F.to_date(end)), lambda x: (F.weekday(x) < 5) & ~F.array_contains(holidays, x))


def timesheet_plan(sprints: DataFrame, sprint_numbers: DataFrame | None, fact: DataFrame, members: DataFrame,
                   resources: DataFrame, teams: DataFrame, projects: DataFrame, holidays: Column,
                   as_of) -> DataFrame:
    """C3 [INFERRED contract]: planned hours per member x working day x feature.

    For every sprint whose number is listed: the members covering it (strict, J4, the
    same rule as the team size A4) times the working days in [actual start, complete]
    without holidays times the sprint's features, ``per_day_time_spent = time_spent /
    actual_sprint_days``. The output size is inherent: members x days x features.
    """
    if sprint_numbers is not None:  # None: the sprints of every number
        sprints = sprints.join(sprint_numbers, "sprint_number", "left_semi")
    s = sprints.select(
        "team_dim_id", "sprint_number", "sprint_name", "sprint_start_date", "sprint_complete_date",
        "actual_sprint_start_date", "actual_sprint_days")
    m = members_covering(s, members, as_of, strict=True)
    r = resources.select("resource_dim_id", "resource_ppm_id", F.col("primary_role_id").alias("resource_role_id"))
    t = teams.select("team_dim_id", "team_name")
    # Lookups go on the narrow sides before the one join that multiplies rows
    # (member-days x features), so the wide result is produced once and not reshuffled.
    m = m.join(r.hint("merge"), F.col("user_dim_id") == F.col("resource_dim_id")).join(t, "team_dim_id")
    s_days = m.withColumn("__hol", holidays).select(
        "team_dim_id", "sprint_number", "sprint_name", "team_name", "actual_sprint_days", "resource_ppm_id",
        "resource_role_id", F.explode(working_days(F.col("actual_sprint_start_date"), F.col("sprint_complete_date"),
                                                   F.col("__hol"))).alias("date_of_sprint"))
    p = projects.select(F.col("pv_project_dim_id").alias("__pv"),
                        F.col("project_ppm_id").try_cast("bigint").alias("project_ppm_id"))
    p = one_row_per_key(p, "__pv", ["project_ppm_id"])
    f = fact.join(p.hint("merge"), F.col("pv_project_dim_id") == F.col("__pv"), "left")
    j = s_days.join(f, ["team_dim_id", "sprint_number"])
    per_day = F.try_divide(F.col("time_spent"), F.col("actual_sprint_days").cast("double"))
    return j.select("resource_ppm_id", "date_of_sprint", per_day.alias("per_day_time_spent"),
                    "project_ppm_id", "task_ppm_id", "resource_role_id", "team_name", "sprint_name",
                    "team_dim_id", "sprint_number", "portfolio_dim_id")


PLAN_COLUMNS = ("resource_ppm_id BIGINT, date_of_sprint DATE, per_day_time_spent DOUBLE, project_ppm_id BIGINT, task_ppm_id BIGINT, "
                "resource_role_id BIGINT, team_name STRING, sprint_name STRING, team_dim_id BIGINT, sprint_number BIGINT, portfolio_dim_id BIGINT")


def register_timesheet_functions(plan: DataFrame, list_function: str = "timesheet_entries", sprint_function: str = "sprint_entries") -> None:
    """V4: C3 as SQL table functions of the session.

    ``timesheet_entries('14, 15')`` takes the text list of sprint numbers that A6 makes, as the
    warehouse's routine does; ``sprint_entries(14)`` one number, and can be called for each row of
    another table (``JOIN LATERAL``). ``plan`` is C3 over all sprints, a plan that hasn't run: a call's argument becomes
    a filter or a join key in it, so only the sprints asked for are planned, and calls per row
    are one equi join.
    """
    spark = plan.sparkSession
    view = f"{list_function}_plan"
    plan.createOrReplaceTempView(view)
    names = ", ".join(f"p.{c.split()[0]}" for c in PLAN_COLUMNS.split(", "))
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION {list_function}(numbers STRING) RETURNS TABLE ({PLAN_COLUMNS})
        RETURN SELECT {names} FROM {view} p WHERE array_contains(transform(split(numbers, ','), x -> try_cast(trim(x) AS BIGINT)), p.sprint_number)""")
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION {sprint_function}(number BIGINT) RETURNS TABLE ({PLAN_COLUMNS})
        RETURN SELECT {names} FROM {view} p WHERE p.sprint_number = number""")


def team_daily_hours_check(fact: DataFrame, sprints: DataFrame) -> DataFrame:
    """Per (team, sprint) ``sum(time_spent) / actual_sprint_days`` as whole hours
    (features with a portfolio only); the warehouse test expects 8 everywhere."""
    s = sprints.select("team_dim_id", "sprint_number", "actual_sprint_days")
    j = fact.where(F.col("portfolio_dim_id").isNotNull()).join(s, ["team_dim_id", "sprint_number"])
    g = j.groupBy("team_dim_id", "sprint_number", "actual_sprint_days").agg(F.sum("time_spent").alias("__s"))
    hr = F.try_divide(F.col("__s"), F.col("actual_sprint_days").cast("double")).cast("decimal(10,0)")
    return g.select("team_dim_id", "sprint_number", hr.cast("bigint").alias("hr"))


def team_hours_vs_capacity_check(plan: DataFrame, fact: DataFrame, sprints: DataFrame) -> DataFrame:
    """Planned hours of a (team, sprint) against time spent x number of developers."""
    planned = plan.groupBy("team_dim_id", "sprint_number", "team_name", "sprint_name").agg(
        F.sum("per_day_time_spent").alias("__p"))
    s = sprints.select("team_dim_id", "sprint_number", "number_of_devs")
    cap = fact.where(F.col("portfolio_dim_id").isNotNull()).join(s, ["team_dim_id", "sprint_number"]) \
        .groupBy("team_dim_id", "sprint_number", "number_of_devs").agg(F.sum("time_spent").alias("__t"))
    j = planned.join(cap, ["team_dim_id", "sprint_number"])
    return j.select("team_dim_id", "sprint_number", "team_name", "sprint_name",
                    F.col("__p").cast("decimal(10,0)").cast("bigint").alias("planned_hr"),
                    (F.col("__t") * F.col("number_of_devs")).cast("decimal(10,0)").cast("bigint")
                    .alias("capacity_hr"))


def as_timesheet_rows(timesheets: DataFrame) -> DataFrame:
    """Timesheets as header + entry rows: nested input is exploded (N1), flat rows pass."""
    return explode_project_entries(timesheets) if "entriesProject" in timesheets.columns else timesheets


def requested_timesheets(timesheets: DataFrame, users: DataFrame) -> DataFrame:
    """S13 for the generator: timesheets of the A5 users whose header ends on or after the
    overall earliest sprint start (the single start date of the service call)."""
    first = users.select(F.to_date(F.min("sprint_start_date"))).scalar()
    u = users.select(F.col("resource_ppm_id").alias("userId"))
    return timesheets.join(u.hint("merge"), "userId", "left_semi").where(F.col("endDate") >= first)


def day_range(start: Column, end: Column) -> Column:
    """The days from start to end as an array; none when start is after end."""
    return F.when(start <= end, F.sequence(start, end))


def header_days(headers: DataFrame, start: str = "startDate", end: str = "endDate",
                day: str = "__day") -> DataFrame:
    """One row per header and day of its [start, end] range."""
    return headers.where(F.col(start) <= F.col(end)) \
        .withColumn(day, F.explode(day_range(F.col(start), F.col(end))))


def timesheet_population(plan: DataFrame, timesheet_data: DataFrame) -> DataFrame:
    """C4: planned rows inside an existing header (J10), with the id of an entry already
    booked for the same user, project, task, date and timesheet (J11), else 0.

    The header range becomes pieces of a range cover, whatever its length, so the first join is
    an equi join on the user and a piece. The second is on all five columns: one user's day may
    hold any number of rows on either side."""
    dist_ts = timesheet_data.select("timesheetId", "userId", "startDate", "endDate").distinct()
    j = days_in_ranges(plan, dist_ts, [("resource_ppm_id", "userId")], "date_of_sprint", "startDate", "endDate")
    pv = timesheet_data.where(F.col("entryId").isNotNull()).select(
        F.col("timesheetId").alias("__ts"), F.col("userId").alias("__u"), F.col("startDate").alias("__s"),
        F.col("endDate").alias("__e"), F.col("entryId").alias("__entry"), F.col("entryDate").alias("__d"),
        F.col("project_ppm_id").alias("__p"), F.col("task_ppm_id").alias("__t"))
    cond = ((j["resource_ppm_id"] == pv["__u"]) & (j["date_of_sprint"] == pv["__d"])
            & (j["project_ppm_id"] == pv["__p"]) & (j["task_ppm_id"] == pv["__t"])
            & (j["timesheetId"] == pv["__ts"]) & j["date_of_sprint"].between(pv["__s"], pv["__e"]))
    k = j.join(pv.hint("merge"), cond, "left")
    return k.select(
        F.lit(0).alias("companyId"), F.lit(1).alias("entryTypeId"), "timesheetId",
        F.col("resource_ppm_id").alias("userId"), F.col("project_ppm_id").alias("level1Id"),
        F.col("task_ppm_id").alias("level2Id"), pg_to_char("date_of_sprint", "YYYY/MM/DD").alias("entryDate"),
        F.coalesce(F.col("__entry"), F.lit(0).cast("bigint")).alias("entryId"),
        F.col("resource_role_id").alias("level3Id"), F.col("per_day_time_spent").alias("entryHours"))


def mark_populated(sprints: DataFrame, sprint_numbers: DataFrame) -> DataFrame:
    """Every sprint (any team) with a listed number becomes populated."""
    return flag_matching(sprints, sprint_numbers, "sprint_number", "is_timesheet_populated", True)


DEAD_LETTER_COLS = ["companyId", "entryTypeId", "timesheetId", "userId", "level1Id", "level2Id", "entryDate",
                    "entryId", "level3Id", "entryHours", "created_date"]


CHUNK_KEYS = ["timesheetId", "userId", "chunk"]


def chunk_answers(acks: DataFrame, ok: bool) -> DataFrame:
    """The payload chunks (timesheetId, userId, chunk) whose every answer was ``ok``, or any was not."""
    g = acks.groupBy(*CHUNK_KEYS).agg(F.min(F.col("ok").cast("int")).alias("__ok"))
    return g.where(F.col("__ok") == int(ok)).select(*CHUNK_KEYS)


def dead_letter_append(dead_letter: DataFrame, rows: DataFrame, acks: DataFrame, as_of) -> DataFrame:
    """The rows of rejected payload chunks go to the dead letter unless their (timesheet,
    user) is already there (anti join on both columns, not on a concatenated text); missing
    hours become 0 and ``created_date`` is ``as_of``. Rows of accepted chunks never go there,
    so they are not sent again."""
    bad = rows.withColumn("chunk", F.col(CHUNK_FIELD)).join(chunk_answers(acks, False).hint("merge"), CHUNK_KEYS, "left_semi") \
        .join(dead_letter.select("timesheetId", "userId").hint("merge"), ["timesheetId", "userId"], "left_anti")
    new = bad.select(
        "companyId", "entryTypeId", "timesheetId", "userId", "level1Id", "level2Id",
        F.to_date("entryDate", "yyyy/MM/dd").alias("entryDate"), "entryId", "level3Id",
        F.coalesce(F.col("entryHours"), F.lit(0.0)).alias("entryHours"), lit_ts(as_of).alias("created_date"))
    return dead_letter.unionByName(new.select(*[F.col(c).cast(dead_letter.schema[c].dataType) for c in
                                                DEAD_LETTER_COLS]))


def dead_letter_clear(dead_letter: DataFrame, acks: DataFrame) -> DataFrame:
    """The rows of a retried chunk that was accepted leave the dead letter."""
    keyed = dead_letter.withColumn("chunk", pg_to_char("entryDate", "YYYY/MM/DD"))
    return keyed.join(chunk_answers(acks, True).hint("merge"), CHUNK_KEYS, "left_anti").select(*dead_letter.columns)


def dead_letter_rows(dead_letter: DataFrame) -> DataFrame:
    """The retry set in payload-row form (dates back to YYYY/MM/DD text)."""
    return dead_letter.select("companyId", "entryTypeId", "timesheetId", "userId", "level1Id", "level2Id",
                              pg_to_char("entryDate", "YYYY/MM/DD").alias("entryDate"), "entryId", "level3Id",
                              "entryHours")


def apply_push_result(dead_letter: DataFrame, rows: DataFrame, acks_for, as_of,
                      payload: DataFrame | None = None) -> DataFrame:
    """Push the new payloads, dead-letter the rejected chunks (U23), then retry the whole
    dead letter - which already holds this run's failures - and drop accepted chunks (U24).

    ``acks_for(payload)`` returns the acknowledgement table (timesheetId, userId, chunk,
    ok, error) for a payload table; it stands in for the push service. ``rows`` and
    ``payload`` (built from the rows unless given) should be written tables. The dead
    letter after the push is written to the shared folder when this is called: the retry
    reads it and does not replay the generation.
    """
    first = acks_for(timesheet_payload(rows) if payload is None else payload)
    dl = cut_lineage(dead_letter_append(dead_letter, rows, first, as_of), "dead_letter")
    second = acks_for(timesheet_payload(dead_letter_rows(dl)))
    # A retry that fails again would be appended (U23), but every retried pair is already
    # in the dead letter, so that append adds nothing; only the accepted chunks leave.
    return dead_letter_clear(dl, second)


class Results(dict):
    """Results by name; one given as a function is made when it is first read, and kept."""

    def __getitem__(self, name: str) -> DataFrame:
        value = super().__getitem__(name)
        if callable(value):
            value = self[name] = value()
        return value


def generate_timesheets(sprints, issues, members, resources, teams, projects, generator_timesheets,
                        holidays: Column, acks_for, as_of, populate: bool = True) -> Results:
    """C1 -> C2 -> U7 -> A5 -> S13 -> N1 -> A6 -> C3 -> C4 -> N4 -> push -> U22.

    The generated rows and their payload are written to the shared folder when they are
    first read, once; the other results are plans, and the sprint table needs neither. For the dead letter and the retries call
    ``apply_push_result`` with ``rows`` and ``payload``. Without users nothing is sent, and
    no sprint is marked populated (U22).

    ``populate=False`` stops after closing the sprints (metrics and time spent only):
    the source runs the generation step unconditionally on one side of an unresolved
    merge and only in a staging environment on the other; here it is this flag.
    """
    from burnup.operators.sprints import close_sprints, sprint_metrics
    s1 = sprint_metrics(sprints, issues, members, holidays, as_of)
    fact = feature_time_spent(s1, issues)
    s2 = close_sprints(s1)
    if not populate:
        return Results(sprints=s2, fact=fact)
    users = timesheet_users(s2, members, resources, as_of)
    data = requested_timesheets(as_timesheet_rows(generator_timesheets), users)
    numbers = timesheet_sprint_numbers(s2, as_of)
    plan = timesheet_plan(s2, numbers, fact, members, resources, teams, projects, holidays, as_of)
    sent = numbers.where(users.select(F.count(F.lit(1))).scalar() > 0)
    out = Results(sprints=mark_populated(s2, sent), fact=fact, plan=plan)
    out["rows"] = lambda: cut_lineage(timesheet_population(plan, data), "rows")
    out["payload"] = lambda: cut_lineage(timesheet_payload(out["rows"]), "payload")
    out["acks"] = lambda: acks_for(out["payload"])
    return out


def draft_timesheet_population(plan: DataFrame, timesheets: DataFrame) -> DataFrame:
    """J12 (draft variant of C4): plan rows joined to headers LEFT JOIN their entries with a
    conditional condition: a header row without entry matches on the header's date range,
    an entry row only on its own date. An entry's date is a range of one day, so both cases
    are one equi join on the user and a piece of the range cover."""
    if "entriesProject" in timesheets.columns:
        from burnup.operators.nesting import draft_entry_rows
        hdr = timesheets.select("timesheetId", "userId", "startDate", "endDate")
        ent = draft_entry_rows(timesheets).select("timesheetId", "entryId", "entryDate")
        td = hdr.join(ent, "timesheetId", "left")
    else:  # flat already: a header without entries has one row with none
        td = timesheets.select("timesheetId", "userId", "startDate", "endDate", "entryId", "entryDate")
    ranges = td.withColumns({"__from": F.coalesce("entryDate", "startDate"), "__to": F.coalesce("entryDate", "endDate")})
    p = plan.select("resource_ppm_id", "date_of_sprint", "per_day_time_spent", "project_ppm_id", "task_ppm_id",
                    "resource_role_id")
    j = days_in_ranges(p, ranges, [("resource_ppm_id", "userId")], "date_of_sprint", "__from", "__to")
    return j.select(pg_to_char("date_of_sprint", "YYYY/MM/DD").alias("date_of_sprint"), "resource_ppm_id",
                    "per_day_time_spent", "project_ppm_id", "task_ppm_id", "resource_role_id", "timesheetId",
                    F.col("entryId").alias("entryid"), pg_to_char("entryDate", "YYYY/MM/DD").alias("entrydate"))
