"""Sprint metrics: F1, A1-A4, W1, U1-U7 and the one-pass composite C1."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burnup.functions.expr import (POINTS_TYPE, flag_unset, json_decimal, json_text, json_timestamp, lit_ts,
                                   weekdays_between, working_days_between)
from burnup.operators.apply import set_where, update_from
from burnup.operators.carry import row_before

KEY = ["sprint_number", "team_dim_id"]
POINTS_FIELD = ("fields", "customfield_10411")
RESOLUTION_FIELD = ("fields", "resolutiondate")


# The two fields read from the issue document, parsed once per row into a struct
# (text values: numbers keep their text, JSON null and malformed documents give NULL).
TICKET_SCHEMA = "struct<fields: struct<customfield_10411: string, resolutiondate: string>>"


def parse_ticket(issues: DataFrame, doc: str = "ticket_details") -> DataFrame:
    """Add ``__pts`` (decimal points), ``__res_txt`` and ``__res`` (zone-less timestamp)."""
    t = F.from_json(F.col(doc), TICKET_SCHEMA)
    return issues.withColumn("__t", t).select(
        "*", F.col("__t.fields.customfield_10411").try_cast(POINTS_TYPE).alias("__pts"),
        F.col("__t.fields.resolutiondate").alias("__res_txt"),
        F.col("__t.fields.resolutiondate").try_cast("timestamp_ntz").alias("__res")).drop("__t")


def _points(doc="ticket_details") -> Column:
    return json_decimal(doc, *POINTS_FIELD)


def _resolution(doc="ticket_details") -> Column:
    return json_timestamp(doc, *RESOLUTION_FIELD)


def pending_sprints(sprints: DataFrame) -> DataFrame:
    """distinct (sprint, team) whose metrics are not updated yet."""
    return sprints.where(flag_unset("is_metrics_updated")).select(*KEY).distinct()


def _pending_numbers(sprints: DataFrame) -> DataFrame:
    return sprints.where(flag_unset("is_metrics_updated")).select("sprint_number")


def estimated_points(issues: DataFrame, sprints: DataFrame) -> DataFrame:
    """A1: points of active issues whose sprint *number* is pending for any team."""
    i = parse_ticket(issues.where(F.col("is_active") == F.lit(True))
                     .join(_pending_numbers(sprints), "sprint_number", "left_semi"))
    return i.groupBy(*KEY).agg(F.sum("__pts").alias("estimated_points"))


def _issues_in_pending_sprints(issues: DataFrame, sprints: DataFrame) -> DataFrame:
    s = sprints.where(flag_unset("is_metrics_updated")).select(
        *KEY, "sprint_start_date", "sprint_complete_date")
    return parse_ticket(issues.where(F.col("is_active") == F.lit(True)).join(s, KEY))


def actual_completed_points(issues: DataFrame, sprints: DataFrame, as_of) -> DataFrame:
    """A2: points resolved inside [start, complete] of their own (sprint, team)."""
    j = _issues_in_pending_sprints(issues, sprints)
    res = F.coalesce(F.col("__res"), lit_ts(as_of))
    j = j.where(F.col("__res_txt").isNotNull()
                & res.between(F.col("sprint_start_date"), F.col("sprint_complete_date")))
    return j.groupBy(*KEY).agg(F.sum("__pts").alias("completed_points"))


def completed_points(issues: DataFrame, sprints: DataFrame, as_of) -> DataFrame:
    """A3: points resolved (or still open at ``as_of``) from the start on, status not Open."""
    j = _issues_in_pending_sprints(issues, sprints)
    res = F.coalesce(F.col("__res"), lit_ts(as_of))
    j = j.where((res >= F.col("sprint_start_date"))
                & (F.coalesce(F.col("status_on_sprint_closure"), F.lit("Open")) != F.lit("Open")))
    return j.groupBy(*KEY).agg(F.sum("__pts").alias("completed_points"))


def members_covering(sprints: DataFrame, members: DataFrame, as_of, strict: bool = True,
                     end_col: str = "sprint_complete_date") -> DataFrame:
    """Memberships that span a sprint; an open exit counts as ``as_of``.

    strict (J4): entry < start and exit > end; non-strict (J5): entry <= start and
    exit >= end. Equi key is the team, the interval test stays a residual filter. The
    sprints, a few rows a team, are sent to the members, never the other way round.
    """
    m = members.select("user_dim_id", F.col("team_dim_id").alias("__team"),
                       "team_entry_date", "team_exit_date")
    j = F.broadcast(sprints).join(m, sprints["team_dim_id"] == m["__team"])
    exit_ = F.coalesce(F.col("team_exit_date"), lit_ts(as_of))
    if strict:
        cond = (F.col("team_entry_date") < F.col("sprint_start_date")) & (exit_ > F.col(end_col))
    else:
        cond = (F.col("team_entry_date") <= F.col("sprint_start_date")) & (exit_ >= F.col(end_col))
    return j.where(cond).drop("__team")


def team_size(sprints: DataFrame, members: DataFrame, as_of) -> DataFrame:
    """A4: members present for the whole pending sprint (strict containment)."""
    s = sprints.where(flag_unset("is_metrics_updated")).select(
        *KEY, "sprint_start_date", "sprint_complete_date")
    return (members_covering(s, members, as_of, strict=True)
            .groupBy("team_dim_id", "sprint_number")
            .agg(F.count("user_dim_id").alias("no_of_devs")))


def actual_sprint_start(sprints: DataFrame, scope: str = "global") -> DataFrame:
    """Start + 1 day when the previous sprint completed on the start's calendar day.

    ``scope='global'`` reproduces a lag over *all* sprints ordered by (team, number,
    start): a team's first sprint looks at the previous team's last sprint.
    ``scope='team'`` restarts at every team. Both are a carry over range partitions, so
    neither all sprints nor one team's need fit one task; the ordered rows are written to
    the shared folder when this is called.
    Order columns must be non-null and (team, number, start) unique.
    """
    if scope not in ("global", "team"):
        raise ValueError(f"scope must be 'global' or 'team', not {scope!r}")
    s = row_before(sprints.select(*KEY, "sprint_start_date", "sprint_complete_date"),
                   ["team_dim_id", "sprint_number", "sprint_start_date"],
                   F.struct("team_dim_id", "sprint_complete_date"), "__before")
    prev = F.col("__before.sprint_complete_date")
    if scope == "team":
        prev = F.when(F.col("__before.team_dim_id") == F.col("team_dim_id"), prev)
    s = s.withColumn("__prev", prev)
    same_day = F.coalesce(F.to_date("__prev") == F.to_date("sprint_start_date"), F.lit(False))
    actual = F.date_add(F.to_date("sprint_start_date"), F.when(same_day, 1).otherwise(0))
    return s.select(*KEY, actual.alias("actual_start_date"))


# --- U1..U7: the sprint table after each update ------------------------------------

def set_estimated_points(sprints: DataFrame, issues: DataFrame) -> DataFrame:
    """Any (sprint, team) present in A1 is overwritten (the row itself need not be pending)."""
    return update_from(sprints, estimated_points(issues, sprints), KEY,
                       {"estimated_points": "estimated_points"})


def set_actual_completed_points(sprints: DataFrame, issues: DataFrame, as_of) -> DataFrame:
    """U2"""
    return update_from(sprints, actual_completed_points(issues, sprints, as_of), KEY,
                       {"actual_completed_points": "completed_points"})


def set_completed_points(sprints: DataFrame, issues: DataFrame, as_of) -> DataFrame:
    """U3"""
    return update_from(sprints, completed_points(issues, sprints, as_of), KEY,
                       {"completed_points": "completed_points"})


def set_team_size(sprints: DataFrame, members: DataFrame, as_of) -> DataFrame:
    """U4"""
    return update_from(sprints, team_size(sprints, members, as_of), KEY,
                       {"number_of_devs": "no_of_devs"})


def set_actual_start(sprints: DataFrame, scope: str = "global") -> DataFrame:
    """Fill ``actual_sprint_start_date`` where it is still NULL (any flag state).

    Matched on (sprint_number, team) instead of the sprint number alone, which would be
    ambiguous when teams share sprint numbers.
    """
    return update_from(sprints, actual_sprint_start(sprints, scope), KEY,
                       {"actual_sprint_start_date": "actual_start_date"},
                       guard=F.col("actual_sprint_start_date").isNull())


def sprint_days(sprints: DataFrame, holidays: Column) -> DataFrame:
    """Working days of pending sprints between actual start and completion (inclusive);
    ``actual_sprint_days`` also drops mandatory weekday holidays. ``holidays`` is an
    array column, see :func:`burnup.functions.expr.holiday_array`."""
    a, b = F.col("actual_sprint_start_date"), F.col("sprint_complete_date")
    # A subquery may not sit inside a lambda: bind the array to a column first.
    s = sprints.withColumn("__hol", holidays)
    return set_where(s, flag_unset("is_metrics_updated"), {
        "total_sprint_days": weekdays_between(a, b),
        "actual_sprint_days": working_days_between(a, b, F.col("__hol"))}).drop("__hol")


def close_sprints(sprints: DataFrame) -> DataFrame:
    """Mark every pending sprint as metrics-updated."""
    return set_where(sprints, flag_unset("is_metrics_updated"), {"is_metrics_updated": F.lit(True)})


def sprint_metrics(sprints: DataFrame, issues: DataFrame, members: DataFrame, holidays: Column,
                   as_of, scope: str = "global") -> DataFrame:
    """U1..U6 in one pass.

    A1, A2 and A3 are one aggregation over the issues (one shuffle on (sprint, team))
    with conditional sums; A4 is one interval join; all are left joined to the sprint
    table once, then W1 and U6 are applied.
    """
    pend_numbers = _pending_numbers(sprints).distinct().withColumn("__pn", F.lit(True))
    s_dates = sprints.select(*KEY, F.col("sprint_start_date").alias("__start"),
                             F.col("sprint_complete_date").alias("__complete"),
                             flag_unset("is_metrics_updated").alias("__pending"))
    iss = parse_ticket(issues.where(F.col("is_active") == F.lit(True))
                       .select(*KEY, "ticket_details", "status_on_sprint_closure")
                       .join(pend_numbers, "sprint_number", "left")
                       .join(s_dates, KEY, "left"))
    pts = F.col("__pts")
    res = F.coalesce(F.col("__res"), lit_ts(as_of))
    in_pending = F.coalesce(F.col("__pending"), F.lit(False))
    c1 = F.coalesce(F.col("__pn"), F.lit(False))
    c2 = in_pending & F.col("__res_txt").isNotNull() \
        & res.between(F.col("__start"), F.col("__complete"))
    c3 = in_pending & (res >= F.col("__start")) \
        & (F.coalesce(F.col("status_on_sprint_closure"), F.lit("Open")) != F.lit("Open"))
    agg = iss.groupBy(*KEY).agg(
        F.max(c1).alias("__h1"), F.sum(F.when(c1, pts)).alias("__p1"),
        F.max(F.coalesce(c2, F.lit(False))).alias("__h2"), F.sum(F.when(c2, pts)).alias("__p2"),
        F.max(F.coalesce(c3, F.lit(False))).alias("__h3"), F.sum(F.when(c3, pts)).alias("__p3"))
    devs = team_size(sprints, members, as_of).withColumnRenamed("no_of_devs", "__devs") \
        .withColumn("__h4", F.lit(True))
    j = sprints.join(agg, KEY, "left").join(devs, ["team_dim_id", "sprint_number"], "left")

    def pick(h, v, old):
        return F.when(F.coalesce(F.col(h), F.lit(False)), F.col(v)).otherwise(F.col(old))

    updated = j.select(*[
        pick("__h1", "__p1", c).cast("decimal(18,2)").alias(c) if c == "estimated_points" else
        pick("__h2", "__p2", c).cast("decimal(18,2)").alias(c) if c == "actual_completed_points" else
        pick("__h3", "__p3", c).cast("decimal(18,2)").alias(c) if c == "completed_points" else
        pick("__h4", "__devs", c).alias(c) if c == "number_of_devs" else
        F.col(c) for c in sprints.columns])
    return sprint_days(set_actual_start(updated, scope), holidays)
