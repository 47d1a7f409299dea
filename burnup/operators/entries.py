"""Timesheet import side: A7, S13, U21, resolve_entry_dims (U10-U15), C7; refresh side:
A8, A9, U25, C8; A14."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burnup.functions.expr import lit_date, lit_ts, pg_to_char, round_to_bigint
from burnup.operators.apply import flag_matching, one_row_per_key, update_from
from burnup.operators.nesting import bounded_listagg, explode_project_entries, flatten_all_entries
from burnup.session import cut_lineage

# Fixed value: the pull start for users that never booked.
DEFAULT_PULL_START = dt.date(2020, 1, 1)
APPROVED = "Fully Approved"


def reportable_resources(members: DataFrame, teams: DataFrame, resources: DataFrame) -> DataFrame:
    """members JOIN team (reportable) JOIN resource: one row per membership."""
    t = teams.where(F.col("is_reportable") == F.lit(True)).select("team_dim_id")
    r = resources.select("resource_dim_id", "resource_ppm_id")
    return members.select("user_dim_id", "team_dim_id").join(t, "team_dim_id") \
        .join(r.hint("merge"), F.col("user_dim_id") == F.col("resource_dim_id")) \
        .select("resource_ppm_id", "resource_dim_id", "team_dim_id")


def pull_watermark_rows(members: DataFrame, teams: DataFrame, resources: DataFrame,
                        entries: DataFrame) -> DataFrame:
    """A7, per user: last booked date of approved (or state-less) entries.

    The approval test sits *after* the left join in the warehouse query, so a user
    with bookings but none approved drops out, while a user without any booking stays
    with no date. The entries are reduced per user first (map-side partial
    aggregation), so a user with a huge share of all entries costs one row here.
    """
    approved = F.lower(F.coalesce(F.col("state"), F.lit(APPROVED))) == F.lit(APPROVED.lower())
    per_user = entries.groupBy("resource_dim_id").agg(
        F.max(F.when(approved, F.col("entrydate"))).alias("max_entrydate"),
        F.max(approved).alias("__any_ok"))
    res = reportable_resources(members, teams, resources)
    j = res.join(per_user, "resource_dim_id", "left") \
        .where(F.col("__any_ok").isNull() | (F.col("__any_ok") == F.lit(True)))
    return j.groupBy("resource_ppm_id").agg(F.max("max_entrydate").alias("max_entrydate"))


def pull_watermarks(members, teams, resources, entries) -> DataFrame:
    """Users grouped by their watermark; ``min`` is the watermark as YYYYMMDD, 20200101
    for users without bookings; ``user_list`` in batches of ids."""
    w = pull_watermark_rows(members, teams, resources, entries)
    g = bounded_listagg(w, ["max_entrydate"], "resource_ppm_id", "user_list", batch_col="user_batch")
    return g.select("user_list", "user_batch",
                    pg_to_char(F.coalesce(F.col("max_entrydate"), lit_date(DEFAULT_PULL_START)), "YYYYMMDD")
                    .alias("min"))


def timesheet_extract(landed: DataFrame, requests: DataFrame, user_col: str = "resource_ppm_id",
                      start_col: str = "start_date") -> DataFrame:
    """Timesheets of the requested users whose header ends on or after the start.
    The request table has one row per user (the service call's user list, as rows)."""
    r = requests.select(F.col(user_col).alias("__u"), F.col(start_col).alias("__s"))
    return landed.join(r, (landed["userId"] == r["__u"]) & (landed["endDate"] >= r["__s"]), "left_semi")


def versioned_replace(stored: DataFrame, batch: DataFrame, as_of, mark: tuple[str, int] | None = None) -> DataFrame:
    """Every stored row of a timesheet in the batch becomes inactive; the batch rows
    with an entry id are appended active, stamped ``as_of``, ids rounded to bigint (E7).

    With ``mark`` = (stream, epoch) (incremental import) the store carries both for its
    import and its deactivation: appended rows get them, and so do the rows this batch
    switches from active to inactive, which lets a retried epoch undo its first try.
    """
    ts = batch.select(round_to_bigint("timesheetid").alias("timesheetid"))
    if mark is None:
        out = flag_matching(stored, ts, "timesheetid", "is_active", False)
    else:
        marks = ts.distinct().select(F.col("timesheetid").alias("__ts"), F.lit(True).alias("__hit"))
        j = stored.join(marks, stored["timesheetid"] == marks["__ts"], "left")
        hit = F.coalesce(F.col("__hit"), F.lit(False))
        flipped = hit & F.coalesce(F.col("is_active"), F.lit(False))
        new_values = {"is_active": F.when(hit, F.lit(False)).otherwise(F.col("is_active")),
                      "deactivated_stream": F.when(flipped, F.lit(mark[0])).otherwise(F.col("deactivated_stream")),
                      "deactivated_epoch": F.when(flipped, F.lit(mark[1])).otherwise(F.col("deactivated_epoch"))}
        out = j.select(*[new_values[c].cast(stored.schema[c].dataType).alias(c) if c in new_values else stored[c]
                         for c in stored.columns])
    id_cols = ["timesheetid", "companyid", "entryid", "entrytypeid", "level1id", "level2id",
               "level3id", "locationid", "userid"]
    stamps = [F.lit(mark[0]).alias("import_stream"), F.lit(mark[1]).cast("bigint").alias("import_epoch")] if mark else []
    new = batch.where(F.col("entryid").isNotNull()).select(
        *[round_to_bigint(c).alias(c) if c in id_cols else F.col(c) for c in batch.columns],
        lit_ts(as_of).alias("date_created"), F.lit(True).alias("is_active"), *stamps)
    new = new.select(*[F.col(c).cast(stored.schema[c].dataType).alias(c) if c in new.columns
                       else F.lit(None).cast(stored.schema[c].dataType).alias(c) for c in stored.columns])
    return out.unionByName(new)


def _lookup(df: DataFrame, key_expr, key_name: str, cols: list[str], order: str) -> DataFrame:
    return one_row_per_key(df.select(key_expr.alias(key_name), *cols).where(F.col(key_name).isNotNull()),
                           key_name, [order])


def set_entry_resource(entries, resources):
    """U10"""
    r = _lookup(resources, F.col("resource_ppm_id"), "__ppm", ["resource_dim_id"], "resource_dim_id")
    return update_from(entries, r, ["userid"], {"resource_dim_id": "resource_dim_id"},
                       guard=F.col("resource_dim_id").isNull(), source_keys=["__ppm"])


def set_entry_team(entries, members, as_of):
    """U11 (after U10): team of the membership whose dates contain the entry date."""
    return update_from(entries, memberships(members, as_of).hint("merge"), "resource_dim_id", {"team_dim_id": team_on("entrydate")},
                       guard=F.col("team_dim_id").isNull(), source_keys="user_dim_id")


def memberships(members: DataFrame, as_of) -> DataFrame:
    """(user_dim_id, spans): a user's memberships, those that started last first.

    A user has few of them, so entries are joined by user once and look into the list; the
    entries aren't read a second time to find the dates to look up."""
    span = F.struct("team_entry_date", F.col("team_dim_id").alias("team"), F.to_date("team_entry_date").alias("first"),
                    F.to_date(F.coalesce(F.col("team_exit_date"), lit_ts(as_of))).alias("last"))
    return members.where(F.col("user_dim_id").isNotNull()).groupBy("user_dim_id").agg(
        F.sort_array(F.collect_list(span), asc=False).alias("spans"))


def team_on(day: str, spans: str = "src__spans") -> Column:
    """Team of the first span that contains the day; NULL when none does."""
    return F.get(F.filter(spans, lambda x: F.col(day).between(x["first"], x["last"])), F.lit(0))["team"]


def set_entry_resource_team(entries, resources, members, as_of):
    """U10 and U11 in one join: an entry without resource looks up its user's resource and that
    one's memberships, any other entry the memberships of its resource."""
    r = _lookup(resources, F.col("resource_ppm_id"), "__key", ["resource_dim_id"], "resource_dim_id")
    m = memberships(members, as_of)
    by_user = r.join(m.hint("merge"), F.col("resource_dim_id") == F.col("user_dim_id"), "left") \
        .select(F.lit(True).alias("__open"), "__key", "resource_dim_id", "spans")
    by_resource = m.select(F.lit(False).alias("__open"), F.col("user_dim_id").alias("__key"),
                           F.col("user_dim_id").alias("resource_dim_id"), "spans")
    has = F.col("resource_dim_id").isNotNull()
    keyed = entries.withColumns({"__open": ~has, "__user": F.when(has, F.col("resource_dim_id")).otherwise(F.col("userid"))})
    # a known resource stays as it is, and so does a known team
    return update_from(keyed, by_user.unionByName(by_resource).hint("merge"), ["__open", "__user"],
                       {"resource_dim_id": F.coalesce("resource_dim_id", "src__resource_dim_id"),
                        "team_dim_id": F.coalesce("team_dim_id", team_on("entrydate"))},
                       source_keys=["__open", "__key"]).drop("__open", "__user")


def set_entry_project(entries, projects):
    """Project entries (type 1): project and its portfolio, both overwritten when
    either is missing."""
    p = _lookup(projects, F.col("project_ppm_id").try_cast("bigint"), "__k",
                ["pv_project_dim_id", "portfolio_dim_id"], "pv_project_dim_id")
    guard = (F.col("entrytypeid") == 1) & (F.col("project_dim_id").isNull() | F.col("portfolio_dim_id").isNull())
    return update_from(entries, p, ["level1id"], {"project_dim_id": "pv_project_dim_id",
                                                  "portfolio_dim_id": "portfolio_dim_id"},
                       guard=guard, source_keys=["__k"])


def set_entry_task(entries, tasks):
    """U13"""
    t = _lookup(tasks, F.col("task_ppm_id").try_cast("bigint"), "__k", ["task_dim_id"], "task_dim_id")
    guard = (F.col("entrytypeid") == 1) & F.col("task_dim_id").isNull()
    return update_from(entries, t, ["level2id"], {"task_dim_id": "task_dim_id"}, guard=guard,
                       source_keys=["__k"])


def set_entry_portfolio(entries, portfolios):
    """Portfolio entries (type 99)."""
    p = _lookup(portfolios, F.col("portfolio_ppm_id").try_cast("bigint"), "__k", ["portfolio_dim_id"],
                "portfolio_dim_id")
    guard = (F.col("entrytypeid") == 99) & F.col("portfolio_dim_id").isNull()
    return update_from(entries, p, ["level1id"], {"portfolio_dim_id": "portfolio_dim_id"}, guard=guard,
                       source_keys=["__k"])


def set_entry_level1(entries, projects, portfolios):
    """U12 and U14 in one join: both look up ``level1id``, each for its own entry type."""
    p = _lookup(projects, F.col("project_ppm_id").try_cast("bigint"), "__k",
                ["pv_project_dim_id", "portfolio_dim_id"], "pv_project_dim_id")
    f = _lookup(portfolios, F.col("portfolio_ppm_id").try_cast("bigint"), "__k", ["portfolio_dim_id"],
                "portfolio_dim_id")
    both = p.select(F.lit(1).cast("bigint").alias("__type"), "__k", F.col("pv_project_dim_id").alias("pv"),
                    F.col("portfolio_dim_id").alias("pf")) \
        .unionByName(f.select(F.lit(99).cast("bigint").alias("__type"), "__k", F.lit(None).cast("bigint").alias("pv"),
                              F.col("portfolio_dim_id").alias("pf")))
    kind, pf_missing = F.col("entrytypeid"), F.col("portfolio_dim_id").isNull()
    guard = pf_missing | ((kind == 1) & F.col("project_dim_id").isNull())
    project = F.when(kind == 1, F.col("src__pv")).otherwise(F.col("project_dim_id"))
    return update_from(entries, both.hint("merge"), ["entrytypeid", "level1id"], {"project_dim_id": project, "portfolio_dim_id": "pf"},
                       guard=guard, source_keys=["__type", "__k"])


def set_entry_date(entries, dates):
    """U15. A calendar has a row a day: it goes to the entries, which would else be shuffled by a few dates."""
    d = F.broadcast(_lookup(dates, F.to_date("dt"), "__d", ["sk_date"], "sk_date"))
    return update_from(entries, d, ["entrydate"], {"date_dim_id": "sk_date"},
                       guard=F.col("date_dim_id").isNull(), source_keys=["__d"])


def resolve_entry_dims(entries, resources, members, projects, tasks, portfolios, dates, as_of):
    """U10..U15 in the warehouse's order, with one join for U10 and U11 (which needs U10's resource
    key) and one for U12 and U14: their entry types are disjoint and U13 touches neither of their columns."""
    e = set_entry_resource_team(entries, resources, members, as_of)
    e = set_entry_level1(e, projects, portfolios)
    e = set_entry_task(e, tasks)
    return set_entry_date(e, dates)


def import_timesheets(stored, landed, members, teams, resources, projects, tasks, portfolios, dates,
                      as_of) -> DataFrame:
    """Watermarks -> pull -> flatten -> versioned replace -> resolve keys, in one pass
    for all users (the per-watermark loop becomes a join with the per-user watermark).

    The flat batch is staged, written to the shared folder when this is called, as in the warehouse: it gives both
    the timesheets to replace and the new rows, and the pull behind it would else run for each."""
    wm = pull_watermark_rows(members, teams, resources, stored).select(
        "resource_ppm_id", F.coalesce(F.col("max_entrydate"), lit_date(DEFAULT_PULL_START)).alias("start_date"))
    pulled = timesheet_extract(landed, wm)
    batch = cut_lineage(flatten_all_entries(pulled), "import_batch")
    out = versioned_replace(stored, batch, as_of)
    return resolve_entry_dims(out, resources, members, projects, tasks, portfolios, dates, as_of)


# --- refresh / delete --------------------------------------------------------------

def refresh_request_rows(log: DataFrame, members: DataFrame, resources: DataFrame) -> DataFrame:
    """Requests not yet handled, one row per active member of the team."""
    m = members.where(F.col("is_active") == F.lit(True)).select("user_dim_id", "team_dim_id")
    r = resources.select("resource_dim_id", "resource_ppm_id")
    return log.where(F.col("is_timesheet_refreshed") == F.lit(False)) \
        .join(m, "team_dim_id").join(r, F.col("user_dim_id") == F.col("resource_dim_id")) \
        .select("team_dim_id", "from_date", "to_date", "resource_ppm_id")


def refresh_requests(log, members, resources) -> DataFrame:
    """Per (team, from, to) the members' ids as text lists, dates as YYYY/MM/DD."""
    rows = refresh_request_rows(log, members, resources)
    g = bounded_listagg(rows, ["team_dim_id", "from_date", "to_date"], "resource_ppm_id", "resource_list",
                        batch_col="user_batch")
    return g.select("team_dim_id", pg_to_char("from_date", "YYYY/MM/DD").alias("from_date"),
                    pg_to_char("to_date", "YYYY/MM/DD").alias("to_date"), "user_batch", "resource_list")


def delete_command_rows(log, members, resources, timesheets) -> DataFrame:
    """A9 rows: entries of the requested users' timesheets (header ending on or after the
    request start) whose entry date lies in [from, to]."""
    req = refresh_request_rows(log, members, resources)
    ts = timesheets.join(req.select(F.col("resource_ppm_id").alias("__u"), F.col("from_date").alias("__f")),
                         (F.col("userId") == F.col("__u")) & (F.col("endDate") >= F.col("__f")), "left_semi")
    flat = explode_project_entries(ts) if "entriesProject" in ts.columns else ts
    j = flat.join(req, flat["userId"] == req["resource_ppm_id"])
    return j.where((F.col("endDate") >= F.col("from_date"))
                   & F.col("entryDate").between(F.col("from_date"), F.col("to_date"))).select(
        "team_dim_id", "from_date", "to_date", F.col("timesheetId").alias("timesheetid"),
        F.col("userId").alias("userid"), F.col("entryId").alias("entryid"))


def delete_commands(log, members, resources, timesheets) -> DataFrame:
    """Entry-id lists per (request, timesheet, user)."""
    rows = delete_command_rows(log, members, resources, timesheets)
    return bounded_listagg(rows, ["team_dim_id", "from_date", "to_date", "timesheetid", "userid"],
                           "entryid", "entryid_list", batch_col="entry_batch")


def mark_refreshed(log: DataFrame, members: DataFrame, resources: DataFrame) -> DataFrame:
    """Every request of a handled team is marked refreshed (whatever its range)."""
    handled = refresh_request_rows(log, members, resources).select("team_dim_id")
    return flag_matching(log, handled, "team_dim_id", "is_timesheet_refreshed", True)


def refresh_delete(log, members, resources, timesheets) -> tuple[DataFrame, DataFrame]:
    """Delete commands for all pending requests, and the log after U25."""
    return delete_commands(log, members, resources, timesheets), mark_refreshed(log, members, resources)


def reportable_user_list(members, teams, resources, start: dt.date = DEFAULT_PULL_START) -> DataFrame:
    """Reportable members as id lists (no de-duplication) with a fixed start date."""
    rows = reportable_resources(members, teams, resources)
    g = bounded_listagg(rows, [], "resource_ppm_id", "user_list", batch_col="user_batch")
    return g.select("user_list", "user_batch", pg_to_char(lit_date(start), "YYYY/MM/DD").alias("min"))
