"""Domain tables derived from the driver's TPC-H-like tables.

The pipeline needs sprints, issues, teams, members, resources, projects and
timesheet entries. The test data holds none of these, so each one is *derived by a
select* from the given tables; the derivation rules are plain arithmetic on keys
and dates, so both Spark and the SQL oracle can state them. All derivations read
whole tables; nothing is sampled or capped.

Derivation rules (fixed values of the scenario):
- now (``AS_OF``) is 2024-01-24 12:00; the sprint-end floor is 2020-05-14.
- team = nation; member / resource = customer (resource ppm id = custkey + 100000).
- sprints: six five-day windows per team from 2024-01-01 09:00.
- issues = events of customers; sprint from the day of month; points from props.k;
  an issue's feature is one of 5 projects x 3 tasks, so a sprint has a bounded
  number of features (as real sprints do) and planned rows grow with members.
- portfolios = regions, projects / epics = parts, Jira projects and tasks = suppliers.
- stored timesheet entries = lineitem x orders, dates folded into Dec 2023 - Jan 2024.
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from burnup.functions.expr import HOURS_TYPE, lit_date, lit_ts

# Fixed values of the scenario.
AS_OF = dt.datetime(2024, 1, 24, 12, 0, 0)
SPRINT_END_FLOOR = dt.date(2020, 5, 14)
RESOURCE_PPM_OFFSET = 100000
PROJECT_PPM_OFFSET = 7000
PORTFOLIO_PPM_OFFSET = 500
ENTRY_DATE_BASE = dt.date(2023, 12, 1)
SHIP_DATE_BASE = dt.date(1995, 1, 1)
ENTRY_DATE_SPAN = 61


def plans_of(spark: SparkSession) -> dict:
    """Plans shared within one session. They live on the session object, so they end with it."""
    return spark.__dict__.setdefault("_burnup_plans", {})


def forget_plans(spark: SparkSession) -> None:
    """Drop the shared plans, for example after table files were rewritten."""
    plans_of(spark).clear()


class Tables:
    """Lazy access to the parquet tables of one scale-factor folder.

    A table is read once per session and folder; later uses share the DataFrame, so
    the file listing and footer reads are not repeated for every operator.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        plans, key = plans_of(self.spark), (self.sf_dir, name)
        if key not in plans:
            plans[key] = self.spark.read.parquet(os.path.join(self.sf_dir, f"{name}.parquet"))
        return plans[key]


def view(fn):
    """Memoise a derived table per session and folder: a DataFrame is an immutable plan,
    so every operator of a session can share it instead of rebuilding it."""
    def wrapped(t: Tables) -> DataFrame:
        plans, key = plans_of(t.spark), (t.sf_dir, fn)
        if key not in plans:
            plans[key] = fn(t)
        return plans[key]
    wrapped.__name__ = fn.__name__
    wrapped.__doc__ = fn.__doc__
    return wrapped


def _days(ts: Column, n) -> Column:
    n = n if isinstance(n, Column) else F.lit(n)
    return F.timestamp_add("DAY", n, ts)


def _hours(ts: Column, n) -> Column:
    n = n if isinstance(n, Column) else F.lit(n)
    return F.timestamp_add("HOUR", n, ts)


@view
def team_dim(t: Tables) -> DataFrame:
    n = t.nation
    k = F.col("n_nationkey")
    return n.select(
        k.cast("bigint").alias("team_dim_id"),
        F.when(k == 0, F.lit("Artex"))
         .when(k % 5 == 0, F.concat(F.lit("Artex "), F.col("n_name")))
         .otherwise(F.col("n_name")).alias("team_name"),
        F.lit(True).alias("is_active"),
        F.col("n_regionkey").cast("int").alias("jira_rapid_view_id"),
        (k % 3 != 0).alias("is_reportable"))


@view
def resource_dim(t: Tables) -> DataFrame:
    c = t.customer
    k = F.col("c_custkey")
    seg = F.col("c_mktsegment")
    return c.select(
        k.alias("resource_dim_id"),
        (k + RESOURCE_PPM_OFFSET).alias("resource_ppm_id"),
        F.col("c_name").alias("resource_first_name"),
        F.when(seg == "AUTOMOBILE", F.lit(None).cast("string"))
         .when(seg == "BUILDING", F.lit("Contractor"))
         .when(seg == "FURNITURE", F.lit("Sr Consultant"))
         .otherwise(F.lit("Employee")).alias("type"),
        F.when(k % 10 == 0, F.lit(False)).otherwise(F.lit(None).cast("boolean")).alias("is_consultant"),
        (F.col("c_nationkey") % 4 + 1).cast("bigint").alias("primary_role_id"))


@view
def user_team_map(t: Tables) -> DataFrame:
    c = t.customer
    k = F.col("c_custkey")
    entry = F.date_add(lit_date("2023-12-20"), (k % 20).cast("int"))
    return c.select(
        k.alias("user_dim_id"),
        F.col("c_nationkey").cast("bigint").alias("team_dim_id"),
        entry.cast("timestamp_ntz").alias("team_entry_date"),
        F.when(k % 4 == 0, F.date_add(entry, 15).cast("timestamp_ntz"))
         .otherwise(F.lit(None).cast("timestamp_ntz")).alias("team_exit_date"),
        (k % 7 != 0).alias("is_active"))


@view
def sprint_summary(t: Tables) -> DataFrame:
    n = t.nation.select(F.col("n_nationkey").cast("bigint").alias("team_dim_id"),
                        F.explode(F.sequence(F.lit(1), F.lit(6))).alias("w"))
    team, w = F.col("team_dim_id"), F.col("w")
    start = _days(lit_ts("2024-01-01 09:00:00"), (w - 1) * 5)
    complete = _hours(_days(start, F.when(team % 2 == 0, 5).otherwise(4)), 8)
    tw = team + w
    null_dec = F.lit(None).cast("decimal(18,2)")
    return n.select(
        w.cast("bigint").alias("sprint_number"),
        team,
        F.concat(F.lit("Sprint "), w.cast("string")).alias("sprint_name"),
        start.alias("sprint_start_date"),
        _days(start, 4).alias("sprint_end_date"),
        complete.alias("sprint_complete_date"),
        F.when(tw % 7 == 0, F.to_date(start)).otherwise(F.lit(None).cast("date"))
         .alias("actual_sprint_start_date"),
        null_dec.alias("estimated_points"),
        null_dec.alias("actual_completed_points"),
        null_dec.alias("completed_points"),
        F.lit(None).cast("bigint").alias("number_of_devs"),
        F.lit(None).cast("int").alias("total_sprint_days"),
        F.lit(None).cast("int").alias("actual_sprint_days"),
        F.when(tw % 3 == 0, F.lit(True)).when(tw % 3 == 1, F.lit(False))
         .otherwise(F.lit(None).cast("boolean")).alias("is_metrics_updated"),
        F.when(tw % 4 == 0, F.lit(True)).otherwise(F.lit(None).cast("boolean"))
         .alias("is_timesheet_populated"))


@view
def sprint_issues(t: Tables) -> DataFrame:
    e = t.events.join(t.customer.select("c_custkey", "c_nationkey").hint("merge"),
                      F.col("user_id") == F.col("c_custkey"))
    eid = F.col("event_id")
    k = F.get_json_object("props", "$.k")
    points = (F.when(eid % 11 == 0, F.lit("null"))
              .when(eid % 2 == 1, F.concat(k, F.lit(".5"))).otherwise(k))
    resolution = F.when(F.col("event_type") == "error", F.lit(None).cast("string")) \
        .otherwise(F.date_format(_days(F.col("ts"), 2), "yyyy-MM-dd HH:mm:ss"))
    doc = F.concat(
        F.lit('{"fields": {"customfield_10411": '), points,
        F.when(resolution.isNull(), F.lit(""))
         .otherwise(F.concat(F.lit(', "resolutiondate": "'), resolution, F.lit('"'))),
        F.lit("}}"))
    return e.select(
        eid.alias("issue_id"),
        ((F.dayofmonth("ts") - 1) / 5).cast("bigint").alias("__w0"),
        F.col("c_nationkey").cast("bigint").alias("team_dim_id"),
        doc.alias("ticket_details"),
        (eid % 10 != 0).alias("is_active"),
        F.when(F.col("event_type") == "view", F.lit("Open"))
         .when(F.col("event_type") == "error", F.lit(None).cast("string"))
         .otherwise(F.lit("Done")).alias("status_on_sprint_closure"),
        (eid % 150).alias("epic_dim_id"),
        (eid % 10).alias("project_dim_id"),
        F.when(eid % 3 == 0, F.lit(None).cast("bigint")).otherwise(eid % 5 + 1).alias("portfolio_dim_id"),
        F.when(eid % 3 == 0, F.lit(None).cast("bigint")).otherwise(eid % 5).alias("pv_project_dim_id"),
        F.lit(None).cast("boolean").alias("is_maintenance"),
        (eid % 3 + 1).alias("task_ppm_id"),
    ).select(
        "issue_id", (F.col("__w0") + 1).alias("sprint_number"), "team_dim_id", "ticket_details",
        "is_active", "status_on_sprint_closure", "epic_dim_id", "project_dim_id",
        "portfolio_dim_id", "pv_project_dim_id", "is_maintenance", "task_ppm_id")


@view
def portfolio_dim(t: Tables) -> DataFrame:
    r = F.col("r_regionkey")
    return t.region.select(
        (r + 1).cast("bigint").alias("portfolio_dim_id"),
        (r + PORTFOLIO_PPM_OFFSET).cast("string").alias("portfolio_ppm_id"),
        F.col("r_name").alias("portfolio_name"))


@view
def jira_project_dim(t: Tables) -> DataFrame:
    s = t.supplier.join(t.nation.select("n_nationkey", "n_regionkey"),
                        F.col("s_nationkey") == F.col("n_nationkey")) \
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    k = F.col("s_suppkey")
    return s.select(
        k.alias("project_dim_id"),
        F.when(k % 2 == 0, F.concat(F.lit("Team "), F.col("r_name"), F.lit(" Care")))
         .otherwise(F.col("s_name")).alias("project_name"))


@view
def projects_dim(t: Tables) -> DataFrame:
    p = t.part
    k, size = F.col("p_partkey"), F.col("p_size")
    return p.select(
        k.alias("pv_project_dim_id"),
        (k + PROJECT_PPM_OFFSET).cast("string").alias("project_ppm_id"),
        F.concat(F.col("p_name"), F.when(size % 7 == 0, F.lit(" (Ongoing)")).otherwise(F.lit("")))
         .alias("pv_project_name"),
        F.when(k % 3 == 0, F.concat(F.lit("A"), k.cast("string"))).otherwise(F.lit(None).cast("string"))
         .alias("pv_aha_id"),
        F.when(F.col("p_type") == "ECONOMY", F.lit("Services")).otherwise(F.col("p_type")).alias("category"),
        F.when(size > 45, F.lit(None).cast("bigint")).otherwise(k % 5 + 1).alias("portfolio_dim_id"),
        F.when(size % 13 == 0, F.lit(True)).when(size % 11 == 0, F.lit(False))
         .otherwise(F.lit(None).cast("boolean")).alias("is_maintenance_project"))


@view
def epic_dim(t: Tables) -> DataFrame:
    k = F.col("p_partkey")
    return t.part.select(
        k.alias("epic_dim_id"),
        F.when(k % 2 == 0, F.concat(F.lit("https://tracker.example.com/features/A"), k.cast("string"), F.lit(" ")))
         .otherwise(F.concat(F.lit("A"), k.cast("string"))).alias("aha_reference"))


@view
def project_tasks(t: Tables) -> DataFrame:
    k = F.col("s_suppkey")
    return t.supplier.select(
        k.alias("task_dim_id"),
        k.cast("string").alias("task_ppm_id"),
        (k * 7 % 200).alias("pv_project_dim_id"),
        (k % 9 != 0).alias("is_time_reportable"))


def holiday_dim(t: Tables | None = None, spark: SparkSession | None = None) -> DataFrame:
    """Calendar of the scenario (fixed values: two Monday holidays, one on a Saturday,
    one optional day)."""
    spark = spark or t.spark
    plans = plans_of(spark)
    if "holidays" in plans:
        return plans["holidays"]
    rows = [
        (dt.datetime(2024, 1, 1), "New Years Day", "US", "US", True),
        (dt.datetime(2024, 1, 13), "Company Day", "US", "US", True),
        (dt.datetime(2024, 1, 15), "Martin Luther King Day", "US", "US", True),
        (dt.datetime(2024, 1, 16), "Optional Day", "US", "US", False),
    ]
    plans["holidays"] = spark.createDataFrame(
        rows, "holiday_date timestamp_ntz, holiday_name string, holiday_country string, "
              "holiday_state string, is_mandatory_holiday boolean")
    return plans["holidays"]


def _entry_type() -> Column:
    f = F.col("l_returnflag")
    return F.when(f == "A", 1).when(f == "N", 99).otherwise(2).cast("bigint")


def _entry_date() -> Column:
    return F.date_add(lit_date(ENTRY_DATE_BASE),
                      (F.datediff(F.to_date("l_shipdate"), lit_date(SHIP_DATE_BASE)) % ENTRY_DATE_SPAN)
                      .cast("int"))


def _entry_columns() -> list[Column]:
    etype = _entry_type()
    pk = F.col("l_partkey")
    return [
        F.col("l_orderkey").alias("timesheetid"),
        F.lit(0).cast("bigint").alias("companyid"),
        _entry_date().alias("entrydate"),
        F.col("l_quantity").cast(HOURS_TYPE).alias("entryhours"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("entryid"),
        etype.alias("entrytypeid"),
        F.lit(None).cast("string").alias("externalid"),
        (pk % 100).cast(HOURS_TYPE).alias("internalrate"),
        (F.col("l_suppkey") % 100).cast(HOURS_TYPE).alias("billablerate"),
        (F.col("l_linestatus") == "F").alias("isbillable"),
        (F.col("l_returnflag") != "R").alias("isproductive"),
        F.when(etype == 1, pk + PROJECT_PPM_OFFSET)
         .when(etype == 99, pk % 5 + PORTFOLIO_PPM_OFFSET).otherwise(pk).alias("level1id"),
        F.col("l_suppkey").alias("level2id"),
        F.col("l_linenumber").cast("bigint").alias("level3id"),
        F.lit(None).cast("bigint").alias("locationid"),
        F.lit(None).cast("string").alias("notes"),
        F.when(F.col("l_linestatus") == "F", F.lit("Fully Approved"))
         .when(F.col("l_orderkey") % 5 == 0, F.lit(None).cast("string"))
         .otherwise(F.lit("Open")).alias("state"),
        (F.col("o_custkey") + RESOURCE_PPM_OFFSET).alias("userid"),
    ]


def _lineitem_orders(t: Tables) -> DataFrame:
    return t.lineitem.join(t.orders.select("o_orderkey", "o_custkey", "o_orderdate").hint("merge"),
                           F.col("l_orderkey") == F.col("o_orderkey"))


@view
def timesheet_entries(t: Tables) -> DataFrame:
    """Stored entries (the warehouse fact). Some rows still lack dimension keys."""
    return _lineitem_orders(t).select(
        *_entry_columns(),
        F.col("o_orderdate").alias("date_created"),
        F.lit(True).alias("is_active"),
        F.when(F.col("l_linenumber") == 2, F.lit(None).cast("bigint")).otherwise(F.col("o_custkey"))
         .alias("resource_dim_id"),
        F.lit(None).cast("bigint").alias("team_dim_id"),
        F.lit(None).cast("bigint").alias("project_dim_id"),
        F.when(F.col("l_linenumber") == 1, F.lit(0).cast("bigint")).otherwise(F.lit(None).cast("bigint"))
         .alias("portfolio_dim_id"),
        F.lit(None).cast("bigint").alias("task_dim_id"),
        F.lit(None).cast("bigint").alias("date_dim_id"))


@view
def import_batch(t: Tables) -> DataFrame:
    """The staged pull (import staging, 18 columns): every entry booked anew on a timesheet of
    twice the number, so a part of the pulled timesheets is stored already. Lines numbered 7
    carry no entry id."""
    return _booked_anew(t).withColumn("timesheetid", F.col("timesheetid") * 2)


def _booked_anew(t: Tables) -> DataFrame:
    """The staged entries before their timesheets' number is doubled: still partitioned by it after the join."""
    return _lineitem_orders(t).select(*_entry_columns()) \
        .withColumn("entryid", F.when(F.col("level3id") == 7, F.lit(None).cast("bigint")).otherwise(F.col("entryid")))


@view
def date_dimension(t: Tables) -> DataFrame:
    d = t.lineitem.select(_entry_date().alias("dt")).distinct()
    return d.select(F.date_format("dt", "yyyyMMdd").cast("bigint").alias("sk_date"), "dt")


@view
def landed_timesheets(t: Tables) -> DataFrame:
    """Timesheets as the service returns them: header + four entry arrays.

    Built from the import batch: type 1 -> entriesProject, 2 -> entriesOther,
    99 -> entriesPortfolio; entriesAccount is empty, or NULL for even ids.
    """
    b = _booked_anew(t)  # grouped where the join put the rows, without another shuffle
    names = ["companyId", "entryDate", "entryHours", "entryId", "entryTypeId", "externalId",
             "internalRate", "billableRate", "isBillable", "isProductive", "level1Id", "level2Id",
             "level3Id", "locationId", "notes", "state"]
    entry = F.struct(*[F.col(n.lower()).alias(n) for n in names])
    g = b.groupBy(F.col("timesheetid").alias("timesheetId"), F.col("userid").alias("userId")).agg(
        F.min("entrydate").alias("startDate"), F.max("entrydate").alias("endDate"),
        F.collect_list(F.when(F.col("entrytypeid") == 1, entry)).alias("entriesProject"),
        F.collect_list(F.when(F.col("entrytypeid") == 2, entry)).alias("entriesOther"),
        F.collect_list(F.when(F.col("entrytypeid") == 99, entry)).alias("entriesPortfolio"))
    empty = F.filter(F.col("entriesOther"), lambda x: F.lit(False))
    g = g.withColumn("timesheetId", F.col("timesheetId") * 2)
    return g.select(
        "timesheetId", "userId", "startDate", "endDate", "entriesProject", "entriesOther",
        F.when(F.col("timesheetId") % 2 == 0, F.lit(None)).otherwise(empty).alias("entriesAccount"),
        "entriesPortfolio")


@view
def generator_headers(t: Tables) -> DataFrame:
    """Weekly timesheet headers that exist in the service for every resource."""
    c = t.customer.select(F.col("c_custkey"), F.explode(F.sequence(F.lit(0), F.lit(3))).alias("w"))
    start = F.date_add(lit_date("2024-01-01"), (F.col("w") * 7).cast("int"))
    return c.select(
        (F.col("c_custkey") * 10 + F.col("w")).alias("timesheetId"),
        (F.col("c_custkey") + RESOURCE_PPM_OFFSET).alias("userId"),
        start.alias("startDate"),
        F.date_add(start, 6).alias("endDate"))


@view
def generator_existing_entries(t: Tables) -> DataFrame:
    """Entries already booked in the service: one per user, day, project and task of all events."""
    g = t.events.groupBy(
        (F.col("user_id") + RESOURCE_PPM_OFFSET).alias("userId"),
        F.to_date("ts").alias("entryDate"),
        (F.col("event_id") % 5 + PROJECT_PPM_OFFSET).alias("project_ppm_id"),
        (F.col("event_id") % 3 + 1).alias("task_ppm_id"),
    ).agg(F.min("event_id").alias("entryId"), F.count(F.lit(1)).cast(HOURS_TYPE).alias("entryHours"))
    return g


@view
def generator_timesheet_rows(t: Tables) -> DataFrame:
    """The generator timesheets already flat (N1's output): header LEFT JOIN the entries
    inside its range. Used where the pipeline needs rows, so no (user, week) group is
    gathered into one array just to be exploded again."""
    h = generator_headers(t)
    e = generator_existing_entries(t)
    j = h.join(e.hint("merge"), (h["userId"] == e["userId"]) & e["entryDate"].between(h["startDate"], h["endDate"]), "left")
    return j.select(h["timesheetId"], h["userId"], h["startDate"], h["endDate"], e["entryId"], e["entryDate"],
                    e["entryHours"], e["project_ppm_id"], e["task_ppm_id"])


@view
def generator_timesheets(t: Tables) -> DataFrame:
    """Nested generator-side timesheets: header + entriesProject inside the header range."""
    h = generator_headers(t)
    e = generator_existing_entries(t)
    j = h.join(e.hint("merge"), (h["userId"] == e["userId"]) & e["entryDate"].between(h["startDate"], h["endDate"]), "left")
    entry = F.struct(e["entryId"].alias("entryId"), e["entryDate"].alias("entryDate"),
                     e["entryHours"].alias("entryHours"), e["project_ppm_id"].alias("level1Id"),
                     e["task_ppm_id"].alias("level2Id"))
    return j.groupBy(h["timesheetId"], h["userId"], h["startDate"], h["endDate"]).agg(
        F.collect_list(F.when(e["entryId"].isNotNull(), entry)).alias("entriesProject"))


@view
def refresh_log(t: Tables) -> DataFrame:
    n, k = t.nation, F.col("n_nationkey")
    first = F.struct(lit_date("2024-01-05").alias("from_date"), lit_date("2024-01-20").alias("to_date"))
    second = F.struct(lit_date("2024-01-10").alias("from_date"), lit_date("2024-01-12").alias("to_date"))
    reqs = n.select(k.cast("bigint").alias("team_dim_id"),
                    F.explode(F.when(k == 0, F.array(first, second)).otherwise(F.array(first))).alias("r"))
    return reqs.select("team_dim_id", "r.from_date", "r.to_date",
                       (F.col("team_dim_id") == 12).alias("is_timesheet_refreshed"))


def push_acknowledgements(payload: DataFrame) -> DataFrame:
    """Service answers for pushed payloads: timesheets divisible by 11 are rejected."""
    ok = F.col("timesheetId") % 11 != 0
    keys = ["timesheetId", "userId"] + (["chunk"] if "chunk" in payload.columns else [])
    return payload.select(
        *keys, ok.alias("ok"),
        F.when(ok, F.lit(None).cast("string")).otherwise(F.lit("rejected by service")).alias("error"))


@view
def dead_letter_seed(t: Tables) -> DataFrame:
    """Dead letter left by an earlier run: one row per supplier, on a timesheet of the resource
    of the same number."""
    k = F.col("s_suppkey")
    week = (k % 4).cast("int")
    return t.supplier.select(
        F.lit(0).alias("companyId"), F.lit(1).alias("entryTypeId"),
        (k * 10 + week).alias("timesheetId"), (k + RESOURCE_PPM_OFFSET).alias("userId"),
        ((k + RESOURCE_PPM_OFFSET) % 200 + PROJECT_PPM_OFFSET).alias("level1Id"),
        F.lit(1).cast("bigint").alias("level2Id"),
        F.date_add(lit_date("2024-01-01"), week * 7).alias("entryDate"), F.lit(0).cast("bigint").alias("entryId"),
        F.lit(1).cast("bigint").alias("level3Id"), F.lit(1.0).alias("entryHours"),
        lit_ts("2024-01-17 00:00:00").alias("created_date"))
