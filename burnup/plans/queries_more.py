"""Registered queries of the composites and small operators: C8, C9, C10, J17/T1, O1, U20, V3, E12, S5, S11, and
the list operators in their whole form."""

from __future__ import annotations

from pyspark.sql import functions as F

from burnup.functions import expr as E
from burnup.operators import apply as ap
from burnup.operators import effort as ef
from burnup.operators import entries as en
from burnup.operators import mapping as mp
from burnup.operators import nesting as ns
from burnup.operators.lists import listagg_pieces
from burnup.plans import domain as d
from burnup.plans.queries_entries import REQ_CTE
from burnup.plans.queries_mapping import ISSUE_COLS, U17_CTES
from burnup.plans.registry import query
from burnup.sources import landing as ld
from burnup.sources import seeds

# Projects whose names are among the patched ones (C9, U20): by the part's size; some have a reference already.
PATCH_NAMES = [name for name, _ in mp.PROJECT_AHA_PATCHES]
PATCHED_CTE = ("named_project", f"""
SELECT * REPLACE (CASE p_size % 5 {' '.join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(PATCH_NAMES))} ELSE pv_project_name END
                  AS pv_project_name)
FROM projects_dim JOIN (SELECT p_partkey, p_size FROM part) ON p_partkey = pv_project_dim_id""")


def named_projects(t: d.Tables):
    size = t.part.select(F.col("p_partkey").alias("pv_project_dim_id"), "p_size")
    name = F.col("pv_project_name")
    for i, n in enumerate(PATCH_NAMES):
        name = F.when(F.col("p_size") % 5 == i, F.lit(n)).otherwise(name)
    p = d.projects_dim(t)
    return p.join(size.hint("merge"), "pv_project_dim_id").withColumn("pv_project_name", name).select(*p.columns)


def _cleaned(spark, sf_dir):
    t = d.Tables(spark, sf_dir)
    tables = {"team_dim": d.team_dim(t), "projects_dim": named_projects(t), "project_tasks": d.project_tasks(t),
              "portfolio_dim": d.portfolio_dim(t), "epic_dim": d.epic_dim(t), "jira_project_dim": d.jira_project_dim(t),
              "sprint_issues": d.sprint_issues(t), "resource_dim": d.resource_dim(t), "user_team_map": d.user_team_map(t),
              "holiday_dim": d.holiday_dim(t)}
    return mp.dim_cleanup(tables, seeds.seed_frame(spark, seeds.HOLIDAY_SEED, seeds.HOLIDAY_SCHEMA))


# References the patches set.
PATCH_VALUES = ", ".join(f"('{n}', '{a}')" for n, a in mp.PROJECT_AHA_PATCHES)
CLEAN_CTES = (
    PATCHED_CTE,
    ("patched", f"""
SELECT p.* EXCLUDE (p_partkey, p_size) REPLACE (coalesce(p.pv_aha_id, x.ref) AS pv_aha_id,
  if(coalesce(p.is_maintenance_project, FALSE), TRUE, contains(lower(p.pv_project_name), '(ongoing)')) AS is_maintenance_project)
FROM named_project p LEFT JOIN (VALUES {PATCH_VALUES}) x(name, ref) ON x.name = p.pv_project_name"""),
)


@query("dim_cleanup_projects", """
SELECT pv_project_dim_id, pv_project_name, pv_aha_id, is_maintenance_project FROM patched""", ctes=CLEAN_CTES)
def dim_cleanup_projects(spark, sf_dir):
    """U20's project patches, then U8."""
    return _cleaned(spark, sf_dir)["projects_dim"].select("pv_project_dim_id", "pv_project_name", "pv_aha_id", "is_maintenance_project")


CLEAN_ISSUE_CTES = tuple((n, b.replace("FROM p8 ", "FROM patched ").replace("JOIN p8 ", "JOIN patched "))
                         for n, b in U17_CTES if n != "p8")


@query("dim_cleanup_issues", f"SELECT {ISSUE_COLS} FROM u17", ctes=(*CLEAN_CTES, *CLEAN_ISSUE_CTES))
def dim_cleanup_issues(spark, sf_dir):
    """U16 and U17 over the patched projects."""
    return _cleaned(spark, sf_dir)["sprint_issues"].select(*ISSUE_COLS.split(", "))


@query("dim_cleanup_members", """
SELECT 'member' AS what, m.user_dim_id AS id, m.is_active AS flag FROM user_team_map m
WHERE EXISTS (SELECT 1 FROM resource_dim r WHERE r.resource_dim_id = m.user_dim_id AND r.type IS NOT NULL)
UNION ALL
SELECT 'team', team_dim_id, is_active AND contains(team_name, 'Artex') FROM team_dim
UNION ALL
SELECT 'task', task_dim_id, is_time_reportable AND coalesce((SELECT category <> 'Services' FROM projects_dim p
   WHERE p.pv_project_dim_id = k.pv_project_dim_id), TRUE) FROM project_tasks k""")
def dim_cleanup_members(spark, sf_dir):
    """U19 members, U20 teams and U9 tasks."""
    out = _cleaned(spark, sf_dir)
    pick = lambda name, kind, key, flag: out[name].select(F.lit(kind).alias("what"), F.col(key).alias("id"), F.col(flag).alias("flag"))
    return pick("user_team_map", "member", "user_dim_id", "is_active").unionByName(
        pick("team_dim", "team", "team_dim_id", "is_active")).unionByName(pick("project_tasks", "task", "task_dim_id", "is_time_reportable"))


@query("insert_if_absent", """
SELECT s_suppkey AS id, s_name AS label FROM supplier
UNION ALL
SELECT o_custkey, 'from orders' FROM orders ANTI JOIN supplier ON s_suppkey = o_custkey GROUP BY o_custkey""")
def insert_if_absent(spark, sf_dir):
    """The customers of all orders, inserted where a table keyed by supplier has no such id."""
    t = d.Tables(spark, sf_dir)
    target = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("label"))
    rows = t.orders.select(F.col("o_custkey").alias("id"), F.lit("from orders").alias("label"))
    return ap.insert_if_absent(target, rows, "id")


# A registry of three entities (fixed values): name, service id, schedule, field map, load order.
REGISTRY = [("Vendor", 31, "weekly", '{"id": 1, "title": 2}', 2), ("Article", 32, "weekly", '{"id": 5, "title": 6}', 1),
            ("Client", 33, "weekly", '{"id": 7, "title": 8}', 3)]
ENTITY_ROWS = {"Vendor": ("supplier", "s_suppkey", "s_name"), "Article": ("part", "p_partkey", "p_name"), "Client": ("customer", "c_custkey", "c_name")}


@query("load_dimensions", """
SELECT x.load_order, x.entity, x.id, x.title FROM (
  SELECT 1 AS load_order, 'Article' AS entity, p_partkey AS id, nullif(p_name, 'None') AS title FROM part UNION ALL
  SELECT 2, 'Vendor', s_suppkey, s_name FROM supplier UNION ALL
  SELECT 3, 'Client', c_custkey, c_name FROM customer) x""")
def load_dimensions(spark, sf_dir):
    """C10 over three landed entities; the position of an entity is its place in the load order (O1)."""
    t = d.Tables(spark, sf_dir)
    registry = spark.createDataFrame(REGISTRY, seeds.ENTITY_SCHEMA)
    raw = {}
    for name, (table, key, title) in ENTITY_ROWS.items():
        cells = [F.struct(F.col(key).cast("string").alias("elementValue")), F.struct(F.col(title).alias("elementValue"))]
        raw[name] = getattr(t, table).select(F.array(*cells).alias("methodValues"))
    typed = lambda s: s.select(F.col("id").cast("bigint").alias("id"), "title")
    out = None
    for place, (name, df) in enumerate(ld.load_dimensions(registry, raw, dict.fromkeys(raw, typed)).items(), 1):
        part = df.select(F.lit(place).alias("load_order"), F.lit(name).alias("entity"), "id", "title")
        out = part if out is None else out.unionByName(part)
    return out


@query("refresh_delete", """
SELECT 'delete' AS what, r.team_dim_id, r.from_date, r.to_date, t.timesheetId AS timesheetid, t.entryId AS entryid, NULL::BOOLEAN AS refreshed
FROM req r, timesheet_data t
WHERE t.userId = r.resource_ppm_id AND t.endDate >= r.from_date AND t.entryDate >= r.from_date AND t.entryDate <= r.to_date
UNION ALL
SELECT 'log', team_dim_id, from_date, to_date, NULL, NULL, is_timesheet_refreshed OR team_dim_id IN (SELECT team_dim_id FROM req)
FROM refresh_log""", ctes=(REQ_CTE,))
def refresh_delete(spark, sf_dir):
    """The entries its delete commands name, and the log after U25."""
    t = d.Tables(spark, sf_dir)
    commands, log = en.refresh_delete(d.refresh_log(t), d.user_team_map(t), d.resource_dim(t), d.generator_timesheet_rows(t))
    named = commands.select(F.lit("delete").alias("what"), "team_dim_id", "from_date", "to_date", "timesheetid",
                            F.explode(E.id_list_to_array("entryid_list")).alias("entryid"), F.lit(None).cast("boolean").alias("refreshed"))
    return named.unionByName(log.select(F.lit("log").alias("what"), "team_dim_id", "from_date", "to_date", F.lit(None).cast("bigint").alias("timesheetid"),
                                        F.lit(None).cast("bigint").alias("entryid"), F.col("is_timesheet_refreshed").alias("refreshed")))


@query("working_days_sql", """
SELECT o_orderkey, (SELECT count(*) FROM range(0, 1 + o_orderkey % 40) g(i) WHERE isodow(first_day + i::INTEGER) <= 5)::INTEGER AS weekdays,
       (SELECT count(*) FROM range(0, 1 + o_orderkey % 40) g(i) WHERE isodow(first_day + i::INTEGER) <= 5
          AND (first_day + i::INTEGER) NOT IN (SELECT holiday_date::DATE FROM holiday_dim WHERE is_mandatory_holiday))::INTEGER AS working_days
FROM (SELECT o_orderkey, DATE '2023-12-20' + (o_orderkey % 50)::INTEGER AS first_day FROM orders)""")
def working_days_sql(spark, sf_dir):
    """V3: the two SQL functions over a date range per order."""
    t = d.Tables(spark, sf_dir)
    d.holiday_dim(t).createOrReplaceTempView("holidays_v3")
    E.register_sql_functions(spark, "holidays_v3")
    k = F.col("o_orderkey")
    first = F.date_add(E.lit_date("2023-12-20"), (k % 50).cast("int"))
    o = t.orders.select("o_orderkey", first.alias("a"), F.date_add(first, (k % 40).cast("int")).alias("b"))
    return o.select("o_orderkey", F.expr("weekdays_sql(a, b)").alias("weekdays"), F.expr("weekdays_holiday_sql(a, b)").cast("int").alias("working_days"))


@query("id_list_to_array", "SELECT c_nationkey::BIGINT AS team, c_custkey AS id FROM customer")
def id_list_to_array(spark, sf_dir):
    """Id lists written as text and read back, one row per id."""
    c = d.Tables(spark, sf_dir).customer.select(F.col("c_nationkey").cast("bigint").alias("team"), F.col("c_custkey").alias("id"))
    lists = ns.bounded_listagg(c, ["team"], "id", "ids")
    return lists.select("team", F.explode(E.id_list_to_array("ids")).alias("id"))


STAGED_LIMIT = 9


@query("over_length", f"""
SELECT p_partkey::VARCHAR AS id, p_name AS title, p_type AS kind FROM part
WHERE greatest(length(p_name), length(p_type), length(p_partkey::VARCHAR)) > {STAGED_LIMIT}""")
def over_length(spark, sf_dir):
    """Staged parts (all columns text) with a value longer than the staging width."""
    p = d.Tables(spark, sf_dir).part
    staged = p.select(F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("title"), F.col("p_type").alias("kind"))
    assert staged.schema == ld.staging_schema(["id", "title", "kind"])
    return ld.over_length(staged, STAGED_LIMIT)


@query("schema_backfill", """
SELECT r_regionkey::INTEGER AS entity_ppm_id,
       CASE WHEN r_regionkey % 2 = 0 THEN 'kept' ELSE (SELECT string_agg(concat(n_nationkey, ':', n_name), ',' ORDER BY n_nationkey)
            FROM nation WHERE n_regionkey = r_regionkey) END AS entity_schema
FROM region""")
def schema_backfill(spark, sf_dir):
    """Regions as entities, their nations as fields; the JSON text is read back."""
    t = d.Tables(spark, sf_dir)
    key = F.col("r_regionkey").cast("int")
    registry = t.region.select(key.alias("entity_ppm_id"), F.when(F.col("r_regionkey") % 2 == 0, F.lit("kept")).alias("entity_schema"))
    catalogue = t.nation.select(F.col("n_regionkey").cast("int").alias("entity_ppm_id"), F.col("n_nationkey").cast("int").alias("field"), F.col("n_name").alias("label"))
    out = ld.schema_backfill(registry, catalogue)
    fields = F.from_json("entity_schema", "array<struct<field:int,label:string>>")
    text = F.array_join(F.transform(fields, lambda x: F.concat_ws(":", x["field"].cast("string"), x["label"])), ",")
    return out.select("entity_ppm_id", F.when(F.col("entity_schema") == "kept", "kept").otherwise(text).alias("entity_schema"))


@query("whole_user_lists", """
SELECT c_nationkey::BIGINT AS team, array_to_string(list(c_custkey ORDER BY c_custkey), ', ') AS ids FROM customer GROUP BY ALL
UNION ALL SELECT -1, NULL""")
def whole_user_lists(spark, sf_dir):
    """Id lists as the warehouse has them: one row per group, and one with NULL where there are no ids at all."""
    c = d.Tables(spark, sf_dir).customer.select(F.col("c_nationkey").cast("bigint").alias("team"), F.col("c_custkey").alias("id"))
    none = ns.bounded_listagg(c.where(F.col("id") < 0), [], "id", "ids", batch_size=None)
    return ns.bounded_listagg(c, ["team"], "id", "ids", batch_size=None).unionByName(none.select(F.lit(-1).cast("bigint").alias("team"), "ids"))


@query("header_days", """
SELECT timesheetId, userId, startDate, endDate, startDate + i::INTEGER AS day
FROM generator_headers, range(0, 7) g(i) WHERE startDate + i::INTEGER <= endDate""")
def header_days(spark, sf_dir):
    """J10's expansion: a row for each day of each header."""
    return ef.header_days(d.generator_headers(d.Tables(spark, sf_dir)), day="day")


@query("user_list_pieces", """
WITH placed AS (SELECT c_nationkey::BIGINT AS team, c_custkey AS id, (row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1) // 1000 AS piece FROM customer)
SELECT team, piece, string_agg(id::VARCHAR, ', ' ORDER BY id) AS ids FROM placed GROUP BY team, piece""")
def user_list_pieces(spark, sf_dir):
    """The same lists in pieces of a thousand ids by their place in the team, however many a team has."""
    c = d.Tables(spark, sf_dir).customer.select(F.col("c_nationkey").cast("bigint").alias("team"), F.col("c_custkey").alias("id"))
    return listagg_pieces(c, ["team"], "id", "ids")
