"""Registered landing queries: S2-S6 (positional entity rows) and S14/S15 (upsert)."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from burnup.functions.expr import lit_date, without_quotes
from burnup.plans import domain as d
from burnup.plans.registry import query
from burnup.session import scratch_path
from burnup.sources import landing as ld
from burnup.sources import seeds as sd
from burnup.sources.landed import read_landed
from burnup.sources.seeds import ENTITY_SCHEMA, ENTITY_SEED

PROJECT_ENTITY = 4


def raw_project_responses(t: d.Tables, aliases: list[str]):
    """What the service would return for the Project entity, derived from ``part``:
    one array of value cells per row, positions in the registry's field order."""
    k, size = F.col("p_partkey"), F.col("p_size")
    text = {
        "id": (k + d.PROJECT_PPM_OFFSET).cast("string"),
        "ahaid": F.when(k % 3 == 0, F.concat(F.lit("A"), k.cast("string"))).otherwise(F.lit("None")),
        "title": F.col("p_name"),
        "status": F.when(size % 2 == 0, F.lit("Active")).otherwise(F.lit("Closed")),
        "category": F.col("p_type"),
        "startdate": F.date_format(F.date_add(lit_date("2024-01-01"), (size % 28).cast("int")), "yyyy-MM-dd"),
        "targetdate": F.when(size % 5 == 0, F.lit("")).otherwise(F.lit("2024-12-31")),
        "canbetemplate": F.lit("false"),
        "completiondate": F.lit("None"),
        "associatedportfolio": (k % 5 + d.PORTFOLIO_PPM_OFFSET).cast("string"),
    }
    cells = [F.struct(text[a].alias("elementValue")) for a in aliases]
    return t.part.select(F.array(*cells).alias("methodValues"))


PROJECT_TYPES = {"id": "bigint", "startdate": "date", "targetdate": "date", "canbetemplate": "boolean",
                 "completiondate": "date", "associatedportfolio": "bigint"}


def landed_projects(spark, sf_dir):
    t = d.Tables(spark, sf_dir)
    registry = spark.createDataFrame(ENTITY_SEED, ENTITY_SCHEMA)
    aliases = [a for _, a, _ in ld.entity_fields(registry, PROJECT_ENTITY)]
    staged = ld.land_entity(raw_project_responses(t, aliases), aliases)
    return staged.select(*[F.col(a).cast(PROJECT_TYPES.get(a, "string")).alias(a) for a in aliases])


LANDED_SQL = """
SELECT CAST(p_partkey + 7000 AS BIGINT) AS id,
       CASE WHEN p_partkey % 3 = 0 THEN 'A' || CAST(p_partkey AS VARCHAR) END AS ahaid,
       p_name AS title, CASE WHEN p_size % 2 = 0 THEN 'Active' ELSE 'Closed' END AS status, p_type AS category,
       DATE '2024-01-01' + CAST(p_size % 28 AS INTEGER) AS startdate,
       CASE WHEN p_size % 5 = 0 THEN NULL ELSE DATE '2024-12-31' END AS targetdate,
       FALSE AS canbetemplate, CAST(NULL AS DATE) AS completiondate,
       CAST(p_partkey % 5 + 500 AS BIGINT) AS associatedportfolio
FROM part"""


@query("land_entity", LANDED_SQL)
def land_entity(spark, sf_dir):
    return landed_projects(spark, sf_dir)


@query("landed_extract", """
SELECT CAST(p_partkey + 7000 AS VARCHAR) AS id, p_name AS title, CAST(p_partkey % 5 + 500 AS VARCHAR) AS associatedportfolio
FROM part WHERE p_size % 2 = 0""")
def landed_extract(spark, sf_dir):
    """Three fields of the active projects from the files the service's answers landed in."""
    registry = spark.createDataFrame(ENTITY_SEED, ENTITY_SCHEMA)
    aliases = [a for _, a, _ in ld.entity_fields(registry, PROJECT_ENTITY)]
    path = scratch_path(spark, f"landed-{uuid.uuid4().hex}")
    raw_project_responses(d.Tables(spark, sf_dir), aliases).write.json(path)
    active = read_landed(spark, path, aliases, ["id", "title", "status", "associatedportfolio"]).where("status = 'Active'")
    return active.select("id", "title", "associatedportfolio")


# The dimension before the load: one project per supplier, of the same number as a part's.
@query("dimension_upsert", f"""
WITH landed AS ({LANDED_SQL}),
known AS (SELECT s_suppkey AS key, CAST(s_suppkey + 7000 AS VARCHAR) AS ppm, s_name AS name,
                 if(s_suppkey % 4 = 0, concat('S', s_suppkey), NULL) AS aha, s_suppkey % 2 = 0 AS kept FROM supplier),
staged AS (SELECT CAST(id AS VARCHAR) AS ppm, title, ahaid, category,
                  (SELECT min(portfolio_dim_id) FROM portfolio_dim f WHERE f.portfolio_ppm_id = CAST(associatedportfolio AS VARCHAR)) AS pf
           FROM landed),
merged AS (SELECT k.key, coalesce(k.ppm, s.ppm) AS ppm, s.ppm IS NOT NULL AS hit, k.name, s.title, k.aha, s.ahaid, s.category, s.pf, k.kept
         FROM known k FULL JOIN staged s ON k.ppm = s.ppm)
SELECT coalesce(key, (SELECT max(key) FROM known) + count(*) FILTER (key IS NULL) OVER (ORDER BY ppm)) AS pv_project_dim_id,
       ppm AS project_ppm_id, if(hit, title, name) AS pv_project_name, coalesce(if(hit, ahaid, aha), aha) AS pv_aha_id,
       if(hit, category, 'none') AS category, if(hit, pf, NULL) AS portfolio_dim_id, kept AS is_maintenance_project
FROM merged""")
def dimension_upsert(spark, sf_dir):
    t = d.Tables(spark, sf_dir)
    k = F.col("s_suppkey")
    target = t.supplier.select(
        k.alias("pv_project_dim_id"), (k + d.PROJECT_PPM_OFFSET).cast("string").alias("project_ppm_id"),
        F.col("s_name").alias("pv_project_name"), F.when(k % 4 == 0, F.concat(F.lit("S"), k.cast("string"))).alias("pv_aha_id"),
        F.lit("none").alias("category"), F.lit(None).cast("bigint").alias("portfolio_dim_id"),
        (k % 2 == 0).alias("is_maintenance_project"))
    landed = landed_projects(spark, sf_dir)
    pd_ = d.portfolio_dim(t).select(F.col("portfolio_ppm_id").try_cast("bigint").alias("__ppm"),
                                    "portfolio_dim_id")
    staged = landed.join(pd_, landed["associatedportfolio"] == pd_["__ppm"], "left").select(
        F.col("id").cast("string").alias("project_ppm_id"), F.col("title").alias("pv_project_name"),
        F.col("ahaid").alias("pv_aha_id"), "category", "portfolio_dim_id")
    return ld.dimension_upsert(target, staged, "project_ppm_id", "pv_project_dim_id",
                               keep_if_null=["pv_aha_id"], keep_always=["is_maintenance_project"])


# --- staging files, seeds, quotes ----------------------------------------------------

def _cell(x) -> str:
    if isinstance(x, bool):
        return str(x).upper()
    return str(x) if isinstance(x, int) else f"TIMESTAMP '{x}'" if isinstance(x, dt.datetime) else "'" + x.replace("'", "''") + "'"


def _values(rows) -> str:
    """Seed rows as SQL VALUES."""
    return ", ".join("(" + ", ".join(map(_cell, r)) + ")" for r in rows)


# Part names with every kind of character that means something in a staging file, and a bad line for each supplier.
@query("staged_parts", r"""
SELECT p_partkey AS id, p_retailprice AS price,
       p_name || CASE p_partkey % 6 WHEN 0 THEN '|x' WHEN 1 THEN ' "q" ""' WHEN 2 THEN '\n \' WHEN 3 THEN chr(10) || '|' || chr(13) || chr(10)
                                    WHEN 4 THEN ' ~ ''' ELSE ' \\"' END AS name,
       CASE WHEN p_partkey % 4 > 0 THEN p_brand END AS brand, NULL AS rejected FROM part
UNION ALL SELECT NULL, NULL, NULL, NULL, s_suppkey || CASE s_suppkey % 3 WHEN 0 THEN '|no number|a|b' WHEN 1 THEN '|1.5|a|b|too many' ELSE '|too few' END
FROM supplier""")
def staged_parts(spark, sf_dir):
    """Staged and read back, typed; lines that are no record are kept apart."""
    t = d.Tables(spark, sf_dir)
    odd = F.element_at(F.array(*map(F.lit, ["|x", ' "q" ""', "\\n \\", "\n|\r\n", " ~ '", ' \\\\"'])), (F.col("p_partkey") % 6 + 1).cast("int"))
    parts = t.part.select(F.col("p_partkey").alias("id"), F.col("p_retailprice").alias("price"), F.concat("p_name", odd).alias("name"),
                          F.when(F.col("p_partkey") % 4 > 0, F.col("p_brand")).otherwise("").alias("brand"))
    path = scratch_path(spark, f"staged-{uuid.uuid4().hex}")
    ld.stage_delimited(parts, f"{path}/good")
    what = F.element_at(F.array(*map(F.lit, ["|no number|a|b", "|1.5|a|b|too many", "|too few"])), (F.col("s_suppkey") % 3 + 1).cast("int"))
    lines = t.supplier.select(F.concat(F.col("s_suppkey").cast("string"), what).alias("id|price|name|brand"))
    lines.write.option("header", True).option("sep", "\u0001").csv(f"{path}/bad")  # whole lines below the header
    rows, rejected = ld.read_staged(spark, [f"{path}/good", f"{path}/bad"], "id bigint, price double, name string, brand string")
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields]
    return rows.withColumn("rejected", F.lit(None).cast("string")).unionByName(rejected.select(*none, F.col(ld.REJECTED).alias("rejected")))


@query("seed_entities", f"""
WITH registry AS (SELECT p_name AS entity_name, CAST(p_partkey AS INTEGER) AS entity_ppm_id, p_brand AS load_frequency, '{{}}' AS column_select_list,
                         p_size AS load_sequence FROM part)
SELECT * FROM registry UNION ALL
SELECT * FROM (VALUES {_values(ENTITY_SEED)}) v(entity_name, entity_ppm_id, load_frequency, column_select_list, load_sequence)
WHERE NOT EXISTS (FROM registry r WHERE r.entity_ppm_id = v.entity_ppm_id)""")
def seed_entities(spark, sf_dir):
    """S8 into a registry that has an entity of each part's number."""
    p = d.Tables(spark, sf_dir).part
    registry = p.select(F.col("p_name").alias("entity_name"), F.col("p_partkey").cast("int").alias("entity_ppm_id"), F.col("p_brand").alias("load_frequency"),
                        F.lit("{}").alias("column_select_list"), F.col("p_size").alias("load_sequence"))
    return sd.seed_entities(spark, registry)


@query("seed_admin_tasks", f"""
WITH task AS (SELECT s_name AS admin_task_name, CAST(s_suppkey AS INTEGER) AS admin_task_ppm_id FROM supplier)
SELECT * FROM task UNION ALL
SELECT * FROM (VALUES {_values(sd.ADMIN_TASK_SEED)}) v(admin_task_name, admin_task_ppm_id)
WHERE NOT EXISTS (FROM task t WHERE t.admin_task_ppm_id = v.admin_task_ppm_id)""")
def seed_admin_tasks(spark, sf_dir):
    """S9 into tasks of the suppliers' numbers."""
    s = d.Tables(spark, sf_dir).supplier
    return sd.seed_admin_tasks(spark, s.select(F.col("s_name").alias("admin_task_name"), F.col("s_suppkey").cast("int").alias("admin_task_ppm_id")))


@query("seed_holidays", f"""
WITH calendar AS (SELECT TIMESTAMP '2019-12-01' + INTERVAL 1 DAY * (o_orderkey % 28) AS holiday_date, min(o_orderpriority) AS holiday_name, 'US' AS holiday_country,
                         'US' AS holiday_state, count(*) > 1 AS is_mandatory_holiday FROM orders GROUP BY o_orderkey % 28)
SELECT * FROM calendar UNION ALL
SELECT * FROM (VALUES {_values(sd.HOLIDAY_SEED)}) v(holiday_date, holiday_name, holiday_country, holiday_state, is_mandatory_holiday)
WHERE NOT EXISTS (FROM calendar c WHERE c.holiday_date = v.holiday_date)""")
def seed_holidays(spark, sf_dir):
    """S10 into a calendar of all orders, folded into December 2019."""
    o = d.Tables(spark, sf_dir).orders
    day = F.date_add(lit_date("2019-12-01"), (F.col("o_orderkey") % 28).cast("int")).cast("timestamp_ntz")
    calendar = o.groupBy(day.alias("holiday_date")).agg(F.min("o_orderpriority").alias("holiday_name"), (F.count(F.lit(1)) > 1).alias("is_mandatory_holiday"))
    return sd.seed_holidays(spark, calendar.select("holiday_date", "holiday_name", F.lit("US").alias("holiday_country"), F.lit("US").alias("holiday_state"),
                                                   "is_mandatory_holiday"))


@query("error_texts", r"""
SELECT event_id, replace(replace(replace(props || ' can''t open C:\' || event_type, '''', ''), '"', ''), '\', '\\') AS message FROM events""")
def error_texts(spark, sf_dir):
    """E14 over the messages of all events."""
    e = d.Tables(spark, sf_dir).events
    return e.select("event_id", without_quotes(F.concat("props", F.lit(" can't open C:\\"), "event_type")).alias("message"))
