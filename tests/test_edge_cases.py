"""Edge cases on small hand-made frames (the FIXTURES section 4 list)."""

import datetime as dt
import decimal
import random

import pytest
from pyspark.sql import functions as F

from burnup.functions import expr as E
from burnup.operators import apply as ap
from burnup.operators import effort as ef
from burnup.operators import entries as en
from burnup.operators import mapping as mp
from burnup.operators import nesting as ns
from burnup.operators import quality as qa
from burnup.operators import sprints as sp
from burnup.sources import landing as ld

D = dt.date
T = dt.datetime


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)


def test_flag_tests(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, f boolean")
    assert [r.id for r in df.where(E.flag_unset("f")).orderBy("id").collect()] == [2, 3]
    assert [r.id for r in df.where(E.flag_set("f")).collect()] == [1]


def test_json_fields(spark):
    docs = [
        (1, '{"fields": {"customfield_10411": 3.5, "resolutiondate": "2024-01-03 10:00:00"}}'),
        (2, '{"fields": {"customfield_10411": null}}'),
        (3, '{"fields": {}}'),
        (4, 'not json at all'),
        (5, '{"fields": {"customfield_10411": "abc", "resolutiondate": "2024-01-03 10:00:00-0500"}}'),
    ]
    df = spark.createDataFrame(docs, "id int, doc string")
    out = {r.id: (r.p, r.r) for r in df.select(
        "id", E.json_decimal("doc", "fields", "customfield_10411").alias("p"),
        E.json_timestamp("doc", "fields", "resolutiondate").alias("r")).collect()}
    assert float(out[1][0]) == 3.5 and out[1][1] == T(2024, 1, 3, 10)
    assert out[2] == (None, None) and out[3] == (None, None) and out[4] == (None, None)
    assert out[5][0] is None
    # A zone suffix does not shift a zone-less timestamp.
    assert out[5][1] in (None, T(2024, 1, 3, 10))


def _weekdays_brute(a, b, holidays=()):
    if a > b:
        return 0
    n = 0
    d = a
    while d <= b:
        if d.weekday() < 5 and d not in holidays:
            n += 1
        d += dt.timedelta(days=1)
    return n


def test_working_days_against_brute_force(spark):
    rnd = random.Random(7)
    base = D(2023, 12, 1)
    pairs = [(base + dt.timedelta(days=rnd.randint(0, 60)), base + dt.timedelta(days=rnd.randint(0, 60)))
             for _ in range(300)]
    pairs += [(D(2024, 1, 6), D(2024, 1, 7)), (D(2024, 1, 8), D(2024, 1, 8)), (D(2024, 1, 9), D(2024, 1, 2))]
    hol = [D(2024, 1, 1), D(2024, 1, 13), D(2024, 1, 15)]
    df = spark.createDataFrame(pairs, "a date, b date")
    h = spark.createDataFrame([(T(x.year, x.month, x.day), True) for x in hol],
                              "holiday_date timestamp_ntz, is_mandatory_holiday boolean")
    out = df.withColumn("hol", E.holiday_array(h)).select(
        "a", "b", E.weekdays_between("a", "b").alias("w"),
        E.working_days_between("a", "b", F.col("hol")).alias("x")).collect()
    for r in out:
        assert r.w == _weekdays_brute(r.a, r.b), r
        assert r.x == _weekdays_brute(r.a, r.b, set(hol)), r


def _sprints(spark, rows_):
    return spark.createDataFrame(rows_, "sprint_number bigint, team_dim_id bigint, sprint_start_date timestamp_ntz, "
                                        "sprint_complete_date timestamp_ntz, actual_sprint_start_date date")


def test_actual_start_global_and_team_scope(spark):
    s = _sprints(spark, [
        (1, 1, T(2024, 1, 1, 9), T(2024, 1, 5, 17), None),
        (2, 1, T(2024, 1, 5, 9), T(2024, 1, 10, 17), None),     # previous completed the same day
        (1, 2, T(2024, 1, 10, 8), T(2024, 1, 12, 17), None),    # previous team's last: same day
        (2, 2, T(2024, 1, 13, 9), T(2024, 1, 15, 9), D(2024, 1, 1)),  # target already filled
    ])
    g = {(r.team_dim_id, r.sprint_number): r.actual_start_date for r in sp.actual_sprint_start(s).collect()}
    assert g[(1, 1)] == D(2024, 1, 1) and g[(1, 2)] == D(2024, 1, 6)
    assert g[(2, 1)] == D(2024, 1, 11) and g[(2, 2)] == D(2024, 1, 13)
    t = {(r.team_dim_id, r.sprint_number): r.actual_start_date
         for r in sp.actual_sprint_start(s, scope="team").collect()}
    assert t[(2, 1)] == D(2024, 1, 10)
    u = {(r.team_dim_id, r.sprint_number): r.actual_sprint_start_date for r in sp.set_actual_start(s).collect()}
    assert u[(2, 2)] == D(2024, 1, 1)


def test_membership_strict_and_non_strict(spark):
    s = spark.createDataFrame([(1, 1, T(2024, 1, 1, 9), T(2024, 1, 5, 9), T(2024, 1, 6, 9))],
                              "sprint_number bigint, team_dim_id bigint, sprint_start_date timestamp_ntz, "
                              "sprint_end_date timestamp_ntz, sprint_complete_date timestamp_ntz")
    m = spark.createDataFrame([
        (10, 1, T(2024, 1, 1, 9), None),                # starts exactly at start
        (11, 1, T(2023, 12, 1), T(2024, 1, 5, 9)),      # ends exactly at sprint end
        (12, 1, T(2023, 12, 1), None),                  # open end
        (13, 1, T(2023, 12, 1), T(2024, 1, 6, 9)),      # ends exactly at completion
    ], "user_dim_id bigint, team_dim_id bigint, team_entry_date timestamp_ntz, team_exit_date timestamp_ntz")
    as_of = T(2024, 2, 1)
    strict = {r.user_dim_id for r in sp.members_covering(s, m, as_of, strict=True).collect()}
    loose = {r.user_dim_id for r in sp.members_covering(s, m, as_of, strict=False, end_col="sprint_end_date").collect()}
    assert strict == {12}
    assert loose == {10, 11, 12, 13}


def test_like_pattern_matches_equals_brute_force(spark):
    names = ["teammiddleeastcare", "teamasiacare", "a_b", "axb", "", "x", "europe", "teameurope_care", None]
    patterns = ["%middle%east%", "%asia%", "%a_b%", "%%", "%_%", "__", "%europe%", "%e_r%", "%care"]
    n = spark.createDataFrame([(x,) for x in names], "name string")
    p = spark.createDataFrame([(x,) for x in patterns], "pattern string")
    got = rows(mp.like_pattern_matches(n, "name", p, "pattern"), "name", "pattern")
    brute = rows(n.join(p, F.expr("name LIKE pattern")), "name", "pattern")
    assert got == brute and len(got) > 5


def test_epic_or_join_gives_one_row(spark):
    epics = spark.createDataFrame([(1, "A3"), (2, "https://x/y/A6 "), (3, "B9")], "epic_dim_id bigint, aha_reference string")
    projects = spark.createDataFrame([(30, "A3", 1), (60, "A6", 2)],
                                     "pv_project_dim_id bigint, pv_aha_id string, portfolio_dim_id bigint") \
        .withColumn("pv_project_name", F.lit("p")).withColumn("category", F.lit("c")) \
        .withColumn("is_maintenance_project", F.lit(None).cast("boolean"))
    portfolios = spark.createDataFrame([(1, "P1")], "portfolio_dim_id bigint, portfolio_name string")
    c = {r.epic_dim_id: (r.pv_project_dim_id, r.portfolio_dim_id)
         for r in mp.epic_project_candidates(epics, projects, portfolios).collect()}
    assert c == {1: (30, 1), 2: (60, None)}


def _timesheets(spark):
    entry = ("struct<companyId:bigint,entryDate:date,entryHours:decimal(18,2),entryId:bigint,entryTypeId:bigint,"
             "externalId:string,internalRate:decimal(18,2),billableRate:decimal(18,2),isBillable:boolean,"
             "isProductive:boolean,level1Id:bigint,level2Id:bigint,level3Id:bigint,locationId:bigint,notes:string,"
             "state:string>")
    schema = (f"timesheetId bigint, userId bigint, startDate date, endDate date, entriesProject array<{entry}>, "
              f"entriesOther array<{entry}>, entriesAccount array<{entry}>, entriesPortfolio array<{entry}>")

    def e(i, t):
        return (0, D(2024, 1, 2), decimal.Decimal("1.00"), i, t, None, None, None, None, None, 7001, 1, 1, None, None,
                "Open")
    data = [
        (1, 100, D(2024, 1, 1), D(2024, 1, 7), None, [], None, []),
        (2, 100, D(2024, 1, 1), D(2024, 1, 7), [e(1, 1), e(2, 1)], [e(3, 2)], [e(4, 3)], [e(5, 99)]),
        (3, 101, D(2024, 1, 1), D(2024, 1, 7), [], None, None, None),
    ]
    return spark.createDataFrame(data, schema)


def test_explode_and_flatten(spark):
    ts = _timesheets(spark)
    n1 = ns.explode_project_entries(ts)
    assert rows(n1, "timesheetId", "entryId") == [(1, None), (2, 1), (2, 2), (3, None)]
    n2 = ns.flatten_all_entries(ts)
    assert rows(n2, "timesheetid", "entryid", "entrytypeid") == [(2, 1, 1), (2, 2, 1), (2, 3, 2), (2, 4, 3), (2, 5, 99)]
    assert all(r.isbillable is False for r in n2.collect())


def test_population_reuses_existing_entry_ids(spark):
    plan = spark.createDataFrame([
        (100, D(2024, 1, 2), 2.0, 7001, 1, 5), (100, D(2024, 1, 3), 2.0, 7001, 1, 5),
        (100, D(2024, 2, 20), 2.0, 7001, 1, 5)],
        "resource_ppm_id bigint, date_of_sprint date, per_day_time_spent double, project_ppm_id bigint, "
        "task_ppm_id bigint, resource_role_id bigint")
    data = spark.createDataFrame([
        (9, 100, D(2024, 1, 1), D(2024, 1, 7), 77, D(2024, 1, 2), 1.0, 7001, 1)],
        "timesheetId bigint, userId bigint, startDate date, endDate date, entryId bigint, entryDate date, "
        "entryHours double, project_ppm_id bigint, task_ppm_id bigint")
    out = rows(ef.timesheet_population(plan, data), "entryDate", "entryId", "timesheetId")
    assert out == [("2024/01/02", 77, 9), ("2024/01/03", 0, 9)]


def _people(spark):
    members = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (4, 1)], "user_dim_id bigint, team_dim_id bigint")
    teams = spark.createDataFrame([(1, True)], "team_dim_id bigint, is_reportable boolean")
    res = spark.createDataFrame([(1, 1001), (2, 1002), (3, 1003), (4, 1004)],
                                "resource_dim_id bigint, resource_ppm_id bigint")
    return members, teams, res


def test_pull_watermarks_rules(spark):
    members, teams, res = _people(spark)
    entries = spark.createDataFrame([
        (2, D(2024, 1, 5), "Open"),                   # only unapproved -> user 2 absent
        (3, D(2024, 1, 9), "Fully Approved"), (3, D(2024, 1, 10), "Open"),
        (4, D(2024, 1, 9), None)],                    # state-less counts as approved
        "resource_dim_id bigint, entrydate date, state string")
    out = rows(en.pull_watermarks(members, teams, res, entries), "min", "user_list")
    assert out == [("20200101", "1001"), ("20240109", "1003, 1004")]


def test_entry_project_overwrites_both_keys(spark):
    e = spark.createDataFrame([(1, 7001, None, 5), (1, 7002, 3, None), (1, 7003, 3, 4), (99, 7001, None, None)],
                              "entrytypeid bigint, level1id bigint, project_dim_id bigint, portfolio_dim_id bigint")
    p = spark.createDataFrame([("7001", 1, None), ("7002", 2, 20), ("7003", 3, 30)],
                              "project_ppm_id string, pv_project_dim_id bigint, portfolio_dim_id bigint")
    out = rows(en.set_entry_project(e, p))
    assert out == [(1, 7001, 1, None), (1, 7002, 2, 20), (1, 7003, 3, 4), (99, 7001, None, None)]


def test_versioned_replace_twice(spark, tables):
    from burnup.plans import domain as d
    store = d.timesheet_entries(tables)
    batch = d.import_batch(tables)
    once = en.versioned_replace(store, batch, d.AS_OF)
    twice = en.versioned_replace(once, batch, d.AS_OF)
    active = lambda df: rows(df.where("is_active").drop("date_created"))
    assert active(once) == active(twice)
    assert twice.where("not is_active").count() > once.where("not is_active").count()


ROW_SCHEMA = ("companyId int, entryTypeId int, timesheetId bigint, userId bigint, level1Id bigint, "
              "level2Id bigint, entryDate string, entryId bigint, level3Id bigint, entryHours double")
ACK_SCHEMA = "timesheetId bigint, userId bigint, chunk string, ok boolean"


def test_dead_letter_pairs_and_hours(spark):
    dl = spark.createDataFrame([(0, 1, 1, 23, 1, 1, D(2024, 1, 1), 0, 1, 1.0, T(2024, 1, 1))],
                               ", ".join(f"{c} {t}" for c, t in zip(ef.DEAD_LETTER_COLS, [
                                   "int", "int", "bigint", "bigint", "bigint", "bigint", "date", "bigint",
                                   "bigint", "double", "timestamp_ntz"])))
    day, other = "2024/01/02", "2024/01/03"
    rws = spark.createDataFrame([(0, 1, 12, 3, 5, 6, day, 0, 1, None), (0, 1, 1, 23, 5, 6, day, 0, 1, 2.0),
                                 (0, 1, 12, 3, 5, 6, other, 0, 1, 4.0)], ROW_SCHEMA)
    acks = spark.createDataFrame([(12, 3, day, False), (1, 23, day, False), (12, 3, other, True)], ACK_SCHEMA)
    out = ef.dead_letter_append(dl, rws, acks, T(2024, 1, 24))
    got = rows(out, "timesheetId", "userId", "entryHours")
    assert got == [(1, 23, 1.0), (12, 3, 0.0)]  # the accepted chunk is not kept for a retry
    again = ef.dead_letter_append(out, rws, acks, T(2024, 1, 25))
    assert again.count() == out.count()
    cleared = ef.dead_letter_clear(out, spark.createDataFrame([(12, 3, day, True), (1, 23, day, True)], ACK_SCHEMA))
    assert rows(cleared, "timesheetId", "userId") == [(1, 23)]  # its row is of another day


def test_accepted_chunks_are_never_sent_again(spark):
    days = ["2024/01/02", "2024/01/03", "2024/01/04"]
    rws = spark.createDataFrame([(0, 1, 5, 9, 7001, i, x, 0, 1, 1.0) for x in days for i in range(3)], ROW_SCHEMA)
    dl = spark.createDataFrame([], ", ".join(f"{c} {t}" for c, t in zip(ef.DEAD_LETTER_COLS, [
        "int", "int", "bigint", "bigint", "bigint", "bigint", "date", "bigint", "bigint", "double", "timestamp_ntz"])))
    sent = []

    def service(payload):
        sent.append(payload)
        return payload.select("timesheetId", "userId", "chunk", (F.col("chunk") != days[1]).alias("ok"))

    left = ef.apply_push_result(dl, rws, service, T(2024, 1, 24))
    assert {str(r.entryDate) for r in left.collect()} == {"2024-01-03"} and left.count() == 3
    assert [r.chunk for r in sent[1].select("chunk").collect()] == [days[1]]


def test_no_users_no_flag(spark, tables):
    from burnup.plans import domain as d
    args = lambda members: (d.sprint_summary(tables), d.sprint_issues(tables), members, d.resource_dim(tables),
                            d.team_dim(tables), d.projects_dim(tables), d.generator_timesheet_rows(tables),
                            E.holiday_array(d.holiday_dim(tables)), d.push_acknowledgements, d.AS_OF)
    populated = lambda df: df.where("is_timesheet_populated").count()
    before = populated(d.sprint_summary(tables))
    none = ef.generate_timesheets(*args(d.user_team_map(tables).limit(0)))
    assert none["payload"].count() == 0 and populated(none["sprints"]) == before
    some = ef.generate_timesheets(*args(d.user_team_map(tables)))
    assert populated(some["sprints"]) > before


def test_hot_user_day_uses_all_keys(spark):
    """One user's day with many planned rows and booked entries: an equality on all keys, not a product."""
    n = 30_000
    plan = spark.range(n).select(F.lit(1).cast("bigint").alias("resource_ppm_id"), F.lit(D(2024, 1, 2)).alias("date_of_sprint"),
                                 F.lit(1.0).alias("per_day_time_spent"), F.col("id").alias("project_ppm_id"),
                                 F.lit(1).cast("bigint").alias("task_ppm_id"), F.lit(1).cast("bigint").alias("resource_role_id"))
    data = spark.range(n // 2).select(F.lit(7).cast("bigint").alias("timesheetId"), F.lit(1).cast("bigint").alias("userId"),
                                      F.lit(D(2024, 1, 1)).alias("startDate"), F.lit(D(2024, 1, 7)).alias("endDate"),
                                      (F.col("id") + 1).alias("entryId"), F.lit(D(2024, 1, 2)).alias("entryDate"),
                                      F.col("id").alias("project_ppm_id"), F.lit(1).cast("bigint").alias("task_ppm_id"))
    out = ef.timesheet_population(plan, data)
    assert out.count() == n and out.where("entryId > 0").count() == n // 2


def test_header_of_any_length(spark):
    h = spark.createDataFrame([(1, 1, D(1950, 1, 1), D(2049, 12, 31)), (2, 1, D(2024, 1, 1), D(2024, 1, 7)), (3, 1, D(2024, 1, 7), D(2024, 1, 1))],
                              "timesheetId bigint, userId bigint, startDate date, endDate date")
    assert [r[1] for r in ef.header_days(h).groupBy("timesheetId").count().orderBy("timesheetId").collect()] == [36525, 7]
    plan = spark.createDataFrame([(1, D(1949, 12, 31)), (1, D(1950, 1, 1)), (1, D(2024, 1, 7)), (1, D(2050, 1, 1)), (2, D(2024, 1, 1)), (1, None)],
                                 "resource_ppm_id bigint, date_of_sprint date").selectExpr(
        "*", "2L AS project_ppm_id", "3L AS task_ppm_id", "1L AS resource_role_id", "8D AS per_day_time_spent")
    data = h.selectExpr("*", "CAST(NULL AS BIGINT) AS entryId", "CAST(NULL AS DATE) AS entryDate", "2L AS project_ppm_id", "3L AS task_ppm_id")
    got = sorted((r.timesheetId, r.userId, r.entryDate) for r in ef.timesheet_population(plan, data).collect())
    assert got == [(1, 1, "1950/01/01"), (1, 1, "2024/01/07"), (2, 1, "2024/01/07")]
    draft = sorted((r.timesheetId, r.date_of_sprint) for r in ef.draft_timesheet_population(plan, data).collect())
    assert draft == [(1, "1950/01/01"), (1, "2024/01/07"), (2, "2024/01/07")]


def test_range_cover_against_brute_force(spark):
    from burnup.operators.intervals import range_pieces
    r = random.Random(4)
    first, last = D(1, 1, 1).toordinal(), D(9999, 12, 31).toordinal()
    days = [r.randint(first, last) for _ in range(60)] + [D(1970, 1, 1).toordinal() + i for i in (-33, -32, -1, 0, 1, 31, 32, 1024)]
    spans = [(a, a + r.choice([0, 1, 6, 30, 31, 32, 63, 64, 400, 36525, -1])) for a in days] + [(first, last)]
    df = spark.createDataFrame([(i, D.fromordinal(a), D.fromordinal(min(b, last))) for i, (a, b) in enumerate(spans)], "i int, a date, b date")
    epoch = D(1970, 1, 1).toordinal()
    for x in df.select("i", range_pieces(F.col("a"), F.col("b")).alias("p")).collect():
        lo, hi = spans[x.i][0] - epoch, min(spans[x.i][1], last) - epoch
        covered = sorted((p.block << 5 * p.level, (p.block + 1 << 5 * p.level) - 1) for p in x.p)
        assert len(x.p) <= 62 * 5
        assert all(q[0] == p[1] + 1 for p, q in zip(covered, covered[1:]))
        assert (covered[0][0], covered[-1][1]) == (lo, hi) if lo <= hi else not covered


def test_timesheet_table_functions(spark, tables):
    """Called in SQL for a list and for each row; calls per row are an equi join, not a loop over rows."""
    from burnup.plans import queries_effort as q
    s2, plan = q._all_sprints_plan(spark, tables.sf_dir)
    ef.register_timesheet_functions(plan, "entries_of_list", "entries_of_sprint")
    numbers = [r[0] for r in plan.select("sprint_number").distinct().orderBy("sprint_number").collect()][:2]
    want = plan.where(F.col("sprint_number").isin(numbers))
    listed = spark.sql(f"SELECT * FROM entries_of_list(' {numbers[0]},{numbers[1]} ')")
    assert listed.columns == plan.columns and listed.exceptAll(want).count() == 0 == want.exceptAll(listed).count()
    spark.createDataFrame([(n,) for n in [*numbers, numbers[0], None, -5]], "n bigint").createOrReplaceTempView("some_numbers")
    each = spark.sql("SELECT s.n, e.* FROM some_numbers s, LATERAL entries_of_sprint(s.n) e")
    assert each.where(F.col("n") != F.col("sprint_number")).count() == 0
    assert each.count() == want.count() + plan.where(F.col("sprint_number") == numbers[0]).count()
    shown = each._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in shown and "Cartesian" not in shown
    assert spark.sql("SELECT * FROM entries_of_list('')").count() == 0 == spark.sql("SELECT * FROM entries_of_list(NULL)").count()


def test_sanity_suite_statuses(spark):
    spark.createDataFrame([(1, "0", None, 0.6), (2, "0", None, 0.6)], "x int, s string, n int, f double").createOrReplaceTempView("qa_t")
    sql = {"two rows": ("SELECT count(*) FROM qa_t", 2), "empty": ("SELECT x FROM qa_t WHERE x > 5", 0), "wrong": ("SELECT count(*) FROM qa_t", 3),
           "null cell": ("SELECT n FROM qa_t", 0), "fraction": ("SELECT f FROM qa_t", 0), "text": ("SELECT s FROM qa_t", 0),
           "order": ("SELECT x FROM qa_t ORDER BY x DESC", 2), "dotted": ("SELECT 0.6", 0), "dotted ok": ("SELECT 3.0", 3), "broken": ("SELECT nothing FROM nowhere", 0),
           "fails late": ("SELECT CAST(s || 'x' AS INT) FROM qa_t", 0), "two columns": ("SELECT x AS a, x AS a FROM qa_t ORDER BY 1", 1)}
    rules = spark.createDataFrame([(q, name, exp, "effort") for name, (q, exp) in sql.items()] + [("SELECT 1", "other project", 9, "other")],
                                  "query string, name string, expected_value bigint, project_name string")
    out = {r.condition: (r.actual_value, r.status, r.message) for r in qa.sanity_suite(spark, rules, T(2024, 1, 24), 7).collect()}
    assert {k for k, v in out.items() if v[1] == "Success"} == {"two rows", "empty", "order", "dotted ok", "two columns"}
    assert out["two rows"] == ("2", "Success", None) and out["empty"][0] == "0" and out["null cell"][0] is None
    assert "expected 3, found 2" in out["wrong"][2] and "could not run" in out["broken"][2] and "could not run" in out["fails late"][2]
    assert "other project" not in out and qa.sanity_suite(spark, rules.limit(0), T(2024, 1, 24), 7).count() == 0


def test_rules_of_one_table_share_a_pass(spark):
    spark.createDataFrame([(1, "a", None), (2, "b", 3.0), (None, None, -1.0)], "k int, s string, x double").createOrReplaceTempView("checked")
    spark.createDataFrame([(1,), (9,)], "k int").createOrReplaceTempView("other_checked")
    rules = [("all", "SELECT count(*) FROM checked"), ("null", "select COUNT(*) from checked where x > 0"), ("alias", "SELECT count(*) FROM checked c WHERE c.k IS NULL OR c.x < 0;"),
             ("text", "SELECT count(*)\nFROM checked\nWHERE s = 'it is where'"), ("as", "SELECT count(*) FROM checked AS d WHERE d.s LIKE 'a%'"),
             ("other", "SELECT count(*) FROM checked c WHERE EXISTS (SELECT 1 FROM other_checked o WHERE o.k = c.k)"), ("join", "SELECT count(*) FROM checked, other_checked"),
             ("group", "SELECT count(*) FROM checked GROUP BY k"), ("distinct", "SELECT count(DISTINCT k) FROM checked"), ("two", "SELECT count(*), 1 FROM checked")]
    shared = qa.shared_rules(rules)
    assert {t: [n for n, _, _ in x] for t, x in shared.items()} == {"checked": ["all", "null", "alias", "text", "as"]}
    counted = qa.shared_counts(spark, rules)
    assert set(counted) == {"all", "null", "alias", "text", "as"}
    assert all(spark.sql(sql).first()[0] == counted[n] for n, sql in rules if n in counted)
    # one rule that can't run: it fails alone, the others of its table have their counts
    some = rules[:2] + [("broken", "SELECT count(*) FROM checked WHERE no_such_column = 1"), ("missing", "SELECT count(*) FROM no_such_table"), ("raises", "SELECT count(*) FROM checked WHERE 1 / (k - 1) > 0")]
    table = spark.createDataFrame([(sql, n, 3, "effort") for n, sql in some], "query string, name string, expected_value bigint, project_name string")
    got = {r.condition: (r.actual_value, r.status) for r in qa.sanity_suite(spark, table, T(2024, 1, 24), 1).collect()}
    assert got == {"all": ("3", "Success"), "null": ("1", "Fail"), "broken": (None, "Fail"), "missing": (None, "Fail"), "raises": (None, "Fail")}


@pytest.mark.parametrize("seed", [1, 2])
def test_ledger_stream_equals_batch_in_any_order(spark, tmp_path, seed):
    from burnup.streaming.ledger import read_ledger, start_ledger_stream
    r = random.Random(seed)
    t0 = T(2024, 1, 1)
    events = [(i % 12, i % 12 % 4, r.choice(["start", "end", "error", "main_start", "main_end", "end"]), t0 + dt.timedelta(minutes=r.randint(0, 40)), "m") for i in range(60)]
    schema = "task_id bigint, main_task_id bigint, kind string, ts timestamp_ntz, message string"
    df = spark.createDataFrame(events, schema)
    for start in (0, 25):  # the second run goes on from the first one's progress
        part = spark.createDataFrame(events[start: 25 if not start else 60], schema)
        part.repartition(2).write.mode("append").parquet(str(tmp_path / "events"))
        for q in start_ledger_stream(spark, str(tmp_path / "events"), df.schema, str(tmp_path / "ledger"), files_per_batch=1):
            q.awaitTermination()
    assert rows(read_ledger(spark, str(tmp_path / "ledger"))) == rows(qa.run_ledger_fold(df))


def test_null_tokens_and_length_check(spark):
    raw = spark.createDataFrame([([("1",), ("None",), ("",)],), ([("2",), ("x" * 101,), ("ok",)],)],
                                "methodValues array<struct<elementValue:string>>")
    out = ld.land_entity(raw, ["id", "title", "status"])
    assert rows(out) == [("1", None, None), ("2", "x" * 101, "ok")]
    assert ld.over_length(out).count() == 1


def test_mark_refreshed_flags_every_request_of_team(spark):
    log = spark.createDataFrame([(0, D(2024, 1, 5), D(2024, 1, 20), False), (0, D(2024, 1, 10), D(2024, 1, 12), False),
                                 (6, D(2024, 1, 5), D(2024, 1, 20), False)],
                                "team_dim_id bigint, from_date date, to_date date, is_timesheet_refreshed boolean")
    members = spark.createDataFrame([(1, 0, True)], "user_dim_id bigint, team_dim_id bigint, is_active boolean")
    res = spark.createDataFrame([(1, 1001)], "resource_dim_id bigint, resource_ppm_id bigint")
    out = rows(en.mark_refreshed(log, members, res), "team_dim_id", "is_timesheet_refreshed")
    assert out == [(0, True), (0, True), (6, False)]


def test_assign_keys_consecutive(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7 % 5003).cast("string").alias("k")).distinct()
    out = ld.assign_keys(df, "k", 100, "key").collect()
    ordered = sorted(out, key=lambda r: r.k)
    assert [r.key for r in ordered] == list(range(101, 101 + len(ordered)))


def test_assign_keys_at_size(spark, tmp_path):
    n = 2_000_000
    df = spark.range(0, n, 1, 16).select(F.sha1(F.col("id").cast("string")).alias("k"))
    ld.assign_keys(df, "k", 10, "key").write.parquet(str(tmp_path / "keys"))
    got = spark.read.parquet(str(tmp_path / "keys")).agg(F.count_distinct("key"), F.min("key"), F.max("key"), F.count("k")).first()
    assert tuple(got) == (n, 11, 10 + n, n)


def test_upsert_null_and_repeated_keys(spark):
    cols = "key bigint, k string, v string, by_hand string"
    target = spark.createDataFrame([(1, "a", "x", "h1"), (2, None, "manual", "h2"), (3, "c", "z", "h3")], cols)
    staged = spark.createDataFrame([("a", "new"), ("b", "q"), ("b", "p"), (None, "n1"), (None, "n2")], "k string, v string")
    out = {(r.k, r.v): (r.key, r.by_hand) for r in ld.dimension_upsert(target, staged, "k", "key", keep_always=["by_hand"]).collect()}
    assert {k: v for k, v in out.items() if v[1]} == {("a", "new"): (1, "h1"), (None, "manual"): (2, "h2"), ("c", "z"): (3, "h3")}
    assert {k for k, v in out.items() if not v[1]} == {("b", "p"), (None, "n1"), (None, "n2")}
    assert sorted(v[0] for v in out.values()) == [1, 2, 3, 4, 5, 6]


def test_upsert_of_many_new_rows(spark, tmp_path):
    n = 150_000
    target = spark.createDataFrame([(7, "00000000", "old")], "key bigint, k string, v string")
    staged = spark.range(0, n, 1, 8).select(F.lpad(F.col("id").cast("string"), 8, "0").alias("k"), F.lit("new").alias("v"))
    ld.dimension_upsert(target, staged, "k", "key").write.parquet(str(tmp_path / "dim"))
    got = spark.read.parquet(str(tmp_path / "dim")).agg(F.count_distinct("key"), F.min("key"), F.max("key"), F.count_distinct("k")).first()
    assert tuple(got) == (n, 7, 7 + n - 1, n)


def test_fractional_ids_round(spark):
    stored = spark.createDataFrame([(1, 5, True)], "timesheetid bigint, entryid bigint, is_active boolean")
    batch = spark.createDataFrame([(decimal.Decimal("2.5"), decimal.Decimal("6.4"))], "timesheetid decimal(10,2), entryid decimal(10,2)")
    assert rows(en.versioned_replace(stored, batch, T(2024, 1, 1)).where("timesheetid <> 1")) == [(3, 6, True)]


def test_insert_if_absent_idempotent(spark):
    from burnup.sources import seeds
    empty = spark.createDataFrame([], seeds.ADMIN_TASK_SCHEMA)
    once = seeds.seed_admin_tasks(spark, empty)
    twice = seeds.seed_admin_tasks(spark, once)
    assert once.count() == 9 and rows(once) == rows(twice)
    reg = seeds.seed_entities(spark, spark.createDataFrame([("Portfolio", 114, "x", "{}", 1)], seeds.ENTITY_SCHEMA))
    assert reg.count() == 9
    hol = seeds.seed_holidays(spark, seeds.seed_holidays(spark, spark.createDataFrame([], seeds.HOLIDAY_SCHEMA)))
    assert hol.count() == 4


def test_one_row_per_key_picks_smallest(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 3, "b"), (2, 9, "c")], "k int, o int, v string")
    assert rows(ap.one_row_per_key(df, "k", ["o"])) == [(1, 3, "b"), (2, 9, "c")]


def test_run_ledger_fold(spark):
    t = lambda m: T(2024, 1, 1, 10, m)
    ev = [(None, 1, "main_start", t(0)), (11, 1, "start", t(1)), (11, 1, "error", t(2)), (11, 1, "end", t(3)), (None, 1, "main_end", t(9)),
          (None, 2, "main_start", t(0)), (21, 2, "start", t(1)), (21, 2, "end", t(2)), (22, 2, "start", t(3)), (None, 2, "main_end", t(5)), (22, 2, "error", t(7)),
          (None, 3, "main_start", t(0)), (31, 3, "start", t(1))]
    df = spark.createDataFrame([(*x, None) for x in ev], "task_id bigint, main_task_id bigint, kind string, ts timestamp_ntz, message string")
    out = {r.task_id: (r.status, r.end_date, r.error_count, r.main_status, r.main_end_date) for r in qa.run_ledger_fold(df).collect()}
    assert out[11] == ("SUCCESS", t(3), 1, "FAILED", t(2))  # the sub task ends anew, its main task stays failed
    assert out[21] == ("SUCCESS", t(2), 0, "SUCCESS", t(5))
    assert out[22] == ("FAILED", t(7), 1, "SUCCESS", t(5))  # an error after the main task's end changes nothing
    assert out[31] == ("IN-PROGRESS", None, 0, "IN-PROGRESS", None)


def test_delimited_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a|b", None), (2, 'quote"d', "x")], "id int, s string, t string")
    ld.write_delimited(df, str(tmp_path / "out"), sep="|")
    back = ld.read_delimited(spark, str(tmp_path / "out"), "id int, s string, t string", sep="|")
    assert rows(back) == rows(df)


def test_staged_files_round_trip_and_rejects(spark, tmp_path):
    r = random.Random(6)
    text = lambda: "".join(r.choice(['|', '"', "\\", "\n", "\r", "n", "r", "~", " ", "a", "é", ",", "'"]) for _ in range(r.randint(1, 9)))
    some = [(i, text(), r.choice([None, 1.5, -2.0]), r.choice([None, D(2024, 1, 2)]), text()) for i in range(400)]
    schema = "id bigint, a string, x double, d date, b string"
    for sep in "|~":
        path = str(tmp_path / f"ok{ord(sep)}")
        ld.stage_delimited(spark.createDataFrame(some, schema).repartition(3), path, sep)
        good, bad = ld.read_staged(spark, path, schema, sep)
        assert rows(good) == sorted(map(tuple, some), key=repr) and bad.count() == 0
    wrong = tmp_path / "wrong"
    wrong.mkdir()
    lines = ["1|a|1.5|2024-01-02|b", "x|a|1.5|2024-01-02|b", "2|a|1.5|2024-13-02|b", "3|a|1.5", "4|a|1.5|2024-01-02|b|c", "5||||"]
    (wrong / "f.csv").write_text("id|a|x|d|b\n" + "\n".join(lines) + "\n")
    good, bad = ld.read_staged(spark, str(wrong), schema)
    assert rows(good) == [(1, "a", 1.5, D(2024, 1, 2), "b"), (5, None, None, None, None)]
    assert sorted(x[0] for x in bad.collect()) == sorted(lines[1:5])
    ld.stage_delimited(spark.createDataFrame([], schema), str(tmp_path / "none"))
    assert [x.count() for x in ld.read_staged(spark, str(tmp_path / "none"), schema)] == [0, 0]


def test_without_quotes(spark):
    some = ["it's", 'a "b" c', "back\\slash", "\\\\'\"", "", None]
    got = [r[0] for r in spark.createDataFrame([(i, s) for i, s in enumerate(some)], "i int, s string").orderBy("i").select(E.without_quotes("s")).collect()]
    assert got == [None if s is None else s.replace("'", "").replace('"', "").replace("\\", "\\\\") for s in some]


def test_schema_backfill(spark):
    reg = spark.createDataFrame([(4, "Project", None), (5, "Task", "kept")],
                                "entity_ppm_id int, entity_name string, entity_schema string")
    cat = spark.createDataFrame([(4, "id", "it's"), (4, "title", "t"), (5, "id", "x")],
                                "entity_ppm_id int, field string, label string")
    out = {r.entity_ppm_id: r.entity_schema for r in ld.schema_backfill(reg, cat).collect()}
    assert out[5] == "kept" and "'" not in out[4] and '"field":"title"' in out[4]


def _dims(tables):
    from burnup.plans import domain as d
    return {"resources": d.resource_dim(tables), "members": d.user_team_map(tables),
            "projects": d.projects_dim(tables), "tasks": d.project_tasks(tables),
            "portfolios": d.portfolio_dim(tables), "dates": d.date_dimension(tables)}


def test_incremental_import_stream(spark, tables, tmp_path):
    """Entries without a date, a retried epoch, a new progress folder, and a batch that broke off."""
    from burnup.plans import domain as d
    from burnup.sources import sinks
    from burnup.streaming.incremental_import import apply_batch, start_import_stream
    dims, path = _dims(tables), str(tmp_path / "store")
    undated = F.when(F.col("entryid") % 9 == 0, F.lit(None).cast("date")).otherwise(F.col("entrydate"))
    store = d.timesheet_entries(tables).where("timesheetid % 4 < 2").withColumn("entrydate", undated)
    store = en.resolve_entry_dims(store, *dims.values(), d.AS_OF)
    landed = d.landed_timesheets(tables).where("timesheetId % 3 = 0")
    landed = landed.withColumn("entriesProject", F.transform("entriesProject", lambda x: x.withField(
        "entryDate", F.when(x["entryId"] % 5 == 0, F.lit(None).cast("date")).otherwise(x["entryDate"]))))
    landed.write.parquet(str(tmp_path / "landed"))
    start = lambda ckpt: start_import_stream(
        spark, str(tmp_path / "landed"), landed.schema, path, dims, d.AS_OF, initial_store=store,
        checkpoint_location=str(tmp_path / ckpt)).awaitTermination(300)
    start("ckpt")
    batch = ns.flatten_all_entries(landed)
    resolve = lambda df: en.resolve_entry_dims(df, *dims.values(), d.AS_OF)
    expected = resolve(en.versioned_replace(store, batch, d.AS_OF))
    cols = expected.columns
    read = lambda: rows(sinks.read_entry_store(spark, path).select(*cols))
    once, before = read(), rows(expected)
    assert once == before and any(r[cols.index("entrydate")] is None for r in once)
    # A retried epoch undoes its first attempt: the store is the same afterwards.
    import json
    stream = json.loads((tmp_path / "ckpt" / "metadata").read_text())["id"]
    apply_batch(path, dims, d.AS_OF, lambda: stream)(landed, 0)
    assert read() == once
    # A batch that breaks off after writing months, before its switch, changes nothing.
    version = sinks.store_version(spark, path)
    (tmp_path / "store" / "manifest" / f"v={version + 1}").mkdir()
    assert sinks.store_version(spark, path) == version and read() == once
    (tmp_path / "store" / "manifest" / f"v={version + 1}").rmdir()
    # A new progress folder is a new stream: it imports again and undoes nothing of the first.
    start("other")
    assert read() == rows(resolve(en.versioned_replace(expected, batch, d.AS_OF)))


def test_load_dimensions_project(spark, tables):
    from burnup.plans.queries_landing import raw_project_responses
    from burnup.sources import seeds
    registry = spark.createDataFrame(seeds.ENTITY_SEED, seeds.ENTITY_SCHEMA)
    aliases = [a for _, a, _ in ld.entity_fields(registry, 4)]
    assert aliases[0] == "id" and len(aliases) == 10
    out = ld.load_dimensions(registry, {"Project": raw_project_responses(tables, aliases)},
                             {"Project": lambda s: s.select(F.col("id").cast("bigint").alias("id"), "title")})
    assert set(out) == {"Project"} and out["Project"].count() == tables.part.count()


def test_sql_working_day_functions(spark):
    spark.createDataFrame([(T(2024, 1, 1), True), (T(2024, 1, 13), True), (T(2024, 1, 16), False)],
                          "holiday_date timestamp_ntz, is_mandatory_holiday boolean").createOrReplaceTempView("hol_v")
    E.register_sql_functions(spark, "hol_v")
    r = spark.sql("SELECT weekdays_sql(DATE'2024-01-01', DATE'2024-01-14') AS a, "
                  "weekdays_holiday_sql(DATE'2024-01-01', DATE'2024-01-14') AS b, "
                  "weekdays_sql(DATE'2024-01-09', DATE'2024-01-02') AS c").first()
    assert (r.a, r.b, r.c) == (10, 9, 0)


def test_payload_json_and_chunks(spark):
    rws = spark.createDataFrame([(0, 1, 5, 100 + (i % 2), 7001, 1, "2024/01/02", 0, 1, 1.5) for i in range(7)],
                                "companyId int, entryTypeId int, timesheetId bigint, userId bigint, level1Id bigint, "
                                "level2Id bigint, entryDate string, entryId bigint, level3Id bigint, entryHours double")
    p = ns.timesheet_payload(rws.unionByName(rws.withColumn("entryDate", F.lit("2024/01/03"))))
    sizes = {(r.userId, r.chunk): r.n for r in p.select("userId", "chunk", F.size("entriesProject").alias("n")).collect()}
    assert sizes == {(u, x): n for u, n in ((100, 4), (101, 3)) for x in ("2024/01/02", "2024/01/03")}
    whole = ns.timesheet_payload(rws, chunk=None)
    assert rows(whole.select("userId", "chunk", F.size("entriesProject"))) == [(100, None, 4), (101, None, 3)]
    js = ns.payload_json(p).collect()
    assert all('"entriesProject":[' in r.payload and '"userId"' in r.payload for r in js)
    assert "userId" not in ns.PAYLOAD_FIELDS


def test_list_path_and_date_text(spark):
    df = spark.createDataFrame([("2448, 2506,77", "https://a/b/A6 ", dt.date(2024, 1, 5))], "l string, r string, d date")
    r = df.select(E.id_list_to_array("l").alias("ids"), E.last_path_segment("r").alias("seg"),
                  E.pg_to_char("d", "YYYY/MM/DD").alias("a"), E.pg_to_char("d", "YYYYMMDD").alias("b")).first()
    assert r.ids == [2448, 2506, 77] and r.seg == "A6" and r.a == "2024/01/05" and r.b == "20240105"


def test_service_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "timesheetid bigint, userid bigint, other int")
    assert ns.to_service_names(df).columns == ["timesheetId", "userId", "other"]


def test_entity_extract_prunes_fields(spark, tmp_path):
    from pyspark.sql import types as TT
    path = str(tmp_path / "entity")
    spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id long, title string, extra string").write.json(path)
    out = ld.entity_extract(spark, path, [("id", TT.LongType()), ("title", TT.StringType())])
    assert out.columns == ["id", "title"] and rows(out) == [(1, "a"), (2, "b")]


def test_refresh_delete_composite(spark, tables):
    from burnup.plans import domain as d
    cmds, log = en.refresh_delete(d.refresh_log(tables), d.user_team_map(tables), d.resource_dim(tables),
                                  d.generator_timesheet_rows(tables))
    assert cmds.count() >= 0
    handled = {r.team_dim_id for r in en.refresh_request_rows(d.refresh_log(tables), d.user_team_map(tables),
                                                              d.resource_dim(tables)).collect()}
    assert all(r.is_timesheet_refreshed for r in log.collect() if r.team_dim_id in handled)


def test_dim_cleanup_composite(spark, tables):
    from burnup.plans import domain as d
    from burnup.sources import seeds
    tabs = {"team_dim": d.team_dim(tables), "projects_dim": d.projects_dim(tables),
            "project_tasks": d.project_tasks(tables), "portfolio_dim": d.portfolio_dim(tables),
            "epic_dim": d.epic_dim(tables), "jira_project_dim": d.jira_project_dim(tables),
            "sprint_issues": d.sprint_issues(tables), "resource_dim": d.resource_dim(tables),
            "user_team_map": d.user_team_map(tables), "holiday_dim": d.holiday_dim(tables)}
    out = mp.dim_cleanup(tabs, seeds.seed_frame(spark, seeds.HOLIDAY_SEED, seeds.HOLIDAY_SCHEMA))
    assert out["holiday_dim"].count() == d.holiday_dim(tables).count() + 4
    expect = mp.issue_portfolio_by_name(
        mp.issue_portfolio_by_epic(d.sprint_issues(tables), d.epic_dim(tables),
                                   mp.maintenance_projects(d.projects_dim(tables)), d.portfolio_dim(tables)),
        d.jira_project_dim(tables), mp.maintenance_projects(d.projects_dim(tables)), d.portfolio_dim(tables))
    assert rows(out["sprint_issues"]) == rows(expect)
    assert out["user_team_map"].count() < d.user_team_map(tables).count()


def test_entry_store_partition_pruning(spark, tables, tmp_path):
    from burnup.plans import domain as d
    from burnup.sources import sinks
    path = str(tmp_path / "store")
    sinks.write_entry_store(d.timesheet_entries(tables).drop("date_created"), path)
    df = sinks.read_entry_store(spark, path, "2024-01-05", "2024-01-20")
    assert {f.rpartition("/")[0].rpartition("/")[2] for f in df.inputFiles()} == {"__m=2024-01"}
    full = d.timesheet_entries(tables).where("entrydate between date'2024-01-05' and date'2024-01-20'")
    assert df.count() == full.count()
    assert sinks.write_version(df.limit(1), str(tmp_path / "v"), 3).endswith("version=3")


def test_generate_without_population(spark, tables):
    from burnup.plans import domain as d
    out = ef.generate_timesheets(d.sprint_summary(tables), d.sprint_issues(tables), d.user_team_map(tables),
                                 d.resource_dim(tables), d.team_dim(tables), d.projects_dim(tables),
                                 d.generator_timesheet_rows(tables),
                                 E.holiday_array(d.holiday_dim(tables)), d.push_acknowledgements, d.AS_OF,
                                 populate=False)
    assert set(out) == {"sprints", "fact"}
    assert all(r.is_metrics_updated for r in out["sprints"].collect())


def test_parse_ticket_matches_path_extraction(spark):
    docs = [
        (1, '{"fields": {"customfield_10411": 3.50, "resolutiondate": "2024-01-03 10:00:00"}}'),
        (2, '{"fields": {"customfield_10411": null}}'),
        (3, '{"fields": {}}'),
        (4, 'not json at all'),
        (5, '{"fields": {"customfield_10411": "abc", "resolutiondate": "2024-01-03 10:00:00-0500"}}'),
        (6, '{"fields": {"customfield_10411": 7, "resolutiondate": null}}'),
        (7, None),
    ]
    df = spark.createDataFrame(docs, "id int, ticket_details string")
    parsed = {r["id"]: (r["__pts"], r["__res_txt"] is None, r["__res"]) for r in sp.parse_ticket(df).collect()}
    by_path = {r.id: (r.p, r.t is None, r.r) for r in df.select(
        "id", E.json_decimal("ticket_details", "fields", "customfield_10411").alias("p"),
        E.json_text("ticket_details", "fields", "resolutiondate").alias("t"),
        E.json_timestamp("ticket_details", "fields", "resolutiondate").alias("r")).collect()}
    assert parsed == by_path


def test_batch_reads_only_its_months(spark, tables, tmp_path):
    """A batch names its months by the locator: it works on while other months can't be read at all."""
    import pathlib

    from burnup.plans import domain as d
    from burnup.sources import sinks
    from burnup.streaming.incremental_import import apply_batch, init_store
    dims, path = _dims(tables), str(tmp_path / "store")
    store = d.timesheet_entries(tables).withColumn("timesheetid", F.col("timesheetid") * 40_000)
    store = en.resolve_entry_dims(store, *dims.values(), d.AS_OF)
    init_store(store, path)
    months = store.select("timesheetid", sinks.entry_month().alias("m")).distinct().collect()
    by_sheet = {}
    for r in months:
        by_sheet.setdefault(r.timesheetid, set()).add(r.m)
    ids = spark.createDataFrame([(i,) for i in [*sorted(by_sheet)[:3], None, 7]], "timesheetid bigint")
    assert set(sinks.located_months(spark, path, ids)) == set.union(*(by_sheet[i] for i in sorted(by_sheet)[:3]))
    assert sinks.located_months(spark, path, ids.where("timesheetid = 7")) == []
    # a batch for one timesheet, with an entry in a month that the store doesn't have yet
    one = next(i for i in sorted(by_sheet) if len(by_sheet[i]) < len({r.m for r in months}))
    landed = d.landed_timesheets(tables).withColumn("timesheetId", F.lit(one)).limit(1)
    landed = landed.withColumn("entriesProject", F.transform("entriesProject", lambda x: x.withField("entryDate", F.lit(D(2031, 5, 6)))))
    landed.write.parquet(str(tmp_path / "one"))
    landed = spark.read.parquet(str(tmp_path / "one"))
    expected = en.resolve_entry_dims(en.versioned_replace(store, ns.flatten_all_entries(landed), d.AS_OF), *dims.values(), d.AS_OF)
    left = rows(expected.where(F.col("timesheetid") == one))
    touched = by_sheet[one] | {r[0] for r in ns.flatten_all_entries(landed).select(sinks.entry_month()).distinct().collect()}
    spoiled = [m for m in sinks.month_dirs(spark, path) if m not in touched]
    assert spoiled
    for m in spoiled:
        for f in pathlib.Path(sinks.month_dirs(spark, path)[m]).glob("*.parquet"):
            f.write_bytes(b"not parquet")
    for _ in range(2):  # the second run is a retry of the same epoch
        apply_batch(path, dims, d.AS_OF, lambda: "a-stream")(landed, 0)
        now = sinks.read_entry_store(spark, path, months=sorted(touched)).select(*expected.columns).where(F.col("timesheetid") == one)
        assert rows(now) == left
    assert set(sinks.marked_months(spark, path, "a-stream", 0)) == touched and sinks.marked_months(spark, path, "a-stream", 1) == []
    assert "2031-05" in sinks.located_months(spark, path, spark.createDataFrame([(one,)], "timesheetid bigint"))


def test_resolve_missing_keys_equals_full_pass(spark, tables, tmp_path):
    from burnup.plans import domain as d
    from burnup.streaming.incremental_import import init_store, resolve_missing_keys
    dims = {"resources": d.resource_dim(tables), "members": d.user_team_map(tables),
            "projects": d.projects_dim(tables), "tasks": d.project_tasks(tables),
            "portfolios": d.portfolio_dim(tables), "dates": d.date_dimension(tables)}
    raw = d.timesheet_entries(tables)
    path = str(tmp_path / "store")
    init_store(raw, path)
    resolve_missing_keys(spark, path, dims, d.AS_OF)
    full = en.resolve_entry_dims(raw, *dims.values(), d.AS_OF)
    from burnup.sources import sinks
    assert rows(sinks.read_entry_store(spark, path).select(*full.columns)) == rows(full)
