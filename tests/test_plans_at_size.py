"""Tables that grow with the input aren't sent through the driver, and joins don't multiply them."""

import contextlib
import datetime as dt
import io
import random
import re

import pytest
from pyspark.sql import functions as F

from burnup.operators import entries as en
from burnup.operators import mapping as mp
from burnup.operators.intervals import days_in_ranges
from burnup.plans.registry import load_all
from conftest import SMALL


def plan_text(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


@pytest.mark.parametrize("name", ["timesheet_population", "long_header_population", "timesheet_payload", "dead_letter_append", "generate_timesheets",
                                  "draft_population"])
def test_growing_tables_are_not_broadcast(spark, name):
    joins = [x for x in plan_text(load_all()[0][name](spark, SMALL)).splitlines() if "BroadcastHashJoin" in x]
    keys = r"\b(user_dim_id|resource_dim_id|userId|resource_ppm_id|pv_project_dim_id|user_id|timesheetId)#"
    assert [x for x in joins if re.search(keys, x)] == []
    assert [x for x in joins if "__team#" in x and "BuildRight" in x] == []  # members are the large side


@pytest.mark.parametrize("name", ["payload_json", "payload_service_names"])
def test_payloads_of_growing_tables_are_not_broadcast(spark, name):
    joins = [x for x in plan_text(load_all()[0][name](spark, SMALL)).splitlines() if "BroadcastHashJoin" in x]
    keys = r"\b(user_dim_id|resource_dim_id|userId|resource_ppm_id|pv_project_dim_id|user_id|timesheetId)#"
    assert [x for x in joins if re.search(keys, x)] == []


def test_dead_letter_after_the_retry_is_not_broadcast(spark):
    """The steps before are written tables, so this plan is the last one: accepted chunks leave the dead letter."""
    shown = plan_text(load_all()[0]["generate_timesheets_dead_letter"](spark, SMALL))
    assert "SortMergeJoin" in shown and "BroadcastExchange" not in shown


def test_pieces_of_ranges_are_not_broadcast(spark):
    days = spark.range(4).select(F.col("id").alias("u"), F.expr("date_add(DATE'2024-01-01', cast(id as int))").alias("day"))
    ranges = spark.range(4).select(F.col("id").alias("v"), F.expr("DATE'1970-01-05'").alias("a"), F.expr("DATE'2024-01-02'").alias("b"))
    out = days_in_ranges(days, ranges, [("u", "v")], "day", "a", "b")
    assert "BroadcastHashJoin" not in plan_text(out)
    assert sorted(r.u for r in out.collect()) == [0, 1]


def test_names_meet_one_project_a_pattern(spark):
    """Jira projects x maintenance projects of a portfolio never become pairs; the smallest project id wins over all patterns."""
    jira = spark.range(40).select(F.col("id").alias("project_dim_id"), F.expr("if(id % 2 = 0, 'Team ASIA Care', 'Asia and Middle East')").alias("project_name"))
    projects = spark.range(1, 91).select(F.col("id").alias("pv_project_dim_id"), F.lit("x").alias("pv_aha_id"), F.lit("p").alias("pv_project_name"),
                                         F.lit("c").alias("category"), (F.col("id") > 3).alias("is_maintenance_project"),
                                         F.expr("cast(1 + id % 3 as bigint)").alias("portfolio_dim_id"))
    portfolios = spark.createDataFrame([(1, "Middle East"), (2, "Asia"), (3, "Europe")], "portfolio_dim_id bigint, portfolio_name string")
    out = mp.name_project_candidates(jira, projects, portfolios)
    got = {r.project_dim_id: (r.pv_project_dim_id, r.portfolio_dim_id) for r in out.collect()}
    assert got == {i: (4, 2) for i in range(40)}
    assert not re.search(r"Join \[__pattern#", plan_text(out))


@pytest.mark.parametrize("name", ["issue_portfolio_by_name", "dim_cleanup_issues", "issue_portfolio_by_epic"])
def test_epics_are_not_broadcast(spark, name):
    joins = [x for x in plan_text(load_all()[0][name](spark, SMALL)).splitlines() if "BroadcastHashJoin" in x]
    assert [x for x in joins if re.search(r"\b(__aha|pv_aha_id)#", x)] == []


def test_entries_are_read_once_and_not_dealt_by_date(spark):
    shown = plan_text(load_all()[0]["resolve_entry_dims"](spark, SMALL))
    assert len(re.findall(r"FileScan parquet \[l_orderkey", shown)) == 1  # the calendar reads dates alone
    assert not re.search(r"hashpartitioning\((resource_dim_id#\w+, )?entrydate#", shown)


def test_resource_and_team_in_one_join(spark):
    """Against brute force: overlapping, open and empty memberships, equal starts, known and unknown resources and teams."""
    r = random.Random(7)
    day = lambda: dt.date(2024, 1, r.randint(1, 28))
    as_of = dt.datetime(2024, 1, 24, 12)
    resources = [(i, 100 + i % 9) for i in range(12)]
    members = [(r.choice([*range(14), None]), r.choice([1, 2, 3, None]), dt.datetime.combine(day(), dt.time(9)) if r.random() < .95 else None,
                dt.datetime.combine(day(), dt.time(9)) if r.random() < .6 else None) for _ in range(60)]
    entries = [(i, r.choice([*range(98, 112), None]), r.choice([None, None, *range(14)]), r.choice([None, None, 77]), day() if r.random() < .95 else None) for i in range(300)]
    want = {}
    for i, user, res, team, d in entries:
        if res is None:
            res = min((x for x, ppm in resources if ppm == user), default=None)
        if team is None and res is not None and d is not None:
            spans = [(a, t or 0) for u, t, a, b in members if u == res and a and a.date() <= d <= (b or as_of).date()]
            team = (max(spans)[1] or None) if spans else None
        want[i] = (res, team)
    e = spark.createDataFrame(entries, "n bigint, userid bigint, resource_dim_id bigint, team_dim_id bigint, entrydate date")
    res = spark.createDataFrame(resources, "resource_dim_id bigint, resource_ppm_id bigint")
    m = spark.createDataFrame(members, "user_dim_id bigint, team_dim_id bigint, team_entry_date timestamp_ntz, team_exit_date timestamp_ntz")
    one = en.set_entry_resource_team(e, res, m, as_of)
    two = en.set_entry_team(en.set_entry_resource(e, res), m, as_of)
    assert one.columns == e.columns == two.columns
    for out in (one, two):
        got = out.collect()
        assert len(got) == len(entries) and {x.n: (x.resource_dim_id, x.team_dim_id) for x in got} == want
