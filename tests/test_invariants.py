"""The warehouse's own checks as invariants over every (team, sprint), and idempotence."""

from conftest import SMALL

import __spark_entry__ as entry


def test_eight_hours_per_developer_day(spark):
    out = entry.queries()["team_daily_hours_check"](spark, SMALL).collect()
    assert out and all(r.hr == 8 for r in out)


def test_planned_hours_equal_capacity(spark):
    out = entry.queries()["team_hours_vs_capacity_check"](spark, SMALL).collect()
    assert out and all(r.planned_hr == r.capacity_hr for r in out)


def test_timesheet_user_list_not_empty(spark):
    out = entry.queries()["timesheet_user_list"](spark, SMALL).collect()
    assert out and all(r.user_list for r in out)


def test_resolve_entry_dims_idempotent(spark, tables):
    from burnup.operators import entries as en
    from burnup.plans import domain as d
    args = (d.resource_dim(tables), d.user_team_map(tables), d.projects_dim(tables), d.project_tasks(tables),
            d.portfolio_dim(tables), d.date_dimension(tables), d.AS_OF)
    once = en.resolve_entry_dims(d.timesheet_entries(tables), *args)
    twice = en.resolve_entry_dims(once, *args)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_mapping_changes_something(spark):
    """The scenario exercises both portfolio mapping arms (not a vacuous match)."""
    q = entry.queries()
    by_epic = q["issue_portfolio_by_epic"](spark, SMALL).where("is_maintenance = false").count()
    by_name = q["issue_portfolio_by_name"](spark, SMALL).where("is_maintenance = true").count()
    assert by_epic > 0 and by_name > 0
