"""Rewrites checked against their naive form on random inputs (seeded)."""

import datetime as dt
import random
import re

from pyspark.sql import Window
from pyspark.sql import functions as F

from burnup.operators import mapping as mp
from burnup.operators import nesting as ns
from burnup.operators import sprints as sp
from burnup.operators.carry import row_before


def test_global_lag_decomposition_equals_single_window(spark):
    rnd = random.Random(11)
    rows = []
    for team in range(12):
        start = dt.datetime(2024, 1, 1, 9) + dt.timedelta(days=rnd.randint(0, 3))
        for n in range(1, rnd.randint(1, 6) + 1):
            complete = start + dt.timedelta(days=rnd.randint(0, 6), hours=rnd.randint(0, 12))
            rows.append((n, team, start, complete, None))
            start = complete.replace(hour=rnd.choice([8, 9, 23])) + dt.timedelta(days=rnd.choice([0, 0, 1]))
    s = spark.createDataFrame(rows, "sprint_number bigint, team_dim_id bigint, sprint_start_date timestamp_ntz, "
                                    "sprint_complete_date timestamp_ntz, actual_sprint_start_date date")
    w = Window.orderBy("team_dim_id", "sprint_number", "sprint_start_date")
    prev = F.lag("sprint_complete_date").over(w)
    naive = s.select("sprint_number", "team_dim_id", F.date_add(
        F.to_date("sprint_start_date"),
        F.when(F.coalesce(F.to_date(prev) == F.to_date("sprint_start_date"), F.lit(False)), 1).otherwise(0))
        .alias("actual_start_date"))
    got = sp.actual_sprint_start(s)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, naive.collect()))
    starts = {(n, t): st.date() for n, t, st, _, _ in rows}
    shifted = [(r.sprint_number, r.team_dim_id) for r in got.collect()
               if r.actual_start_date != starts[(r.sprint_number, r.team_dim_id)]]
    assert shifted, "the data must exercise the one-day shift"


def test_row_before_over_ranges(spark):
    """A group with a third of all rows, NULL values and groups, more ranges than rows, no rows."""
    rnd = random.Random(4)
    rows = [(None if i % 17 == 0 else 5 if i % 3 else rnd.randint(0, 9), i, None if i % 7 == 0 else rnd.randint(0, 99)) for i in range(400)]
    df = spark.createDataFrame(rows, "g int, n int, v int").repartition(3)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    for some in (rows, rows[:3]):
        part = df.where(F.col("n") <= max(r[1] for r in some))
        line = sorted(some, key=key)
        want = dict(zip(line, [None, *(b[2] for b in line[:-1])], strict=True))
        got = row_before(part, ["g", "n"], F.col("v"), "before").collect()
        assert {(r.g, r.n, r.v): r.before for r in got} == want and len(got) == len(some)
    assert row_before(df.limit(0), ["g", "n"], F.col("v"), "before").collect() == []


def test_like_blocking_on_random_patterns(spark):
    rnd = random.Random(5)
    alphabet = "ab_c "

    def word(lo, hi):
        return "".join(rnd.choice(alphabet) for _ in range(rnd.randint(lo, hi)))
    names = list({word(0, 8) for _ in range(120)}) + [None]
    patterns = list({"%" + word(0, 4).replace(" ", "%") + "%" for _ in range(40)})
    patterns += ["__", "%", "a%b", "_a_", "%c"]
    n = spark.createDataFrame([(x,) for x in names], "name string")
    p = spark.createDataFrame([(x,) for x in patterns], "pattern string")
    got = sorted(map(tuple, mp.like_pattern_matches(n, "name", p, "pattern").select("name", "pattern").collect()))
    brute = sorted(map(tuple, n.join(p, F.expr("name LIKE pattern")).select("name", "pattern").collect()))
    assert got == brute and len(brute) > 50


def test_bounded_listagg_matches_python(spark):
    rnd = random.Random(3)
    data = [(rnd.randint(0, 4), rnd.randint(0, 3500)) for _ in range(3000)]
    df = spark.createDataFrame(data, "g int, id bigint")
    out = ns.bounded_listagg(df, ["g"], "id", "ids", batch_size=1000).collect()
    expect = {}
    for g, i in data:
        expect.setdefault((g, i // 1000), []).append(i)
    got = {(r.g, r.batch): r.ids for r in out}
    assert got == {k: ", ".join(str(x) for x in sorted(v)) for k, v in expect.items()}
    assert max(len(v.split(", ")) for v in got.values()) <= max(len(v) for v in expect.values())


def test_hot_groups_are_spread_by_chunk_and_batch(spark):
    """Input already hash-partitioned on the group key must still be shuffled on
    (key, chunk) / (key, batch) before the list aggregation, so one hot group is
    spread over many tasks."""
    hot = spark.range(0, 20000).select((F.col("id") % 1 + 7).alias("timesheetId"),
                                       (F.col("id") % 1 + 1).alias("userId"), F.col("id").alias("entryId"))
    rows = hot.select("timesheetId", "userId", F.lit(0).alias("companyId"), F.lit(1).alias("entryTypeId"),
                      F.lit(7001).cast("bigint").alias("level1Id"), F.lit(1).cast("bigint").alias("level2Id"),
                      F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("entryId") % 20).cast("int")), "yyyy/MM/dd").alias("entryDate"), "entryId", F.lit(1).cast("bigint").alias("level3Id"),
                      F.lit(1.0).alias("entryHours")).repartition("timesheetId", "userId")
    p = ns.timesheet_payload(rows)
    plan = p._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(timesheetId#\d+L, userId#\d+L, chunk#", plan), plan
    sizes = [r.n for r in p.select(F.size("entriesProject").alias("n")).collect()]
    assert sizes == [1000] * 20
    ids = hot.repartition("timesheetId")
    lst = ns.bounded_listagg(ids, ["timesheetId"], "entryId", "ids", batch_size=1000)
    plan2 = lst._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(timesheetId#\d+L, batch#", plan2), plan2
    assert lst.count() == 20


def test_list_pieces_join_to_whole_lists(spark):
    """Also for one id repeated very often, NULL groups and NULL ids; no piece holds more than its size."""
    from burnup.operators.lists import listagg_pieces
    r = random.Random(8)
    some = [(r.choice([1, 2, None]), r.choice([None, 7, r.randint(1, 50)])) for _ in range(400)] + [(3, 7)] * 1500 + [(4, 1)]
    df = spark.createDataFrame(some, "g int, id bigint").repartition(5)
    got = {}
    for x in sorted(listagg_pieces(df, ["g"], "id", "ids", 64).collect(), key=lambda x: (str(x.g), x.piece)):
        got.setdefault(x.g, []).append((x.piece, x.ids.split(", ")))
    want = {}
    for g, i in some:
        if i is not None:
            want.setdefault(g, []).append(i)
    assert {g: [int(i) for _, ids in p for i in ids] for g, p in got.items()} == {g: sorted(v) for g, v in want.items()}
    assert all([n for n, _ in p] == list(range(len(p))) and all(len(ids) == 64 for _, ids in p[:-1]) for p in got.values())
    whole = listagg_pieces(df, [], "id", "ids", 10_000).collect()
    assert len(whole) == 1 and len(whole[0].ids.split(", ")) == sum(map(len, want.values()))
    assert listagg_pieces(df.limit(0), ["g"], "id", "ids").count() == 0
