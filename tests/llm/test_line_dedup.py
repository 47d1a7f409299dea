import random
from collections import defaultdict

import numpy as np
import pytest

from burnup.llm import line_dedup as L

SCHEMA = "doc_id long, text string, h string, n long, _d long, lost string"
ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_chars=40, min_docs=5):
    """Sorted (doc_id, n_lines, n_dropped, text), by definition; ids must be distinct and not null."""
    key = lambda line: line.strip(" \t\n\v\f\r").translate(ASCII)
    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < min_docs or i == max(holders[key(x)])]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


def corpus(seed, n=300):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abeinorstéЖ") for _ in range(r.randint(2, 9)))
    line = lambda k: " ".join(word() for _ in range(k))
    shared = [line(r.randint(5, 12)) for _ in range(60)]
    out = []
    for i in range(n):
        lines = [r.choice([line(3), line(12), r.choice(shared), "\t " + r.choice(shared).upper() + " \r", "", shared[0]]) for _ in range(r.randint(0, 9))]
        out.append((i * 7, "\n".join(lines)))
    r.shuffle(out)
    return out


def result(df, **more):
    return sorted((x.doc_id, x.n_lines, x.n_dropped, x.text) for x in L.dedup_lines(df, **more).collect())


def frame(spark, rows, parts=5):
    return spark.createDataFrame([(i, t, "x", 1, 2, "y") for i, t in rows], SCHEMA).repartition(parts)


@pytest.mark.parametrize("seed", [1, 2])
def test_brute(spark, seed):
    rows = corpus(seed)
    assert result(frame(spark, rows)) == brute(rows)


def test_other_limits_shards_and_groups(spark):
    """Full filters and one shard a broadcast change nothing."""
    rows = corpus(3)
    assert result(frame(spark, rows), min_chars=10, min_docs=2, shard_lines=64, group_bytes=32) == brute(rows, 10, 2)


def test_filters_let_few_pass(spark):
    rows = [(i, f"a line of its own with the number {i:09d} in it\n" + "shared line, held by two documents, number " + str(i // 2)) for i in range(4000)]
    found = L.suspects(L.texts(frame(spark, rows)).select("_d", "_k", "text"), 40).count()
    assert 4000 <= found < 4200


def test_length_is_in_code_points_of_the_stripped_key(spark):
    rows = [(i, "é" * 40 + "\n" + "é" * 39 + "\n" + " " * 30 + "z" * 39 + "\t") for i in range(6)]
    assert result(frame(spark, rows)) == brute(rows)
    assert [x[2] for x in result(frame(spark, rows))] == [1, 1, 1, 1, 1, 0]


def test_nulls_repeats_ties(spark):
    line = "this very line is long enough to be found again"
    rows = [(1, None), (2, ""), (3, "\n\n"), (4, line + "\n" + line), (5, line), (5, line), (None, line), (6, line.upper()), (7, line + "\nx")]
    got = result(frame(spark, [r for r in rows if r[0] is not None]))
    # rows that repeat id and text are one document: four of them hold the line, one fewer than needed
    assert [x[2] for x in got] == [0] * len(got)
    got = sorted(((x.doc_id or 0, x.n_lines, x.n_dropped, x.text) for x in L.dedup_lines(frame(spark, rows)).collect()), key=str)
    assert got == sorted([(1, 1, 0, ""), (2, 1, 0, ""), (3, 3, 0, "\n\n"), (4, 2, 2, ""), (5, 1, 1, ""), (5, 1, 1, ""), (0, 1, 0, line), (6, 1, 1, ""), (7, 2, 1, "x")], key=str)


def test_one_id_with_other_texts(spark):
    line = "this very line is long enough to be found again"
    rows = [(9, f"{line}\n{i}") for i in range(6)]
    assert sorted(x[2] for x in result(frame(spark, rows))) == [0, 1, 1, 1, 1, 1]


def test_hot_line_and_long_text(spark):
    hot = "a line that every single document of the table holds"
    long = "\n".join(f"line {i % 50_000} of a very long text, which holds many lines twice" for i in range(100_000))
    rows = [(i, hot + "\n" + str(i)) for i in range(3000)] + [(9000, long + "\n" + hot)] + [(9001 + i, long[:5000]) for i in range(6)]
    assert result(frame(spark, rows)) == brute(rows)


def test_empty_table(spark):
    assert result(spark.createDataFrame([], SCHEMA)) == []


def test_twice_seen_has_every_key_added_twice():
    r = np.random.default_rng(1)
    keys = r.integers(0, 2**63, 5000, dtype=np.uint64)
    seen = L.Seen(8192)
    seen.add(keys[:3000], np.zeros(3000, bool))
    seen.add(keys[2000:], np.arange(2000, 5000) >= 4900)
    hit = np.logical_and.reduce([seen.twice[L.bits(keys, i, len(seen.twice))] for i in range(L.TWICE_HASHES)])
    assert hit[2000:3000].all() and hit[4900:].all() and hit[:2000].mean() < 0.05
