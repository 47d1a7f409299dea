import hashlib
import random

import pytest
from pyspark.sql import functions as F

from burnup.llm import suffix_dedup as S

SCHEMA = "doc_id long, text string, spans string, d long"


def brute(rows, length):
    """{(doc_id, text): (n_bytes, removed mask as spans)} over distinct (doc_id, text)."""
    rows = sorted({(i, t or "") for i, t in rows}, key=lambda r: (r[0] is None, r[0] or 0))
    seen, out = set(), {}
    for i, t in rows:
        b = t.encode()
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            w = b[s: s + length]
            if w in seen:
                gone[s: s + length] = b"\1" * length
            seen.add(w)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans, s = [], None
        for p, g in enumerate([*gone, 0]):
            if g and s is None:
                s = p
            elif not g and s is not None:
                spans.append([s, p])
                s = None
        out[i, t] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def corpus(seed=5):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abeinorst é") for _ in range(r.randint(2, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared = [text(40) for _ in range(6)]
    rows = []
    for i in range(220):
        kind = i % 6
        if kind == 0:
            t = text(r.randint(0, 60))
        elif kind == 1:
            t = text(20) + r.choice(shared) + text(20)
        elif kind == 2:
            t = rows[r.randrange(len(rows))][1] or "x"
        elif kind == 3:
            t = shared[0][r.randint(0, 60):] + shared[1][: r.randint(50, 200)]
        elif kind == 4:
            t = "ab" * r.randint(0, 300) + " " * r.randint(0, 200)
        else:
            t = (rows[r.randrange(len(rows))][1] or "")[: r.randint(90, 400)] + text(5)
        rows.append((i * 3, t))
    r.shuffle(rows)
    return rows


def check(spark, rows, length, block, parts=5):
    df = spark.createDataFrame([(i, t, "other", 1) for i, t in rows], SCHEMA).repartition(parts)
    got = S.dedup_spans(df, length, max(4, length // 4), block).collect()
    want = brute(rows, length)
    assert len(got) == len(rows)
    by_id = {i: v for (i, _), v in want.items()}
    for x in got:
        assert (x.n_bytes, x.n_removed, x.spans, x.kept_sha256) == by_id[x.doc_id], x.doc_id


def test_against_brute_force(spark):
    check(spark, corpus(), 100, 1 << 22)


def test_small_blocks_and_short_strings(spark):
    check(spark, corpus(8), 30, 1 << 10, 7)


@pytest.mark.parametrize("hot, group_rows", [(0, 4096), (0.2, 4), (9, 4096)])
def test_hot_anchors_part_by_window(spark, hot, group_rows):
    """A short line in most texts, in some of them within the same longer passage."""
    r = random.Random(11)
    text = lambda n: "".join(r.choice("abcdefghij ") for _ in range(n))
    line, passages = text(60), [text(70) for _ in range(4)]
    rows = [(i, text(r.randint(0, 150)) + (r.choice(passages) if i % 3 else "") + line + (r.choice(passages) if i % 2 else text(30))) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    found = S.repeated_windows(df, 100, 24, 1 << 11, hot, group_rows).collect()
    gone = {i: set() for i, _ in rows}
    for x in found:
        for w in range(x.lo, x.hi + 1):
            gone[x.d] |= set(range(w, w + 100))
    want = brute(rows, 100)
    assert {i: len(v) for i, v in gone.items()} == {i: want[i, t][1] for i, t in rows}


def test_passage_in_every_block_in_rounds(spark):
    """Shards of a group hand on one occurrence each; the rest of a text stays."""
    r = random.Random(12)
    text = lambda n: "".join(r.choice("abcdefghij ") for _ in range(n))
    passage = text(260)
    rows = [(i, text(r.randint(50, 300)) + passage[r.randint(0, 90): r.randint(170, 260)] + text(200)) for i in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(11)
    gone = {i: set() for i, _ in rows}
    for x in S.repeated_windows(df, 100, 24, 1 << 9, 2, 3).collect():
        for w in range(x.lo, x.hi + 1):
            gone[x.d] |= set(range(w, w + 100))
    want = brute(rows, 100)
    assert {i: len(v) for i, v in gone.items()} == {i: want[i, t][1] for i, t in rows}


def test_nulls_ties_repeats_and_empty(spark):
    a = "the quick brown fox jumps over the lazy dog and then goes on for quite a while, " * 2
    rows = [(1, None), (2, ""), (3, a), (3, a), (None, a), (4, a + "é"), (5, "short")]
    df = spark.createDataFrame([(i, t, None, None) for i, t in rows], SCHEMA)
    got = {(x.doc_id, x.n_bytes): (x.n_removed, x.kept_sha256) for x in S.dedup_spans(df).collect()}
    n = len(a)
    assert S.dedup_spans(df).count() == len(rows)
    want = brute([(3, a), (4, a + "é"), (None, a)], 100)
    assert got[3, n] == (want[3, a][1], want[3, a][3]) and got[4, n + 2][0] == n and got[None, n][0] == n
    assert got[1, 0] == got[2, 0] == (0, hashlib.sha256(b"").hexdigest())
    assert S.dedup_spans(df.limit(0)).count() == 0
    # one id with two texts: the shared passage stays in exactly one of them
    two = spark.createDataFrame([(7, a + "x", None, None), (7, "y" + a, None, None)], SCHEMA).repartition(2)
    assert sorted(x.n_removed >= n - 1 for x in S.dedup_spans(two).collect()) == [False, True]


def test_thousands_of_rows_without_id(spark):
    """They share one place in the order; each text is still a document of its own."""
    r = random.Random(9)
    text = lambda n: "".join(r.choice("abcdefghijklmnop ") for _ in range(n))
    first = [(i, text(110)) for i in range(3000)]
    rows = first + [(None, t) for _, t in first] + [(None, text(110)) for _ in range(3000)] + [(None, text(20) + t[5:107] + text(8)) for _, t in first[:1000]]
    got = S.dedup_spans(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), block=1 << 16).collect()
    want = brute(rows, 100)
    key = lambda x: (x[0] is None, x[0] or 0, *x[1:])
    assert sorted(((x.doc_id, x.n_bytes, x.n_removed, x.spans, x.kept_sha256) for x in got), key=key) == sorted(((i, *want[i, t]) for i, t in rows), key=key)


def test_texts_keep_columns(spark):
    r = random.Random(1)
    a = "".join(r.choice("abcdefgh") for _ in range(300))
    df = spark.createDataFrame([(1, a, "s", 5), (2, "p" + a + "q", "t", 6), (3, None, None, None)], SCHEMA)
    got = {x.doc_id: x for x in S.dedup_texts(df).collect()}
    assert S.dedup_texts(df).columns == df.columns
    assert (got[1].text, got[2].text, got[3].text) == (a, "pq", None) and got[2].spans == "t" and got[2].d == 6


def test_segments_of_a_long_text(spark, monkeypatch):
    monkeypatch.setattr(S, "SEGMENT", 1 << 9)
    import numpy as np
    r = random.Random(3)
    t = "".join(r.choice("abc") for _ in range(5000))
    buf = np.frombuffer((t + t).encode() + bytes([S.PAD]), np.uint8)
    place, h, lo, hi = S.anchors(buf, np.array([0, len(buf)]), 100, 24)
    assert sum(hi - lo + 1) == 2 * len(t) - 99
    assert all(p - 76 <= a <= b <= p for p, a, b in zip(place, lo, hi))
