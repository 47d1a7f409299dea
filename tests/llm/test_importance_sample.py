import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from burnup.llm import importance_sample as S

SCHEMA = "doc_id long, text string, n_words string, rank string, bucket long, _at long"
ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_features(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(ASCII))
    return w + [f"{a} {b}" for a, b in zip(w, w[1:])], len(w)


def brute(rows, target, percent=25, least=20, buckets=10_000):
    """(doc_id, n_features, weight, score, rank) in the order of ``rows``."""
    at = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(at(f) for _, t in rows for f in brute_features(t)[0])
    t = Counter(at(f) for x in target for f in brute_features(x)[0])
    S_, T = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (S_ + buckets) / ((s[b] + 1) * (T + buckets))))
    out = []
    for i, text in rows:
        f, n = brute_features(text)
        weight = sum(gain(at(x)) for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    order = sorted((x for x in out if x[5] >= least), key=lambda x: (-x[3], x[0] is None, x[0]))
    for r, x in enumerate(order[: percent * len(order) // 100]):
        x[4] = r + 1
    return [tuple(x[:5]) for x in out]


def frame(spark, rows, parts=4):
    return spark.createDataFrame([(i, t, "x", "y", 1, 2) for i, t in rows], SCHEMA).repartition(parts)


def result(spark, rows, target, **more):
    out = S.resample(frame(spark, rows), spark.createDataFrame([(x,) for x in target], "text string"), **more)
    return sorted((tuple(x) for x in out.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


def corpus(seed, n=400):
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdeé7Ж") for _ in range(r.randint(1, 9))) for _ in range(300)]
    text = lambda k: "".join(r.choice(vocabulary) + r.choice([" ", ", ", "_", "\n", "A"]) for _ in range(k))
    return [(i * 3, text(r.choice([0, 3, 25, 60]))) for i in range(n)], [text(30) for _ in range(12)]


@pytest.mark.parametrize("buckets", [10_000, 17])
def test_brute(spark, buckets):
    rows, target = corpus(4)
    assert result(spark, rows, target, buckets=buckets) == sorted(brute(rows, target, buckets=buckets), key=str)


def test_ties_nulls_empty_and_repeats(spark):
    rows = [(i, "the same words " * 10) for i in range(40)] + [(500, None), (501, ""), (502, "?!"), (None, "the same words " * 10), (7, "the same words " * 10)]
    assert result(spark, rows, ["the same", None]) == sorted(brute(rows, ["the same", None]), key=str)


def test_no_target_and_empty_tables(spark):
    rows, _ = corpus(5, 60)
    assert result(spark, rows, []) == sorted(brute(rows, []), key=str)
    assert result(spark, [], ["a"]) == []


def test_long_words_and_texts(spark):
    r = random.Random(6)
    long = " ".join("".join(r.choice("abc") for _ in range(r.randint(1, 6))) for _ in range(600_000))
    rows = [(1, long), (2, "x" * 300_000 + " y"), (3, "é" * 64 + " " + "é" * 65 + " z" * 30)]
    assert result(spark, rows, ["a b"]) == sorted(brute(rows, ["a b"]), key=str)


def test_crc_of_spans():
    r = np.random.default_rng(7)
    data = r.integers(0, 256, 4000).astype(np.uint8)
    starts = r.integers(0, 3000, 2000)
    lengths = r.integers(1, 200, 2000)
    want = [zlib.crc32(data[a: a + n]) for a, n in zip(starts, lengths)]
    assert S.crc32_spans(data, starts, lengths).tolist() == want


def test_blocks_join(monkeypatch):
    monkeypatch.setattr(S, "BLOCK_WORDS", 3)
    texts = ["a b c a b c a", "", "b", "c a  b-d"]
    raw = " ".join(texts).encode() + b" "
    bounds = np.cumsum([0, *(len(x) + 1 for x in texts)])
    data, at, n = S.words(np.frombuffer(raw, np.uint8), bounds)
    got = {(r, b): c for r, b, c in zip(*(x.tolist() for x in S.feature_counts(data, at, n, 10_000)))}
    assert got == {(i, zlib.crc32(f.encode()) % 10_000): c for i, t in enumerate(texts) for f, c in Counter(brute_features(t)[0]).items()}


def test_ranks_over_many_ranges(spark):
    rows = spark.range(5000).selectExpr("id AS doc_id", "id % 3 AS score").repartition(7)
    got = [(x.score, x.doc_id) for x in S.ranked(rows, [rows.score.desc(), rows.doc_id.asc()]).orderBy("rank").collect()]
    assert got == sorted(((i % 3, i) for i in range(5000)), key=lambda x: (-x[0], x[1]))
    assert [x.rank for x in S.ranked(rows, [rows.score.desc(), rows.doc_id.asc()]).orderBy("rank").collect()] == list(range(1, 5001))


def test_draws_follow_the_target(spark):
    rows = [(i, ("red green blue " if i % 2 else "one two three ") * 20) for i in range(400)]
    drawn = [x[0] for x in result(spark, rows, ["red green blue red green blue"] * 50) if x[4]]
    assert len(drawn) == 100 and sum(i % 2 for i in drawn) > 90
