import random
import re

import numpy as np
import pytest
import xxhash

from burnup.llm import simhash_dedup as S


def brute_fp(text, words=3):
    t = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    sh = [" ".join(w[i: i + words]) for i in range(len(w) - words + 1)] or ([" ".join(w)] if w else [])
    hs = np.array([xxhash.xxh64_intdigest(s.encode(), 42) for s in sh], np.uint64)
    return sum(1 << b for b in range(64) if 2 * int((hs >> np.uint64(b) & np.uint64(1)).sum()) > len(hs))


def brute_components(fps, radius=2):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(fps))]


def corpus():
    r = random.Random(2)
    text = lambda n: " ".join("".join(r.choice("aeinorstÉ") for _ in range(r.randint(1, 6))) for _ in range(n))
    rows = [None, "", " \t\n", "One", "one two", "ONE  two", "one two three", "a\x0bb\x0cc\rd"]
    for _ in range(40):
        t = text(r.randint(1, 200))
        rows.append(t)
        w = t.split()
        for _ in range(r.randint(0, 3)):
            v = list(w)
            v[r.randrange(len(v))] = "changed"
            rows.append("  ".join(v).upper() if r.random() < .3 else " ".join(v))
    r.shuffle(rows)
    return rows


def test_fingerprints_and_components(spark):
    rows = corpus()
    fps = [brute_fp(t) for t in rows]
    want = brute_components(fps)
    df = spark.createDataFrame([(i, t, 7, "x") for i, t in enumerate(rows)], "doc_id long, text string, component_id int, fp string").repartition(6)
    got = {x.doc_id: x for x in S.near_duplicates(df).collect()}
    assert [int(got[i].fingerprint, 16) for i in range(len(rows))] == fps
    assert [got[i].component_id for i in range(len(rows))] == want
    kept = S.keep_first(df)
    assert kept.columns == df.columns
    assert sorted(x.doc_id for x in kept.collect()) == sorted(set(want))


@pytest.mark.parametrize("hot", [10, 200_000])
def test_links_of_dense_groups(spark, hot):
    r = random.Random(4)
    fps = {r.getrandbits(64) for _ in range(300)}
    for f in list(fps)[:60]:
        for _ in range(r.randint(1, 12)):
            fps.add(f ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)))
    fps = sorted(fps | {0, 1, 3, 7, 15})
    want = brute_components(fps)
    df = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long").repartition(5)
    root = list(range(len(fps)))
    at = {f: i for i, f in enumerate(fps)}
    pairs = [(at[x.u % 2**64], at[x.v % 2**64]) for x in S.near_links(df, 2, hot).collect()]
    assert all(want[i] == want[j] for i, j in pairs)
    got = S.united(len(fps), iter([tuple(np.array(x) for x in zip(*pairs))]))
    assert list(got) == want and len(root) == len(fps)


def test_nulls_repeats_empty(spark):
    schema = "doc_id long, text string"
    a = "some words that are here and there again"
    df = spark.createDataFrame([(None, a), (5, a), (5, a), (None, None), (8, "zz yy xx")], schema)
    got = sorted((x.doc_id or 0, x.fingerprint == "0" * 16, x.component_id) for x in S.near_duplicates(df).collect())
    assert got == [(0, False, 5), (0, True, None), (5, False, 5), (5, False, 5), (8, False, 8)]
    assert sorted((x.doc_id or 0) for x in S.keep_first(df).collect()) == [0, 5, 8]
    assert S.near_duplicates(df.limit(0)).count() == 0
