import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from burnup.llm import decontaminate as D


def toks(t):
    return re.findall(r"[a-z0-9\u0080-\U0010ffff]+", (t or "").lower())


def jac(a, b):
    a, b = Counter(a), Counter(b)
    return sum((a & b).values()) / sum((a | b).values())


def brute(texts, items):
    out = {}
    for d, t in texts:
        w = toks(t)
        hit = {}
        for i, x in items:
            y = toks(x)
            if not y:
                continue
            k = min(5, len(y))
            sh = lambda z: [tuple(z[j: j + k]) for j in range(len(z) - k + 1)]
            best = max((jac(sh(w[s: s + len(y)]), sh(y)) for s in range(len(w) - len(y) + 1)), default=0)
            if best >= 0.8:
                hit[i] = best
        out[d] = hit
    return out


def data():
    r = random.Random(7)
    word = lambda: "".join(r.choice("aeinorstéü") for _ in range(r.randint(2, 6)))
    text = lambda n: [word() for _ in range(n)]
    items = [(i, " ".join(text(r.randint(20, 60)))) for i in range(12)] + [(90, "tiny item"), (91, ""), (92, None), (93, "one"), (94, "the the the the the the the the")]
    items.append((95, items[0][1]))
    docs = []
    for d in range(60):
        w = text(r.randint(0, 80))
        if d % 3 == 0:
            x = items[r.randrange(12)][1].split()
            for _ in range(r.randint(0, 2)):
                x[r.choice([0, -1, len(x) // 2])] = "CHANGED"
            at = r.randint(0, len(w))
            w[at:at] = [(", ".join(x) if d % 2 else "  ".join(x)).title()]
        docs.append((d, " ".join(w)))
    return docs + [(100, None), (101, ""), (102, "a tiny ITEM!"), (103, "one"), (104, "the " * 30), (105, "the the the the")], items


def test_against_brute_force(spark):
    docs, items = data()
    df = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, matches int").repartition(4)
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items)
    got = {x.doc_id: x for x in D.contaminated(df, bench).collect()}
    assert len(got) == len(docs)
    for d, hit in want.items():
        assert got[d].item_ids == sorted(hit) and got[d].contaminated == bool(hit), d
        assert (abs(got[d].similarity - max(hit.values())) < 1e-9) if hit else got[d].similarity is None
    kept = D.keep_clean(df, bench)
    assert kept.columns == df.columns and {x.doc_id for x in kept.collect()} == {d for d in want if not want[d]}


def test_texts_shorter_than_the_item(spark):
    """A text with fewer words than an item is compared as a whole."""
    r = random.Random(12)
    items = [(i, " ".join("".join(r.choice("aeinorst") for _ in range(5)) for _ in range(r.randint(18, 50)))) for i in range(20)]
    items += [(50, "so so so so so so so so so so so so")]
    docs = [(100 * i + k, " ".join(t.split()[k // 2: len(t.split()) - (k + 1) // 2])) for i, t in items for k in range(9)]
    docs += [(9000 + i, t.replace(t.split()[3], "", 1)) for i, t in items[:20]]
    want = {}
    for d, t in docs:
        w = toks(t)
        sh = lambda z: [tuple(z[j: j + 5]) for j in range(len(z) - 4)]
        want[d] = [i for i, x in items if max((jac(sh(w[a: a + len(toks(x))]), sh(toks(x))) for a in range(max(1, len(w) - len(toks(x)) + 1))), default=0) >= 0.8]
    short = {i: len(t.split()) for i, t in items}
    assert sum(len(t.split()) < short[i] for d, t in docs for i in want[d]) > 20
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {x.doc_id: x.item_ids for x in D.contaminated(df, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == want


def test_blocks_of_items_and_empty(spark, monkeypatch):
    docs, items = data()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    one = sorted(map(tuple, D.contaminated(df, bench).select("doc_id", "item_ids").collect()))
    monkeypatch.setattr(D, "BLOCK_ITEMS", 5)
    assert sorted(map(tuple, D.contaminated(df, bench).select("doc_id", "item_ids").collect())) == one
    assert D.contaminated(df, bench.limit(0)).where("contaminated").count() == 0
    assert D.contaminated(df.limit(0), bench).count() == 0


def test_multi_index_finds_all_within_radius():
    r = np.random.default_rng(1)
    index = D.Index(5, [(i, r.integers(0, 1 << 62, 30).astype(np.uint64)) for i in range(300)])
    prints = np.concatenate([index.prints[:50] ^ np.uint64((1 << 20) - 1), r.integers(0, 1 << 62, 200).astype(np.uint64)])
    want = {(i, j) for i, p in enumerate(prints) for j, q in enumerate(index.prints) if bin(int(p) ^ int(q)).count("1") <= D.RADIUS}
    assert set(zip(*(x.tolist() for x in index.within(prints)))) == want and want
    assert not D.indexes([], pa.array([], pa.string()))
