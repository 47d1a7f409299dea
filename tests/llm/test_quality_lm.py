import math
import random
from collections import Counter, defaultdict

import numpy as np

from burnup.llm import quality_lm as Q


def ngrams(text, k=Q.ORDER):
    s = [0] * (k - 1) + [int(x) for x in Q.ALPHABET[np.frombuffer(text.encode(), np.uint8)]]
    return [tuple(s[i: i + k]) for i in range(len(s) - k + 1)]


class Brute:
    def __init__(self, texts):
        c = Counter(g for t in texts for g in ngrams(t))
        self.orders = {}
        for k in range(Q.ORDER, 0, -1):
            n = Counter(c.values())
            y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0
            d = [min(max(i - (i + 1) * y * n[i + 1] / n[i] if n[i] else 0, Q.LEAST_DISCOUNT), i) for i in (1, 2, 3)]
            total, left = defaultdict(float), defaultdict(float)
            for g, x in c.items():
                total[g[:-1]] += x
                left[g[:-1]] += d[min(x, 3) - 1]
            self.orders[k] = (c, d, total, left)
            c = Counter(g[1:] for g in c)

    def p(self, g):
        if not g:
            return 1 / Q.SYMBOLS
        c, d, total, left = self.orders[len(g)]
        below, h = self.p(g[1:]), g[:-1]
        if not total[h]:
            return below
        x = c[g]
        return (x - d[min(x, 3) - 1] if x else 0) / total[h] + left[h] / total[h] * below

    def ppl(self, text):
        g = ngrams(text)
        return 2 ** (-sum(math.log2(self.p(x)) for x in g) / len(g)) if g else None


def data():
    r = random.Random(2)
    good = lambda: " ".join("".join(r.choice(["the", "re", "in", "on", "st"]) for _ in range(r.randint(1, 4))) for _ in range(r.randint(3, 40))).capitalize()
    bad = lambda: "".join(r.choice("ZXQ!!%%$#9 ") for _ in range(r.randint(20, 200)))
    docs = [(i, good() if i % 4 else bad(), "en" if i % 3 else None) for i in range(160)] + [(500, None, "en"), (501, "", "xx"), (502, "The rest", "xx"), (502, "The rest", "xx"), (None, "In the rest", "en")]
    labels = [(i, int(i % 4 > 0), 0) for i in range(120)] + [(3, 1, 0), (5, None, 1), (None, 1, 0), (7, 1, None)]
    return docs, labels


def test_against_brute_force(spark):
    docs, labels = data()
    trusted = {i for i, q, t in labels if q == 1 and not t and i is not None}
    model = Brute([t for i, t, _ in docs if i in trusted])
    df = spark.createDataFrame([(*x, 1.5) for x in docs], "doc_id long, text string, lang string, perplexity double").repartition(5)
    got = Q.judge(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(got) == len(docs)
    text = {i: t for i, t, _ in docs}
    for x in got:
        want = model.ppl(text[x.doc_id] or "")
        assert x.perplexity == want or abs(x.perplexity / want - 1) < 1e-4
        assert x.kept == (want is not None and x.perplexity <= x.threshold)
    for lang in {x.lang for x in got}:
        own = sorted(x.perplexity for x in got if x.lang == lang and x.doc_id in trusted and x.perplexity)
        own = own or sorted(x.perplexity for x in got if x.doc_id in trusted and x.perplexity)
        assert {x.threshold for x in got if x.lang == lang} == {own[math.ceil(Q.QUANTILE * len(own)) - 1]}
    fresh = [x.kept == bool(x.doc_id % 4) for x in got if x.doc_id is not None and 120 <= x.doc_id < 160]
    assert np.mean(fresh) > 0.9  # not learned from


def test_probabilities_sum_to_one(spark):
    docs, _ = data()
    rows = spark.createDataFrame([(t,) for _, t, _ in docs if t], "text string")
    p = np.exp2(Q.dense(Q.collected(Q.estimate(Q.symbol_counts(rows)))).astype(float)).reshape(-1, Q.SYMBOLS)
    assert np.allclose(p.sum(axis=1), 1, atol=1e-4)


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    df = spark.createDataFrame([(1, "some text", "en"), (2, None, "en")], "doc_id long, text string, lang string")
    got = {x.doc_id: x for x in Q.judge(df, none).collect()}
    assert got[1].kept and abs(got[1].perplexity - Q.SYMBOLS) < 1e-3 and not got[2].kept and got[2].perplexity is None
    assert Q.judge(df.limit(0), none).count() == 0
