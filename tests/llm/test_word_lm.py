import math
import random
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from burnup.llm import word_lm as W
from burnup.llm.queries import QUERIES


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    return [x for x in low.split(" ") if x]


class Brute:
    """Interpolated modified Kneser-Ney over word bigrams, straight from its formulas."""

    def __init__(self, texts):
        self.two = Counter()
        for w in filter(None, map(words, texts)):
            self.two.update(zip([0, *w], [*w, 1], strict=True))
        self.one = Counter(s for _, s in self.two)
        self.d2, self.d1 = self.cuts(self.two), self.cuts(self.one)
        self.total, self.left = Counter(), defaultdict(float)
        for (w, _), n in self.two.items():
            self.total[w] += n
            self.left[w] += self.d2[min(n, 3)]

    @staticmethod
    def cuts(counts):
        n = Counter(counts.values())
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0
        return [0, *(min(max(i - (i + 1) * y * n[i + 1] / n[i] if n[i] else 0, W.LEAST_DISCOUNT), i) for i in (1, 2, 3))]

    def p(self, s, w):
        if not self.one:
            return 1.0
        left = sum(self.d1[min(n, 3)] for n in self.one.values())
        below = (self.one[s] - self.d1[min(self.one[s], 3)] + left / (len(self.one) + 1)) / sum(self.one.values())
        if not self.total[w]:
            return below
        n = self.two[w, s]
        return (n - self.d2[min(n, 3)] + self.left[w] * below) / self.total[w]

    def ppl(self, text):
        w = words(text)
        return 2 ** (-sum(math.log2(self.p(s, c)) for c, s in zip([0, *w], [*w, 1], strict=True)) / (len(w) + 1)) if w else None


def fold(i):
    return zlib.crc32(str(i).encode()) % 5


def data():
    r = random.Random(5)
    vocabulary = ["the", "Re", "мир", "слово", "καλός", "书", "in", "on", "st"]
    follow = {w: r.sample(vocabulary, 3) for w in vocabulary}

    def good():
        out = [r.choice(vocabulary)]
        while len(out) < r.randint(8, 40):
            out.append(r.choice(follow[out[-1]]))
        return out

    def bad():  # the same words, in any order
        out = good()
        r.shuffle(out)
        return out

    sep = [" ", "  ", "\n", "\t"]
    docs = [(i, r.choice(sep).join(good() if i % 4 else bad()) + r.choice(["", " new" + str(i)]), "en" if i % 3 else None) for i in range(240)]
    docs += [(500, None, "en"), (501, " \n", "xx"), (502, "The rest", "xx"), (502, "the мир", "xx"), (None, "In the rest", "en")]
    labels = [(i, int(i % 4 > 0), 0) for i in range(180)] + [(3, 1, 0), (5, None, 1), (None, 1, 0), (7, 1, None), (500, 1, 0), (501, 1, 0)]
    return docs, labels


@pytest.mark.parametrize("sizes", [{}, {"batch_tokens": 50, "bucket_bytes": 300, "passes": 3}])
def test_against_brute_force(spark, sizes):
    docs, labels = data()
    trusted = {i for i, q, t in labels if q == 1 and not t and i is not None}
    model = Brute([t for i, t, _ in docs if i in trusted and fold(i) != 1])
    df = spark.createDataFrame([(*x, 1.5) for x in docs], "doc_id long, text string, lang string, perplexity double").repartition(3)
    got = W.judge(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), **sizes).collect()
    assert sorted((x.doc_id or -1, x.lang or "", x.n_symbols) for x in got) == sorted((i or -1, lang or "", len(words(t)) + bool(words(t))) for i, t, lang in docs)
    want = defaultdict(list)
    for i, t, _ in docs:
        want[i].append(model.ppl(t))
    for i, all_ in want.items():
        mine = [x.perplexity for x in got if x.doc_id == i]
        assert sorted((x for x in mine if x is not None)) == pytest.approx(sorted(x for x in all_ if x is not None), rel=1e-9) and len(mine) == len(all_)
    held = lambda f: sorted(x.perplexity for x in got if x.doc_id in trusted and fold(x.doc_id) == 1 and x.perplexity and f(x))
    for lang in {x.lang for x in got}:
        own = held(lambda x, lang=lang: x.lang == lang) or held(lambda x: True)
        assert {x.threshold for x in got if x.lang == lang} == {own[math.ceil(W.QUANTILE * len(own)) - 1]}
    assert all(x.kept == (x.perplexity is not None and x.perplexity <= x.threshold) for x in got)


def test_words_of_any_script_and_their_order_count(spark):
    """Shuffled words of the text learned from, and other words of its script, are less likely than its own."""
    own = "добрый день дорогой друг как твои дела сегодня утром"
    docs = spark.createDataFrame([(i, own, "ru") for i in range(20)] + [(100, " ".join(sorted(own.split())), "ru"), (101, "шумит камыш деревья гнутся ночка тёмная была", "ru")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    got = {x.doc_id: x for x in W.judge(docs, labels).collect()}
    assert [i for i, x in got.items() if not x.kept] == [100, 101] and got[0].perplexity < min(got[100].perplexity, got[101].perplexity)


def test_probabilities_sum_to_one():
    model = Brute([t for _, t, _ in data()[0]])
    seen = list(model.one)
    count = lambda x: [sum(n == i for n in x.values()) for i in (1, 2, 3, 4)] + [len(x), sum(x.values())]
    for w in [*list(model.total)[:20], "not seen"]:
        followers = [model.two[w, s] for s in seen] + [0]
        mine = [n for (c, _), n in model.two.items() if c == w]
        sums = [sum(mine), *(sum(f(n) for n in mine) for f in (lambda n: n == 1, lambda n: n == 2, lambda n: n > 2)), 0]
        p = W.probabilities(np.array(followers), np.array([sums] * len(followers)), np.array([model.one[s] for s in seen] + [0]), count(model.two), count(model.one))
        assert abs(p.sum() - 1) < 1e-9


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    df = spark.createDataFrame([(1, "some text", "en"), (2, None, "en")], "doc_id long, text string, lang string")
    got = {x.doc_id: x for x in W.judge(df, none).collect()}
    assert got[1].kept and got[1].perplexity == 1 and got[1].threshold is None and not got[2].kept and got[2].perplexity is None
    assert W.judge(df.limit(0), none).count() == 0


def test_query_scores_words(spark, tmp_path):
    docs = [(1, "one two three", "en"), (2, "дом", "ru"), (3, None, "en")]
    spark.createDataFrame(docs, "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert {x.doc_id: x.n_symbols for x in QUERIES["op7_quality_classifier"](spark, str(tmp_path)).collect()} == {1: 4, 2: 2, 3: 0}


def test_a_batch_keeps_its_words_and_their_places(monkeypatch):
    """Repeated, rare and long words, many texts and buckets: the packed form gives back each word's hash; hashes are in order of their bucket."""
    r = np.random.default_rng(3)
    texts = [" ".join(f"w{x}" for x in r.zipf(1.3, 400) % 5000) for _ in range(120)] + ["", "w" * 100]
    rows = pa.RecordBatch.from_pydict({"doc_id": range(122), "lang": ["en"] * 122, "part": pa.array([0] * 122, pa.int32()), "text": texts})
    packed = [x.set_column(2, "packed", x["packed"]).append_column("part", rows["part"]) for x in W._packed_texts([rows])]
    monkeypatch.setattr(W.TaskContext, "get", lambda: SimpleNamespace(partitionId=lambda: 0))
    one, = W._batches(1 << 20)(packed)
    for buckets in (1, 7, 1000):
        tokens, keys, n = W._coded(one, buckets)
        assert n.tolist() == [len(words(t)) + 1 for t in texts]
        low = np.frombuffer(" ".join([*texts, ""]).encode(), np.uint8)
        want = W.word_hashes(low, *W.token_bounds(low))
        ends = np.cumsum(n) - 1
        assert (np.delete(keys[tokens], ends) == want).all() and (keys[tokens][ends] == W.END).all()
        assert (np.diff((keys % np.uint64(buckets)).astype(int)) >= 0).all() and len(set(keys.tolist())) == len(keys)
    # less than whole hashes and places in their order
    distinct, places = np.unique(keys[tokens], return_inverse=True)
    assert sum(len(one[x][0].as_py()) for x in ("tokens", "hashes", "often")) < 0.9 * (len(W.pack(places.astype("<u4"))) + len(W.pack(distinct)))


def test_texts_are_not_shuffled_all_at_once(spark, monkeypatch):
    docs, labels = data()
    parts = []
    monkeypatch.setattr(W, "scores", lambda rows, size, scores=W.scores, **sizes: (parts.extend(x.count() for x in rows), scores(rows, size, **sizes))[1])
    got = W.judge(spark.createDataFrame(docs, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert sum(parts) == len(docs) == got.count() and max(parts) < 0.7 * len(docs)
