import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from burnup.llm import bloom_lm as B


def toks(t):
    t = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x20\x09-\x0D]+", t) + [None]


def brute(rows):
    train = [toks(t) for i, t in rows if i is not None and zlib.crc32(str(i).encode()) % 5 != 1]
    c = Counter(w for x in train for w in x)
    pairs = Counter(p for x in train for p in zip([0, *x[:-1]], x))
    q = lambda n: (3 * 2 ** (int(math.log2(n))) - 1) / 2 if n else 0
    n, v = sum(c.values()), len(c)
    below = n + 0.5 * (v + 1)
    quantised = sum(map(q, c.values())) + 0.5 * (v + 1)
    after = Counter()
    for (h, _), k in pairs.items():
        after[h] += q(k)
    out = []
    for i, t in rows:
        x = toks(t)
        base = sum(math.log10((c[w] + 0.5) / below) for w in x)
        s = 0
        for h, w in zip([0, *x[:-1]], x):
            s += math.log10((q(pairs[h, w]) + B.PRIOR * (q(c[w]) + 0.5) / quantised) / (after[h] + B.PRIOR))
        out.append((len(x), sum(c[w] > 0 for w in x), n, base, s))
    return out


def corpus():
    r = random.Random(6)
    vocab = ["".join(r.choice("abcdeÉé") for _ in range(r.randint(1, 5))) for _ in range(150)]
    rows = [(i, " ".join(r.choice(vocab[: r.randint(3, 150)]) for _ in range(r.randint(0, 90))).title()) for i in range(150)]
    return rows + [(200, None), (201, ""), (202, " \t\x0b x\x0cy\r\nZ "), (203, "nevernever seen"), (203, "nevernever seen"), (204, "ab " * 3000)]


@pytest.mark.parametrize("size", [1 << 20, 200])
def test_against_brute_force(spark, size):
    rows = corpus()
    df = spark.createDataFrame([(i, t, 1.0) for i, t in rows], "doc_id long, text string, score double").coalesce(1)
    got = sorted(B.score(df, size, 4000, 64).collect(),  # 64 bits: no false positives to speak of
                 key=lambda x: x.doc_id)
    assert len(got) == len(rows)
    for x, (i, _), w in zip(got, rows, brute(rows)):
        assert x.doc_id == i and x.held_out == (zlib.crc32(str(i).encode()) % 5 == 1)
        assert (x.n_tokens, x.n_known, x.train_tokens) == w[:3]
        assert abs(x.base_score - w[3]) < 1e-8 * max(1, abs(w[3])) and abs(x.score - w[4]) < 1e-8 * max(1, abs(w[4]))


def test_filter_never_underestimates():
    r = np.random.default_rng(0)
    keys = r.integers(0, 1 << 63, 60_000).astype(np.uint64)
    counts = np.minimum(r.zipf(1.6, len(keys)), 1 << 20)
    n = 7
    parts = [B.fill(keys[keys % n == b], counts[keys % n == b], 1 << 30).tobytes() for b in range(n)]
    f = B.Filter(parts)
    assert (f.level(keys) >= B.levels(counts)).all()
    assert (f.level(keys) == B.levels(counts)).mean() > 0.97
    assert (f.level(r.integers(0, 1 << 63, 60_000).astype(np.uint64)) > 0).mean() < 0.02


def test_filter_grows_with_its_entries(spark, monkeypatch):
    """No bound on all parts together: many entries have as small an error as few."""
    monkeypatch.setattr(B, "MAX_BITS", 1 << 10, raising=False)  # the bound there was, far below this input
    rows = corpus()
    got = sorted(B.score(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), 1 << 20, 4000, 64).collect(), key=lambda x: x.doc_id)
    for x, w in zip(got, brute(rows), strict=True):
        assert abs(x.score - w[4]) < 1e-8 * max(1, abs(w[4]))
    # one bucket of very many: absent bigrams do not pass
    r = np.random.default_rng(2)
    keys = r.integers(0, 1 << 63, 40_000).astype(np.uint64)
    counts = (np.arange(len(keys)) % 2).astype("<u4")  # every second one is only looked up
    sent = pa.RecordBatch.from_arrays([pa.array([5], pa.int32()), pa.array([0], pa.int64()), pa.array([keys.tobytes()], pa.binary()), pa.array([counts.tobytes()], pa.binary())], names=["bucket", "batch", "keys", "counts"])
    out = next(B._sum(False, B.ENTRY_BITS)(iter([sent])))
    level = np.frombuffer(out["levels"][1].as_py(), np.uint8)
    assert (level[counts == 1] >= 1).all() and (level[counts == 0] > 0).mean() < 0.02
    assert out["n_distinct"][0].as_py() == 20_000


@pytest.mark.parametrize("size", [1 << 20, 300])
def test_probabilities_of_a_context_sum_to_one(spark, size):
    """After each word, and at the start, over all learned words, the text's end and one word never seen."""
    vocab = ["aa", "bb", "cc", "dd", "ee"]
    r = random.Random(5)
    learned = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 != 1][:120]
    rows = [(i, " ".join(r.choice(vocab[: r.randint(1, 5)]) for _ in range(r.randint(0, 30)))) for i in learned]
    held = [i for i in range(400, 4000) if zlib.crc32(str(i).encode()) % 5 == 1]
    probes = [(h, w) for h in [None, *vocab] for w in [*vocab, "unseen"]]
    texts = {}
    for h, w in probes:  # two texts that differ by one token and one context
        for t in ([h] if h else [], [h, w] if h else [w]):
            texts.setdefault(" ".join(t), held[len(texts)])
    got = {x.doc_id: x.score for x in B.score(spark.createDataFrame(rows + [(i, t) for t, i in texts.items()], "doc_id long, text string").coalesce(1), size, 4000, 64).collect()}
    # p(end | w) from the text of w alone and p(w | start): both follow from texts of no, one and two words
    p = {t: 10 ** got[i] for t, i in texts.items()}
    train = [toks(t) for _, t in rows]
    c, pairs = Counter(w for x in train for w in x), Counter(x for y in train for x in zip([0, *y[:-1]], y))
    q = lambda n: (3 * 2 ** (int(math.log2(n))) - 1) / 2 if n else 0
    low = sum(map(q, c.values())) + 0.5 * (len(c) + 1)
    words = [*vocab, None, "unseen"]
    after = {h: sum(q(pairs[h, w]) for w in words) for h in [0, *vocab, "unseen"]}
    one = lambda h, w: (q(pairs[h, w]) + B.PRIOR * (q(c[w]) + 0.5) / low) / (after[h] + B.PRIOR)
    for h in [0, *vocab, "unseen"]:
        assert abs(sum(one(h, w) for w in words) - 1) < 1e-9
    for h, w in probes:  # the operator's own figures are those probabilities
        t = f"{h} {w}" if h else w
        want = (one(0, h) * one(h, w) if h else one(0, w)) * one(w, None)
        assert abs(p[t] - want) < 1e-9 * want
    assert abs(p[""] + sum(p[w] / one(w, None) for w in [*vocab, "unseen"]) - 1) < 1e-9


def test_nulls_and_empty(spark):
    df = spark.createDataFrame([(None, "a b"), (1, None)], "doc_id long, text string")
    got = {x.doc_id: x for x in B.score(df).collect()}
    learned = zlib.crc32(b"1") % 5 != 1
    assert got[None].held_out is False and got[None].train_tokens == int(learned) and got[None].n_tokens == 3 and got[1].n_tokens == 1
    assert B.score(df.limit(0)).count() == 0
