import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from burnup.llm import fill_in_middle as M

SCHEMA = "doc_id long, text string, n string, form string, output string"


def brute(i, text):
    t = text or ""
    h = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[x: x + 8], 16) for x in (0, 8, 16, 24))
    a, b = sorted((h1 % (len(t) + 1), h2 % (len(t) + 1)))
    if not t or any(x in t for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return i, len(t), "plain", None, None, t, t
    p, m, s = t[:a], t[a:b], t[b:]
    out, form = (f"<S>{s}<P>{p}<M>{m}", "spm") if h4 % 100 < 20 else (f"<P>{p}<S>{s}<M>{m}", "psm")
    return i, len(t), form, len(p), len(m), out, t


def texts(seed, n=600):
    r = random.Random(seed)
    letters = ["abcdefgh .\n", "абвгд ежзи", "你好世界，的了", "aé😀<>PSM", "😀😁"]
    return [(i * 11, "".join(r.choice(r.choice(letters)) for _ in range(r.choice([0, 1, 2, 7, 90, 700])))) for i in range(n)]


def check(spark, rows, parts=3, **more):
    df = M.transform(spark.createDataFrame([(i, t, "x", "y", "z") for i, t in rows], SCHEMA).repartition(parts), **more)
    got = df.select("*", M.restored(F.col("output"), F.col("form")).alias("restored")).collect()
    assert sorted(map(tuple, got), key=str) == sorted((brute(i, t) for i, t in rows), key=str)
    return got


def test_brute(spark):
    got = check(spark, texts(1))
    share = {f: sum(x.form == f for x in got) / len(got) for f in ("plain", "psm", "spm")}
    assert all(share.values()) and share["psm"] > share["spm"]


def test_narrow_error_and_small_chunks(spark):
    check(spark, texts(2, 200), parts=40, error=1)


def test_marks_nulls_repeats_and_empty(spark):
    rows = [(1, None), (2, ""), (3, "a<P>b"), (4, "<S>"), (5, "x<M>"), (6, "<<P"), (None, "no id"), (7, "twice"), (7, "twice"), (8, "<"), (9, "P>S>M>"), *((i, "<<S<P<M") for i in range(20, 60))]
    check(spark, rows)
    check(spark, [])


def test_long_text(spark):
    r = random.Random(3)
    check(spark, [(i, "".join(r.choice("ab é你😀") for _ in range(1_500_000))) for i in (1, 2)] + [(3, "x" * 3_000_000)], parts=1)


@pytest.mark.parametrize("error", [1, 5, 127])
@pytest.mark.parametrize("block", [16, 1000, 1 << 20])
def test_index_is_exact_and_bounded(error, block):
    r = random.Random(error * block)
    pieces = ["".join(r.choice(x) for _ in range(r.randint(0, 400))) for x in ("abc", "éü", "你好", "😀a", "a你😀é") * 5]
    raw = "".join(pieces).encode()
    bounds = np.cumsum([0, *(len(x.encode()) for x in pieces)])
    index = M.BoundaryIndex(np.frombuffer(raw, np.uint8), bounds, error, block)
    want = np.cumsum([0, *(len(c.encode()) for c in raw.decode())])
    ranks = np.arange(len(want))
    assert (index.offsets(ranks) == want).all()
    assert (np.abs(index.predict(ranks) - want) <= error).all()
    assert (index.ranks == np.cumsum([0, *map(len, pieces)])).all()


def test_ascii_is_one_piece_a_text():
    index = M.BoundaryIndex(np.frombuffer(b"a" * 5000, np.uint8), np.array([0, 2000, 5000]))
    assert index.first.tolist() == [0, 2000, 5000] and not index.residual.any()
    with pytest.raises(ValueError):
        M.BoundaryIndex(np.zeros(0, np.uint8), np.array([0]), 128)
