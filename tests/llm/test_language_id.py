import random
import zlib

import numpy as np

from burnup.llm import language_id as L

POOL = {"aa": "ba be bi bo bu ta te ti", "bb": "xo xu zek zok kra kro", "cc": "éli élo ñan ñun çer"}


def text(r, lang, n):
    parts = POOL[lang].split()
    return " ".join("".join(r.choice(parts) for _ in range(r.randint(1, 4))) for _ in range(n)).capitalize()


def frame(spark):
    r = random.Random(1)
    rows = []
    for i in range(300):
        lang = r.choice(list(POOL))
        rows.append((i, text(r, lang, r.randint(3, 40)), lang, 0.5))
    rows += [(900, None, "aa", 0.5), (901, "", "aa", 0.5), (902, "12 34 !? \t", "bb", 0.5), (None, "bata xo", None, 0.5), (903, "BATA BATE", None, 0.5), (903, "BATA BATE", None, 0.5)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score double").repartition(5), rows


def test_predictions(spark):
    df, rows = frame(spark)
    got = L.identify(df).collect()
    assert len(got) == len(rows)
    truth = {i: lang for i, t, lang, _ in rows if i is not None and i < 900}
    held = [(x.lang_pred == truth[x.doc_id]) for x in got if x.doc_id in truth and x.held_out]
    assert np.mean(held) > 0.97 and len(held) > 50
    for x in got:
        assert 0 <= x.score <= 1
        assert x.held_out == (x.doc_id is not None and zlib.crc32(str(x.doc_id).encode()) % 3 == 1)
    assert {x.doc_id: (x.lang_pred, x.score) for x in got if x.doc_id in (900, 901, 902)} == {i: ("und", 0.0) for i in (900, 901, 902)}
    kept = L.keep_identified(df)
    assert kept.columns == df.columns and not {900, 901, 902} & {x.doc_id for x in kept.collect()}


def test_counts_cover_the_training_fold(spark):
    df, rows = frame(spark)
    languages, table = L.train(df.where(L.fold() != 1))
    want = np.zeros((3, L.FEATURES))
    for i, t, lang, _ in rows:
        if t and lang and i is not None and zlib.crc32(str(i).encode()) % 3 != 1:
            buf = L.FOLD[np.frombuffer(t.encode() + b" ", np.uint8)]
            f = L.features(buf)
            want[languages.index(lang)] += np.bincount(f[(buf != 32) | np.append(False, buf[:-1] != 32)], minlength=L.FEATURES)
    want += L.ALPHA
    assert np.allclose(table, np.log(want / want.sum(1, keepdims=True)), atol=1e-5)


def test_mixture_proportions():
    """Chunks of several texts agree with single texts, and a mixed text gets both languages."""
    r = random.Random(3)
    f = [np.bincount(L.features(L.FOLD[np.frombuffer(text(r, g, 4000).encode() + b" ", np.uint8)]), minlength=L.FEATURES) + L.ALPHA for g in POOL]
    table = np.log(np.array([x / x.sum() for x in f])).astype(np.float32)
    docs = [text(r, "aa", 30) + " " + text(r, "bb", 70), text(r, "cc", 5), "", "?", text(r, "aa", 1)]
    raw = [t.encode() + b" " for t in docs]
    bounds = np.cumsum([0, *map(len, raw)])
    pred, score = L.infer(L.FOLD[np.frombuffer(b"".join(raw), np.uint8)], bounds, table)
    assert pred.tolist() == [1, 2, -1, -1, 0]
    assert abs(score[0] - 0.7) < 0.03 and score[1] == 1.0
    wide = raw[0].replace(b" ", b" 123 -- ")
    assert L.infer(L.FOLD[np.frombuffer(wide, np.uint8)], np.array([0, len(wide)]), table)[1][0] == score[0]
    for b, p, s in zip(raw, pred, score):
        one = L.infer(L.FOLD[np.frombuffer(b, np.uint8)], np.array([0, len(b)]), table)
        assert one[0][0] == p and abs(one[1][0] - s) < 1e-6


def test_empty_and_untrained(spark):
    df, _ = frame(spark)
    assert L.identify(df.limit(0)).count() == 0
    none = spark.createDataFrame([(1, "hello there", None)], "doc_id long, text string, lang string")
    assert [(x.lang_pred, x.score) for x in L.identify(none).collect()] == [("und", 0.0)]
