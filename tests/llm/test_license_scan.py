import random
import textwrap

import numpy as np
import pytest

from burnup.llm import license_scan as L


def filler(r, n):
    return " ".join("".join(r.choice(["the", "re", "in", "on", "st", "é"]) for _ in range(r.randint(1, 4))) for _ in range(n))


def frame(spark):
    r = random.Random(4)
    rows, truth = [], {}
    for i in range(400):
        lines = [filler(r, r.randint(3, 30)) for _ in range(r.randint(1, 6))]
        if i % 4 == 0:
            family = r.choice(L.FAMILIES)
            lines.insert(r.randint(0, len(lines)), r.choice(["{}", "We release it under these terms: {}", "NOTICE -- {} (see file)"]).format(r.choice(L.NOTICES[family])))
            truth[i] = family
        rows.append((i, "\n".join(lines), "x"))
    rows += [(900, None, "x"), (901, "", "x"), (902, "\n\n --- \n", "x"), (None, "MIT License", "x"), (903, "Released under the MIT License.", "x"), (903, "Released under the MIT License.", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, licences string").repartition(4), rows, truth


def test_families(spark):
    df, rows, truth = frame(spark)
    got = L.scan(df).collect()
    assert len(got) == len(rows)
    text = {i: t for i, t, _ in rows}
    hit = []
    for x in got:
        if x.doc_id is not None and x.doc_id < 400:
            names = [y.family for y in x.licences]
            hit.append(names == ([truth[x.doc_id]] if x.doc_id in truth else []))
            assert x.n_paragraphs == sum(bool(L.words_of(p)) for p in text[x.doc_id].split("\n"))
            for y in x.licences:  # confirmed by a template in the very paragraph
                part = text[x.doc_id].lower().encode()[y.first_byte: y.end_byte].decode()
                assert part in text[x.doc_id].lower().split("\n")
                if y.family != L.UNKNOWN:
                    assert L.resemblance(L.words_of(part), y.family) == y.resemblance >= L.SIMILARITY
    assert np.mean(hit) > 0.95
    by_id = {x.doc_id: x for x in got}
    assert [(by_id[i].n_paragraphs, by_id[i].licences) for i in (900, 901, 902)] == [(0, [])] * 3
    assert [y.family for y in by_id[903].licences] == ["MIT"] == [y.family for y in by_id[None].licences]


def test_chunks_do_not_matter():
    """A paragraph's features are its own, wherever it stands."""
    import pyarrow as pa

    texts = ["one two\n\nthree", "four\nfive six seven", "", "eight"]
    _, _, f, first, row, place = next(L.paragraphs(pa.array(texts)))
    parts = np.split(f, first[1:])
    alone = [next(L.paragraphs(pa.array([p])))[2] for t in texts for p in t.split("\n") if p]
    assert [x.tolist() for x in parts] == [x.tolist() for x in alone]
    assert [texts[r][a:b] for r, (a, b) in zip(row, place)] == ["one two", "three", "four", "five six seven", "eight"]


@pytest.mark.parametrize("prefix", ["", " * "])
def test_wrapped_notices(spark, prefix):
    """Notices over several lines are one licence, confirmed over the joined lines."""
    r = random.Random(8)
    rows, truth = [], {}
    long = [(f, t) for f in L.FAMILIES for t in L.NOTICES[f] if len(t) > 80]
    for i in range(300):
        lines = [filler(r, r.randint(3, 30)) for _ in range(r.randint(1, 4))]
        if i % 4 == 0:
            family, t = long[i // 4 % len(long)]
            lines[1:1] = ["", *(prefix + x for x in textwrap.wrap(t + ", " + filler(r, 3), 45)), prefix if i % 8 else ""]
            truth[i] = family
        rows.append((i, "\n".join(lines)))
    got = {x.doc_id: [y.family for y in x.licences] for x in L.scan(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert {f for f in truth.values()} >= {"MIT", "BSD", "ISC", "CC0", "GPL"}
    assert np.mean([got[i] == [f] for i, f in truth.items()]) > 0.9
    assert np.mean([not got[i] for i in got if i not in truth]) > 0.95


def test_few_distinct_lines_still_train(spark, monkeypatch):
    """The sample is of distinct lines, so lines that repeat very often do not shrink it."""
    monkeypatch.setattr(L, "NEGATIVES", 40)
    r = random.Random(3)
    distinct = [filler(r, r.randint(3, 30)) for _ in range(60)] + [filler(r, 900)]
    rows = [(i, "\n".join(r.choice(distinct) for _ in range(20))) for i in range(400)] + [(999, "\n".join(distinct))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert len(L._sample(df)) == 40
    got = {x.doc_id: x for x in L.scan(df).collect()}
    assert sum(len(x.licences) for x in got.values()) <= L.FALSE_RATE * sum(x.n_paragraphs for x in got.values())


#: Notices of licences that the module knows nothing of.
UNSEEN = ["Licensed under the Academic Free License version 3.0", "This software is released under the PostgreSQL License", "Licensed under the Open Software License version 3.0",
          "You may redistribute and modify this source under the terms of the CERN Open Hardware Licence", "Distributed under the Python Software Foundation License Version 2",
          "This work is licensed under the Educational Community License, Version 2.0"]


def test_unknown_licences(spark):
    """Licences that no training notice or template names, and those that only teach the class, are ``unknown``; clean lines are none."""
    r = random.Random(12)
    rows, truth = [], set()
    for i in range(600):
        lines = [filler(r, r.randint(3, 30)) for _ in range(r.randint(1, 6))]
        if i % 10 == 0:
            lines.insert(r.randint(0, len(lines)), [*UNSEEN, *L.OTHERS][i // 10 % (len(UNSEEN) + len(L.OTHERS))])
            truth.add(i)
        rows.append((i, "\n".join(lines)))
    got = {x.doc_id: [y.family for y in x.licences] for x in L.scan(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    unseen = [got[i] == [L.UNKNOWN] for i in truth if any(u in rows[i][1] for u in UNSEEN)]
    others = [got[i] == [L.UNKNOWN] for i in truth if not any(u in rows[i][1] for u in UNSEEN)]
    assert np.mean(unseen) >= 0.8 and np.mean(others) > 0.95
    assert np.mean([not got[i] for i in got if i not in truth]) > 0.99


def test_against_single_paragraphs(spark):
    """Lines apart from each other: every decision from one line, its softmax written out, and its templates."""
    df, _, _ = frame(spark)
    df = df.selectExpr("doc_id", "replace(text, '\n', '\n\n') AS text")
    weights, least = L.train(df.where("text is not null"))
    want = []
    for x in df.collect():
        found = []
        for line in (x.text or "").split("\n"):
            if not L.words_of(line):
                continue
            f = next(L._features([line]))[0]
            z = np.sum([weights[i] for i in f], axis=0) / np.sqrt(len(f)) + weights[-1]
            p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
            if 1 - p[-1] > least:
                words, family = L.words_of(line), L.KINDS[int(np.argmax(p[:-1]))]
                part = max(len(t & {tuple(words[i: i + k]) for i in range(len(words) - k + 1)}) / len(t) for k, t in L.templates()[family])
                found.append((family if part >= L.SIMILARITY else L.UNKNOWN, round(float(1 - p[-1]), 4)))
        want.append((x.doc_id if x.doc_id is not None else -1, found))
    got = [(x.doc_id if x.doc_id is not None else -1, [(y.family, round(y.score, 4)) for y in x.licences]) for x in L.scan(df).collect()]
    same = [a[0] == b[0] and [y[0] for y in a[1]] == [y[0] for y in b[1]] and np.allclose([y[1] for y in a[1]], [y[1] for y in b[1]], atol=2e-3) for a, b in zip(sorted(got), sorted(want), strict=True)]
    assert all(same) and sum(len(x[1]) for x in got) > 90


def test_very_many_wrapped_notices():
    """The time for a text's wrapped notices grows with their number."""
    import time

    import pyarrow as pa

    notice = "\n".join(textwrap.wrap(L.NOTICES["MIT"][2], 45))
    took = {}
    for n in (500, 4000):
        x = next(L.lines_of(pa.array(["\n\n".join([notice + "\nand more of it"] * n)])))
        t = time.perf_counter()
        assert len(L.wrapped(x)) == n
        took[n] = time.perf_counter() - t
    assert took[4000] < 24 * took[500]


def test_empty(spark):
    df, _, _ = frame(spark)
    assert L.scan(df.limit(0)).count() == 0
