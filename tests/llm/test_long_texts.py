"""One very long text among short ones: whole results, whatever the chunks."""
import hashlib
import random

import numpy as np
import pytest
from test_bpe import PATH
from test_simhash_dedup import brute_fp
from test_suffix_dedup import brute as brute_repeats
from tokenizers import Tokenizer

from burnup.llm import bloom_lm, bpe, decontaminate, language_id, license_scan, quality_lm, simhash_dedup, suffix_dedup


@pytest.fixture(scope="module")
def rows():
    r = random.Random(9)
    long = " ".join("".join(r.choice("abcdeéiorst") for _ in range(r.randint(1, 7))) for _ in range(600_000))
    return [(1, "a short one"), (2, long), (3, "x" * 300_000), (4, None), (5, "Released under the MIT License.\n" + long[:400])]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, lang string").coalesce(1)


def test_tokens(docs, rows):
    lib = Tokenizer.from_file(PATH)
    got = {x.doc_id: x for x in bpe.encode(docs, PATH, 1000, digests=True).collect()}
    for i, t in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        assert (got[i].n_tokens, got[i].ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())


def test_fingerprints(docs, rows):
    got = {x.doc_id: int(x.fingerprint, 16) for x in simhash_dedup.near_duplicates(docs).collect()}
    assert got == {i: brute_fp(t) for i, t in rows}


def test_repeats(docs, rows):
    want = brute_repeats(rows, 100)
    got = {x.doc_id: (x.n_bytes, x.n_removed, x.spans, x.kept_sha256) for x in suffix_dedup.dedup_spans(docs).collect()}
    assert got == {i: v for (i, _), v in want.items()}


def test_others(spark, docs, rows):
    n = len(rows)
    long = dict(rows)[2]
    item = " ".join(long.split()[400_000:400_040])
    found = {x.doc_id: x.item_ids for x in decontaminate.contaminated(docs, spark.createDataFrame([(7, item)], "item_id long, text string")).collect()}
    assert found == {1: [], 2: [7], 3: [], 4: [], 5: []}
    assert {x.doc_id: x.n_tokens for x in bloom_lm.score(docs).collect()} == {i: len((t or "").split()) + 1 for i, t in rows}
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert {x.doc_id: x.n_symbols for x in quality_lm.judge(docs, labels).collect()} == {i: len((t or "").encode()) for i, t in rows}
    assert language_id.identify(docs).count() == n
    assert {x.doc_id for x in license_scan.scan(docs).collect() if [y.family for y in x.licences] == ["MIT"]} == {5}
