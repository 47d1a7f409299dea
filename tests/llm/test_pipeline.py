import importlib

import numpy as np
import pytest
from test_bpe import PATH
from test_decontaminate import brute as brute_matches
from test_simhash_dedup import brute_components, brute_fp
from test_suffix_dedup import brute as brute_repeats
from tokenizers import Tokenizer

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """(name, rows in, rows out) of each stage over the smallest tables."""
    p = importlib.import_module("corpus_pipeline")
    from burnup.llm.base import stored

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    docs = stored(docs.union(docs.limit(0)), "documents")
    out = {}
    for name, f in p.STAGES:
        after = stored(f(spark, docs, SMALL), name)
        out[name] = (docs.collect(), after.collect(), docs.columns, after.columns)
        docs = after
    return out


def test_columns(stages):
    names = list(stages)
    assert names == ["language_id", "simhash_near_dedup", "suffix_array_dedup", "benchmark_decontamination", "bpe_encode"]
    for name in names[:-1]:
        assert stages[name][2] == stages[name][3]


def test_language_stage_keeps_clean_documents(stages):
    before, after, *_ = stages["language_id"]
    assert len(after) >= 0.99 * len(before)


def test_near_copies(stages):
    before, after, *_ = stages["simhash_near_dedup"]
    before = sorted(before, key=lambda x: x.doc_id)
    roots = brute_components([brute_fp(x.text) for x in before])
    assert sorted(x.doc_id for x in after) == sorted({before[i].doc_id for i in roots})


def test_passages(stages):
    before, after, *_ = stages["suffix_array_dedup"]
    want = {}
    for (i, t), (_, _, spans, _) in brute_repeats([(x.doc_id, x.text) for x in before], 100).items():
        b = t.encode()
        for s, e in reversed(spans):
            b = b[:s] + b[e:]
        want[i] = b.decode("utf-8", "ignore")
    assert {x.doc_id: x.text for x in after} == want
    assert all(x.n_chars == len(x.text) for x in after)


def test_benchmark(stages, spark):
    before, after, *_ = stages["benchmark_decontamination"]
    items = [tuple(x) for x in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    hit = brute_matches([(x.doc_id, x.text) for x in before], items)
    assert {x.doc_id for x in after} == {d for d in hit if not hit[d]}


def test_tokens(stages):
    before, after, *_ = stages["bpe_encode"]
    lib = Tokenizer.from_file(PATH)
    ids = {x.doc_id: np.array(x.ids).tolist() for x in after}
    assert ids == {x.doc_id: lib.encode(x.text, add_special_tokens=False).ids for x in before}
    assert all(x.n_tokens == len(x.ids) for x in after)


def test_stages_on_odd_rows(spark):
    """Nulls in every column, repeated rows, extra columns with the operators' own names, and no rows at all."""
    p = importlib.import_module("corpus_pipeline")
    schema = "doc_id long, text string, lang string, source string, n_chars long, row string, matches int, _d string, windows int, lang_pred double, `a.b` int"
    odd = [(None, None, None, None, None, None, None, None, None, None, None), (1, "", "en", "s", 0, "r", 1, "d", 2, 0.5, 3), (2, "A plain text of words", "en", "s", 21, "r", 1, "d", 2, 0.5, 3),
           (2, "A plain text of words", "en", "s", 21, "r", 1, "d", 2, 0.5, 3), (None, "Another text here", None, None, None, "r", None, None, None, None, None)]
    df = spark.createDataFrame(odd, schema)
    for name, f in p.STAGES[:-1]:
        out = f(spark, df, SMALL)
        assert out.columns == df.columns, name
        texts = [x.text for x in out.collect()]
        assert texts.count("A plain text of words") == (1 if name == "simhash_near_dedup" else 2), name
        assert "Another text here" in texts
        assert f(spark, df.limit(0), SMALL).count() == 0
    last = p.STAGES[-1][1](spark, df, SMALL)
    assert last.count() == len(odd) and p.STAGES[-1][1](spark, df.limit(0), SMALL).count() == 0
