"""The registered queries on the smallest tables: their columns, a row per input row, and DuckDB where SQL can say it."""
import os

import pytest
from oracle import compare, duck

import __spark_entry__ as entry
from burnup.llm.queries import ORACLE, QUERIES

SMALL = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_bpe_encode_decode": ("documents", {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}),
    "op2_lm_scoring": ("documents", {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint", "base_score": "double", "score": "double"}),
    "op3_simhash_near_dedup": ("documents", {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"}),
    "op4_language_id": ("documents", {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"}),
    "op5_embedding_near_dedup": ("embeddings", {"vec_id": "bigint", "n_links": "bigint", "component_id": "bigint", "kept": "boolean"}),
    "op6_license_scan": ("documents", {"doc_id": "bigint", "n_paragraphs": "bigint", "licences": "array<string>", "score": "double"}),
    "op7_quality_classifier": ("documents", {"doc_id": "bigint", "lang": "string", "n_symbols": "bigint", "perplexity": "double", "threshold": "double", "kept": "boolean"}),
    "op8_benchmark_decontamination": ("documents", {"doc_id": "bigint", "contaminated": "boolean", "n_items": "bigint", "item_ids": "array<bigint>", "similarity": "double"}),
    "op9_url_filter": ("pages", {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"}),
    "op10_suffix_array_dedup": ("documents", {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"}),
    "op11_line_dedup": ("documents", {"doc_id": "bigint", "n_lines": "bigint", "n_dropped": "bigint", "kept_sha256": "string"}),
    "op12_importance_resampling": ("documents", {"doc_id": "bigint", "n_features": "bigint", "weight": "bigint", "score": "bigint", "rank": "bigint"}),
    "op13_fill_in_middle": ("documents", {"doc_id": "bigint", "n": "bigint", "form": "string", "prefix_chars": "bigint", "middle_chars": "bigint", "output_sha256": "string", "restored_sha256": "string"}),
}


def test_registered():
    assert set(COLUMNS) == set(QUERIES) and set(QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    table, columns = COLUMNS[name]
    out = QUERIES[name](spark, SMALL)
    assert dict(out.dtypes) == columns
    if name in ORACLE:
        res = compare(out, ORACLE[name], duck(SMALL))
        assert res["values_match"] and res["types_match"], res
    else:
        assert out.count() == spark.read.parquet(os.path.join(SMALL, f"{table}.parquet")).count()
