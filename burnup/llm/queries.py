"""One query per operator over its whole table, and its DuckDB SQL where SQL can say it."""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from burnup.llm import (bloom_lm, bpe, decontaminate, embedding_dedup, fill_in_middle, importance_sample, language_id, license_scan, line_dedup, simhash_dedup, suffix_dedup,
                        url_filter, word_lm)
from burnup.llm.base import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        @wraps(f)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return f(spark, sf_dir)

        QUERIES[name] = run
        if sql:
            ORACLE[name] = sql
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


@query("op10_suffix_array_dedup", """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS hx, strlen(coalesce(text, '')) AS n FROM documents),
w AS (SELECT doc_id, p, md5(substr(hx, 2 * p + 1, 200)) AS g
      FROM (SELECT doc_id, hx, unnest(range(greatest(n - 99, 0))) AS p FROM d)),
later AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY g ORDER BY doc_id, p) AS r FROM w) WHERE r > 1),
step AS (SELECT doc_id, p, CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= 100 THEN 0 ELSE 1 END AS fresh FROM later),
run AS (SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS k FROM step),
span AS (SELECT doc_id, min(p) AS a, max(p) + 100 AS b FROM run GROUP BY doc_id, k),
piece AS (SELECT s.doc_id, s.a, substr(d.hx, 2 * coalesce(lag(s.b) OVER o, 0) + 1, 2 * (s.a - coalesce(lag(s.b) OVER o, 0))) AS hx
          FROM span s JOIN d USING (doc_id) WINDOW o AS (PARTITION BY s.doc_id ORDER BY s.a)),
head AS (SELECT doc_id, string_agg(hx, '' ORDER BY a) AS hx FROM piece GROUP BY doc_id),
sums AS (SELECT doc_id, sum(b - a) AS removed, count(*) AS spans, max(b) AS last FROM span GROUP BY doc_id)
SELECT d.doc_id, d.n AS n_bytes, CAST(coalesce(s.removed, 0) AS BIGINT) AS n_removed, coalesce(s.spans, 0) AS n_spans,
       sha256(unhex(CASE WHEN s.doc_id IS NULL THEN d.hx ELSE h.hx || substr(d.hx, 2 * s.last + 1) END)) AS kept_sha256
FROM d LEFT JOIN sums s USING (doc_id) LEFT JOIN head h USING (doc_id)""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.dedup_spans(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


@query("op3_simhash_near_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@query("op1_bpe_encode_decode")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), digests=True)


@query("op4_language_id")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


@query("op8_benchmark_decontamination")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op5_embedding_near_dedup", """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
pair AS (SELECT a.vec_id AS u, b.vec_id AS w FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (SELECT vec_id AS u, vec_id AS w FROM v UNION SELECT r.u, p.w FROM reach r JOIN pair p ON r.w = p.u),
comp AS (SELECT u, min(w) AS c FROM reach GROUP BY u),
deg AS (SELECT u, count(*) AS n FROM pair GROUP BY u)
SELECT v.vec_id, coalesce(d.n, 0) AS n_links, c.c AS component_id, v.vec_id = c.c AS kept
FROM v JOIN comp c ON c.u = v.vec_id LEFT JOIN deg d ON d.u = v.vec_id""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op9_url_filter")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


@query("op2_lm_scoring")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bloom_lm.score(table(spark, sf_dir, "documents"))


@query("op6_license_scan")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = license_scan.scan(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_paragraphs", F.array_sort(F.array_distinct(F.transform("licences", lambda x: x["family"]))).alias("licences"),
                      F.array_max(F.transform("licences", lambda x: x["score"])).alias("score"))


@query("op7_quality_classifier")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_lm.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op11_line_dedup", """
WITH line AS (SELECT doc_id, i, string_split(coalesce(text, ''), chr(10))[i] AS line
              FROM (SELECT doc_id, text, unnest(generate_series(1, len(string_split(coalesce(text, ''), chr(10))))) AS i FROM documents)),
keyed AS (SELECT *, translate(regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM line),
common AS (SELECT key, max(doc_id) AS keeps FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (SELECT k.doc_id, k.i, k.line, c.key IS NOT NULL AND k.doc_id <> c.keeps AS gone FROM keyed k LEFT JOIN common c USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query("op12_importance_resampling", """
WITH crc AS (SELECT list_transform(range(256), lambda x: list_reduce(range(8), lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, x)) AS t),
word AS (SELECT side, id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                            '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w
         FROM (SELECT 0 AS side, doc_id AS id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark)),
feature AS (SELECT side, id, unnest(w) AS f FROM word
            UNION ALL SELECT side, id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM word),
counted AS (SELECT side, id, f, count(*) AS n FROM feature GROUP BY ALL),
hashed AS (SELECT f, xor(list_reduce(list_transform(range(strlen(f)), lambda i: CAST('0x' || substr(hex(encode(f)), 2 * i + 1, 2) AS BIGINT)),
                                     lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 10000 AS bucket
           FROM (SELECT DISTINCT f FROM counted), crc),
bucketed AS (SELECT side, id, bucket, sum(n) AS n FROM counted JOIN hashed USING (f) GROUP BY ALL),
total AS (SELECT coalesce(sum(n) FILTER (side = 0), 0) AS s, coalesce(sum(n) FILTER (side = 1), 0) AS t FROM bucketed),
gain AS (SELECT bucket, CAST(floor(1000 * ln((coalesce(sum(n) FILTER (side = 1), 0) + 1)::DOUBLE * (any_value(total.s) + 10000)
                                             / ((coalesce(sum(n) FILTER (side = 0), 0) + 1)::DOUBLE * (any_value(total.t) + 10000)))) AS BIGINT) AS g
         FROM bucketed, total GROUP BY bucket),
weighed AS (SELECT id, sum(n) AS n_features, CAST(floor(sum(n * g)::DOUBLE / sum(n)) AS BIGINT) AS weight FROM bucketed JOIN gain USING (bucket) WHERE side = 0 GROUP BY id),
scored AS (SELECT id, len(w) AS n_words, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
                  coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
           FROM word LEFT JOIN weighed USING (id) WHERE side = 0),
placed AS (SELECT id, row_number() OVER (ORDER BY score DESC, id) AS r, count(*) OVER () AS n FROM scored WHERE n_words >= 20)
SELECT id AS doc_id, n_features, weight, score, CASE WHEN r <= 25 * n // 100 THEN r END AS rank FROM scored LEFT JOIN placed USING (id)""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_sample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op13_fill_in_middle", """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || doc_id) AS h FROM documents),
drawn AS (SELECT *, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (n + 1) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (n + 1) AS h2,
                 CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 AS h4 FROM d),
cut AS (SELECT *, least(h1, h2) AS a, greatest(h1, h2) AS b,
               CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 >= 90 THEN 'plain' WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
piece AS (SELECT *, substr(t, 1, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1) AS s FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM piece""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill_in_middle.transform(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(fill_in_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
