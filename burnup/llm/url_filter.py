"""URL filter: rules first, then naive Bayes over segmented host and path words (operator 9).

Rules name a host and the start of a path; one fits its host and all subdomains, and the longest
fitting rule decides. All other URLs get the verdict of a multinomial naive Bayes model that learns
from the URLs the rules decide. Its tokens are the words of the path and of the host, whose
concatenated names ("thering") are split by a unigram Viterbi search. The unigram counts come from
the words of all page texts.

At scale: a name is split once however many pages it has. Which of its substrings are words, and how
frequent, follows from a join of the substrings of distinct names with the word counts, so neither
table is broadcast or gathered. A substring row carries the name's number, not the name, so rows and
bytes follow a name's length. Words over ``WORD_LETTERS`` letters are candidates where their first
``WORD_LETTERS`` letters are in the name; the search itself finds the places where they are whole. The
model's tokens are hashed to ``BUCKETS`` counts, so what is collected and broadcast has a fixed bound. A
hot host is one row until its split name is joined back. Words and buckets are SQL expressions for
learning and judging alike.

Defined cases: of rules of equal length that fit, the later counts; a url, host or text may have any length; a null url, or one without ``://``, has an empty host and path, no rule and no tokens
(its verdict is the prior's); odds of zero allow; pages that repeat an id are judged each; null html
has no words; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burnup.llm.base import stored

#: (verdict, host, start of the path)
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
MAX_RULES = 1000
BUCKETS = 1 << 18
#: Letters of the longest unknown word in a name (a longer stretch is several), and of a longer word's key.
WORD_LETTERS = 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise(F.lit(""))
    host = F.coalesce(F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER), F.lit(""))
    path = F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))
    return host, path


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """(rule, verdict) of the longest fitting rule, else null."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def word_counts(pages: DataFrame) -> DataFrame:
    """(word, n): words of all page texts, in lower case."""
    text = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->|<[^>]*>", " ")
    words = F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+"), F.lit(0))
    return pages.select(F.explode(words).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def viterbi(name: str, known: dict[str, float], total: float) -> list[str]:
    """Most probable words of ``name``; of equally probable splits the one of the longest last words.

    An unknown word of n letters has probability 1 / (total * 10^(n - 1)).
    """
    best, back = [0.0], [0]
    longer = sorted({len(w) for w in known if len(w) > WORD_LETTERS}, reverse=True)
    for end in range(1, len(name) + 1):
        found, at = -math.inf, end - 1
        for start in (end - n for n in longer if n <= end):
            p = known.get(name[start:end])
            if p and (score := best[start] + math.log(p / total)) > found:
                found, at = score, start
        for start in range(max(0, end - WORD_LETTERS), end):
            p = known.get(name[start:end])
            score = best[start] + (math.log(p / total) if p else -math.log(total) - (end - start - 1) * math.log(10))
            if score > found:
                found, at = score, start
        best.append(found)
        back.append(at)
    out, end = [], len(name)
    while end:
        out.append(name[back[end]: end])
        end = back[end]
    return out[::-1]


def segmented(names: DataFrame, counts: DataFrame, total: float) -> DataFrame:
    """(name, words): distinct names (column ``name``) split into words."""
    names = stored(names.where("length(name) > 0").withColumn("id", F.monotonically_increasing_id()), "url_names")
    at = names.select("id", "name", F.explode(F.sequence(F.lit(1), F.length("name"))).alias("s")) \
        .select("id", F.expr(f"substring(name, s, {WORD_LETTERS})").alias("piece"))
    sub = at.select("id", F.explode(F.sequence(F.lit(1), F.length("piece"))).alias("l"), "piece").select("id", F.expr("substring(piece, 1, l)").alias("key")).distinct()
    counts = counts.withColumn("key", F.expr(f"substring(word, 1, {WORD_LETTERS})"))
    found = sub.join(counts, "key").groupBy("id").agg(F.collect_list(F.struct("word", "n")).alias("known"))  # a name's own words
    known = names.join(found, "id", "left").select("name", "known")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [viterbi(name, {x["word"]: x["n"] for x in known or ()}, total) for name, known in zip(batch["name"].to_pylist(), batch["known"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch["name"], pa.array(words, pa.list_(pa.string()))], names=["name", "words"])

    return known.mapInArrow(run, "name string, words array<string>")


def _buckets(tokens: Column) -> Column:
    return F.transform(tokens, lambda t: F.xxhash64(t).bitwiseAND(F.lit(BUCKETS - 1)).cast("int"))


def _path_tokens(path: Column) -> Column:
    return F.transform(F.regexp_extract_all(F.lower(path), F.lit(r"\p{L}+"), F.lit(0)), lambda t: F.concat(F.lit("p:"), t))


def odds(tokens: DataFrame, decided: dict[str, int]) -> tuple[float, np.ndarray]:
    """Prior and per-bucket log odds of ``block`` from (bucket, verdict, n); add-one smoothing over used buckets."""
    sums = tokens.groupBy("bucket").agg(*[F.sum(F.when(F.col("verdict") == v, F.col("n")).otherwise(0)).alias(v) for v in ("allow", "block")])
    rows = sums.collect()  # at most BUCKETS
    c = np.zeros((2, BUCKETS))
    for x in rows:
        c[:, x.bucket] = x.allow, x.block
    used = max(1, len(rows))
    p = np.log((c + 1) / (c.sum(axis=1, keepdims=True) + used))
    return math.log((decided.get("block", 0) + 1) / (decided.get("allow", 0) + 1)), p[1] - p[0]


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, odds (log odds of ``block``; null where a rule decides)."""
    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    rows = stored(rows.withColumn("fit", matching_rule(F.col("host"), F.col("path"), rules)), "url_rows")
    counts = stored(word_counts(pages.select("html")), "url_words")
    total = float(counts.agg(F.sum("n")).first()[0] or 1)
    pieces = rows.select("host").distinct().select("host", F.posexplode(F.regexp_extract_all("host", F.lit(r"\p{L}+"), F.lit(0))).alias("at", "name"))
    split = segmented(pieces.select("name").distinct(), counts, total)
    hosts = stored(pieces.join(split, "name").groupBy("host").agg(F.sort_array(F.collect_list(F.struct("at", "words"))).alias("w"))  # a host's own parts
                   .select("host", F.transform(F.flatten(F.transform("w", lambda x: x["words"])), lambda t: F.concat(F.lit("h:"), t)).alias("tokens")), "url_hosts")
    ruled = rows.where("fit is not null").select("host", "path", F.col("fit.verdict").alias("verdict"))
    by_host = ruled.groupBy("host", "verdict").agg(F.count(F.lit(1)).alias("n"))
    seen = (by_host.join(hosts, "host").select(F.explode(_buckets(F.col("tokens"))).alias("bucket"), "verdict", "n")
            .unionByName(ruled.select(F.explode(_buckets(_path_tokens(F.col("path")))).alias("bucket"), "verdict", F.lit(1).cast("long").alias("n"))))
    prior, table = odds(seen, {x.verdict: x["sum(n)"] for x in by_host.groupBy("verdict").agg(F.sum("n")).collect()})
    model = pages.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value = [None if fit is not None else prior + float(model.value[np.array(at, np.int64)].sum())
                     for at, fit in zip(batch["at"].to_pylist(), batch["rule"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in ("page_id", "host", "path", "rule", "verdict")), pa.array(value, pa.float64())], names=["page_id", "host", "path", "rule", "verdict", "odds"])

    out = rows.join(hosts, "host", "left").select("page_id", "host", "path", F.col("fit.rule").alias("rule"), F.col("fit.verdict").alias("verdict"),
                                                 _buckets(F.concat(F.coalesce("tokens", F.array().cast("array<string>")), _path_tokens(F.col("path")))).alias("at"))
    out = out.mapInArrow(run, "page_id long, host string, path string, rule string, verdict string, odds double")
    return out.withColumn("verdict", F.coalesce("verdict", F.when(F.col("odds") > 0, "block").otherwise("allow")))
