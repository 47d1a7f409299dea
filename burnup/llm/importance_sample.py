"""Documents drawn to resemble a target text: importance weights over hashed n-grams, Gumbel top-k (operator 12).

Features are a text's words and pairs of neighbouring words, ASCII letters lowered. A feature's bucket is
the CRC-32 of its bytes modulo ``BUCKETS``. A bucket's gain is the log ratio of its smoothed share in the
target to that in all documents, in thousandths; a document's weight is the mean gain of its features. A Gumbel
number from the document's id is added and the highest scores are drawn, which samples without
replacement in proportion to the weights.

CRCs. Words lie in one buffer, each followed by one space, so that a word and a pair are both one run of bytes.
The distinct features of a block of words are grouped by length; a group is a matrix of bytes, a row per
feature, and the CRCs of all its rows are brought forward column by column. The buckets go back to
the features' places. Features of over ``LONG_FEATURE`` bytes, of which there are few per byte of text, are
summed one by one; the result is the same.

Distribution. Texts are read once: a document becomes its distinct buckets and their counts (``BUCKETS``
entries at most, however long it is), stored. Totals per bucket are summed in each task before they
are shuffled. The gains, ``BUCKETS`` numbers, go to all tasks. Scores are ordered by ranges, stored with their place,
and counted per range; no task sees more than its range.

Defined cases: null and empty texts and texts without words have no feature and weight 0; without benchmark texts
every bucket's t and T are 0; a row without doc_id is hashed as the empty id and comes last among equal scores;
rows that repeat an id are drawn each for itself, equal rows in any order; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burnup.llm.base import doc_key, stored
from burnup.llm.columns import LOWER, chunks, per_row

BUCKETS = 10_000
BLOCK_WORDS = 1 << 18
LONG_FEATURE = 128
#: Bytes of a matrix of features.
MATRIX_BYTES = 1 << 22

IS_WORD = np.zeros(256, bool)
IS_WORD[0x30:0x3A] = IS_WORD[0x61:0x7B] = IS_WORD[0x80:] = True


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, np.uint32(0xEDB88320) ^ (c >> np.uint32(1)), c >> np.uint32(1))
    return c


CRC = _crc_table()


def crc32_spans(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of each byte span of ``data``."""
    out = np.empty(len(starts), np.uint32)
    order = np.argsort(lengths, kind="stable")
    sizes, first = np.unique(lengths[order], return_index=True)
    for size, a, b in zip(sizes.tolist(), first.tolist(), [*first[1:].tolist(), len(order)], strict=True):
        if size > LONG_FEATURE:
            for i in order[a:b].tolist():
                out[i] = zlib.crc32(data[starts[i]: starts[i] + size])
            continue
        windows = np.lib.stride_tricks.sliding_window_view(data, size)
        step = max(1, MATRIX_BYTES // size)
        for at in range(a, b, step):
            some = order[at: min(at + step, b)]
            matrix = np.ascontiguousarray(windows[starts[some]].T)  # one feature per column in memory, one byte place per row
            crc = np.full(len(some), 0xFFFFFFFF, np.uint32)
            for place in matrix:
                crc = CRC[(crc ^ place) & np.uint32(0xFF)] ^ (crc >> np.uint32(8))
            out[some] = ~crc
    return out


def words(buf: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words of all texts, each followed by one space: bytes, where each starts (and a last bound), and how many each text has."""
    low = LOWER[buf]
    inside = np.zeros(len(low) + 1, bool)
    inside[:-1] = IS_WORD[low]
    step = np.diff(inside.astype(np.int8), prepend=np.int8(0))
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    inside[ends] = True
    low = np.append(low, np.uint8(32))
    low[ends] = 32
    at = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts + 1, out=at[1:])
    return low[inside], at, per_row(starts, bounds)


def feature_counts(data: np.ndarray, at: np.ndarray, n: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, count) of all words and pairs of neighbouring words, in order of row and bucket."""
    row = np.repeat(np.arange(len(n)), n)
    keys, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for a in range(0, len(row), BLOCK_WORDS):
        b = min(a + BLOCK_WORDS, len(row))
        more = min(b + 1, len(row))  # the last word's neighbour
        offsets = pa.py_buffer(np.ascontiguousarray(at[a: more + 1]))
        listed = pa.Array.from_buffers(pa.large_binary(), more - a, [None, offsets, pa.py_buffer(data)]).dictionary_encode()
        word = listed.indices.to_numpy().astype(np.int64)
        distinct, first = np.unique(word, return_index=True)
        pairs = a + np.flatnonzero(row[a: more - 1] == row[a + 1: more])
        _, first2, place2 = np.unique(word[pairs - a] * len(distinct) + word[pairs - a + 1], return_index=True, return_inverse=True)
        spans = np.concatenate([a + first, pairs[first2]])
        last = spans + np.repeat([1, 2], [len(first), len(first2)])
        bucket = (crc32_spans(data, at[spans], at[last] - at[spans] - 1) % np.uint32(buckets)).astype(np.int64)
        key = np.concatenate([row[a:b] * buckets + bucket[word[: b - a]], row[pairs] * buckets + bucket[len(first) + place2]])
        key, count = np.unique(key, return_counts=True)
        keys.append(key)
        counts.append(count)
    key, place = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(place, np.concatenate(counts), len(key)).astype(np.int64)
    return key // buckets, key % buckets, total


FEATURES = "doc_id long, n_words long, n_features long, buckets binary, counts binary"


def _features(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, buf, bounds in chunks(batch["text"]):
                data, at, n = words(buf, bounds)
                row, bucket, count = feature_counts(data, at, n, buckets)
                cuts = np.searchsorted(row, np.arange(b - a + 1)).tolist()
                pieces = list(zip(cuts[:-1], cuts[1:], strict=True))
                bucket, count = bucket.astype("<u4"), count.astype("<u4")
                n = n.astype(np.int64)
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(a, b - a), pa.array(n), pa.array(n + np.maximum(n - 1, 0)), pa.array([bucket[x:y].tobytes() for x, y in pieces], pa.binary()),
                                                  pa.array([count[x:y].tobytes() for x, y in pieces], pa.binary())], names=["doc_id", "n_words", "n_features", "buckets", "counts"])

    return run


def features(texts: DataFrame, doc_id, buckets: int = BUCKETS) -> DataFrame:
    """doc_id, n_words, n_features and the distinct buckets and their counts (little-endian unsigned 32-bit integers) per row."""
    rows = texts.select(doc_id.cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return rows.mapInArrow(_features(buckets), FEATURES)


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All rows' integers, and how many each has."""
    each = [np.frombuffer(x.as_py(), "<u4") for x in column]
    return np.concatenate(each).astype(np.int64), np.array([len(x) for x in each])


def bucket_totals(found: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): how many features all rows have in a bucket; summed in each task first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            if len(batch):
                bucket, count = _flat(batch["buckets"])[0], _flat(batch["counts"])[0]
                total += np.bincount(bucket, count, buckets).astype(np.int64)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    return found.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(own: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> np.ndarray:
    """Thousandths of the log ratio of each bucket's smoothed shares."""
    s_all, t_all = sum(own.values()), sum(target.values())
    return np.array([math.floor(1000 * math.log((target.get(b, 0) + 1) * (s_all + buckets) / ((own.get(b, 0) + 1) * (t_all + buckets)))) for b in range(buckets)], np.int64)


def gumbel(doc_id: int | None, seed: int) -> int:
    """Thousandths of a Gumbel number from a document's id."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _score(gain: np.ndarray, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            (bucket, n), (count, _) = _flat(batch["buckets"]), _flat(batch["counts"])
            sums = np.zeros(len(bucket) + 1, np.int64)
            np.cumsum(gain[bucket] * count, out=sums[1:])
            ends = np.cumsum(n)
            n_features = batch["n_features"].to_numpy()
            weight = (sums[ends] - sums[ends - n]) // np.maximum(n_features, 1)
            score = weight + np.array([gumbel(x, seed) for x in batch["doc_id"].to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays([*(batch[x] for x in ("doc_id", "n_words", "n_features")), pa.array(weight), pa.array(score)], names=["doc_id", "n_words", "n_features", "weight", "score"])

    return run


def ranked(rows: DataFrame, order: list) -> DataFrame:
    """``rows`` with ``rank``, 1, 2, 3... in the given order, without a task that sees all of them.

    Rows are dealt by ranges of the order and stored with their range and place; a rank is the place plus the
    rows of all ranges before. The ranges' counts, one number per partition, come through the driver.
    """
    spark = rows.sparkSession
    placed = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), "ranges")
    placed = placed.withColumn("_range", F.shiftright("_at", 33)).withColumn("_place", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
    before, listed = 0, []
    for r in placed.groupBy("_range").count().orderBy("_range").collect():
        listed.append((r["_range"], before))
        before += r["count"]
    offsets = spark.createDataFrame(listed, "_range long, _before long")
    return placed.join(offsets, "_range").withColumn("rank", F.col("_before") + F.col("_place") + 1).drop("_at", "_range", "_place", "_before")


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, min_words: int = 20, seed: int = 7, buckets: int = BUCKETS) -> DataFrame:
    """doc_id, n_features, weight, score and rank (null: not drawn) per row; ``target`` has a column text."""
    own = stored(features(docs, F.col("doc_id"), buckets), "features")
    totals = [{r["bucket"]: r["n"] for r in bucket_totals(x, buckets).collect()} for x in (own, features(target, F.lit(None), buckets))]
    scored = stored(own.mapInArrow(_score(gains(*totals, buckets), seed), "doc_id long, n_words long, n_features long, weight long, score long"), "scores")
    enough = F.col("n_words") >= min_words
    quota = percent * scored.where(enough).count() // 100
    drawn = ranked(scored.where(enough), [F.col("score").desc(), doc_key().asc()])
    out = drawn.withColumn("rank", F.when(F.col("rank") <= quota, F.col("rank")))
    rest = scored.where(~enough).withColumn("rank", F.lit(None).cast("long"))
    return out.unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank")
