"""Language-model scores from a log-frequency Bloom filter (operator 2).

Texts are turned once into stored batches: the distinct token hashes of about ``BATCH_TOKENS`` tokens
and the tokens as places in that list. All counting goes by batch, so a token that a batch holds a
million times is one entry in any shuffle.

Counts. Each batch sends its distinct tokens, split into buckets by hash, with their number in
training texts; a bucket sums them over all batches, makes its part of the unigram filter and returns every batch its
counts (for the exact ``base_score``) and its levels in the filter. Distinct bigrams of all texts go
the same way and get their levels back.

Filter. An n-gram of count c is entered under 1 + floor(log2 c) levels, each by ``HASHES`` bits of its
bucket's part, ``ENTRY_BITS`` bits to an entry however many entries there are. A lookup probes level
after level until one is missing; the last one present gives the count's expectation (levels are never
underestimated, and overestimated with the filter's small error). A part is made and probed in its
bucket's task and never leaves it, so nothing is gathered, and no bound is needed on all parts.

Score. log10 of the product of p(w | h) = (c(h w) + PRIOR * p(w)) / (C(h) + PRIOR) over all tokens,
with p(w) = (c(w) + 0.5) / (C + 0.5 (V + 1)) and all c from the filter. C is the sum of c(w) over all
words and C(h) that of c(h w) over all followers of h, so that the probabilities after any h sum to one (but
for the filter's error). The first token's h is the start of the text. For C(h), the buckets make one
batch the owner of each bigram; batches sum what they own by context, and the sums go by the context's bucket.

Defined cases: null text is empty (one token, its end); a row without doc_id is in neither fold
(held_out false, not learned from); rows that repeat an id are texts of their own; an empty training
fold gives uniform probabilities; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burnup.llm.base import stored
from burnup.llm.columns import GOLD, LOWER, MIX1, MIX2, chunks, groups, mix, per_row, word_hashes, token_bounds

FOLDS, HELD_OUT = 5, 1
BATCH_TOKENS = 1 << 19
#: Bytes of text for each bucket of n-grams.
BUCKET_BYTES = 1 << 24
ENTRY_BITS, HASHES = 10, 6
#: Beside a level: the batch owns the n-gram.
OWNER = np.uint8(0x80)
#: Weight of the unigram in tokens of context; 20 to 2,000 were tried on held-out texts.
PRIOR = 1000.0
END, START = np.uint64(0x656E64), np.uint64(0x7374617274)

BATCH = "batch long, doc_id array<bigint>, part array<int>, n_tokens array<int>, tokens binary, hashes binary"


def _as(column: pa.ChunkedArray | pa.Array, kind: str) -> list[np.ndarray]:
    return [np.frombuffer(x.as_py(), kind) for x in column]


def _by_bucket(h: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes in order of their bucket, and the place of each hash among them."""
    distinct, places = np.unique(h, return_inverse=True)
    order = np.argsort(distinct % np.uint64(buckets), kind="stable")
    rank = np.empty(len(order), np.uint32)
    rank[order] = np.arange(len(order), dtype=np.uint32)
    return distinct[order], rank[places]


def _batches(buckets: int, most: int):
    """Rows of texts to batches; distinct hashes are in order of their bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, number = 0, 0

        def out() -> pa.RecordBatch:
            ids, part, n, h = (np.concatenate(x) for x in zip(*held, strict=True))
            distinct, places = _by_bucket(h, buckets)
            id_list = pa.array([ids.tolist()], pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId() << 32 | number]), id_list, pa.array([part.tolist()], pa.list_(pa.int32())), pa.array([n.tolist()], pa.list_(pa.int32())),
                                               pa.array([places.tobytes()], pa.binary()), pa.array([distinct.tobytes()], pa.binary())], names=["batch", "doc_id", "part", "n_tokens", "tokens", "hashes"])

        for batch in batches:
            ids = np.array(batch["doc_id"].to_pylist(), object)
            part = batch["part"].to_numpy()
            for a, b, buf, bounds in chunks(batch["text"]):
                low = LOWER[buf]
                starts, ends = token_bounds(low)
                n = per_row(starts, bounds)
                h = np.insert(word_hashes(low, starts, ends), np.cumsum(n), END)
                held.append((ids[a:b], part[a:b], n + 1, h))
                size += len(h)
                if size >= most:
                    yield out()
                    held, size, number = [], 0, number + 1
        if held:
            yield out()

    return run


def levels(counts: np.ndarray) -> np.ndarray:
    """1 + floor(log2 c); 0 for none."""
    return np.frexp(counts.astype(np.float64))[1] * (counts > 0)


def expected(level: np.ndarray) -> np.ndarray:
    """Mean of the counts of a level: 2^(q-1) to 2^q - 1."""
    return np.where(level > 0, (3.0 * np.exp2(level - 1.0) - 1) / 2, 0.0)


def _bits(keys: np.ndarray, level: np.ndarray | int, i: int, size: np.ndarray | np.uint64) -> np.ndarray:
    seed = np.asarray(level).astype(np.uint64) * MIX2 + np.full(1, i + 1, np.uint64) * MIX1
    return mix(keys ^ (seed * GOLD)) % size


def fill(keys: np.ndarray, counts: np.ndarray, most_bits: int | None = None, entry_bits: int = ENTRY_BITS) -> np.ndarray:
    """A filter's part (bytes) with the n-grams entered under all their levels; as large as they need unless bounded."""
    q = levels(counts)
    size = max(64, int(q.sum()) * entry_bits)
    size = (size if most_bits is None else min(size, max(64, most_bits))) + 63 & ~63
    bits = np.zeros(size, bool)
    for level in range(1, int(q.max(initial=0)) + 1):
        some = keys[q >= level]
        for i in range(HASHES):
            bits[_bits(some, level, i, np.uint64(size))] = True
    return np.packbits(bits, bitorder="little")


class Filter:
    """Parts by bucket, laid out after another."""

    def __init__(self, parts: list[bytes] | tuple[bytes, list[int]]):
        data, length = parts if isinstance(parts, tuple) else (b"".join(parts), [len(p) for p in parts])
        self.bits = np.frombuffer(data, np.uint8)
        size = 8 * np.array(length, np.uint64)
        self.size, self.first = np.maximum(size, 1), np.cumsum(size) - size
        self.empty = size == 0

    def level(self, keys: np.ndarray) -> np.ndarray:
        """Highest level up to which every level is present."""
        out = np.zeros(len(keys), np.int64)
        if not len(self.size):
            return out
        bucket = (keys % np.uint64(len(self.size))).astype(np.int64)
        alive, level = np.flatnonzero(~self.empty[bucket]), 1
        while len(alive):
            for i in range(HASHES):
                b = bucket[alive]
                at = _bits(keys[alive], level, i, self.size[b]) + self.first[b]
                alive = alive[(self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1]
                if not len(alive):
                    break
            out[alive] = level
            level += 1
        return out


def bigrams(h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Key of each token with the one before it in its text."""
    before = np.empty_like(h)
    before[1:] = h[:-1]
    before[np.cumsum(n) - n] = START
    return mix(before * MIX1 + mix(h ^ GOLD))


def _split(keys: np.ndarray, counts: np.ndarray, buckets: int) -> Iterator[tuple[int, bytes, bytes]]:
    """Entries in order of their bucket, cut into buckets."""
    bucket = (keys % np.uint64(buckets)).astype(np.int64)
    cuts = np.searchsorted(bucket, np.arange(buckets + 1))
    for b in np.unique(bucket).tolist():
        part = slice(cuts[b], cuts[b + 1])
        yield b, keys[part].tobytes(), counts[part].astype("<u4").tobytes()


def _send(buckets: int, order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                one = batch.slice(row, 1)
                tokens, keys = _as(one["tokens"], "<u4")[0], _as(one["hashes"], "<u8")[0]
                n, part = one["n_tokens"].flatten().to_numpy(), one["part"].flatten().to_numpy()
                if order == 2:
                    keys, tokens = _by_bucket(bigrams(keys[tokens], n), buckets)
                counts = np.bincount(tokens[np.repeat(part == 0, n)], minlength=len(keys))
                rows = list(_split(keys, counts, buckets))
                name = one["batch"][0].as_py()
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([name] * len(rows), pa.int64()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary())],
                                                 names=["bucket", "batch", "keys", "counts"])

    return run


def _sum(give_counts: bool, entry_bits: int):
    """Per bucket: sums over all batches, its part of the filter, and each batch's levels (and counts)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in groups(batches, "bucket"):
            each, number = _as(rows["keys"], "<u8"), _as(rows["counts"], "<u4")
            distinct, place = np.unique(np.concatenate(each), return_inverse=True)
            total = np.bincount(place, np.concatenate(number), len(distinct)).astype(np.int64)
            known = total > 0
            level = Filter([fill(distinct[known], total[known], None, entry_bits).tobytes() if known.any() else b""]).level(distinct).astype(np.uint8)
            mass = int((2 * expected(level[known])).sum())
            ends = np.cumsum([0, *map(len, each)])
            owner = np.zeros(len(place), np.uint8)
            owner[np.unique(place, return_index=True)[1]] = OWNER
            owner[~known[place]] = 0
            places = [place[x:y] for x, y in zip(ends[:-1], ends[1:], strict=True)]
            counts = [total[x].astype("<i8").tobytes() if give_counts else None for x in places]
            none = [0] * len(places)
            yield pa.RecordBatch.from_arrays([pa.array([bucket] * (1 + len(places)), pa.int32()), pa.array([None, *rows["batch"].to_pylist()], pa.int64()), pa.array([None, *((level[x] | owner[i: j]).tobytes() for x, i, j in zip(places, ends[:-1], ends[1:], strict=True))], pa.binary()), pa.array([None, *counts], pa.binary()),
                                              pa.array([int(known.sum()), *none], pa.int64()), pa.array([int(total.sum()), *none], pa.int64()), pa.array([mass, *none], pa.int64())],
                                             names=["bucket", "batch", "levels", "counts", "n_distinct", "n_total", "mass"])

    return run


#: ``mass`` is twice the sum of the expected counts, a whole number.
SUMS = "bucket int, batch long, levels binary, counts binary, n_distinct long, n_total long, mass long"


def _counted(batched: DataFrame, buckets: int, order: int, entry_bits: int) -> DataFrame:
    sent = batched.mapInArrow(_send(buckets, order), "bucket int, batch long, keys binary, counts binary")
    return stored(sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_sum(order == 1, entry_bits), SUMS), f"lm_sums{order}")


def _contexts(tokens: np.ndarray, n: np.ndarray, unigrams: int) -> np.ndarray:
    """Place of the token before each one; the start of a text is the place after all tokens'."""
    before = np.empty(len(tokens), np.int64)
    before[1:] = tokens[:-1]
    before[np.cumsum(n) - n] = unigrams
    return before


def _send_contexts(buckets: int):
    """Batches with their bigrams' levels to twice the counts they own, by context; the start of a text has a bucket of its own."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                one = batch.slice(row, 1)
                tokens, keys = _as(one["tokens"], "<u4")[0], _as(one["hashes"], "<u8")[0]
                n = one["n_tokens"].flatten().to_numpy()
                _, pairs = _by_bucket(bigrams(keys[tokens], n), buckets)
                level = _joined(one["bi"], "levels", np.uint8)
                context = np.empty(len(level), np.int64)
                context[pairs] = _contexts(tokens, n, len(keys))
                own = (level & OWNER) > 0
                twice = np.bincount(context[own], 2 * expected(level[own] & ~OWNER), len(keys) + 1).astype("<i8")
                bucket = (keys % np.uint64(buckets)).astype(np.int64)
                cuts = np.searchsorted(bucket, np.arange(buckets + 1))
                rows = [(b, keys[cuts[b]: cuts[b + 1]].tobytes(), twice[cuts[b]: cuts[b + 1]].tobytes()) for b in np.unique(bucket).tolist()]
                rows.append((buckets, START.tobytes(), twice[-1:].tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([one["batch"][0].as_py()] * len(rows), pa.int64()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary())],
                                                 names=["bucket", "batch", "keys", "counts"])

    return run


def _sum_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per bucket: the sums of all batches, for each batch's own contexts."""
    for bucket, rows in groups(batches, "bucket"):
        each, number = _as(rows["keys"], "<u8"), _as(rows["counts"], "<i8")
        distinct, place = np.unique(np.concatenate(each), return_inverse=True)
        total = np.zeros(len(distinct), "<i8")
        np.add.at(total, place, np.concatenate(number))
        ends = np.cumsum([0, *map(len, each)])
        yield pa.RecordBatch.from_arrays([pa.array([bucket] * len(each), pa.int32()), rows["batch"].combine_chunks() if isinstance(rows["batch"], pa.ChunkedArray) else rows["batch"],
                                          pa.array([total[place[i: j]].tobytes() for i, j in zip(ends[:-1], ends[1:], strict=True)], pa.binary())], names=["bucket", "batch", "counts"])


def _back(sums: DataFrame, name: str, *fields: str) -> DataFrame:
    """What the buckets returned to each batch: of its own n-grams."""
    return sums.where("batch is not null").groupBy("batch").agg(F.collect_list(F.struct("bucket", *fields)).alias(name))


def _joined(back: pa.Array, field: str, kind: str) -> np.ndarray:
    """A batch's values from its buckets, in their order."""
    return np.concatenate([np.frombuffer(x[field], kind) for x in sorted(back[0].as_py(), key=lambda x: x["bucket"])])


def _score(buckets: int, n_all: int, v_all: int, mass: float, prior: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        below, quantised = n_all + 0.5 * (v_all + 1), mass + 0.5 * (v_all + 1)
        for batch in batches:
            for row in range(len(batch)):
                one = batch.slice(row, 1)
                tokens, keys = _as(one["tokens"], "<u4")[0], _as(one["hashes"], "<u8")[0]
                n, part = one["n_tokens"].flatten().to_numpy(), one["part"].flatten().to_numpy()
                c = _joined(one["uni"], "counts", "<i8")
                first = np.cumsum(n) - n
                q = expected(_joined(one["uni"], "levels", np.uint8) & ~OWNER)
                _, pairs = _by_bucket(bigrams(keys[tokens], n), buckets)
                pair = expected(_joined(one["bi"], "levels", np.uint8) & ~OWNER)[pairs]
                context = (_joined(one["after"], "counts", "<i8") / 2.0)[_contexts(tokens, n, len(keys))]
                p = (np.minimum(pair, context) + prior * ((q + 0.5) / quantised)[tokens]) / (context + prior)
                base, known = np.log10((c + 0.5) / below)[tokens], (c > 0).astype(np.int64)[tokens]
                yield pa.RecordBatch.from_arrays([one["doc_id"].flatten(), pa.array(part == 1), pa.array(n.astype(np.int64)), pa.array(np.add.reduceat(known, first)), pa.array(np.full(len(n), n_all)),
                                                  pa.array(np.add.reduceat(base, first)), pa.array(np.add.reduceat(np.log10(p), first))],
                                                 names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return run


def score(docs: DataFrame, batch_tokens: int = BATCH_TOKENS, bucket_bytes: int = BUCKET_BYTES, entry_bits: int = ENTRY_BITS,
          prior: float = PRIOR) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score per row."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    buckets = max(1, -(-size // bucket_bytes))
    remainder = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % FOLDS
    # part: 0 learned from, 1 held out, 2 neither
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.when(remainder.isNull(), 2).when(remainder == HELD_OUT, 1).otherwise(0).cast("int").alias("part"), text.alias("text"))
    batched = stored(rows.mapInArrow(_batches(buckets, batch_tokens), BATCH), "lm_batches")
    uni = _counted(batched, buckets, 1, entry_bits)
    bi = _counted(batched, buckets, 2, entry_bits)
    n_all, v_all, mass = uni.agg(F.sum("n_total"), F.sum("n_distinct"), F.sum("mass")).first()
    pairs = _back(bi, "bi", "levels")
    owned = batched.select("batch", "n_tokens", "tokens", "hashes").join(pairs, "batch").mapInArrow(_send_contexts(buckets), "bucket int, batch long, keys binary, counts binary")
    after = stored(owned.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_sum_contexts, "bucket int, batch long, counts binary"), "lm_contexts")
    out = batched.join(_back(uni, "uni", "levels", "counts"), "batch").join(pairs, "batch").join(_back(after, "after", "counts"), "batch")
    out = out.select("doc_id", "part", "n_tokens", "tokens", "hashes", "uni", "bi", "after")
    return out.mapInArrow(_score(buckets, n_all or 0, v_all or 0, (mass or 0) / 2.0, prior), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
